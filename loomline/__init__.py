"""A Spark-native engine that turns nested event documents into season tables."""
