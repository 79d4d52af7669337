"""Part of the loomline engine; see the README for the layout."""
