"""Game payloads, the schedule index, roster files, crosswalks and committed tables as DataFrames."""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline import schemas
from loomline.operators.relational import first_per_group
from loomline.storage import is_local, local, store_for

ROOT_ENV = "LOOMLINE_RAW_ROOT"
FAMILIES = ("pbp", "lineups", "player_box", "team_box", "shots", "possessions")
INDEX_NAMES = ("{league}_schedule_master.parquet", "schedule_master.parquet")


def resolve_root(explicit: str | None = None) -> str:
    """The raw root: the argument, or the environment's; URLs lose a trailing slash."""
    root = explicit or os.environ.get(ROOT_ENV)
    if not root:
        raise ValueError(f"no raw root: pass one or set {ROOT_ENV}")
    return root.rstrip("/") if root.startswith(("http://", "https://")) else root


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a match of its globs, exists on whatever file system it names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def pinned(schema: T.StructType) -> T.StructType:
    """An inferred payload schema with the types of what the engine reads itself fixed, and absent families empty."""
    have = {f.name: f for f in schema}
    fields = [T.StructField("contest_id", T.StringType()), T.StructField("_corrupt_record", T.StringType())]
    lineup = schemas.struct(f"x array<{schemas.LINEUP}>")["x"].dataType
    for family in FAMILIES:
        if family == "lineups":
            fields.append(T.StructField(family, lineup))
            continue
        known = schemas.EVENT if family == "pbp" else {"team": "string", "player": "string"} if family == "player_box" else {}
        found = have[family].dataType if family in have else None
        row = found.elementType if isinstance(found, T.ArrayType) and isinstance(found.elementType, T.StructType) else T.StructType()
        own = {f.name: f.dataType for f in row}
        if family == "pbp":
            # Columns that no game has stay out but for those a segment needs.
            own |= {n: schemas.struct(f"x {k}")["x"].dataType for n, k in known.items() if n in own or n not in ("event_description", "poss_num")}
        else:
            own |= {n: schemas.struct(f"x {k}")["x"].dataType for n, k in known.items()}
        fields.append(T.StructField(family, T.ArrayType(T.StructType([T.StructField(n, k) for n, k in own.items()] or [T.StructField("_none", T.StringType())]))))
    return T.StructType(fields)


def payload_paths(spark: SparkSession, path: str) -> DataFrame:
    """(path, _cid) of the payload files below a directory; nothing of their content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select("path")
    return files.withColumn("_cid", F.regexp_replace(F.url_decode(F.element_at(F.split("path", "/"), -1)), r"\.json$", ""))


def from_variants(described: str) -> T.DataType:
    """The type that ``schema_of_variant_agg`` describes as text, for columns: decimals are doubles, mixed types and those never seen are text."""

    def settled(k: T.DataType) -> T.DataType:
        if isinstance(k, T.StructType):
            return T.StructType([T.StructField(f.name, settled(f.dataType)) for f in k])
        if isinstance(k, T.ArrayType):
            return T.ArrayType(settled(k.elementType))
        if isinstance(k, (T.VariantType, T.NullType)):
            return T.StringType()
        return T.DoubleType() if isinstance(k, (T.DecimalType, T.FloatType)) else k

    return settled(T.StructType.fromDDL("x " + re.sub(r"\bOBJECT<", "STRUCT<", described))["x"].dataType)


class Payloads:
    """Payload texts, parsed once to variants that are kept in memory; families are cast from those when they are asked for.

    One job parses, unites the schemas of all payloads, and counts those that are absent (null) or
    cannot be parsed, and for each family those in which it is no list of objects (``refused``).
    Columns of all games are united and mixed types become text; columns the engine computes
    with are pinned, so a value of another kind is null. A payload is malformed if it is no JSON object.
    """

    def __init__(self, texts: DataFrame):
        """``texts`` has _cid and payload."""
        self.texts, value = texts, F.try_parse_json("payload")
        # Of a payload that is no object nothing can be taken.
        whole = F.when(F.schema_of_variant(value).startswith("OBJECT<"), value)
        self.variants = texts.select("_cid", F.col("payload").isNull().alias("absent"), whole.alias("v")).persist()
        of = {n: F.try_variant_get("v", f"$.{n}", "variant") for n in FAMILIES}
        first = {n: F.schema_of_variant(F.try_variant_get("v", f"$.{n}[0]", "variant")).startswith("OBJECT<") for n in FAMILIES}
        described = [F.schema_of_variant_agg(F.when(first[n], of[n])).alias(n) for n in FAMILIES]
        # A family that is there but no list of objects cannot be taken apart.
        odd = [F.count_if(F.when(first[n], False).otherwise(of[n].isNotNull() & ~F.is_variant_null(of[n]) & (F.schema_of_variant(of[n]) != "ARRAY<VOID>"))).alias(f"odd_{n}") for n in FAMILIES]
        seen = self.variants.agg(*described, *odd, F.count_if("absent").alias("absent"), F.count_if(F.col("v").isNull()).alias("empty")).first()
        self.absent, self.failed, found = seen["absent"], seen["empty"] - seen["absent"], {n: seen[n] for n in FAMILIES if seen[n]}
        self.refused = {n: seen[f"odd_{n}"] for n in FAMILIES}
        # A game whose list holds more than objects says nothing of the family's columns.
        mixed = [n for n, d in found.items() if not d.startswith("ARRAY<OBJECT<")]
        if mixed:
            found |= self.variants.agg(*[F.schema_of_variant_agg(F.when(F.schema_of_variant(of[n]).startswith("ARRAY<OBJECT<"), of[n])).alias(n) for n in mixed]).first().asDict()
        self.schema = pinned(T.StructType([T.StructField(n, from_variants(d)) for n, d in found.items() if d]))
        self._cast: dict[str, DataFrame] = {}

    def games(self, *families: str) -> DataFrame:
        """contest_id, the families (all if none is named) as arrays, and the id of the file name, of the payloads that could be parsed."""
        fields = [F.try_variant_get("v", f"$.{n}", ddl(self.schema[n].dataType)).alias(n) for n in ("contest_id", *(families or FAMILIES))]
        return self.variants.where("v is not null").select(*fields, "_cid")

    def family(self, name: str) -> DataFrame:
        """The games with one family, cast once and kept in memory for all that ask for it."""
        if name not in self._cast:
            self._cast[name] = self.games(name).persist()
        return self._cast[name]

    def release(self) -> None:
        for df in (self.variants, *self._cast.values()):
            df.unpersist()
        self._cast = {}


def ddl(kind: T.DataType) -> str:
    """A type as text in which every field's name is quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {ddl(f.dataType)}" for f in kind) + ">"
    return f"array<{ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


def payload_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(_cid, payload) of the JSON files below a directory, or of those listed: the id of the file name, and the whole text."""
    texts = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return texts.select(F.regexp_replace(F.url_decode(name), r"\.json$", "").alias("_cid"), F.col("value").alias("payload"))


def read_games(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The readable payloads below a directory, or of the files listed; their variants stay in memory with the session."""
    return Payloads(payload_texts(spark, path)).games()


def is_corrupt(beside: str) -> Column:
    """Whether a JSON file could not be parsed.

    Spark refuses plans that read nothing but the corrupt record, so another column is
    read along in a way that the optimizer keeps.
    """
    return F.col("_corrupt_record").isNotNull() & (F.length(F.concat_ws("", "_corrupt_record", beside)) >= 0)


def good(files: DataFrame, beside: str) -> DataFrame:
    """Rows of JSON files that could be parsed."""
    return files.where(~F.coalesce(is_corrupt(beside), F.lit(False))).drop("_corrupt_record")


def read_index(spark: SparkSession, root: str, league: str) -> DataFrame | None:
    """The schedule index of the raw tree, by its present or its former name; None if there is neither."""
    for name in INDEX_NAMES:
        path = f"{root}/{league}/{name.format(league=league)}"
        if path_exists(spark, path):
            return spark.read.parquet(path)
    return None


def season_ids(index: DataFrame, season: int) -> DataFrame:
    """Distinct contest ids of a season, in order; the index holds the season as text."""
    return index.where(F.col("season") == str(season)).select("contest_id").distinct().orderBy("contest_id")


def split_by_presence(games: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(payloads of the ids, by file name; ids without a payload)."""
    found = games.join(ids, games["_cid"] == ids["contest_id"], "left_semi")
    return found, ids.join(games, games["_cid"] == ids["contest_id"], "left_anti")


def read_roster_files(spark: SparkSession, root: str, league: str, season: int) -> DataFrame:
    """Roster files of a season, one row each; empty if the season has none, unreadable files left out."""
    path = f"{root}/{league}/team_rosters/{season}"
    if not path_exists(spark, f"{path}/*.json"):
        return spark.createDataFrame([], schemas.ROSTER_FILE).drop("_corrupt_record")
    read = spark.read.schema(schemas.ROSTER_FILE).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json").json(path)
    return good(read, "team_id")


def read_committed(spark: SparkSession, base: str, league: str, name: str, columns: list[str] | None = None) -> DataFrame | None:
    """All committed seasons of a dataset, only the columns asked for; None if nothing is committed.

    The partition column comes back as a long, as it was written.
    """
    path = f"{base}/{league}/{name}/parquet"
    if not path_exists(spark, f"{path}/season=*"):
        return None
    df = spark.read.parquet(path).withColumn("season", F.col("season").cast("long"))
    return df.select(*[c for c in columns if c in df.columns]) if columns is not None else df


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A dataset's build manifest; empty if there is none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.MANIFEST)
    return spark.read.schema(schemas.MANIFEST).option("header", True).csv(path)


def bundle_tree(spark: SparkSession, root: str | None, tree: str, beside: str = ".") -> str:
    """``root/tree`` if that exists, else the root itself; the root is the argument or the environment's.

    Without either, the first folder beside ``beside`` whose name ends in -raw and that holds the tree.
    """
    if not root and not os.environ.get(ROOT_ENV):
        around = os.path.dirname(os.path.abspath(local(beside))) if is_local(beside) else os.path.dirname(beside.rstrip("/"))
        found = [f"{around}/{name}/{tree}" for name in store_for(around, spark).names(around) if name.endswith("-raw") and path_exists(spark, f"{around}/{name}/{tree}")]
        if found:
            return found[0]
    root = resolve_root(root)
    return f"{root}/{tree}" if path_exists(spark, f"{root}/{tree}") else root


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order, on whatever file system it names; none if it does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return sorted(f.getPath().getName() for f in found or [] if f.isDirectory())


def read_bundles(spark: SparkSession, tree: str, seasons: list[str], limit: int = 0) -> DataFrame:
    """(season, file, box_score, corrupt) of gzipped page bundles; with a limit, the first files of each season."""
    schema = "pages struct<box_score: string>, _corrupt_record string"
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json.gz")
    parts = [read.json(f"{tree}/{s}").select(F.lit(s).alias("season"), F.col("_metadata.file_path").alias("file"), F.col("pages.box_score").alias("box_score"), is_corrupt("pages.box_score").alias("corrupt")) for s in seasons]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return first_per_group(out, ["season"], ["file"], limit) if limit else out
