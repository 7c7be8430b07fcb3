"""Writers. Each writes a new table; none overwrites what its own plan reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textloom.operators.graph import latest

# Header names by which bulk graph importers know keys, ends and labels.
HEADERS = {
    "concepts": {"cui": "cui:ID(Concept)", "name": "name"},
    "atoms": {"aui": "aui:ID(Atom)", "sab": "sab", "code": "code", "tty": "tty", "str": "str"},
    "has_atom": {"src": ":START_ID(Concept)", "dst": ":END_ID(Atom)"},
    "semantic_types": {"tui": "tui:ID(SemanticType)", "name": "name", "tree_number": "tree_number"},
    "has_semtype": {"src": ":START_ID(Concept)", "dst": ":END_ID(SemanticType)"},
    "relates": {"src": ":START_ID(Concept)", "dst": ":END_ID(Concept)", "rel": "rel", "rela": "rela", "sab": "sab"},
    "is_a": {"src": ":START_ID(Concept)", "dst": ":END_ID(Concept)", "sab": "sab", "rela": "rela"},
    "sources": {"sab": "sab:ID(Source)", "name": "name", "version": "version"},
    "defined_by": {"src": ":START_ID(Concept)", "dst": ":END_ID(Source)", "def": "def"},
}


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def documents(df: DataFrame, path: str) -> None:
    """A full refresh, one folder a document."""
    df.write.mode("overwrite").partitionBy("doc_id").json(path)


def graph_csv(df: DataFrame, path: str, table: str) -> None:
    """The rows as headless parts, and the header as a file of its own beside them, as bulk importers read it once."""
    named = df.select(*[F.col(c).alias(h) for c, h in HEADERS[table].items()])
    named.write.mode("overwrite").options(header=False, quoteAll=False, escape='"').csv(f"{path}/rows")
    head = df.sparkSession.createDataFrame([(",".join(named.columns),)], "value string")
    head.coalesce(1).write.mode("overwrite").text(f"{path}/header")


def snapshot(df: DataFrame, path: str, key: str = "text") -> None:
    """One row a key, in order."""
    df.orderBy(key).write.mode("overwrite").json(path)


def heading_report(df: DataFrame, path: str) -> None:
    """count<TAB>heading, most frequent first. df: term, n_docs."""
    rows = df.orderBy(F.desc("n_docs"), "term").select(F.concat_ws("\t", F.col("n_docs").cast("string"), "term").alias("value"))
    rows.coalesce(1).write.mode("overwrite").text(path)  # a report for people


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str], path: str, version: str = "_version") -> None:
    """Old and new points by key, the new ones in place of old ones, written to a new path."""
    rows = new.withColumn(version, F.lit(1))
    if old is not None:
        rows = old.withColumn(version, F.lit(0)).unionByName(rows)
    latest(rows, keys, version).drop(version).write.mode("overwrite").parquet(path)


def drop_layer(spark: SparkSession, root: str, tables: list[str]) -> None:
    """Delete the folders of a layer and leave the others."""
    jvm = spark.sparkContext._jvm
    for table in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def require(spark: SparkSession, paths: list[str]) -> None:
    """Fails with the names of inputs that are not there."""
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(", ".join(missing))


def observed(df: DataFrame, **counts) -> tuple[DataFrame, Observation]:
    """The same rows, counted on the way: read the observation after an action."""
    seen = Observation()
    return df.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen


def save_position(spark: SparkSession, path: str, key: str) -> None:
    spark.createDataFrame([(key,)], "last string").coalesce(1).write.mode("overwrite").json(path)


def load_position(spark: SparkSession, path: str) -> str | None:
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema("last string").json(path).first()
    except AnalysisException:
        return None
    return row[0] if row else None
