"""What every part of the engine needs from the session: sessions, shipped code, shared tables."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
PIECE_ROWS = 200_000
PACKAGE = Path(__file__).resolve().parent


def session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TEXTLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Arrow functions can import it there.

    Batches for Python are bounded by their bytes, unless the session says otherwise: texts differ much in length.
    """
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, "4m")
    sc = spark.sparkContext
    if getattr(sc, "_textloom_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="textloom-")) / "textloom_code.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, str(path.relative_to(PACKAGE.parent)))
    sc.addPyFile(str(target))
    sc._textloom_shipped = True


_resident: dict = {}


def resident(build, *args):
    """What ``build(*args)`` gives, kept in this process until another is asked for.

    A worker process serves the tasks of many stages: it holds the model or memory of one operator at a time.
    """
    key = (build, *args)
    if key not in _resident:
        _resident.clear()
        _resident[key] = build(*args)
    return _resident[key]


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A local master has one of its own where it is unset."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_textloom_root", None)
    if not root and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not root:
        root = sc._textloom_root = "file://" + tempfile.mkdtemp(prefix="textloom-shared-")
    return root


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/textloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._textloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more."""
    for df in tables:
        path = getattr(df, "_textloom_path", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def pieces(*tables: DataFrame) -> int:
    """In how many pieces to deal tables, by ``repartition``, so that a task sorts or hashes about ``PIECE_ROWS`` rows of the largest."""
    return in_pieces(max(t.count() for t in tables))


def in_pieces(rows: float) -> int:
    return max(1, math.ceil(rows / PIECE_ROWS))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
