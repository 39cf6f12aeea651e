"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.sources.layers import shared_folder

# The words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data; ``sf_dir`` may be any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage with files that survive a lost executor, and gives the planner true sizes.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key() -> list[Column]:
    """``_id`` and ``_hash``: never null, and equal only for rows with equal doc_id and text."""
    doc_id = F.col("doc_id").cast("long")
    return [
        F.coalesce(doc_id, F.lit(0)).alias("_id"),
        F.xxhash64(F.col("text").cast("string"), F.col("text").isNull(), doc_id.isNull()).alias("_hash"),
    ]


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the path in it, for files that are not tables.

    Those that pyarrow knows: local or mounted paths, hdfs, s3 (also under Hadoop's names for it) and gs.
    """
    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else uri)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python code of tasks is imported there by name, and they need not have the driver's search path.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def with_code(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query``, which takes the session first, with the package sent ahead."""

    @wraps(query)
    def run(spark: SparkSession, *arguments) -> DataFrame:
        ship_code(spark)
        return query(spark, *arguments)

    return run
