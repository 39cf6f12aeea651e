"""Raw CSV scans by header name, the rows that cannot be read, and the ingest metadata of Bronze."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstrata.functions.parse import instant
from shopstrata.sources.csv_records import has_breaks, records
from shopstrata.sources.schemas import RAW_COLUMNS

# Holds the text of a row that does not have as many cells as the header; null for all others.
BAD_ROW = "_corrupt_record"


def read_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """All rows of ``path`` (a file, a directory or a glob) with the table's columns and ``BAD_ROW``.

    Columns are taken by the names in the header, in any order; further ones are left out, and a missing one
    is an error. All files of a directory have the same header, or the scan fails. A row with more or
    fewer cells than the header has its text in ``BAD_ROW``; its other cells mean nothing.

    Quotes are doubled inside quoted cells, which may hold line breaks. One pass over the lines with quotes looks for
    such a break. Where there is none, lines are rows; else rows are found by :func:`records`. Both split large files.
    """
    options = {"header": True, "escape": '"'}
    # Only the first line of one file is read here.
    names = spark.read.options(**options).csv(path).columns
    missing = [c for c in RAW_COLUMNS[table] if c not in names]
    if missing:
        raise ValueError(f"the header of {path} lacks {', '.join(missing)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD_ROW]])
    if has_breaks(spark, path):
        return _parsed(records(spark, path), names, schema).select(*RAW_COLUMNS[table], BAD_ROW)
    read = (
        spark.read.schema(schema)
        # Cells are only counted when all of them are parsed.
        .options(**options, enforceSchema=False, columnNameOfCorruptRecord=BAD_ROW, columnPruning=False)
        .csv(path)
    )
    # Spark refuses to scan for the text of bad rows alone, so it always reads a cell as well.
    return read.where(f"length(concat_ws('', `{names[0]}`)) >= 0").select(*RAW_COLUMNS[table], BAD_ROW)


def _parsed(found: DataFrame, names: list[str], schema: T.StructType) -> DataFrame:
    """The cells of each record of :func:`records`; the header of each file is compared and left out."""
    options = {"escape": '"', "columnNameOfCorruptRecord": BAD_ROW}
    cells = found.select("first", F.from_csv("record", schema.toDDL(), options).alias("row")).select("first", "row.*")
    same = F.col(BAD_ROW).isNull()
    for name in names:
        same &= F.col(f"`{name}`").eqNullSafe(F.lit(name))
    wrong = F.raise_error(F.lit("the files do not have the same header")).cast("boolean")
    return cells.where(F.when(F.col("first") & ~same, wrong).otherwise(~F.col("first")))


def good_rows(read: DataFrame) -> DataFrame:
    """The readable rows of :func:`read_csv`, without its extra column."""
    return read.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW)


def rejected_rows(read: DataFrame, table: str) -> DataFrame:
    """(table, record): the text of the rows that cannot be read."""
    return read.where(F.col(BAD_ROW).isNotNull()).select(
        F.lit(table).alias("table"), F.col(BAD_ROW).alias("record")
    )


def scan_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The readable rows of ``path`` with exactly the table's columns."""
    return good_rows(read_csv(spark, table, path))


def read_if_present(spark: SparkSession, table: str, path: str) -> DataFrame | None:
    """The rows with ``BAD_ROW``, or None when there is no such path."""
    try:
        return read_csv(spark, table, path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stamped(raw: DataFrame, table: str, ingest_time: datetime) -> DataFrame:
    """Add the ingest time and the source file name."""
    return raw.withColumns(
        {"_ingest_timestamp": F.expr(instant(ingest_time)), "_source_file": F.lit(f"{table}.csv")}
    )


def write_csv(df: DataFrame, path: str, compression: str = "none", rows_per_file: int = 0) -> None:
    """Write with a header, replacing what is there; cells keep their outer spaces.

    A gzipped file is read by one task, so ``rows_per_file`` should bound it (0: one file per task that writes).
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
