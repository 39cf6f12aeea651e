"""CSV records with line breaks inside quoted cells, found in parallel.

A line can begin outside or inside a quoted cell, and where it ends depends on that. So each line is a map of two
states, and so is each byte range of a file (a scan split): the composition of its lines. A prefix scan over the ranges of a
file gives the true state at each range's start; within a range, running sums give it for every line. A record
ends where a line ends outside. Only records that cross ranges are put together across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A whole quoted cell, at the start of a line or after a comma; doubled quotes belong to it.
_CELL = '(?:(?<=,)|^)"[^"]*+(?:""[^"]*+)*+"'
_OPEN = '(?:^|,)"'


def leaves_open(line: Column) -> Column:
    """Whether ``line``, begun outside of quotes, ends inside a quoted cell."""
    return F.regexp_replace(line, F.lit(_CELL), F.lit("x")).rlike(_OPEN)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def has_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any cell below ``path`` contains a line break.

    Files begin outside of quotes, so the first such cell opens in a line that is judged from outside.
    """
    quoted = _lines(spark, path).where(F.col("value").contains('"'))
    return quoted.where(leaves_open(F.col("value"))).limit(1).count() > 0


def _state_before(start: Column, order: Window) -> Column:
    """The state before each row of a sequence of maps, from the columns ``from_out`` and ``from_in``.

    Behind the last row that ends alike from both states only swaps count.
    """
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.count_if(F.col("from_out") & ~F.col("from_in"))
    certain = F.when(
        F.col("from_out") == F.col("from_in"),
        F.struct(F.col("from_out").alias("state"), F.col("swaps_to").alias("swaps")),
    )
    last = F.last(certain, ignorenulls=True).over(earlier)
    before = F.coalesce(swaps.over(earlier), F.lit(0))
    known = F.coalesce(last["state"], start)
    odd = (before - F.coalesce(last["swaps"], F.lit(0))) % 2 == 1
    return known != odd


def _with_state(maps: DataFrame, start: Column, order: Window) -> DataFrame:
    """``maps`` with ``inside``: whether a row begins inside a quoted cell."""
    here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps_to = F.count_if(F.col("from_out") & ~F.col("from_in")).over(here)
    return maps.withColumn("swaps_to", swaps_to).withColumn("inside", _state_before(start, order)).drop("swaps_to")


def _mapped(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, byte range and place in it, and where they end from outside and from inside."""
    value = F.col("value")
    quoted = value.contains('"')
    return _lines(spark, path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"), "value",
        (quoted & leaves_open(value)).alias("from_out"),
        (~quoted | leaves_open(F.concat(F.lit('"'), value))).alias("from_in"),
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, range, starts_inside, ends_inside): the true states at both ends of each byte range."""
    changing = F.when(~F.col("from_in") | F.col("from_out"), F.struct("line", "from_out", "from_in"))
    listed = lines.groupBy("file", "range").agg(F.sort_array(F.collect_list(changing)).alias("changes"))

    def end(start: bool) -> Column:
        return F.aggregate(
            "changes", F.lit(start), lambda state, x: F.when(state, x["from_in"]).otherwise(x["from_out"])
        )

    maps = listed.select("file", "range", end(False).alias("from_out"), end(True).alias("from_in"))
    found = _with_state(maps, F.lit(False), Window.partitionBy("file").orderBy("range"))
    return found.select(
        "file", "range", F.col("inside").alias("starts_inside"),
        F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out")).alias("ends_inside"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, first) with the text of every record; ``first`` marks the first of its file.

    Line breaks within a record stay as they are; a carriage return at its end and blank lines go. Where the last quote
    of a file is never closed, each line from there on is a record of its own.
    """
    lines = _mapped(spark, path)
    place = Window.partitionBy("file", "range")
    order = place.orderBy("line")
    known = _with_state(lines.join(_ranges(lines), ["file", "range"]), F.col("starts_inside"), order)
    numbered = known.withColumn("number", F.count_if(~F.col("inside")).over(order)).withColumn(
        "last", F.max("number").over(place)
    )
    joined = (
        numbered.groupBy("file", "range", "number", "last", "ends_inside")
        .agg(F.sort_array(F.collect_list(F.struct("line", "value"))).alias("parts"))
        .withColumn("record", F.array_join("parts.value", "\n"))
    )
    cut = (F.col("number") == 0) | (F.col("ends_inside") & (F.col("number") == F.col("last")))
    whole = joined.where(~cut).select("file", "record", ((F.col("range") == 0) & (F.col("number") == 1)).alias("first"))

    # At most two parts per range: the end of a record, and the beginning of the next.
    sequence = Window.partitionBy("file").orderBy("range", "number")
    parts = joined.where(cut).select(
        "file", "range", "number", "record",
        F.count_if(F.col("number") > 0).over(sequence).alias("chain"),
        F.last("ends_inside").over(sequence.rowsBetween(0, Window.unboundedFollowing)).alias("never_closed"),
        F.max(F.when(F.col("number") > 0, F.struct("range", "number"))).over(
            Window.partitionBy("file")
        ).alias("newest"),
    ).withColumn("alone", F.col("never_closed") & (F.struct("range", "number") >= F.col("newest")))
    first = F.min((F.col("range") != 0) | (F.col("number") != 1))
    chained = parts.where(~F.col("alone")).groupBy("file", "chain").agg(
        F.sort_array(F.collect_list(F.struct("range", "number", "record"))).alias("parts"), (~first).alias("first")
    ).select("file", F.array_join("parts.record", "\n").alias("record"), "first")
    lone = parts.where("alone").select(
        "file", F.posexplode(F.split("record", "\n")).alias("at", "record"), "range", "number"
    ).select("file", "record", ((F.col("range") == 0) & (F.col("number") == 1) & (F.col("at") == 0)).alias("first"))

    found = whole.unionByName(chained).unionByName(lone)
    return found.withColumn("record", F.regexp_replace("record", "\r$", "")).where(F.length(F.trim("record")) > 0)
