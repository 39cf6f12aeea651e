"""Duplicate flags for tables that are stored: only rows whose key may be repeated are shuffled.

``keyed.flag_repeated`` shuffles every row to find a few repeats. That is right for a plan whose reader may not
want the flag, as its join then vanishes; a write wants it always. Here

1. hashes of the keys are counted; some 10 bytes a key are shuffled, and copies collapse before that;
2. the hashes that occur twice set bits of a filter, 64 bits to a row, merged by ``bit_or`` over the tasks;
3. rows that miss the filter are not repeated and stay where they are. Rows that hit it, by a repeat or by
   chance, hold all rows of each of their keys, and ``keyed.flag_repeated`` decides them exactly.

The filter has at most ``bits`` / 64 + 1 rows of 16 bytes (8 MB by default), whatever the data, and is broadcast
on that ground. Where more keys are repeated than it can tell apart, more rows are shuffled and the flags are the same.
Missing keys equal each other; their one counter has a filter row of its own and is exact, so they are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.operators.keyed import flag_repeated

# Of ten billion keys, one in a hundred shares its hash and is shuffled for nothing; fewer bits make smaller rows.
HASH_BITS = 40
FILTER_BITS = 2**25


def _hashed(df: DataFrame, key: str) -> DataFrame:
    """``df`` with HASH_BITS of hash of its key; -1 is that of missing keys and of no other."""
    hashed = f"shiftrightunsigned(xxhash64(cast({key} AS string)), {64 - HASH_BITS})"
    return df.withColumn("_key_hash", F.expr(f"if({key} IS NULL, -1L, {hashed})"))


def _placed(df: DataFrame, bits: int) -> DataFrame:
    """``df`` with the filter row and the bit of its hash; row -1 is that of missing keys."""
    return (
        df.withColumn("_key_place", F.expr(f"if(_key_hash < 0, -64L, _key_hash % {bits}L)"))
        .withColumn("_key_word", F.expr("shiftright(_key_place, 6)"))
        .withColumn("_key_bit", F.expr("shiftleft(1L, cast(_key_place & 63 AS int))"))
    )


def repeat_filter(df: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The filter of keys that occur more than once: (_key_word, _key_bits), at most ``bits`` / 64 + 1 rows."""
    counted = _hashed(df.select(key), key).groupBy("_key_hash").agg(F.count(F.lit(1)).alias("_n"))
    return _placed(counted.where("_n > 1"), bits).groupBy("_key_word").agg(F.bit_or("_key_bit").alias("_key_bits"))


def flag_stored(df: DataFrame, key: str, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows and flags of ``keyed.flag_repeated``; an empty table stays empty.

    ``df`` is read four times, twice for the key alone; it has to give the same rows each time, as a stored table does.
    """
    seen = F.broadcast(repeat_filter(df, key, bits))
    met = _placed(_hashed(df, key), bits).join(seen, "_key_word", "left")
    hit = F.col("_key_bits").bitwiseAND(F.col("_key_bit")) != 0
    known, missing = F.coalesce(hit, F.lit(False)), F.col(key).isNull()
    settled = met.where(missing | ~known).select(*df.columns, known.alias(flag))
    candidates = met.where(~missing & hit).select(*df.columns)
    return settled.unionByName(flag_repeated(candidates, key, flag))
