"""Duplicate flags that shuffle candidates only: against counting in Python, and by what is shuffled."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopstrata.operators.keyed import flag_repeated
from shopstrata.operators.repeats import FILTER_BITS, flag_stored, repeat_filter
from shopstrata.plans.silver import CLEANERS, STORED_CLEANERS
from shopstrata.sources.star_adapter import raw_tables

ROWS = (
    [("hot", i // 2) for i in range(400)]
    + [(None, i // 2) for i in range(400)]
    + [(f"k{i % 350}", i) for i in range(400)]
    + [("", 1), ("-", 2), ("single", 3)]
)


def _flagged(rows):
    times = Counter(key for key, _ in rows)
    return Counter((key, n, times[key] > 1) for key, n in rows)


def _shuffled(df):
    """Bytes that the exchanges of a plan wrote while its rows were collected."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleBytesWritten")
        found = own.get().value() if name == "ShuffleExchangeExec" and own.isDefined() else 0
        children = node.children()
        return found + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


# 64 bits are one row of the filter, which every key hits; the default tells all keys apart.
@pytest.mark.parametrize("bits", [64, 1024, FILTER_BITS])
def test_flags(spark, bits):
    df = spark.createDataFrame(ROWS, "key string, n int").repartition(5)
    found = flag_stored(df, "key", "again", bits)
    assert found.columns == ["key", "n", "again"]
    assert Counter(map(tuple, found.collect())) == _flagged(ROWS)


@pytest.mark.parametrize("rows", [[], [(None, 1)], [(None, 1), (None, 1)], [("a", 1)], [("a", 1), ("a", 1), (None, 2)]])
def test_small_tables(spark, rows):
    found = flag_stored(spark.createDataFrame(rows, "key string, n int"), "key", "again")
    assert Counter(map(tuple, found.collect())) == _flagged(rows)


def test_every_key_repeated(spark):
    """The filter is full, and the flags are the same."""
    rows = [(f"k{i // 2}", i) for i in range(4000)] + [("single", 0)]
    found = flag_stored(spark.createDataFrame(rows, "key string, n int"), "key", "again", 128)
    assert Counter(map(tuple, found.collect())) == _flagged(rows)


def test_filter_is_bounded(spark):
    df = spark.range(20000).selectExpr("concat('k', id % 10000) AS key")
    found = repeat_filter(df.unionByName(df.selectExpr("CAST(NULL AS string) AS key")), "key", 4096)
    words = [r["_key_word"] for r in found.collect()]
    assert len(words) == len(set(words)) <= 65
    assert set(words) <= set(range(-1, 64))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """100,000 rows of some 270 bytes; every 1,000th key twice, and a fifth of the keys missing."""
    path = str(tmp_path_factory.mktemp("repeats"))
    rows = spark.range(100000).selectExpr(
        "if(id % 5 = 4, NULL, concat('order-', if(id % 1000 = 1, id - 1, id))) AS key",
        *[f"sha2(cast(id + {i} AS string), 256) AS c{i}" for i in range(4)],
    )
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def no_small_sides(spark):
    """Tests' tables are below Spark's broadcast limit; large ones are not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_candidates_are_shuffled(spark, stored, no_small_sides):
    plain, narrow = flag_repeated(stored, "key", "again"), flag_stored(stored, "key", "again")
    assert narrow.where("again AND key IS NOT NULL").count() == 200
    assert narrow.where("again AND key IS NULL").count() == 20000
    less, more = _shuffled(narrow), _shuffled(plain)
    print(less, more)
    assert 0 < less < more / 10


@pytest.mark.parametrize("table", ["customers", "orders"])
def test_cleaners_for_the_store_agree(spark, table):
    raw = raw_tables(spark, "/root/testdata/sf0.001")[table]
    plain, narrow = CLEANERS[table](raw), STORED_CLEANERS[table](raw)
    assert plain.schema.names == narrow.schema.names
    assert Counter(map(tuple, narrow.collect())) == Counter(map(tuple, plain.collect()))
    flag = narrow.columns[-1]
    assert 0 < narrow.where(F.col(flag)).count() < narrow.count()
