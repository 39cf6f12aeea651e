"""Ordered concatenation in parts, against plain lists."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shopstrata.operators import parts
from shopstrata.plans import quality

SCHEMA = "email string, customer_id string, _group int"


def rows():
    """A third of the rows under one key, a third without a key, one value very often, some missing values."""
    found = [("hot", f"C{i * 7919 % 3000}") for i in range(3000)]
    found += [(None, "same" if i % 2 else f"N{i}") for i in range(3000)]
    found += [(f"k{i % 400}", f"é{i}") for i in range(1200)] + [("", "e1"), ("", "e0"), ("-", "m"), ("one", None)]
    return found + [("hot", None), (None, None), ("=", "q"), ("=", "q")]


def expected(data, size):
    groups = defaultdict(list)
    for key, value in data:
        if value is not None:
            groups[key].append(value)
    out = []
    for key, values in groups.items():
        values.sort()
        for at in range(0, len(values), size):
            offset = sum(len(v) + 2 for v in values[:at])
            out.append((key, len(values), at // size, at, offset, ", ".join(values[at : at + size])))
    return sorted(out, key=str)


def listed(df, size):
    found = parts.concatenated_parts(df, "email", "customer_id", ", ", size)
    assert found.columns == ["email", "occurrences", "part", "first", "offset", "text"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("size", [1, 7, 100_000])
@pytest.mark.parametrize("partitions", [1, 40])
def test_parts(spark, size, partitions):
    df = spark.createDataFrame([(*r, 1) for r in rows()], SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert listed(df, size) == expected(rows(), size)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_rows_and_no_size(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert listed(df, 3) == []
    with pytest.raises(ValueError):
        listed(df, 0)


def test_parts_written_to_their_places_make_the_whole(spark):
    df = spark.createDataFrame([(*r, 1) for r in rows()], SCHEMA)
    whole = {
        r["email"]: r["text"]
        for r in df.groupBy("email").agg(F.expr("listagg(customer_id, ', ') within group (order by customer_id)").alias("text")).collect()
    }
    texts = {}
    # In any order: each part knows its place.
    for r in sorted(parts.concatenated_parts(df, "email", "customer_id", ", ", 11).collect(), key=lambda r: r["text"]):
        cells = texts.setdefault(r["email"], [" "] * len(whole[r["email"]]))
        cells[r["offset"] : r["offset"] + len(r["text"])] = r["text"]
        if r["offset"]:
            cells[r["offset"] - 2] = ","
    assert {k: "".join(v) for k, v in texts.items()} == {k: v for k, v in whole.items() if v}


def test_a_hot_key_is_several_tasks(spark, monkeypatch):
    data = [(None, f"C{i}", 1) for i in range(20_000)] + [(f"u{i}", "x", 1) for i in range(40_000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    kept = []
    runs = parts._runs
    monkeypatch.setattr(parts, "_runs", lambda *a: kept.append(runs(*a)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = parts.concatenated_parts(df, "email", "customer_id", ", ", 500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = Counter(r["_run"] for r in kept[0].where("_key IS NULL").collect())
    # Eight range partitions for 60,000 rows.
    assert len(hot) >= 3 and max(hot.values()) <= 2 * 60_000 / 8
    cells = found.where("email IS NULL").select(F.size(F.split("text", ", ")).alias("n")).collect()
    assert len(cells) == 40 and {r["n"] for r in cells} == {500}


def test_shared_emails(spark):
    data = [*rows(), ("single", "S1"), ("gone", None), ("gone", None)]
    t = {"customers": spark.createDataFrame([(*r, 1) for r in data], SCHEMA).drop("_group")}
    found = quality.shared_email_parts(t, rows=50).collect()
    counts = Counter(k for k, _ in data)
    wanted = [(k, counts[k], *rest) for k, _, *rest in expected(data, 50) if counts[k] > 1]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    lists = {r["email"]: r["customer_ids"] for r in quality.shared_email_lists(t).collect()}
    joined = defaultdict(list)
    for r in sorted(found, key=lambda r: r["part"]):
        joined[r["email"]].append(r["customer_ids"])
    assert {k: ", ".join(v) for k, v in joined.items()} == {k: v for k, v in lists.items() if v}
