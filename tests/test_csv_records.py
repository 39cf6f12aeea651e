"""Records of CSV files with line breaks in cells, against Python's csv module, over small byte ranges."""

import csv
import random

import pytest

from shopstrata.sources.csv_records import has_breaks, leaves_open
from shopstrata.sources.raw_csv import read_csv, rejected_rows, scan_csv
from shopstrata.sources.schemas import RAW_COLUMNS

NAMES = RAW_COLUMNS["returns"]
SMALL = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_ranges(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


def rows_of(rng, n):
    cells = ["x", "a, b", "two\nlines", 'say ""', '"', "\n", "\n\n\n", 'q",\n"r', "é\r\n", '5" pipe', ",", "z" * 90, '\n"' * 30]
    return [[f"R{i}", *(rng.choice(cells) for _ in NAMES[1:])] for i in range(n)]


@pytest.mark.parametrize("seed,quoting", [(1, csv.QUOTE_MINIMAL), (2, csv.QUOTE_ALL), (3, csv.QUOTE_MINIMAL)])
def test_against_the_csv_module(spark, tmp_path, small_ranges, seed, quoting):
    rng, expected = random.Random(seed), []
    folder = tmp_path / "returns.csv"
    folder.mkdir()
    for part in range(3):
        rows = rows_of(rng, 60)
        with open(folder / f"{part}.csv", "w", newline="", encoding="utf8") as out:
            csv.writer(out, quoting=quoting, lineterminator="\r\n" if part == 1 else "\n").writerows([NAMES, *rows])
        expected += rows
    lines = spark.read.text(str(folder))
    assert lines.rdd.getNumPartitions() > 50
    assert has_breaks(spark, str(folder))
    found = scan_csv(spark, "returns", str(folder)).collect()
    assert sorted(map(list, found)) == sorted(expected)


def test_stray_quotes_open_nothing(spark, tmp_path, small_ranges):
    path = tmp_path / "returns.csv"
    text = "".join(f'R{i},5" pipe,"a ""b""",6" x "y",,\n' for i in range(40))
    path.write_text(",".join(NAMES) + "\n" + text)
    assert not has_breaks(spark, str(path))
    assert scan_csv(spark, "returns", str(path)).count() == 40


def test_a_quote_that_is_never_closed(spark, tmp_path, small_ranges):
    """The rows before it are read; it and what follows are lines again."""
    path = tmp_path / "returns.csv"
    good = "".join(f'R{i},O,"two\nlines",x,y,1\n' for i in range(30))
    late = "".join(f"L{i},O,d,x,y,1\n" for i in range(30))
    path.write_text(f'{",".join(NAMES)}\n{good}R99,"open,d,x,y,1\n{late}')
    read = read_csv(spark, "returns", str(path))
    assert [r["record"] for r in rejected_rows(read, "returns").collect()] == ['R99,"open,d,x,y,1']
    kept = scan_csv(spark, "returns", str(path)).collect()
    assert sorted(r["return_id"] for r in kept) == sorted([f"R{i}" for i in range(30)] + [f"L{i}" for i in range(30)])
    assert {r["return_date"] for r in kept} == {"two\nlines", "d"}


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    path = tmp_path / "returns.csv"
    long = "line\n" * 500
    path.write_text(f'{",".join(NAMES)}\nR1,"{long}",c,d,e,f\nR2,b,c,d,e,f\n')
    assert {tuple(r)[:2] for r in scan_csv(spark, "returns", str(path)).collect()} == {("R1", long), ("R2", "b")}


def test_headers_must_agree(spark, tmp_path):
    folder = tmp_path / "returns.csv"
    folder.mkdir()
    body = 'R1,"a\nb",c,d,e,f\n'
    (folder / "1.csv").write_text(f"{','.join(NAMES)}\n{body}")
    (folder / "2.csv").write_text(f"{','.join(reversed(NAMES))}\n{body}")
    with pytest.raises(Exception, match="same header"):
        scan_csv(spark, "returns", str(folder)).collect()


def test_open_lines(spark):
    lines = {'a,"b': True, 'a,"b"': False, 'a,"b"",c': True, 'a,b"c': False, '"': True, '""': False, '"""': True, 'a,"x"y"z': False,
             '"a","': True, 'x"y,"z",",': True, "": False, '"a"",b': True, '"' + 'a""' * 20_000 + '",c': False}
    frame = spark.createDataFrame(list(lines.items()), "line string, open boolean")
    assert frame.where(leaves_open(frame["line"]) != frame["open"]).count() == 0
