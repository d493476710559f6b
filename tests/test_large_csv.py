"""Large CSV against the one-task reader, with quoted line ends at every edge of small ranges."""

import csv
import random

import pytest

from caseledger.sources.files import read_csv
from caseledger.sources.large_csv import read_large_csv


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def rows(seed, n=150):
    r = random.Random(seed)
    cell = lambda: "".join(r.choice(["a", "b\n", '"', ",", "é", "x y", "\n", ""]) for _ in range(r.randint(0, 6)))
    return [(str(i), cell(), cell()) for i in range(n)] + [("long", "line\n" * 400, '"' * 7)]


def write(path, data, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["k", "a", "b"])
        w.writerows(data)


@pytest.mark.parametrize("size", [37, 64, 257, 1_000_000])
def test_equals_what_was_written(spark, tmp_path, small_ranges, size):
    for k in range(3):
        write(tmp_path / f"{k}.csv", rows(k))
    small_ranges(size)
    lines = spark.read.text(str(tmp_path))
    got = read_large_csv(spark, str(tmp_path), ["k", "a", "b"])
    assert (lines.rdd.getNumPartitions() > 20) == (size < 300)
    assert sorted(map(tuple, got.collect())) == sorted(x for k in range(3) for x in rows(k))


def test_equals_the_one_task_reader(spark, tmp_path, small_ranges):
    write(tmp_path / "x.csv", rows(9), "\r\n")
    small_ranges(100)
    whole = read_csv(spark, str(tmp_path / "x.csv"), ["k", "a", "b"])
    got = read_large_csv(spark, str(tmp_path / "x.csv"), ["k", "a", "b"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_empty_header_only_and_no_header(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_text("")
    (tmp_path / "e" / "b.csv").write_text('k,a,b\n\n1,"x\n\ny",\n')
    assert list(map(tuple, read_large_csv(spark, str(tmp_path / "e"), ["k", "a", "b"]).collect())) == [("1", "x\n\ny", "")]
    assert read_large_csv(spark, str(tmp_path / "e" / "b.csv"), ["k", "a", "b"], header=False).count() == 2
