"""CSV files read by splits: equal to the csv module and to the whole-file reader, wherever the splits fall."""
import csv
import os
import random
import tempfile

import duckdb
import pytest

from cleanspark.sources import csv_split as CS
from cleanspark.sources import readers as R

NAMES = ["id", "text", "note"]


@pytest.fixture()
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def some_file(rows, header=True, ending="\n"):
    path = os.path.join(tempfile.mkdtemp(prefix="csv-split-"), "a.csv")
    with open(path, "w", newline="", encoding="utf8") as f:
        w = csv.writer(f, lineterminator=ending)
        w.writerows([NAMES] * header + rows)
    return path


def random_rows(seed, n):
    rng = random.Random(seed)
    texts = ["plain", 'with "quotes"', "line\nbreak", "a,b", "\n\n", "x" * 400 + "\n" + '"y"' * 200, "\n".join("many lines" for _ in range(120)), '"', '""\n""', "é🙂"]
    return [[str(i), rng.choice(texts), rng.choice(["end", "é", "a\r\nb", "last, \"q\""])] for i in range(n)]


@pytest.mark.parametrize("seed, ending", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_equals_the_csv_module_and_duckdb(spark, small_splits, seed, ending):
    rows = random_rows(seed, 150)
    path = some_file(rows, ending=ending)
    df = R.read_csv(spark, [path], split=True)
    assert df.columns == NAMES
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: int(r[0]))
    assert got == [tuple(r) for r in rows]
    if ending == "\n":
        read = duckdb.sql(f"SELECT * FROM read_csv('{path}', header=true, all_varchar=true, quote='\"', escape='\"', max_line_size=1000000)")
        assert got == sorted(read.fetchall(), key=lambda r: int(r[0]))


def test_one_file_is_many_partitions(spark, small_splits):
    path = some_file(random_rows(5, 200))
    lines = CS._lines(spark, [path])
    parities = CS.split_parities(lines)
    assert len(parities) > 20 and any(parities.values()) and not all(parities.values())
    assert R.read_csv(spark, [path], split=True).rdd.getNumPartitions() > 20
    assert R.read_csv(spark, [path]).rdd.getNumPartitions() == 1


def test_a_field_over_many_splits_and_several_files(spark, small_splits):
    long = "\n".join(f"line {i}" for i in range(2000))
    paths = [some_file([["1", long, "a"], ["2", "b", long]]), some_file([["3", long, long]])]
    got = {r.id: (r.text, r.note) for r in R.read_csv(spark, paths, split=True).collect()}
    assert got == {"1": (long, "a"), "2": ("b", long), "3": (long, long)}


def test_odd_files(spark, small_splits):
    assert R.read_csv(spark, [some_file([])], split=True).count() == 0
    assert [tuple(r) for r in R.read_csv(spark, [some_file([["1", "a", "b"]], header=False)], NAMES, split=True, header="false").collect()] == [("1", "a", "b")]
    path = some_file([["1", "a", "b"], [], ["2", "too", "many", "fields"], ["3"], ["4", "c", "d"]])
    good, bad = R.split_rejects(R.read_csv(spark, [path], malformed="keep", split=True))
    assert sorted(tuple(r) for r in good.collect()) == [("1", "a", "b"), ("4", "c", "d")] and bad.count() == 2
    with pytest.raises(Exception):
        R.read_csv(spark, [path], split=True).collect()
    with open(path, "a") as f:
        f.write('5,"open,x\n')
    with pytest.raises(ValueError, match="do not pair up"):
        R.read_csv(spark, [path], split=True)
    other = os.path.join(os.path.dirname(path), "b.csv")
    with open(other, "w") as f:
        f.write("text,id,note\nx,1,y\n")
    with pytest.raises(Exception):  # another header under one path
        CS.read_csv_split(spark, [some_file([["1", "a", "b"]]), other], NAMES).collect()
