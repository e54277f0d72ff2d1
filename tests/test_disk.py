"""What lies on disk while the day's queries run, and after."""

import gzip
import time
from pathlib import Path

from conftest import DATA
from pyspark.sql import functions as F

from tickloom.operators import sinks
from tickloom.plans import daily
from tickloom.schema import CONTRACT_COLUMNS
from tickloom.scratch import shuffles_dropped, watch
from tickloom.sources import files


def shuffled(spark):
    """Names of the shuffle files that lie in the session's local folder."""
    return {p.name for p in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data")}


def parts(made):
    return [p for m in made for p in Path(m).rglob("part-*")]


def test_only_the_export_is_left(spark):
    with watch() as made:
        daily.contracts_export(spark, DATA)
    left = parts(made)
    assert left and all(p.name.endswith(".csv.gz") and p.parent.name.startswith("exchange=") for p in left)


def test_the_raw_master_goes_when_its_lines_are_read(spark):
    with watch() as made:
        rows = daily.india(spark, DATA)
    assert not [p for p in parts(made) if ".csv" in p.name] and rows.count() > 0


def test_the_master_is_landed_compressed_in_the_order_of_its_files(spark):
    landed, at = daily.landed_master(spark, DATA), [daily.MASTER_COLUMNS.index(c) for c in ("isin", "exToken")]
    made = sorted(Path(landed).glob("part-*"))
    lines = [line.split(",") for p in made for line in gzip.open(p, "rt")]
    want = daily.table(spark, DATA, "lineitem").orderBy(*daily.LANDED).select("l_suppkey", "l_partkey").collect()
    # A quoted first column has commas; those that follow it count from the end.
    assert [(c[at[0] - 21], c[at[1] - 21].strip(' "')) for c in lines] == [(f"INE{s}", str(p)) for s, p in want]


def test_rows_are_not_written_aside_to_find_partitions_without_any(spark, tmp_path):
    computed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            computed.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "k string, x int").mapInArrow(seen, "k string, x int")
    with watch() as made:
        for some, n in ((rows, 3), (rows.where("x = 1"), 6), (rows.where("x < 0"), 9)):
            sinks.write_partitions(some, str(tmp_path), ["k"], ["x"], kind="csv", every=[("A",), ("B",), ("C",)], compression="gzip")
            assert computed.value == n and {p.parent.name for p in tmp_path.rglob("part-*.csv.gz")} == {"k=A", "k=B", "k=C"}
            got = spark.read.schema("x int, k string").option("header", True).csv(str(tmp_path))
            assert sorted(map(tuple, got.select("k", "x").collect())) == sorted(map(tuple, some.collect()))
            computed.add(n - computed.value)
    assert not made


def test_a_writes_shuffle_files_go_with_it(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(name), shuffled(spark)
    with shuffles_dropped(spark):
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / "t"))
    for _ in range(50):
        if not shuffled(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffled(spark) - before and spark.conf.get(name) == was and spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_compressed_normalized_files(spark, tmp_path):
    text = ",".join(CONTRACT_COLUMNS) + "\na,EQ,EQUITY,100,1,5,,s,0,NA,7,R,R,0,,INR\n"
    (tmp_path / "XNSE-20260728.csv").write_text(text)
    for name in ("XIMC-20260728.csv.gz", "XNSE-20260728.stripped.csv.gz", "NSE-CM.csv.gz"):
        (tmp_path / name).write_bytes(gzip.compress(text.encode()))
    (tmp_path / "XBOM-20260728.csv.bak").write_text(text)
    assert sorted((r.exchange, r.script, r.scriptToken) for r in files.read_normalized(spark, str(tmp_path)).collect()) == [("XIMC", "NA", 7), ("XNSE", "NA", 7)]
