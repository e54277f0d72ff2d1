"""What stays between runs: merged tables, replaced partitions, captured symbols."""

import pytest
from pyspark.sql import functions as F

from tickloom.functions import numbers
from tickloom.operators import sinks, store
from tickloom.schema import MAPPING_COLUMNS
from tickloom.streaming import intake

MAPS = "kind string, id long, data map<string,double>, more map<string,double>"


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("part-*")}


def contents(spark, path):
    return {(r.kind, r.id): (r.data, r.more) for r in spark.read.schema(MAPS).parquet(str(path)).collect()}


def test_upsert_rewrites_only_what_changes(spark, tmp_path):
    path = tmp_path / "t"

    def merge(*rows):
        return sorted(store.upsert(spark.createDataFrame(rows, MAPS), str(path), "kind", "id", ("data", "more")), key=str)

    assert merge(("a", 1, {"x": 1.0}, None), ("a", 2, {"x": 5.0}, {}), ("b", 1, {"y": 2.0}, None), (None, 7, {"z": 0.0}, None)) == [None, "a", "b"]
    first = files_of(path)
    assert merge(("a", 1, {"x": 9.0, "w": 3.0}, {"m": 1.0}), ("b", 1, {"y": 2.0}, None), ("c d/e", 1, None, None)) == ["a", "c d/e"]
    second = files_of(path)
    assert {k for k in first if second.get(k) == first[k]} == {k for k in first if "kind=a" not in k}  # b and null keep their files
    want = {("a", 1): ({"x": 9.0, "w": 3.0}, {"m": 1.0}), ("a", 2): ({"x": 5.0}, {}), ("b", 1): ({"y": 2.0}, None), (None, 7): ({"z": 0.0}, None), ("c d/e", 1): (None, None)}
    assert contents(spark, path) == want
    assert merge(("a", 1, {"x": 9.0}, {"m": 1.0}), (None, 7, {"z": 0.0}, {})) == [None]  # an empty map is no null
    assert merge(("a", 1, {"x": 9.0}, {"m": 1.0})) == [] == merge()
    assert contents(spark, path) == want | {(None, 7): ({"z": 0.0}, {})}


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_partitions_without_rows_are_replaced(spark, tmp_path, kind):
    rows = spark.createDataFrame([("XNSE", "20260728", 1), ("XBOM", "20260728", 2), ("XIMC", "20260727", 3)], "exchange string, date string, x int")
    days = [(e, "20260728") for e in ("XNSE", "XBOM", "XNEW")]
    sinks.write_partitions(rows, str(tmp_path / "t"), ["exchange", "date"], kind=kind)
    sinks.write_partitions(rows.where("x = 2"), str(tmp_path / "t"), ["exchange", "date"], ["x"], kind=kind, every=days)
    got = spark.read.schema("x int, exchange string, date string").options(header=True).format(kind).load(str(tmp_path / "t"))
    assert sorted((r.exchange, r.x) for r in got.collect()) == [("XBOM", 2), ("XIMC", 3)]
    empty = next((tmp_path / "t" / "exchange=XNEW" / "date=20260728").glob("part-*"))
    assert kind == "parquet" or empty.read_text().strip() == "x"


def capture(spark, tmp_path, batches, cap, seconds):
    """What is captured of batches, each of which lands and is taken in by a stream of its own."""
    landed, out = tmp_path / "in", tmp_path / "out"
    landed.mkdir()
    for i, rows in enumerate(batches):
        lines = [",".join({"instrument_id": r[1], "stype_in_symbol": r[0], "start_ts": r[2]}.get(c, "") for c in MAPPING_COLUMNS) for r in rows]
        (landed / f"{i}.csv").write_text("\n".join([",".join(MAPPING_COLUMNS), *lines]) + "\n")
        stream = intake.captured(intake.read_mapping_stream(spark, str(landed)), cap, seconds)
        intake.take_in(stream, str(tmp_path / "checkpoint"), intake.batch_sink(str(out))).awaitTermination()
    return sorted((r.stype_in_symbol, r.instrument_id, r.reason) for r in spark.read.parquet(str(out)).collect())


def test_capture_stops_at_each_symbols_bounds(spark, tmp_path):
    at = lambda s: f"2026-07-28 10:00:{s:02d}"
    batches = [
        [("A", "3", at(3)), ("A", "1", at(1)), ("A", "2", at(1)), ("B", "", at(0)), ("B", "9", at(9)), ("", "5", at(0))],
        [("A", "4", at(4)), ("A", "5", at(5)), ("B", "8", at(8)), ("B", "7", at(59)), ("C", "1", "no time"), ("C", "2", at(2))],
        [("A", "6", at(0)), ("B", "6", at(10)), ("B", " ", at(10)), ("C", "3", at(30)), ("C", "4", at(5))],
    ]
    got = capture(spark, tmp_path, batches, 4, 20)
    assert got == [("", "5", ""), ("A", "1", ""), ("A", "2", ""), ("A", "3", ""), ("A", "4", ""), ("B", "", "no instrument"), ("B", " ", "no instrument"), ("B", "6", ""), ("B", "8", ""), ("B", "9", ""), ("C", "1", ""), ("C", "2", ""), ("C", "4", "")]


def test_many_rows_of_one_symbol(spark, tmp_path):
    rows = [("A", f"{i:06d}", f"2026-07-28 10:{i // 60 % 60:02d}:{i % 60:02d}") for i in range(3000)][::-1]
    assert [i for _, i, _ in capture(spark, tmp_path, [rows], 3, 10**6)] == ["000000", "000001", "000002"]


@pytest.mark.parametrize(("text", "plain", "price"), [("5", None, None), (None, None, None), (" ", None, None), ("NaN", "not finite", "not finite"), ("x", "no number", "no number"), ("1e17", None, "out of range"), ("-1e19", "out of range", "out of range"), ("1.5d", "no number", "no number")])
def test_cell_errors(spark, text, plain, price):
    x = F.lit(text).cast("string")
    assert tuple(spark.range(1).select(numbers.cell_error(x), numbers.cell_error(x, 100)).first()) == (plain, price)


def test_bars_are_in_order_of_time_within_each_file(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(500).selectExpr("timestamp_seconds((id * 7919) % 500 * 60) AS ts", "id AS volume", "concat('U', id % 3) AS underlying").repartition(4)
    sinks.write_bars(rows, str(tmp_path / "bars"))
    files = list((tmp_path / "bars").rglob("part-*.parquet"))
    assert len(files) >= 3 and sum(pq.read_metadata(f).num_rows for f in files) == 500
    for f in files:
        ts = pq.read_table(f)["ts"].to_pylist()
        assert ts == sorted(ts)
    first, second = (spark.read.parquet(str(tmp_path / "bars")).where(f"underlying = 'U{k}'") for k in (0, 1))
    assert first.union(second).count() == first.count() + second.count() == 334
