"""Readers, sinks and measures on small files and rows whose results are known."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickloom import settings
from tickloom.functions import expiry, numbers, symbols
from tickloom.operators import bars, baskets, contracts, normalize, sinks
from tickloom.plans import steps
from tickloom.schema import CONTRACT_COLUMNS, MASTER_COLUMNS
from tickloom.scratch import discard
from tickloom.sources import files, lines
from tickloom.streaming import intake

CELLS = ["1", "Reliance", "0", "1", "0.10", "INE1", "0915-1530|1815-1915:", "", "", "NSE:RELIANCE-EQ", "10", "10", "2885", "RELIANCE", "", "-1.0", "XX", "", "", "", ""]


def test_master_and_its_quarantine(spark, tmp_path):
    rows = [CELLS, [*CELLS, "more"], CELLS[:10], [*CELLS[:9], "", *CELLS[10:]]]
    (tmp_path / "m.csv").write_text("\n".join(",".join(r) for r in rows))
    good, bad = files.read_master(spark, str(tmp_path / "m.csv"))
    assert [tuple(r)[:2] for r in good.select("fyToken", "symTicker").orderBy("symTicker").collect()] == [("1", None), ("1", "NSE:RELIANCE-EQ")]
    assert {r.record for r in bad.collect()} == {",".join(rows[1]), ",".join(rows[2])} and bad.count() == 2 and {r.source_file for r in bad.collect()} == {"m.csv"}
    (made,) = normalize.normalize_india(good).collect()
    assert (made.market, made.lotSize, made.tickSize, made.tradingSessionUTC, made.expiration, made.optionType) == ("XNSE", 1, 10, "0330-0338|0345-1000|1245-1345", 0, "")


def test_master_with_older_header(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿FyToken,Symbol,InstrumentType,SymbolTicker,exchange,segment\n7,Name,0,NSE:A-EQ,10,10\n")
    (row,) = files.read_master(spark, str(tmp_path / "m.csv"))[0].collect()
    assert (row.fyToken, row.symDetails, row.exInstType, row.symTicker, row.isin) == ("7", "Name", "0", "NSE:A-EQ", None) and len(MASTER_COLUMNS) == 21


def test_files_of_one_folder_have_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(CELLS) + "\n" + ",".join(CELLS[:20]) + "\n\n,,,,,,,,,,,,,,,,,,,,\n")
    (tmp_path / "b.csv").write_bytes(b'\xef\xbb\xbf\r\nISIN,ShortSym,shortsym,other,symTicker\r\nINE7,x,"S ""7"", y"z,o,NSE:B-EQ\r\nINE8,x,y,o\r\n')
    (tmp_path / "c.csv").write_text("symticker,exchange\nthis is no header,as none of its names is an older one\n")
    (tmp_path / "d.csv").write_text("")
    good, bad = files.read_master(spark, str(tmp_path))
    got = {r.source_path.rsplit("/", 1)[1] + str(r.ordinal): r for r in good.collect()}
    assert set(got) == {"a.csv0", "b.csv2"}
    assert (got["a.csv0"].symTicker, got["a.csv0"].underExToken) == ("NSE:RELIANCE-EQ", None)
    assert (got["b.csv2"].isin, got["b.csv2"].exSymName, got["b.csv2"].symTicker, got["b.csv2"].fyToken) == ("INE7", 'S "7", yz', "NSE:B-EQ", None)
    assert {(r.source_file, r.line_no, r.filled) for r in bad.collect()} == {("a.csv", 1, 14), ("b.csv", 3, 4), ("c.csv", 0, 2), ("c.csv", 1, 2)}


@pytest.mark.parametrize("block", [64, 1000, 1 << 27])
def test_line_numbers_over_blocks(spark, tmp_path, block):
    texts = {"a.txt": [f"line {i}" * (i % 5) for i in range(300)], "b.txt": ["", "", "x" * 500, "", "y"], "c.txt": ["only"]}
    for name, some in texts.items():
        (tmp_path / name).write_text("\n".join(some) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        got = lines.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r.source_file, r.line_no): r.value for r in got} == {(n, i): t for n, some in texts.items() for i, t in enumerate(some)} and len(got) == 306
    assert {(r.source_file, r.head.line_no, r.head.value) for r in got} == {("a.txt", 1, "line 1"), ("b.txt", 2, "x" * 500), ("c.txt", 0, "only")}
    assert block > 1000 or len({(r.source_file, r.source_block) for r in got}) > 3


CELL_LINES = ["", ",", "a,b", ',"",', '"a,b",c', '"a ""q"" b",', 'x"y",z', '"open,1', '"a"b"c,d', '"""",""""""', "\u00e9,\U0001f600", '"' + "a," * 5000 + '"' + ',"' + 'b""' * 3000 + '"']


def test_cells_as_the_csv_module_splits_them(spark):
    import csv

    got = {r.v: r.c for r in spark.createDataFrame([(t,) for t in CELL_LINES], "v string").select("v", lines.cells(F.col("v")).alias("c")).collect()}
    for t in CELL_LINES:
        if t != '"open,1':
            assert got[t] == (next(csv.reader([t])) if t else [""]), t
    assert got['"open,1'] == ['"open', "1"]


def test_a_line_is_split_once_and_stays_in_place(spark, tmp_path):
    (tmp_path / "m.csv").write_text("\n".join(",".join(CELLS) for _ in range(3)))
    plan = normalize.normalize_india(files.read_master(spark, str(tmp_path))[0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_first_and_last_row_of_the_files(spark, tmp_path):
    def row(detail, lot, ticker="NSE:A-EQ", token="7"):
        return ",".join(["1", detail, "0", lot, "0.05", "I", "", "", "", ticker, "10", "10", token, "A", *[""] * 7])

    (tmp_path / "1.csv").write_text("\n".join([row("z", "9"), row("b", "5"), row("other", "1", "NSE:B-EQ")]))
    (tmp_path / "2.csv").write_text("\n".join([row("a", "1"), row("m", "3")]))
    rows = normalize.bundle(normalize.normalize_india(files.read_master(spark, str(tmp_path))[0]))
    first = contracts.unique_contracts(contracts.dated(rows, "20260728"), contracts.FILE_ORDER)
    assert {r.script: r.scriptDetails for r in first.collect()} == {"NSE:A-EQ": "z", "NSE:B-EQ": "other"}
    template = spark.createDataFrame([("XNSE_NIFTY50_EQUITY", 0, "NSE:A-EQ"), ("XNSE_NIFTY50_EQUITY", 1, "NSE:C-EQ"), ("XNSE_NIFTY50_EQUITY", 2, "NSE:A-EQ")], "name string, ordinal int, value string")
    got = baskets.resolve(["XNSE_NIFTY50_EQUITY"], template, rows, "20260728", contracts.FILE_ORDER).collect()
    assert sorted((r.root_ordinal, r.scriptDetails) for r in got) == [(0, "m"), (2, "m")]
    with pytest.raises(ValueError, match="no such basket"):
        baskets.resolve(["NONE"], template, rows, "20260728", contracts.FILE_ORDER)


def test_baskets_read_the_contracts_once(spark, tmp_path):
    (tmp_path / "1.csv").write_text(",".join(CELLS))
    rows = normalize.bundle(normalize.normalize_india(files.read_master(spark, str(tmp_path))[0]))
    template = spark.createDataFrame([("XNSE_NIFTY50_EQUITY", 0, "NSE:A-EQ")], "name string, ordinal int, value string")
    plan = baskets.resolve([*baskets.BASKETS, *baskets.UNIONS], template, rows, "20260728", contracts.FILE_ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 4 and "CartesianProduct" not in plan


def test_only_contracts_that_are_asked_for_meet_the_templates(spark, tmp_path):
    (tmp_path / "1.csv").write_text(",".join(CELLS))
    rows = normalize.bundle(normalize.normalize_india(files.read_master(spark, str(tmp_path))[0]))
    template = spark.createDataFrame([("XNSE_NIFTY50_EQUITY", 0, "NSE:RELIANCE-EQ")], "name string, ordinal int, value string")
    seen = []
    before, baskets.kept = baskets.kept, lambda df, *by: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or before(df, *by)
    try:
        got = baskets.resolve(["XNSE_NIFTY50_EQUITY", "XIMC_FUTURES_ALL"], template, rows, "20260728", contracts.FILE_ORDER).collect()
    finally:
        baskets.kept = before
    assert [(r.basket, r.script) for r in got] == [("XNSE_NIFTY50_EQUITY", "NSE:RELIANCE-EQ")]
    assert "= XNSE)" in seen[0] and "= XIMC)" in seen[0]


def test_copied_files_are_the_same_bytes(spark, tmp_path):
    import hashlib
    import os

    data = {"crlf.csv": b"\xef\xbb\xbfa,b\r\n1,2\r\n3,4", "empty.csv": b"", "below/x y%20.bin": bytes(range(256)) * 70_000, "one": b"\n"}
    for name, raw in data.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(raw)
    os.utime(tmp_path / "in" / "one", (1_700_000_000, 1_700_000_000))
    for _ in range(2):  # again gives the same
        got = {r.name: (r.length, r.sha256) for r in sinks.copy_files(spark, str(tmp_path / "in"), f"{tmp_path}/out").collect()}
        assert got == {n: (len(raw), hashlib.sha256(raw).hexdigest()) for n, raw in data.items()}
    assert {str(p.relative_to(tmp_path / "out")): p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()} == data
    assert os.stat(tmp_path / "out" / "one").st_mtime == 1_700_000_000


def test_normalized_and_basket_files_by_name(spark, tmp_path):
    head = ",".join(CONTRACT_COLUMNS)
    line = 'a,EQ,EQUITY,100,1,5,,s,0,NA,7,R,R,0,,INR'
    for name in ("XNSE-20260728.csv", "XIMC-20260728.csv", "XNSE-20260728.stripped.csv", "NSE-CM.csv"):
        (tmp_path / name).write_text(f"{head}\n{line}\n")
    got = files.read_normalized(spark, str(tmp_path)).collect()
    assert sorted((r.exchange, r.script, r.scriptToken, r.ISIN, r.expiration) for r in got) == [("XIMC", "NA", 7, "", 0), ("XNSE", "NA", 7, "", 0)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "NEAR.csv").write_text("script,strike\nX,\n")
    assert [tuple(r) for r in files.read_baskets(spark, str(tmp_path / "b"), ["script", "strike"]).collect()] == [("NEAR", "X", "")]


def test_exchange_file_may_be_missing(spark, tmp_path):
    assert files.read_exchange_file(spark, str(tmp_path / "none.csv")).count() == 0


def test_matrices_of_allowed_names(spark, tmp_path):
    for name in ("AAA_2dte", "BBB_0dte"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name[:3]}_matrix_2026-07-28.csv").write_text("ts,underlying_ltp,straddle_3atm,vt_3atm,X\n2026-07-28 10:00:00,100.2,nan,5,1\n")
    rows = files.read_matrices(spark, f"{tmp_path}/*/*.csv")
    (row,) = bars.allowed(rows, spark.createDataFrame([("aaa",)], "symbol string")).collect()
    assert (row.underlying, row.dte, row.trade_date, row.ts, row.underlying_ltp, row.vt_3atm) == ("AAA", 2, date(2026, 7, 28), datetime(2026, 7, 28, 10), 100.2, 5.0)
    with pytest.raises(ValueError):
        files.read_matrices(spark, write_text(tmp_path / "x.csv", "ts,a\n1,2\n"))


def write_text(path, text):
    path.write_text(text)
    return str(path)


def test_resolved_symbols(spark, tmp_path):
    path = write_text(tmp_path / "r.json", '{"ES.c.0": [{"s": "101", "d0": "2026-07-01", "d1": "2026-07-28"}], "B": []}')
    assert [tuple(r) for r in files.read_resolved(spark, path).collect()] == [("101", "ES.c.0", "101", "raw_symbol", "instrument_id", "2026-07-01", "2026-07-28")]


def test_underlyings_fail_fast(spark, tmp_path):
    with pytest.raises(Exception, match="bad line"):
        files.read_underlyings(spark, write_text(tmp_path / "u.txt", "A|B|C\n")).collect()


def straddle_of(spark, put99):
    quotes = [(100.0, "C", 2.0), (100.0, "P", 1.5), (101.0, "C", 1.4), (101.0, "P", 1.9), (99.0, "C", 2.6), (99.0, "P", put99), (102.0, "C", 2.0), (102.0, "P", 2.0)]
    ts = datetime(2026, 7, 28, 15)
    q = spark.createDataFrame([("A", ts, k, s, f"{k}{s}", v) for k, s, v in quotes], "u string, ts timestamp, strike double, side string, symbol string, mid double")
    minutes = spark.createDataFrame([("A", ts, 100.2, date(2026, 7, 28)), ("A", datetime(2026, 7, 28, 16), 100.2, date(2026, 7, 28))], "u string, ts timestamp, ltp double, expiry date")
    out = bars.straddle(bars.both_sides(q, ["u"]), bars.paired(q, ["u", "ts"]), minutes, ["u"]).orderBy("ts").collect()
    assert out[1].straddle is None and out[1].vt is None
    return round(out[0].straddle, 6), round(out[0].vt, 6)


def test_straddle_chooses_by_definition(spark):
    assert straddle_of(spark, 1.1) == (798.403194, 4207.954305)
    # Without the put of 99 the three nearest strikes stay 100, 101 and 99, and two of them are summed.
    assert straddle_of(spark, None)[0] == round(5.8 * 10_000 / 100.2, 6)


def test_basket_in_order_and_database(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (0, 9, "z"), (1, 4, "c")], "root_ordinal int, expiration long, script string")
    assert [r.script for r in baskets.in_order(rows).collect()] == ["z", "c", "a", "b"]
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    for _ in range(2):
        sinks.push_day(rows.select("script", "expiration"), rows.select(F.lit("B").alias("basket"), "script"), url, "20260728", mirror="latest")
    for schema, name in (("v4_20260728", "contracts"), ("v4_20260728", "baskets"), ("v4_20260728_baskets", "baskets"), ("latest", "contracts"), ("latest", "baskets")):
        assert spark.read.jdbc(url, f'"{schema}"."{name}"').count() == 4


def test_basket_replaced_by_none(spark, tmp_path):
    rows = spark.createDataFrame([("NEAR", "a", 1)], "basket string, script string, strike long")
    for df in (rows, rows.where("strike > 1")):
        sinks.write_basket(df, str(tmp_path), "20260728", "NEAR")
    assert files.read_baskets(spark, f"{tmp_path}/date=20260728", ["script", "strike"]).count() == 0
    sinks.write_aggregates(rows, rows, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "contracts.csv")).collect()[0].script == "a"
    discard(spark, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_capture_cap_and_latest_view(spark):
    assert intake.bounded(spark.range(9), 3).count() == 3
    sinks.latest_view(spark.createDataFrame([("1", 1), ("2", 2)], "date string, x int"), "latest_rows")
    assert [r.x for r in spark.table("latest_rows").collect()] == [2]


@pytest.mark.parametrize(("text", "price"), [("1.5", 150), ("0", 0), ("-1.0", -100), ("2.5", 250), ("invalid", 0), ("0.005", 0), ("0.015", 2), ("0.025", 2), ("0.375", 38), ("1.005", 100), ("2.675", 268)])
def test_prices(spark, text, price):
    assert spark.range(1).select(numbers.scale_price(F.lit(text))).first()[0] == price


def test_occ_symbols(spark):
    cases = {
        "NVDA  270115P00090000": ("NVDA", "PUT", 90_000_000_000, 1800047700000000000, False), "SPXW  260821C06500000": ("SPXW", "CALL", 6_500_000_000_000, 1787346000000000000, True), "NVDA.OPT": ("", "", 0, 0, False),
        "ABC   310115C00010000": ("ABC", "CALL", 10_000_000_000, -1229481900000000000, False), "ABC   271315C00010000": ("ABC", "CALL", 10_000_000_000, None, False), "SPX240119C00500000": ("SPX", "CALL", 500_000_000_000, 1705701600000000000, True),
        "X   260230C00010000": ("X", "CALL", 10_000_000_000, None, False), "\t": ("", "", 0, 0, False),
    }
    df = spark.createDataFrame([(s,) for s in cases], "s string")
    assert {r.s: tuple(r.x) for r in df.select("s", symbols.occ(F.col("s")).alias("x")).collect()} == cases


def test_steps_and_settings(spark, monkeypatch):
    ran = []
    made = [steps.Step(n, lambda n=n: ran.append(n)) for n in steps.GROUPS["all"]]
    assert steps.run_steps(made, ["normalize"]) == ran == list(steps.GROUPS["normalize"])
    assert steps.arguments(["--data", "d", "--only", "database"]).push and not steps.arguments(["--data", "d"]).push
    monkeypatch.setenv("TICKLOOM_LOOK_BACK", "3")
    assert settings.load(spark, raw="r") == settings.Settings(raw="r", look_back=3) and settings.load(look_back=9).look_back == 9
    with pytest.raises(ValueError):
        settings.load(nothing=1)


def test_days(spark):
    assert expiry.history_range("2026-07-28", 7, "2026-07-25", "2026-07-27") == ("2026-07-25", "2026-07-28")
    assert expiry.end_day("*", "2026-07-28", ["2026-07-27", "2026-07-28"]) == "2026-07-27" == expiry.end_day("20260727", "", ["2026-07-24", "2026-07-27"])
    calendar = spark.createDataFrame([(date(2026, 7, 24),)], "session_date date")
    assert expiry.latest_session(calendar, "2026-07-26").first()[0] == date(2026, 7, 24) and expiry.latest_session(calendar, "2026-09-26").first()[0] is None
