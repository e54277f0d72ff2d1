"""A day's steps over files, the load of a day, matrices, the calendar, and small functions that no query calls."""

import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickloom import __main__, settings
from tickloom.functions import calendar, codes, expiry, numbers, sessions
from tickloom.operators import database, sinks
from tickloom.plans import steps
from tickloom.plans.day import Day
from tickloom.sources import files


def master(token, ticker, exchange="10", segment="11", kind="13", expiry_day="1785400000", strike="-1.0"):
    return ",".join([token, f"name {token}", kind, "5", "0.05", "I", "0915-1530:", "", expiry_day, ticker, exchange, segment, token, "P1", "", strike, "XX", *[""] * 4])


@pytest.fixture
def day(spark, tmp_path):
    raw = tmp_path / "raw" / "20260728"
    for folder in ("india", "us/XNAS", "templates"):
        (raw / folder).mkdir(parents=True)
    (raw / "india" / "nse.csv").write_text("\n".join([master("1", "NSE:P1-EQ", segment="10", kind="0", expiry_day=""), master("2", "NSE:P126AUGFUT"), master("3", "NSE:P126SEPFUT", expiry_day="1788000000"), "too,few"]))
    (raw / "us" / "XNAS" / "m.csv").write_text("instrument_id,stype_in_symbol,stype_out_symbol,stype_in,stype_out,start_ts,end_ts\n7,NVDA,7,raw_symbol,instrument_id,,\n")
    (raw / "templates" / "XNSE_INDEX_FUTURES_NEAR.csv").write_text("# list\nNSE:P126JULFUT\n")
    (raw / "templates" / "XNSE_NIFTY50_EQUITY.csv").write_text("NSE:P1-EQ\nNSE:P9-EQ\n")
    ini = tmp_path / "own.ini"
    ini.write_text(f"[tickloom]\nRAW = {tmp_path}/raw\nnormalized = {tmp_path}/normalized\nbaskets = {tmp_path}/baskets\ndatabase_url = jdbc:derby:{tmp_path}/db;create=true\nlook_back = 3\n")
    return tmp_path, str(ini)


def command(capsys, *argv):
    code = __main__.main(["--day", "20260728", *argv])
    said = capsys.readouterr()
    assert code == 1 or not said.err.startswith("error"), said.err
    return code, said


def test_a_day_from_the_command_line(spark, day, capsys):
    tmp, ini = day
    every = list(steps.GROUPS["all"])
    assert command(capsys, "--settings", ini, "--dry")[1].out.split() == every[:-1]
    ran = command(capsys, "--settings", ini, "--only", "normalize")[1]
    assert ran.out.split() == every[:4], ran.err
    assert command(capsys, "--settings", ini, "--push")[1].out.split() == ["csv-export", "database"]  # the others are finished
    assert command(capsys, "--settings", ini, "--push")[1].out.strip() == "nothing to do"
    assert command(capsys, "--settings", ini, "--only", "strip", "--again")[1].out.split() == ["strip"]
    own = Day(spark, "20260728", settings.load(file=ini))
    assert sorted((r.exchange, r.script) for r in own.unique.collect()) == [("XNAS", "NVDA"), ("XNSE", "NSE:P1-EQ"), ("XNSE", "NSE:P126AUGFUT"), ("XNSE", "NSE:P126SEPFUT")]
    assert sorted((r.basket, r.script) for r in own.basket_rows.collect()) == [("ALL_INDEX_FUTURES", "NSE:P126AUGFUT"), ("XNSE_INDEX_FUTURES_NEAR", "NSE:P126AUGFUT"), ("XNSE_NIFTY50_EQUITY", "NSE:P1-EQ")]
    assert [r.record for r in spark.read.parquet(f"{own.out}/quarantine/india").collect()] == ["too,few"]
    assert {r.script for r in spark.read.parquet(f"{own.out}/near").collect()} == {"NVDA", "NSE:P1-EQ", "NSE:P126AUGFUT"}
    url = f"jdbc:derby:{tmp}/db"
    assert spark.read.jdbc(url, '"v4_20260728"."contracts"').count() == spark.read.jdbc(url, '"public"."contracts"').count() == 4
    assert sorted((r.basket, r.scripts) for r in spark.read.jdbc(url, '"v4_20260728_baskets"."baskets"').collect())[2] == ("XNSE_NIFTY50_EQUITY", '["NSE:P1-EQ"]')
    # A changed file has its step run again, and those that read what it wrote.
    (tmp / "raw" / "20260728" / "india" / "bse.csv").write_text(master("9", "BSE:P1-EQ", "12", "10", "0", ""))
    assert command(capsys, "--settings", ini)[1].out.split() == ["normalize-india", "strip", "baskets", "csv-export"]
    # A raw file that goes leaves no contracts of its exchange behind.
    (tmp / "raw" / "20260728" / "india" / "bse.csv").unlink()
    command(capsys, "--settings", ini)
    assert {r.exchange for r in own.unique.collect()} == {"XNSE", "XNAS"}


def test_a_step_that_fails_ends_the_run(spark, day, capsys):
    tmp, ini = day
    text = open(ini).read()
    (tmp / "raw" / "20260728" / "templates" / "XNSE_NIFTY50_EQUITY.csv").unlink()
    (tmp / "raw" / "20260728" / "templates" / "XNSE_INDEX_FUTURES_NEAR.csv").unlink()
    (tmp / "raw" / "20260728" / "templates").rmdir()
    code, said = command(capsys, "--settings", ini)
    assert code == 1 and "PATH_NOT_FOUND" in said.err
    (tmp / "raw" / "20260728" / "templates").mkdir()
    (tmp / "raw" / "20260728" / "templates" / "XNSE_NIFTY50_EQUITY.csv").write_text("NSE:P1-EQ\n")
    assert command(capsys, "--settings", ini)[1].out.split() == ["baskets", "csv-export"]  # goes on where it stopped
    open(ini, "w").write(text.replace("database_url", "other"))
    with pytest.raises(ValueError, match="no such setting: other"):
        settings.load(file=ini)
    open(ini, "w").write("[tickloom]\nraw = %(x)s\n")
    assert settings.load(file=ini).raw == "%(x)s" and settings.load(file=ini, raw="mine").raw == "mine"
    assert __main__.main(["--data", "x", "no_such_query"]) == 1
    with pytest.raises(SystemExit):
        steps.arguments([])


def test_a_load_that_fails_leaves_yesterdays_tables(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    one, two = (spark.createDataFrame([(f"{d}{i}", i) for i in range(n)], "name string, n long") for d, n in (("a", 3), ("b", 5)))
    bad = spark.createDataFrame([("x", 1), (None, 2)], "name string, n long")
    read = lambda t: sorted(r.name for r in spark.read.jdbc(url, t).collect())
    database.load(spark, [("S", "t", one, ("name",), ()), ("U", "t", one, ("name",), ("name",))], url)
    assert read('"S"."t"') == read('"U"."t"') == ["a0", "a1", "a2"]
    with pytest.raises(Exception, match="cannot accept a NULL|CLOB"):
        database.load(spark, [("S", "t", two, ("name",), ()), ("U", "t", bad, ("name",), ())], url)
    assert read('"S"."t"') == read('"U"."t"') == ["a0", "a1", "a2"]
    database.load(spark, [("S", "t", two, ("name",), ()), ("U", "t", two, (), ())], url)
    assert read('"S"."t"') == read('"U"."t"') == [f"b{i}" for i in range(5)]
    with pytest.raises(Exception, match="(?i)not exist|cannot|renamed"), database.transaction(spark, url, {}) as run:
        run('RENAME TABLE "S"."t" TO "gone"')
        run('RENAME TABLE "S"."none" TO "x"')
    assert len(read('"S"."t"')) == 5  # both or neither
    with database.transaction(spark, url, {}) as run:
        assert run.names("S") == {"t"} and run.names("NONE") is None


def test_matrices_have_columns_of_their_own(spark, tmp_path):
    at = lambda h: datetime(2026, 7, 28, h)
    day = date(2026, 7, 28)
    minutes = spark.createDataFrame([("AB", 2, day, at(h), 100.5, None, 7.0) for h in (11, 10)] + [("C D", 0, day, at(9), None, None, None)], "underlying string, dte int, day date, ts timestamp, underlying_ltp double, straddle_3atm double, vt_3atm double")
    prices = spark.createDataFrame([("AB", 2, day, at(10), "K,1", 1.5), ("AB", 2, day, at(11), 'q"', 2.0), ("AB", 2, day, at(11), "K,1", 9.0), ("AB", 2, day, at(11), "K,1", 8.0), ("AB", 2, day, at(23), "LATE", 8.0), ("AB", 2, day, at(10), None, 8.0)], "underlying string, dte int, day date, ts timestamp, symbol string, mid double")
    for _ in range(2):
        assert sinks.write_matrices(minutes, prices, str(tmp_path)) == ["AB_2dte/AB_matrix_20260728.csv", "C D_0dte/C D_matrix_20260728.csv"]
    assert (tmp_path / "AB_2dte" / "AB_matrix_20260728.csv").read_text() == 'ts,underlying_ltp,straddle_3atm,vt_3atm,"K,1","q"""\n2026-07-28 10:00:00,100.5,,7.0,1.5,\n2026-07-28 11:00:00,100.5,,7.0,8.0,2.0\n'
    assert (tmp_path / "C D_0dte" / "C D_matrix_20260728.csv").read_text() == "ts,underlying_ltp,straddle_3atm,vt_3atm\n2026-07-28 09:00:00,,,\n"
    got = {(r.underlying, r.dte, r.trade_date, r.ts.hour, r.name): r.value for r in files.read_matrix_cells(spark, f"{tmp_path}/*/*.csv").collect()}
    assert got == {("AB", 2, day, h, n): v for h, n, v in [(10, "underlying_ltp", 100.5), (11, "underlying_ltp", 100.5), (10, "vt_3atm", 7.0), (11, "vt_3atm", 7.0), (10, "K,1", 1.5), (11, "K,1", 8.0), (11, 'q"', 2.0)]}


HOLIDAYS = {
    2021: "01-01 01-18 02-15 04-02 05-31 07-05 09-06 11-25 12-24", 2022: "01-17 02-21 04-15 05-30 06-20 07-04 09-05 11-24 12-26", 2023: "01-02 01-16 02-20 04-07 05-29 06-19 07-04 09-04 11-23 12-25",
    2024: "01-01 01-15 02-19 03-29 05-27 06-19 07-04 09-02 11-28 12-25", 2025: "01-01 01-09 01-20 02-17 04-18 05-26 06-19 07-04 09-01 11-27 12-25", 2026: "01-01 01-19 02-16 04-03 05-25 06-19 07-03 09-07 11-26 12-25",
}
EARLY = {2021: "11-26", 2022: "11-25", 2023: "07-03 11-24", 2024: "07-03 11-29 12-24", 2025: "07-03 11-28 12-24", 2026: "11-27 12-24"}


def test_calendar_of_known_years(spark):
    days = spark.sql("SELECT explode(sequence(date '2021-01-01', date '2026-12-31')) AS d")
    rows = days.select("d", calendar.is_us_session(F.col("d")).alias("s"), calendar.closes_early(F.col("d")).alias("e")).collect()
    assert {r.d for r in rows if not r.s and r.d.weekday() < 5} == {date.fromisoformat(f"{y}-{d}") for y, some in HOLIDAYS.items() for d in some.split()}
    assert {r.d for r in rows if r.e} == {date.fromisoformat(f"{y}-{d}") for y, some in EARLY.items() for d in some.split()}
    found = spark.createDataFrame([(1818,), (1943,), (2000,), (2008,), (2038,)], "y int").select(calendar.easter(F.col("y"))).collect()
    assert [r[0].isoformat()[5:] for r in found] == ["03-22", "04-25", "04-23", "03-23", "04-25"]
    assert spark.range(1).select(calendar.is_us_session(F.lit(None).cast("date"))).first()[0] is None


def test_landed_partitions(spark, tmp_path):
    for folder in ("u=A/day=1", "u=A/day=2", "u=B%2FC/day=1"):
        (tmp_path / "t" / folder).mkdir(parents=True)
        (tmp_path / "t" / folder / "x.bin").write_bytes(b"no table")
    assert sorted(map(tuple, files.landed_partitions(spark, f"{tmp_path}/t", ["u", "day"]).collect())) == [("A", "1"), ("A", "2"), ("B/C", "1")]
    assert files.landed_partitions(spark, f"{tmp_path}/none", ["u"]).count() == 0 and files.landed(spark, f"{tmp_path}/none") == []


def test_functions_that_no_query_calls(spark, tmp_path, monkeypatch):
    times = {"09:15": "03:45", "9:15": "03:45", "00:10": "18:40", "24:00": "", "x": "", "1:2:3": ""}
    got = spark.createDataFrame([(t,) for t in times], "t string").select("t", sessions.ist_to_utc(F.col("t")).alias("u")).collect()
    assert {r.t: r.u for r in got} == times
    assert spark.range(1).select(numbers.null_if_nan(F.lit(float("nan"))), numbers.null_if_nan(F.lit(1.5))).first()[:] == (None, 1.5)
    assert [sinks.safe_identifier(n) for n in (" A-b ", "9x", "x_1")] == ["a_b", "_9x", "x_1"]
    with pytest.raises(ValueError):
        sinks.safe_identifier(" ")
    assert expiry.history_range("2026-07-28", 7, "2020-01-01", "2030-01-01", "2026070120260705") == ("2026-07-01", "2026-07-06")
    for bad in ("2026", "202607012026070x"):
        with pytest.raises(ValueError):
            expiry.history_range("2026-07-28", 7, "2020-01-01", "2030-01-01", bad)
    (tmp_path / "strategies" / "ONE").mkdir(parents=True)
    (tmp_path / "strategies" / "ONE" / "loader.py").write_text("def main():\n    return 'ran'\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    sys.modules.pop("strategies", None)
    assert steps.loader("one")() == "ran"
    with pytest.raises(ModuleNotFoundError):
        steps.loader("two")
    tokens = {"101126072812345": ("NSE", "FO", "260728", "12345"), "112026072": ("MCX", "COM", "26072", ""), "99992607281": ("", "", "260728", "1"), "1x1126072812": None, "10112607": None, "": None}
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", codes.parse_token(F.col("t")).alias("x")).collect()
    assert {r.t: r.x and tuple(r.x) for r in got} == tokens
