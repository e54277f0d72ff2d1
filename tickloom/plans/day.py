"""A day's run from raw files to baskets, exports and the database, as steps over folders."""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import baskets, contracts, normalize, sinks
from ..schema import BASKET_COLUMNS, CONTRACT_COLUMNS
from ..settings import Settings
from ..sources import files
from .steps import Step

#: The US venues.
VENUES = ("XCME", "XCBO", "XNAS")


class Day:
    """The steps of one day, YYYYMMDD. Raw files stand below {raw}/{day}: india/, us/{venue}/ and templates/; each step writes what later ones read."""

    def __init__(self, spark: SparkSession, day: str, settings: Settings):
        sinks.dated_schema(day)  # a day of eight digits
        self.spark, self.day, self.settings = spark, day, settings
        self.raw, self.out = f"{settings.raw.rstrip('/')}/{day}", f"{settings.normalized.rstrip('/')}/{day}"

    def normalize_india(self) -> None:
        good, bad = files.read_master(self.spark, f"{self.raw}/india")
        rows = normalize.bundle(normalize.normalize_india(good))
        self._write(rows, [(b,) for b in normalize.BUNDLES])
        bad.write.mode("overwrite").parquet(f"{self.out}/quarantine/india")
        normalize.cell_errors(good).write.mode("overwrite").parquet(f"{self.out}/quarantine/cells")

    def normalize_us(self) -> None:
        for venue in VENUES:
            if not files.landed(self.spark, f"{self.raw}/us/{venue}"):
                continue
            good, _ = files.read_mappings(self.spark, f"{self.raw}/us/{venue}")
            rows, bad = normalize.normalize_us(good, venue, self.iso)
            self._write(rows.withColumns({"source_ord": F.lit(0), "source_path": F.lit(venue)}), [(venue,)])
            bad.write.mode("overwrite").parquet(f"{self.out}/quarantine/{venue}")

    def strip(self) -> None:
        """The near-term contracts beside all of them."""
        near = contracts.near_term(self.rows, self.day)
        sinks.write_partitions(near, f"{self.out}/near", ["exchange"], contracts.FILE_ORDER[1:])

    def baskets(self) -> None:
        lists = files.read_lines(self.spark, f"{self.raw}/templates")
        found = baskets.resolve([*baskets.BASKETS, *baskets.UNIONS], lists, self.rows, self.day, contracts.FILE_ORDER)
        place = ["part", "root_ordinal"]
        rows = baskets.flat(found, self.day, [*BASKET_COLUMNS, *place]).repartition("basket")
        sinks.write_baskets(rows.sortWithinPartitions("basket", *place, "expiration", "script").drop(*place), self.settings.baskets, self.day)

    def csv_export(self) -> None:
        sinks.write_aggregates(self.unique.select("date", "exchange", *CONTRACT_COLUMNS), self.basket_rows, f"{self.out}/export")

    def database(self) -> None:
        if not self.settings.database_url:
            raise ValueError("no database_url is set")
        valid, _ = normalize.split_invalid(self.unique)
        scripts = baskets.documents(self.basket_rows.withColumn("_n", F.monotonically_increasing_id()), "basket", "script", [F.col("_n")])
        sinks.push_day(valid.select("date", "exchange", *CONTRACT_COLUMNS), scripts, self.settings.database_url, self.day)

    @property
    def iso(self) -> str:
        return f"{self.day[:4]}-{self.day[4:6]}-{self.day[6:]}"

    def _write(self, rows: DataFrame, every: list) -> None:
        place = contracts.FILE_ORDER[1:]
        sinks.write_partitions(rows.select("exchange", *CONTRACT_COLUMNS, *place), f"{self.out}/contracts", ["exchange"], place, every=every)

    @property
    def rows(self) -> DataFrame:
        """All normalized rows, with their places in the raw files."""
        return self.spark.read.parquet(f"{self.out}/contracts")

    @property
    def unique(self) -> DataFrame:
        return contracts.unique_contracts(contracts.dated(self.rows, self.day), contracts.FILE_ORDER)

    @property
    def basket_rows(self) -> DataFrame:
        return files.read_baskets(self.spark, f"{self.settings.baskets.rstrip('/')}/date={self.day}", [c for c in BASKET_COLUMNS if c not in ("date", "basket")])

    @cached_property
    def steps(self) -> list:
        """Each with the folders that it reads, whose files decide whether it must run again."""
        own, made = f"{self.out}/contracts", f"{self.settings.baskets.rstrip('/')}/date={self.day}"
        return [
            Step("normalize-india", self.normalize_india, (f"{self.raw}/india",)), Step("normalize-us", self.normalize_us, (f"{self.raw}/us",)), Step("strip", self.strip, (own,)),
            Step("baskets", self.baskets, (own, f"{self.raw}/templates")), Step("csv-export", self.csv_export, (own, made)), Step("database", self.database, (own, made)),
        ]
