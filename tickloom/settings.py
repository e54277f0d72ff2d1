"""Settings: what is given, else the environment, else the session's conf, else an INI file, else the default."""

import configparser
import os
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    raw: str = "raw"
    normalized: str = "normalized"
    baskets: str = "baskets"
    database_url: str = ""
    look_back: int = 7
    capture_rows: int = 100_000


def of_file(path: str) -> dict:
    """The values of the section [tickloom] of an INI file, names in any case; a file that is missing, or has others, is an error."""
    parser = configparser.ConfigParser(interpolation=None)
    with open(path, encoding="utf-8-sig") as f:
        parser.read_file(f)
    values = dict(parser["tickloom"]) if parser.has_section("tickloom") else {}
    if unknown := set(values) - {f.name for f in fields(Settings)}:
        raise ValueError(f"no such setting: {', '.join(sorted(unknown))}")
    return values


def load(spark: SparkSession | None = None, file: str | None = None, **given) -> Settings:
    """Settings of the names given, of TICKLOOM_NAME in the environment, of tickloom.name in the session's conf, or of a file."""
    values, read = {}, of_file(file) if file else {}
    for f in fields(Settings):
        v = given.get(f.name)
        v = os.environ.get(f"TICKLOOM_{f.name.upper()}") if v is None else v
        v = spark.conf.get(f"tickloom.{f.name}", None) if v is None and spark else v
        v = read.get(f.name) if v is None else v
        if v is not None:
            values[f.name] = f.type(v)
    if unknown := set(given) - {f.name for f in fields(Settings)}:
        raise ValueError(f"no such setting: {', '.join(sorted(unknown))}")
    return Settings(**values)
