"""Named steps in a fixed order, run one after another; the first failure ends the run, and the next run goes on from there."""

import argparse
import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Groups of step names.
GROUPS = {
    "normalize": ("normalize-india", "normalize-us", "strip", "baskets"),
    "export": ("csv-export", "database"),
    "all": ("normalize-india", "normalize-us", "strip", "baskets", "csv-export", "database"),
}


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable
    inputs: tuple = ()


class Manifest:
    """Which steps of a folder's day are finished, and what their inputs were: a row for each, in a table for each step, replaced as a whole."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def fingerprint(self, inputs: tuple) -> str:
        """Names, lengths and times of all files below the inputs, as one digest; no file is opened, and one that is missing tells too."""
        from pyspark.errors import AnalysisException

        found = []
        for path in inputs:
            try:
                files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
                found.append(files.select(F.concat_ws(" ", "path", "length", F.unix_micros("modificationTime")).alias("f")))
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                found.append(self.spark.sql("SELECT 'none' AS f"))
        both = found[0]
        for more in found[1:]:
            both = both.union(more)
        # A sum of hashes, as the order of files does not matter and their list may be long.
        n, total = both.agg(F.count("*"), F.sum(F.xxhash64("f").cast("decimal(20,0)"))).first()
        return f"{n}:{total}"

    def finished(self, name: str) -> str | None:
        from pyspark.errors import AnalysisException

        try:
            row = self.spark.read.schema("inputs string").json(f"{self.folder}/{name}").first()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            row = None
        return row and row.inputs

    def finish(self, name: str, inputs: str) -> None:
        self.spark.createDataFrame([(inputs,)], "inputs string").coalesce(1).write.mode("overwrite").json(f"{self.folder}/{name}")


def expand(only: list | None, order: list) -> list:
    """Names and groups to step names, each once, in the order of the pipeline; nothing given means all."""
    wanted = {s for n in only or order for s in GROUPS.get(n, (n,))}
    return [s for s in order if s in wanted]


def run_steps(steps: list, only: list | None = None, dry: bool = False, manifest: Manifest | None = None) -> list:
    """Run the chosen steps, or with dry only explain the frames that they return; the names of those that ran.

    With a manifest a step whose inputs are as they were when it last finished is passed over, so that a day is resumed where it stopped and
    a changed file has its steps run again. The inputs are read before the step runs: a file that comes meanwhile counts for the next time.
    """
    names, ran = expand(only, [s.name for s in steps]), []
    if not names:
        raise ValueError("no step has such a name")
    for s in (s for s in steps if s.name in names):
        seen = manifest.fingerprint(s.inputs) if manifest and s.inputs else None
        if seen and manifest.finished(s.name) == seen:
            continue
        ran.append(s.name)
        if dry and manifest:
            continue
        out = s.run()
        if dry and hasattr(out, "explain"):
            out.explain("formatted")
        elif hasattr(out, "write"):
            out.write.format("noop").mode("overwrite").save()
        if seen:
            manifest.finish(s.name, seen)
    return ran


def loader(name: str, package: str = "strategies") -> Callable:
    """main of package.NAME.loader."""
    return importlib.import_module(f"{package}.{name.upper()}.loader").main


def arguments(argv: list) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tickloom")
    p.add_argument("query", nargs="*", help="registered queries to run")
    p.add_argument("--data", help="folder of the Parquet tables that queries read")
    p.add_argument("--out", help="folder for results; without it they are shown")
    p.add_argument("--dry", action="store_true", help="explain queries, or name the steps that would run")
    p.add_argument("--day", help="run the steps of a day, YYYYMMDD, over the folders of the settings")
    p.add_argument("--settings", help="an INI file of settings")
    p.add_argument("--only", action="append", help="steps or groups of steps")
    p.add_argument("--push", action="store_true", help="write to the database; asking for that step by name implies it")
    p.add_argument("--again", action="store_true", help="run steps that are finished too")
    args = p.parse_args(argv)
    if not args.day and not args.data:
        p.error("one of --day and --data is needed")
    args.push = args.push or "database" in (args.only or [])
    return args
