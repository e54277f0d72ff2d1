import sys

from pyspark.sql import SparkSession

from . import settings
from .plans import registry
from .plans.day import Day
from .plans.steps import Manifest, arguments, run_steps


def run_day(spark: SparkSession, args) -> int:
    """The day's steps, all or those asked for; 1 after the first that fails."""
    own = settings.load(spark, file=args.settings)
    day = Day(spark, args.day, own)
    steps = [s for s in day.steps if args.push or s.name != "database"]
    manifest = None if args.again else Manifest(spark, f"{day.out}/steps")
    try:
        ran = run_steps(steps, args.only, args.dry, manifest)
    except Exception as e:  # noqa: BLE001
        print(f"error: {e}", file=sys.stderr)
        return 1
    print("\n".join(ran) or "nothing to do")
    return 0


def main(argv: list) -> int:
    args = arguments(argv)
    known = registry.queries()
    if unknown := [q for q in args.query if q not in known]:
        print(f"no such query: {', '.join(unknown)}", file=sys.stderr)
        return 1
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.day:
        return run_day(spark, args)
    for name in args.query or known:
        df = known[name](spark, args.data)
        if args.dry:
            df.explain("formatted")
        elif args.out:
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
        else:
            df.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
