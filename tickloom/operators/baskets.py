"""Baskets: scripts found in the contracts, rolls to the nearest or to all live futures, and chains of options."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.symbols import script_root
from ..scratch import kept
from ..sources.files import first_of
from .contracts import is_future, is_live, is_option

#: Basket: (exchange, kind, template, root parser). Kinds: by_script, near, all, and chain with two expirations.
BASKETS = {
    "XNSE_NIFTYFNO_EQUITY": ("XNSE", "by_script", "XNSE_NIFTYFNO_EQUITY", None),
    "XNSE_NIFTYFNO_FUTURES_NEAR": ("XNSE", "near", "XNSE_NIFTYFNO_EQUITY", "EQ"),
    "XNSE_NIFTYFNO_FUTURES_ALL": ("XNSE", "all", "XNSE_NIFTYFNO_EQUITY", "EQ"),
    "XNSE_INDEX_FUTURES_NEAR": ("XNSE", "near", "XNSE_INDEX_FUTURES_NEAR", "FUT"),
    "XNSE_INDEX_FUTURES_ALL": ("XNSE", "all", "XNSE_INDEX_FUTURES_ALL", "FUT"),
    "XBOM_INDEX_FUTURES": ("XBOM", "near", "XBOM_INDEX_FUTURES", "FUT"),
    "XIMC_FUTURES_ALL": ("XIMC", "all", "XIMC_FUTURES_ALL", "FUT"),
    "XIMC_CRUDE_NEAREST_NXTNEAREST": ("XIMC", "chain", "XIMC_CRUDE_NEAREST_NXTNEAREST", "OPT"),
    "XIMC_BULLDEX_NEAREST_NXTNEAREST": ("XIMC", "chain", "XIMC_BULLDEX_NEAREST_NXTNEAREST", "OPT"),
    **{f"XNSE_NIFTY{n}_EQUITY": ("XNSE", "by_script", f"XNSE_NIFTY{n}_EQUITY", None) for n in (50, 100, 200, 500)},
    "XNSE_NIFTY500_FUTURES": ("XNSE", "all", "XNSE_NIFTY500_EQUITY", "EQ"),
}
#: What a contract must be for a kind of basket: any by its script, or a live future or option by its root.
SORTS = {"by_script": "script", "near": "future", "all": "future", "chain": "option"}
#: Baskets that are the rows of others, one after another.
UNIONS = {"ALL_INDEX_FUTURES": ("XNSE_INDEX_FUTURES_NEAR", "XBOM_INDEX_FUTURES", "XIMC_FUTURES_ALL")}


def last_by_script(template: DataFrame, contracts: DataFrame, order: list, key: str = "script") -> DataFrame:
    """The contracts of a template(ordinal, key), the last in order where a script occurs twice; a template line that repeats gives its row again.

    Contracts are cut down to the template's scripts before the last one is chosen.
    """
    some = contracts.join(template.select(key).distinct(), key, "left_semi")
    last = first_of(some, [key], [F.desc(c) for c in order])
    return template.select("ordinal", key).join(last, key).select("ordinal", key, *[c for c in contracts.columns if c != key])


def missing_scripts(template: DataFrame, contracts: DataFrame, key: str = "script") -> DataFrame:
    return template.join(contracts, key, "left_anti")


def roots(template: DataFrame, root: Column) -> DataFrame:
    """(root, ordinal): the distinct roots that are not empty, each at its first place."""
    return template.select(root.alias("root"), "ordinal").where("root <> ''").groupBy("root").agg(F.min("ordinal").alias("ordinal"))


def of_roots(wanted: DataFrame, contracts: DataFrame, root: str) -> DataFrame:
    return contracts.withColumn("_root", F.upper(F.col(root).cast("string"))).join(wanted.select(F.col("root").cast("string").alias("_root"), F.col("ordinal").alias("root_ordinal")), "_root").drop("_root")


def nearest(contracts: DataFrame, root: str, expiration: str, ties: list) -> DataFrame:
    """One contract of each root: of the least expiration, the first in the order of ties. Each task sends one row of a root at most."""
    return first_of(contracts, [root], [expiration, *ties])


def chain(contracts: DataFrame, root: str, expiration: str, n: int) -> DataFrame:
    """All contracts of the n nearest distinct expirations of each root.

    One scan; before the shuffle each task drops what lies beyond its own n nearest expirations of a root, so what meets is a chain's size.
    """
    return contracts.withColumn("_n", F.dense_rank().over(Window.partitionBy(root).orderBy(expiration))).where(F.col("_n") <= n).drop("_n")


def coverage(template: DataFrame, contracts: DataFrame, key: str, by: list) -> DataFrame:
    """found and missing lines of the template for each group of `by`."""
    known = contracts.select(key).distinct().withColumn("_found", F.lit(True))
    marked = template.join(known, key, "left")
    return marked.groupBy(*by).agg(F.count("_found").alias("found"), (F.count("*") - F.count("_found")).alias("missing"))


def documents(rows: DataFrame, basket: str, script: str, order: list) -> DataFrame:
    """(basket, scripts): the ordered scripts of each basket as a JSON array."""
    scripts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(script).alias("_s")))), lambda x: x["_s"])
    return rows.groupBy(basket).agg(F.to_json(scripts).alias("scripts"))


def wanted(templates: DataFrame, names: list) -> DataFrame:
    """(basket, part, kind, exchange, sort, key, root_ordinal): what each basket of names asks of the contracts, by script or by root.

    A template line counts for every basket that reads it, and for every union of such a basket; a root counts at its first place.
    """
    if unknown := [n for n in names if n not in BASKETS and n not in UNIONS]:
        raise ValueError(f"no such basket: {', '.join(unknown)}")
    asks = [(n, part, *BASKETS[b]) for n in names for part, b in enumerate(UNIONS.get(n, (n,)))]
    parsers = {p for *_, p in asks}
    rows = F.array(*[F.struct(F.lit(n).alias("basket"), F.lit(part).alias("part"), F.lit(e).alias("exchange"), F.lit(k).alias("kind"), F.lit(t).alias("name"), F.lit(p).alias("parser")) for n, part, e, k, t, p in asks])
    each = templates.where(F.col("name").isin(sorted({a[4] for a in asks}))).withColumn("a", F.explode(F.filter(rows, lambda a: a["name"] == F.col("name"))))
    root = F.coalesce(*[F.when(F.col("a.parser") == p, script_root(F.col("value"), p)) for p in sorted(p for p in parsers if p)], F.lit("")) if parsers - {None} else F.lit("")
    kind = F.col("a.kind")
    sort = F.coalesce(*[F.when(kind == k, s) for k, s in SORTS.items()])
    key = F.when(kind == "by_script", F.col("value")).otherwise(F.upper(root))
    lines = each.select("a.basket", "a.part", kind.alias("kind"), "a.exchange", sort.alias("sort"), key.alias("key"), "ordinal").where("key <> ''")
    of = ["basket", "part", "kind", "exchange", "sort", "key"]
    first = lines.where("sort <> 'script'").groupBy(*of).agg(F.min("ordinal").alias("root_ordinal"))
    return first.unionByName(lines.where("sort = 'script'").select(*of, F.col("ordinal").alias("root_ordinal")))


def resolve(names: list, templates: DataFrame, contracts: DataFrame, as_of: str, order: list) -> DataFrame:
    """The constituents of baskets: basket, part (of a union) and root_ordinal, then the contract's columns.

    templates(name, ordinal, value) as read by read_lines; order is a total order of contracts. Contracts are read once: each stands under its
    script and, if live, its root where its exchange is asked for such, and meets what is wanted in one join, whose rows are written by kind. The nearest and the last
    of each key are then chosen with limits below the shuffle, so that a frequent root or script does not meet in one task.
    """
    lines = wanted(templates, names)
    asked = {(BASKETS[b][0], SORTS[BASKETS[b][1]]) for n in names for b in UNIONS.get(n, (n,))}
    asks = lambda sort: F.col("exchange").isin(sorted(e for e, s in asked if s == sort))
    live = is_live(F.col("expiration"), as_of)
    sort = F.when(asks("future") & live & is_future(), "future").when(asks("option") & live & is_option(), "option")
    under = F.array(F.when(asks("script"), F.struct(F.lit("script").alias("sort"), F.col("script").alias("key"))), F.when(sort.isNotNull(), F.struct(sort.alias("sort"), F.upper("underlying_root").alias("key"))))
    keyed = contracts.withColumn("_k", F.explode(F.array_compact(under))).select("_k.*", *contracts.columns)
    met = kept(keyed.join(lines, ["exchange", "sort", "key"]).drop("sort"), "kind")
    of, out = ["basket", "part", "root_ordinal", "key"], ["basket", "part", "root_ordinal", *contracts.columns]
    found = [
        first_of(met.where("kind = 'by_script'"), of, [F.desc(c) for c in order]), first_of(met.where("kind = 'near'"), of, ["expiration", *order]),
        met.where("kind = 'all'"), met.where("kind = 'chain'").withColumn("_n", F.dense_rank().over(Window.partitionBy(*of).orderBy("expiration"))).where("_n <= 2"),
    ]
    rows = found[0].select(out)
    for more in found[1:]:
        rows = rows.union(more.select(out))
    return rows


def in_order(rows: DataFrame) -> DataFrame:
    """A basket in the order of its template, then by expiration and script."""
    return rows.orderBy("root_ordinal", "expiration", "script")


def flat(rows: DataFrame, as_of: str, columns: list) -> DataFrame:
    """The flat export of basket rows: script, or symbol where it is empty, and the columns named."""
    script = F.coalesce(F.nullif(F.col("script"), F.lit("")), F.col("symbol")) if "symbol" in rows.columns else F.col("script")
    values = {"date": F.lit(as_of), "script": script}
    return rows.select(*[values.get(c, F.col(c) if c in rows.columns else F.lit(None)).alias(c) for c in columns])
