"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full shingle sets, union by connected components."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import discard, watch
from .common import PLACES, U, connected_components, distinct_in_rows, list_array, materialize, mix, quoted, shingle_hashes, text_slices, word_hashes, written

#: 32 bands of 4 rows miss a pair of similarity 0.8 with probability 5e-8, and one of 0.85 with 6e-11.
BANDS, ROWS = 32, 4
FREE = np.iinfo(np.uint64).max
#: Elements whose steps run together.
PART = 1 << 19
#: Members of a bucket, and shingles of them, that meet in one task with as many others; a larger bucket is dealt out in pairs of blocks.
BLOCK, BLOCK_SHINGLES = 500, 400_000


def superminhash(elements: np.ndarray, row_of: np.ndarray, n_rows: int, m: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash (Ertl 2017) of each row's distinct elements, as n_rows x m numbers; FREE throughout for a row without elements.

    Each element visits the m places in an order of its own, at step i with the value i + r, r uniform in [0, 1). A place keeps
    its least value, so a row is finished after the step that fills its last place. The steps of all rows of a batch run together, in
    parts of PART elements; a place's least value over the parts is the least over all.
    """
    if len(elements) > PART:
        sig = np.full((n_rows, m), FREE, U)
        for a in range(0, len(elements), PART):
            row = row_of[a : a + PART]
            first, last = int(row[0]), int(row[-1]) + 1
            np.minimum(sig[first:last], superminhash(elements[a : a + PART], row - first, last - first, m), out=sig[first:last])
        return sig
    sig = np.full(n_rows * m, FREE, U)
    x, row, order, at0 = elements, row_of.astype(np.int64), None, None
    for i in range(m):
        if not len(x):
            break
        u = mix(x ^ mix(np.array([i + 1], U)))
        k = (i + ((u & U(0xFFFFFFFF)) * U(m - i) >> U(32)).astype(np.int64)).astype(np.int64)
        if i == 0:
            place = at0 = k
        else:
            n = np.arange(len(x))
            if order is None:
                order = np.tile(np.arange(m, dtype=np.uint8), (len(x), 1))
                order[n, at0], order[:, 0] = 0, at0
            place = order[n, k].astype(np.int64)
            order[n, k] = order[:, i]
            order[:, i] = place
        np.minimum.at(sig, row * m + place, (U(i) << U(56)) | (mix(u) >> U(8)))
        some = np.unique(row)
        todo = np.zeros(n_rows, bool)
        todo[some] = (sig.reshape(n_rows, m)[some] == FREE).any(axis=1)
        keep = todo[row]
        x, row = x[keep], row[keep]
        if i == 0:
            at0 = at0[keep]
        else:
            order = order[keep]
    return sig.reshape(n_rows, m)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int):
    h, rows, _, _ = word_hashes(data, offs)
    return distinct_in_rows(*shingle_hashes(h, rows, k), len(offs) - 1)


def signatures(docs: DataFrame, k: int, text: str = "text") -> DataFrame:
    """(doc_id, th, n_shingles, set_a, set_b, bands) of each row of docs; th is the text's hash, set_a and set_b stand for the whole set, and are null for an empty one."""

    def run(batches):
        for batch in batches:
            for i, j, data, offs in text_slices(batch.column(2)):
                values, bounds = shingle_sets(data, offs, k)
                n, sizes = j - i, np.diff(bounds)
                row = np.repeat(np.arange(n), sizes)
                sig = superminhash(values, row, n).reshape(n, BANDS, ROWS)
                with np.errstate(over="ignore"):
                    bands = mix((mix(sig) * PLACES[:ROWS]).sum(axis=2, dtype=U) + np.arange(BANDS, dtype=U)).astype(np.int64)
                    sums = np.zeros((2, n), U)
                    for s, salt in enumerate((0xA5A5A5A5, 0x3C3C3C3C3C)):
                        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(values ^ U(salt)), dtype=U)])
                        sums[s] = total[bounds[1:]] - total[bounds[:-1]]
                empty = sizes == 0
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), batch.column(1).slice(i, n), pa.array(sizes.astype(np.int64)), *(pa.array(s.astype(np.int64), mask=empty) for s in sums), lists], ["doc_id", "th", "n_shingles", "set_a", "set_b", "bands"]
                )

    t = F.coalesce(quoted(text), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("th"), t.alias("text")).mapInArrow(run, "doc_id long, th long, n_shingles long, set_a long, set_b long, bands array<long>")


def text_sets(docs: DataFrame, k: int) -> DataFrame:
    """(id, shingles) of docs(id, text)."""

    def run(batches):
        for batch in batches:
            for i, j, data, offs in text_slices(batch.column(1)):
                values, bounds = shingle_sets(data, offs, k)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), list_array(values.astype(np.int64), bounds)], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles array<long>")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, th, component) for each row of docs.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, sets hold distinct k-word shingles, and two documents are linked
    with 100 * intersection >= percent * union. component_id is the smallest doc_id that is reached. A null or empty text has an empty
    set and links with nothing. Rows of one doc_id count as copies of it only if their sets are equal; rows without a doc_id link with
    nothing, and their component_id is null. Texts of any length are taken whole; extra columns are ignored. For those who drop rows: th
    is the text's hash, and component tells components apart even where doc_ids repeat; it is null where nothing could be linked.

    Documents with equal sets (by 128-bit sums of hashes) form a class with one representative. Representatives meet in the buckets of
    their bands. First each is held against the pivot of each of its buckets, the member that shares buckets with the most others; the
    links found are joined to components. Then members outside a bucket's largest component are compared with its other members.
    """
    sig = materialize(signatures(docs, k, text))
    known = sig.where("doc_id is not null and n_shingles > 0")
    classes = known.groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.struct("doc_id", "th")).alias("r"), F.first("bands").alias("bands"))
    # A class has a number of its own, as a doc_id may occur with several sets; it is fixed when the table is written.
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("cid"), F.col("r.doc_id").alias("rep"), F.col("r.th").alias("th"), "n_shingles", "bands", "set_a", "set_b"))
    with watch() as made:
        labels, path = written(class_components(docs, classes, k, percent, text))
    discard(docs.sparkSession, *(p for p in made if p != path))
    comp = classes.join(labels, F.col("cid") == F.col("node"), "left").select("set_a", "set_b", "rep", F.coalesce("comp", "cid").alias("comp"))
    least = comp.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_set = comp.join(least, "comp").select("set_a", "set_b", "component_id", F.col("comp").alias("component"))
    per_doc = sig.where("doc_id is not null").join(by_set, ["set_a", "set_b"], "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "th", "component")
    nameless = sig.where("doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "th", F.lit(None).cast("long").alias("component"))
    both = per_doc.unionByName(nameless)
    return both.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"), "th", "component")


def class_components(docs: DataFrame, classes: DataFrame, k: int, percent: int, text: str) -> DataFrame:
    """(node, comp) over the classes that have a link."""
    rows = classes.select("cid", "n_shingles", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("bucket"), "cid", F.col("n_shingles").alias("n"))
    full = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(rows.join(full, "bucket"))
    reach = shared.groupBy("cid").agg(F.sum("size").alias("reach"))
    met = shared.join(reach, "cid")
    pivots = materialize(met.groupBy("bucket").agg(F.max_by(F.struct("cid", "n"), F.struct("reach", "cid")).alias("p")))
    close = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    pairs = shared.join(pivots, "bucket").select("cid", "n", F.col("p.cid").alias("other"), F.col("p.n").alias("m")).where(f"cid <> other and {close}").select("cid", "other").distinct()
    members = shared.select("cid").distinct()
    chosen = classes.join(members, "cid", "left_semi").select("cid", F.col("rep").alias("doc_id"), "th")
    t = F.coalesce(quoted(text), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("th"), t.alias("text"))
    sets = materialize(text_sets(texts.join(chosen, ["doc_id", "th"]).select(F.col("cid").alias("id"), "text"), k).select(F.col("id").alias("cid"), "shingles").dropDuplicates(["cid"]))
    links = materialize(verified(pairs, sets, percent))
    labels = materialize(connected_components(links))
    more = materialize(across(shared, labels, sets, percent))
    return connected_components(links.union(more))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(src, dst): the pairs (cid, other) whose sets are similar enough."""
    a, b = sets.select("cid", F.col("shingles").alias("x")), sets.select(F.col("cid").alias("other"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(a, "cid").join(b, "other").where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select(F.col("cid").alias("src"), F.col("other").alias("dst"))


def across(shared: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(src, dst): a forest of the links between members of one bucket that lie in different components, verified on full sets.

    Of two members of different components, one lies outside the bucket's largest: only those seek, and only among members whose set
    size allows a link, which lie in their own class of sizes or a neighbouring one. Seekers and the others are dealt out in blocks of
    bounded size, so that no task holds a large bucket, and pairs are counted inside a task.
    """
    step = math.log(100 / percent) if percent < 100 else 1.0
    labelled = materialize(shared.join(labels, F.col("cid") == F.col("node"), "left").select("bucket", "cid", "n", F.coalesce("comp", "cid").alias("comp"), F.floor(F.log("n") / step).cast("int").alias("level")))
    parts = labelled.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
    top = parts.groupBy("bucket").agg(F.max_by("comp", F.struct("size", "comp")).alias("top"), F.count("*").alias("parts")).where("parts > 1").select("bucket", "top")
    seekers = labelled.join(materialize(top), "bucket").where("comp <> top").drop("top")
    seekers = materialize(seekers.select("bucket", "cid", "n", "comp", F.explode(F.array(*[F.col("level") + i for i in (-1, 0, 1)])).alias("level")))

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        n = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
        return rows.groupBy("bucket", "level").agg(n.alias(name))

    sought = blocks(seekers, "rows")
    found = labelled.join(sought.select("bucket", "level"), ["bucket", "level"], "left_semi")
    sizes = materialize(sought.join(blocks(found, "cols"), ["bucket", "level"]))

    def deal(rows: DataFrame, own: str, other: str, is_seeker: bool) -> DataFrame:
        at = F.pmod(F.xxhash64("cid"), F.col(own)).cast("int")
        dealt = rows.join(sizes, ["bucket", "level"]).select("bucket", "level", at.alias(f"{own}_at"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_at"), F.lit(is_seeker).alias("seeks"), "cid", "comp")
        return dealt.select("bucket", "level", F.col("rows_at").alias("i"), F.col("cols_at").alias("j"), "seeks", "cid", "comp")

    dealt = deal(seekers, "rows", "cols", True).unionByName(deal(labelled, "cols", "rows", False))
    full = dealt.join(sets, "cid").select("bucket", "level", "i", "j", "seeks", "cid", "comp", "shingles")
    keys = ["bucket", "level", "i", "j"]
    return full.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(block_links(percent), "src long, dst long").distinct()


def block_links(percent: int):
    """Links of one block between seekers and the others of different components, each only where they are not joined yet."""

    def of_group(seeks, cid, comp, sets):
        m, sizes = len(cid), np.array([len(x) for x in sets])
        row = np.repeat(np.arange(m), sizes)
        _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        members = row[np.argsort(at, kind="stable")]  # of each shingle, one after another
        begin, first = np.cumsum(counts) - counts, np.cumsum(sizes) - sizes
        _, root = np.unique(comp, return_inverse=True)
        out = []
        for x in np.flatnonzero(seeks):
            if (root == root[0]).all():
                break
            own_at = at[first[x] : first[x] + sizes[x]]
            n = counts[own_at]
            held = members[np.repeat(begin[own_at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            both = np.bincount(held, minlength=m)
            linked = (100 * both >= percent * (sizes[x] + sizes - both)) & (root != root[x]) & ~seeks
            for y in np.flatnonzero(linked):
                if root[y] != root[x]:
                    root[root == root[y]] = root[x]
                    out.append((cid[x], cid[y]))
        return out

    def run(batches):
        held, key = [], None

        def flush():
            if held:
                links = of_group(*(np.concatenate([h[c] for h in held]) for c in range(3)), [x for h in held for x in h[3]])
                held.clear()
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["src", "dst"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(4)])
            seeks = batch.column(4).to_numpy(zero_copy_only=False)
            cid, comp = (batch.column(c).to_numpy() for c in (5, 6))
            sets = [x.values.to_numpy() for x in batch.column(7)]
            new = np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1
            for s, e in zip([0, *new], [*new, len(cid)], strict=True):
                if s == e:
                    continue
                if key != tuple(keys[:, s]):
                    yield from flush()
                    key = tuple(keys[:, s])
                held.append((seeks[s:e], cid[s:e], comp[s:e], sets[s:e]))
        yield from flush()

    return run
