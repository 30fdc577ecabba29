r"""Near-duplicate documents by one-permutation MinHash.

One hash of each word shingle fills ``BANDS * ROWS`` bins with their minima; an empty bin takes the
minimum of the first filled bin in a random order of its own (optimal densification). Bands of
``ROWS`` bins are bucket keys. Equal sets are one class from the start. In each bucket a hub is
compared with all other members (a star, so as many pairs as members) on the full sets, and links
of 0.8 or more are joined into components. So that no link is lost, buckets that still hold several
components get a few more hubs, and what is then left in mixed buckets is compared exactly: all pairs
that can be similar enough, found by their rarest shingles.

Words are ``[^\x20\x09-\x0D]+`` after lower-casing A-Z; texts of fewer words than a shingle are one
shingle, texts without words have none and are linked with nothing. NULL text: no words. Rows
without an id take no part: their component is NULL and they are kept. Rows that share an id are
one node. Shingles are compared by 64-bit hashes. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.graph import components
from llm.registry import Memo, per_worker, query, stored, table, text_or_empty

#: A pair of similarity 0.8 shares none of the bands with a chance of 3e-5, one of 0.85 with 2e-7.
BANDS, ROWS = 26, 5
PERCENT = 80
#: Hubs of each bucket in the first and in the second round of stars.
STARS = (1, 4)
MEMO_WORDS = 150_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    words = text.encode().lower().split()
    memo = per_worker("word hashes", lambda: Memo(xxhash.xxh3_64_intdigest, MEMO_WORDS))
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words in their order."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    out = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j:n - size + 1 + j]
    return mix(out)


def _orders(bins: int) -> np.ndarray:
    rng = np.random.default_rng(11)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def signature(shingles: np.ndarray, bins: int, orders: np.ndarray) -> np.ndarray:
    """Minimum of each bin of the sorted distinct ``shingles``, with empty bins densified."""
    at = ((shingles >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.searchsorted(at, np.arange(bins + 1))
    filled = first[1:] > first[:-1]
    out = shingles[np.minimum(first[:-1], len(shingles) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = orders[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS)
    out = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return out.view(np.int64)


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, k1, k2, bands): size, 128-bit key and band keys of each document's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders(BANDS * ROWS)
        for batch in batches:
            n, k1, k2, bands = [], [], [], []
            for text in batch.column(1):
                shingles = np.unique(shingle_hashes(word_hashes(text.as_py()), size))
                n.append(len(shingles))
                key = xxhash.xxh3_128_digest(shingles.tobytes())
                k1.append(int.from_bytes(key[:8], "little", signed=True))
                k2.append(int.from_bytes(key[8:], "little", signed=True))
                bands.append(band_keys(signature(shingles, BANDS * ROWS, orders)) if len(shingles) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "k1", "k2", "bands"])

    return docs.select("doc_id", text_or_empty().alias("text_")).mapInArrow(
        run, "doc_id long, n long, k1 long, k2 long, bands array<long>")


def _sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles) of the documents with these ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(word_hashes(t.as_py()), size)).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"])

    return docs.join(ids, "doc_id", "left_semi").select("doc_id", text_or_empty().alias("text_")).mapInArrow(
        run, "doc_id long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (hub, doc) whose full sets are similar enough."""
    with_doc = pairs.join(sets.select(F.col("doc_id").alias("doc"), F.col("shingles").alias("x")), "doc")
    both = with_doc.join(sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("y")), "hub")
    shared = F.size(F.array_intersect("x", "y"))
    return both.select("hub", "doc", (F.size("x") + F.size("y")).alias("total"), shared.alias("shared")).filter(
        100 * F.col("shared") >= PERCENT * (F.col("total") - F.col("shared"))).select("hub", "doc").distinct()


def _rest_pairs(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs (hub, doc) of ``rest`` (doc, component) of different components that may be similar enough.

    With the shingles of each set in one order, rarest first, two sets that are similar enough meet in
    their first fifth (and one), and so early that what follows can still make up the overlap. Shingles
    that one component alone has there are left out, and the most frequent component of a shingle is
    only met by the others. So copies of one text whose own changes keep them apart meet in hardly any
    pair, however many they are.
    """
    mine = sets.join(rest, sets["doc_id"] == rest["doc"], "left_semi")
    each = stored(mine.select(F.col("doc_id").alias("doc"), F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")), "shingles")
    counts = each.groupBy("shingle").count()
    ordered = each.join(counts, "shingle").groupBy("doc").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("count", "shingle"))).alias("order_"))
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100).cast("int") + 1
    entries = ordered.select("doc", "n", F.posexplode(F.slice("order_", F.lit(1), length)).alias("pos", "x")).select(
        "doc", "n", "pos", F.col("x.shingle").alias("shingle")).join(rest, "doc")
    entries = stored(entries, "entries")
    by_component = entries.groupBy("shingle", "component").count()
    tops = by_component.groupBy("shingle").agg(F.max_by("component", "count").alias("top"), F.count(F.lit(1)).alias("several")).filter("several > 1")
    entries = stored(entries.join(tops.drop("several"), "shingle"), "entries")
    x = entries.filter("component <> top").alias("x")
    y = entries.alias("y")
    at_most = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    near = (100 + PERCENT) * at_most >= PERCENT * (F.col("x.n") + F.col("y.n"))
    once = (F.col("y.component") == F.col("y.top")) | (F.col("x.doc") < F.col("y.doc"))
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component")) & once & near)
    return met.select(F.least("x.doc", "y.doc").alias("hub"), F.greatest("x.doc", "y.doc").alias("doc")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stored(_sketches(docs, size), "sketches")
    classes = stored(sketches.filter("n > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    rows = classes.select(F.explode("bands").alias("bucket"), F.col("rep").alias("doc"), "n")
    shared = rows.groupBy("bucket").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).filter("x < y").select("bucket")
    shared = stored(shared, "shared")  # so that the join below is between two plain exchanges, which can be split
    members = stored(rows.join(shared, "bucket").withColumn("component", F.col("doc")), "buckets")
    sets = stored(_sets(docs, stored(members.select(F.col("doc").alias("doc_id")).distinct(), "ids"), size).distinct(), "sets")
    links = found = None

    def join_links(pairs: DataFrame) -> None:
        nonlocal links, found
        new = stored(_confirmed(stored(pairs, "pairs"), sets).select(F.col("hub").alias("a"), F.col("doc").alias("b")), "confirmed")
        if found is None or not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            found = stored(components(links), "components")

    for hubs_each in STARS:
        if members.isEmpty():
            break
        slot = F.pmod(F.xxhash64("doc", F.lit(hubs_each)), F.lit(hubs_each))
        hubs = members.groupBy("bucket", slot.alias("slot")).agg(F.min("doc").alias("hub")).select("bucket", "hub")
        sizes = members.select("bucket", F.col("doc").alias("hub"), F.col("n").alias("hub_n"), F.col("component").alias("hub_component"))
        hubs = stored(hubs.join(sizes, ["bucket", "hub"]), "hubs")
        join_links(members.join(hubs, "bucket").filter(
            (F.col("doc") != F.col("hub")) & (F.col("component") != F.col("hub_component"))
            & (100 * F.least("n", "hub_n") >= PERCENT * F.greatest("n", "hub_n"))).select("hub", "doc").distinct())
        rest = (members.select("bucket", "doc", "n").join(hubs.select("bucket", F.col("hub").alias("doc")), ["bucket", "doc"], "left_anti")
                .join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc")))
        rest = stored(rest, "rest")
        mixed = rest.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("bucket")
        members = stored(rest.join(stored(mixed, "mixed"), "bucket"), "buckets")
    if not members.isEmpty():
        join_links(_rest_pairs(stored(members.select("doc", "component").distinct(), "rest"), sets))
    reps = classes.select("k1", "k2", "rep")
    if found is not None:
        reps = reps.join(found, reps["rep"] == found["node"], "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    else:
        reps = reps.select("k1", "k2", F.col("rep").alias("component"))
    out = sketches.select("doc_id", "n", "k1", "k2").join(reps, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


@query("op4_minhash")
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)
