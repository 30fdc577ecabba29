r"""Passages that documents share, found by collinear chaining.

Runs of ``SEED_WORDS`` words, thinned to window minima, are the seeds, and so are runs of ``MIN_WORDS`` words, which
stand for the short seeds at ``LONG_STEPS`` in them. Of each seed that several
documents hold, the smallest document is the source, and every other document that has it matches
the source there. A long seed makes the pair of documents share a whole passage, whatever smaller documents
hold parts of it; an equal run of ``MIN_WORDS + WINDOW - 1`` words always has one. Shorter ones may be missed where every
short seed in them stands in a smaller document too. As sources are one to a seed, a passage that a third of all documents share gives as many matches as there are
documents, not pairs. A document's matches with one source are chained in the order of both texts:
each adds its words and pays for the gap since the one before, and a Fenwick tree of prefix maxima
finds the best predecessor. Chains long enough are aligned word by word, between their matches and on
beyond both ends, and every stretch of at least ``MIN_WORDS`` words of which ``MIN_IDENTITY`` agree is a passage.

Words are ``[^\x20\x09-\x0D]+``, A-Z as a-z, compared by hashes. Passages within one document are not
looked for. NULL and empty texts and rows without doc_id have no passages and stay as they are. Rows
that repeat a doc_id with the same text are one document; with other texts, the text of least hash is the document
and the other rows stay as they are. Documents of equal text share the whole text, and the greater
doc_id has the passage. Other columns of the input are kept by
``remove_passages``, which takes the names id_, least_, own_, cut_id_ and cuts_ for itself, and ignored else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.minhash import mix, shingle_hashes, word_hashes
from llm.registry import query, sorted_groups, stored, table, text_or_empty

MIN_WORDS, MIN_IDENTITY = 50, 0.8
SEED_WORDS, WINDOW = 8, 16
#: Places in a long seed of the short seeds that it stands for.
LONG_STEPS = (0, 14, 28, MIN_WORDS - SEED_WORDS)
#: Cost of a word of gap in either text; with SEED_WORDS a chain bridges about 40 words in both.
GAP_COST = 0.1
#: Words covered by the seeds that any equal passage of MIN_WORDS words has at least.
LEAST_SPAN = MIN_WORDS - 2 * (WINDOW - 1)
DROP = 6
BLOCK_WORDS, MARGIN = 64, 64
BLOCK_ROWS = 256
BITMAP_BITS = 1 << 24
KEY = ["doc", "source", "p0", "c0"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _sliding(x: np.ndarray, size: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` of every run of ``size`` values, from prefixes and suffixes of blocks."""
    n = len(x)
    padded = np.full(-(-n // size) * size, fill, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, size)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n - size + 1], ahead[size - 1:n])


def seed_positions(seeds: np.ndarray) -> np.ndarray:
    """Positions of the values that are the minimum of some window of ``WINDOW`` values."""
    if len(seeds) <= WINDOW:
        return np.flatnonzero(seeds == seeds.min()) if len(seeds) else np.empty(0, np.int64)
    least = _sliding(seeds, WINDOW, np.minimum, np.iinfo(np.uint64).max)
    around = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least, np.zeros(WINDOW - 1, np.uint64)])
    return np.flatnonzero(_sliding(around, WINDOW, np.maximum, 0) == seeds)


def long_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``MIN_WORDS`` words, from those of ``SEED_WORDS`` words."""
    n = len(hashes) - (MIN_WORDS - SEED_WORDS)
    out = hashes[:n]
    for k in [*range(SEED_WORDS, MIN_WORDS - SEED_WORDS, SEED_WORDS), MIN_WORDS - SEED_WORDS]:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n])
    return out


def _seeds(docs: DataFrame) -> DataFrame:
    """(seed, doc, pos, first): where seeds stand, and where the document has them first. Long seeds are odd numbers, short ones even."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                seed, doc, pos, first = [], [], [], []
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    words = word_hashes(text.as_py())
                    if len(words) < MIN_WORDS:
                        continue
                    short = shingle_hashes(words, SEED_WORDS)
                    for hashes, odd in ((short, 0), (long_hashes(short), 1)):
                        p = seed_positions(hashes)
                        own = hashes[p] >> np.uint64(1) << np.uint64(1) | np.uint64(odd)
                        _, index, inverse = np.unique(own, return_index=True, return_inverse=True)
                        seed.append(own.view(np.int64))
                        pos.append(p.astype(np.int32))
                        first.append(p[index][inverse].astype(np.int32))
                        doc.append(np.full(len(p), i, np.int64))
                if seed:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (seed, doc, pos, first)], names=["seed", "doc", "pos", "first"])

    return docs.filter("doc_id IS NOT NULL").select("doc_id", text_or_empty().alias("text_")).mapInArrow(
        run, "seed long, doc long, pos int, first int")


def chain(p: np.ndarray, c: np.ndarray) -> list[list[int]]:
    """Chains of matches (p in the document, c in the source), best first, each match in one at most.

    A match may follow one that lies before it in both texts. score(i) = SEED_WORDS + max(0, score(j) - GAP_COST *
    (p_i - p_j + c_i - c_j)), so with GAP_COST * (p + c) added to each score the best predecessor is a prefix maximum.
    """
    order = np.lexsort((-c, p))
    ranks = (np.searchsorted(np.unique(c), c) + 1).tolist()
    size = max(ranks)
    tree, holder = [-1e18] * (size + 1), [-1] * (size + 1)
    score, before = [0.0] * len(p), [-1] * len(p)
    ps, cs = p.tolist(), c.tolist()
    for i in order.tolist():
        best, from_, k = -1e18, -1, ranks[i] - 1
        while k > 0:
            if tree[k] > best:
                best, from_ = tree[k], holder[k]
            k -= k & -k
        gain = best - GAP_COST * (ps[i] + cs[i])
        score[i] = SEED_WORDS + max(0.0, gain)
        if gain > 0:
            before[i] = from_
        value, k = score[i] + GAP_COST * (ps[i] + cs[i]), ranks[i]
        while k <= size:
            if value > tree[k]:
                tree[k], holder[k] = value, i
            k += k & -k
    used, out = [False] * len(p), []
    for i in sorted(range(len(p)), key=lambda i: (-score[i], ps[i], cs[i])):
        own = []
        while i >= 0 and not used[i]:
            used[i] = True
            own.append(i)
            i = before[i]
        if own:
            out.append(own[::-1])
    return out


def _chains(matches: DataFrame) -> DataFrame:
    """(doc, source, p0, c0, p, c): the chains that span enough words of the document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["doc", "source"]):
            p, c = group.column("pos").to_numpy(), group.column("source_pos").to_numpy()
            new = np.concatenate([[True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])])  # long and short seeds may say the same
            p, c = p[new], c[new]
            if p.max() - p.min() + SEED_WORDS < LEAST_SPAN:
                continue
            found = [(p[x], c[x]) for x in chain(p, c) if p[x[-1]] - p[x[0]] + SEED_WORDS >= LEAST_SPAN]
            if found:
                k = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group.column("doc")[0].as_py()] * k, pa.int64()), pa.array([group.column("source")[0].as_py()] * k, pa.int64()),
                     pa.array([int(x[0]) for x, _ in found], pa.int32()), pa.array([int(y[0]) for _, y in found], pa.int32()),
                     pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array([y for _, y in found], pa.list_(pa.int32()))],
                    names=[*KEY, "p", "c"])

    return (matches.repartition("doc").sortWithinPartitions("doc", "source", "pos", "source_pos")
            .mapInArrow(run, "doc long, source long, p0 int, c0 int, p array<int>, c array<int>"))


def _likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids``, and some others: a test by one hash in a bitmap of ``BITMAP_BITS``.

    The bitmap is 4 KB pieces, 2 MB in all whatever the number of ids, so it may be broadcast, and no text is
    shuffled. With more ids than it has room for more of the others pass, and the join on blocks leaves them out.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP_BITS)) + 1
    pieces = ids.select(place("doc_id").alias("h_")).groupBy(F.bitmap_bucket_number("h_").alias("piece_")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h_")).alias("bits_"))
    found = docs.withColumns({"piece_": F.bitmap_bucket_number(place("doc_id")), "at_": F.bitmap_bit_position(place("doc_id"))}).join(
        F.broadcast(pieces), "piece_")
    byte = F.conv(F.hex(F.expr("substring(bits_, cast(at_ div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return found.filter(byte.bitwiseAND(F.expr("shiftleft(1, cast(at_ % 8 as int))")) != 0).select(*docs.columns)


def _blocks(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc, block, words): word hashes of the documents with these ids (and some others), in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                doc, block, words = [], [], []
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    hashes = (word_hashes(text.as_py()) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    for b in range(0, len(hashes), BLOCK_WORDS):
                        doc.append(i)
                        block.append(b // BLOCK_WORDS)
                        words.append(hashes[b:b + BLOCK_WORDS])
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(block, pa.int32()), pa.array(words, pa.list_(pa.int32()))],
                                                 names=["doc_", "block", "words"])

    return _likely(docs, ids).select("doc_id", text_or_empty().alias("text_")).mapInArrow(run, "doc_ long, block int, words array<int>")


def common_words(x: list[int], y: list[int]) -> int:
    """Length of the longest common subsequence, by rows of bits."""
    if x == y:
        return len(x)
    at: dict[int, int] = {}
    for k, word in enumerate(x):
        at[word] = at.get(word, 0) | 1 << k
    full = row = (1 << len(x)) - 1
    for word in y:
        hit = row & at.get(word, 0)
        row = (row + hit | row - hit) & full
    return len(x) - row.bit_count()


def _extend(x: list[int], y: list[int]) -> tuple[int, int]:
    """(words, agreeing words) that two texts run on alike, by the best of +1 and -2 sums until ``DROP`` below it."""
    total = best = length = agreed = same = 0
    for k, (a, b) in enumerate(zip(x, y)):
        total += 1 if a == b else -2
        same += a == b
        if total > best:
            best, length, agreed = total, k + 1, same
        elif total < best - DROP:
            break
    return length, agreed


def _pieces(x: list[int], y: list[int], p: list[int], c: list[int]) -> tuple[int, int, np.ndarray]:
    """(start, source start, pieces) of a chain in two word lists; a piece is (words, source words, agreeing words, kind).

    Kind 0 agrees in full, 1 runs on alike from a piece beside it, 2 is what lies between. Pieces of kind 0 in a row are one.
    """
    out: list[list[int]] = []

    def add(n: int, m: int, agreed: int, kind: int) -> None:
        if n == m == agreed:
            kind = 0
            if out and out[-1][3] == 0:
                out[-1][:3] = [v + n for v in out[-1][:3]]
                return
        if n or m:
            out.append([n, m, agreed, kind])

    behind, before = _extend(x[:p[0]][::-1], y[:c[0]][::-1])
    add(behind, behind, before, 1)
    a, b = p[0], c[0]
    for i, j in zip(p, c):
        if i >= a and j >= b:
            gap, other = x[a:i], y[b:j]
            ahead, same = _extend(gap, other)
            back, too = _extend(gap[ahead:][::-1], other[ahead:][::-1])
            add(ahead, ahead, same, 1)
            add(i - a - ahead - back, j - b - ahead - back, common_words(gap, other) - same - too, 2)
            add(back, back, too, 1)
            a, b = i, j
        n, m = i + SEED_WORDS - a, j + SEED_WORDS - b  # matches may overlap
        add(n - min(n, m), m - min(n, m), 0, 2)
        add(min(n, m), min(n, m), min(n, m), 0)
        a, b = a + n, b + m
    ahead, same = _extend(x[a:], y[b:])
    add(ahead, ahead, same, 1)
    return p[0] - behind, c[0] - behind, np.array(out)


def align(x: list[int], y: list[int], p: list[int], c: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(start, end, source start, source end, agreeing words) of the passages in a chain of two word lists.

    Every stretch of a chain, from a piece that agrees to another, that has ``MIN_WORDS`` words and of which ``MIN_IDENTITY``
    agree is covered. Gaps that score below -``DROP`` by +1 and -2 are left out where both sides are passages without them.
    """
    start, source_start, pieces = _pieces(x, y, p, c)
    n, m, same = np.concatenate([np.zeros((1, 3), np.int64), pieces[:, :3].cumsum(axis=0)]).T
    between = pieces[:, 3] == 2

    def passes(i, j):
        return (n[j] - n[i] >= MIN_WORDS) & (same[j] - same[i] >= MIN_IDENTITY * np.maximum(n[j] - n[i], m[j] - m[i]))

    ends = np.flatnonzero(~between) + 1
    longest: list[tuple[int, int]] = []
    for i in (ends - 1).tolist():
        later = ends[np.searchsorted(ends, longest[-1][1] if longest else i, "right"):]
        later = later[passes(i, later)]
        if len(later):
            while len(longest) > 1 and i <= longest[-2][1]:
                longest.pop()  # its neighbours cover it
            longest.append((i, int(later[-1])))
    wide = pieces[:, :2].max(axis=1)
    bad = np.flatnonzero(between & (3 * pieces[:, 2] - 2 * wide < -DROP))
    out = []
    while longest:
        i, j = longest.pop()
        inner = bad[(bad > i) & (bad < j)]
        inner = inner[passes(i, inner) & passes(inner + 1, j)]
        if len(inner):
            k = int(inner[wide[inner].argmax()])
            longest += [(k + 1, j), (i, k)]
        else:
            out.append(_widened(x, y, *(int(v) for v in (start + n[i], start + n[j], source_start + m[i], source_start + m[j], same[j] - same[i]))))
    return sorted(out)


def _widened(x: list[int], y: list[int], a: int, b: int, s: int, t: int, agreed: int) -> tuple[int, int, int, int, int]:
    """A passage that runs on alike at both ends, where its chain came from elsewhere in the source."""
    behind, before = _extend(x[:a][::-1], y[:s][::-1])
    ahead, after = _extend(x[b:], y[t:])
    size = max(b - a, t - s) + behind + ahead
    if agreed + before + after < MIN_IDENTITY * size:
        return a, b, s, t, agreed
    return a - behind, b + ahead, s - behind, t + ahead, agreed + before + after


PASSAGE = "doc_id long, start int, end int, source_id long, source_start int, source_end int, agreed int"


def _aligned(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for group in sorted_groups(batches, KEY):
            rows = group.to_pylist()  # the chain itself first, then the blocks of the document and of the source in order
            p, c, texts, offset = rows[0]["p"], rows[0]["c"], ([], []), [0, 0]
            for last, row in zip(rows, rows[1:]):
                if (last["side"], last["block"]) == (row["side"], row["block"]):
                    continue  # of a row that repeats the document
                side = row["side"] - 1
                if not texts[side]:
                    offset[side] = row["block"] * BLOCK_WORDS
                texts[side].extend(row["words"])
            for a, b, s, t, agreed in align(*texts, [i - offset[0] for i in p], [j - offset[1] for j in c]):
                out.append((rows[0]["doc"], a + offset[0], b + offset[0], rows[0]["source"], s + offset[1], t + offset[1], agreed))
            if len(out) >= 1000:
                yield _passages(out)
                out = []
        yield _passages(out)

    return rows.repartition(*KEY).sortWithinPartitions(*KEY, "side", "block").mapInArrow(run, PASSAGE)


def _passages(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in PASSAGE.split(", ")]
    types = [pa.int64() if x.endswith("long") else pa.int32() for x in PASSAGE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(names), types)], names=names)


def _one_text(docs: DataFrame) -> DataFrame:
    """``docs`` with ``own_``: whether a row's text is that of its document, which it is unless rows of one id differ in text."""
    key, mark = F.col("doc_id").cast("long"), F.coalesce(F.xxhash64("text"), F.lit(0))
    differing = docs.filter("doc_id IS NOT NULL").groupBy(key.alias("id_")).agg(F.min(mark).alias("least_"), F.max(mark).alias("greatest_")).filter(
        "least_ < greatest_").drop("greatest_")
    differing = stored(differing, "differing")
    if differing.isEmpty():
        return docs.withColumn("own_", F.lit(True))
    return docs.join(differing, key == F.col("id_"), "left").withColumn("own_", F.col("id_").isNull() | (mark == F.col("least_"))).drop("id_", "least_")


def shared_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, source_id, source_start, source_end, agreed): passages of ``docs`` (doc_id, text) that
    a document of a smaller id has too, in words from 0 (end excluded), with the number of words that agree."""
    docs = _one_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).filter("own_").select("doc_id", "text")
    seeds = stored(_seeds(docs), "seeds")
    shared = seeds.groupBy("seed").agg(F.min("doc").alias("source"), F.min_by("first", "doc").alias("source_pos"), F.max("doc").alias("last")).filter(
        "source < last").drop("last")
    shared = stored(shared, "shared")  # so that the join below is between two plain exchanges, which can be split
    steps = F.when(F.col("seed").bitwiseAND(1) == 1, F.array(*map(F.lit, LONG_STEPS))).otherwise(F.array(F.lit(0)))
    matches = seeds.join(shared, "seed").filter("doc <> source").select("doc", "pos", "source", "source_pos", F.explode(steps).alias("step"))
    matches = matches.select("doc", (F.col("pos") + F.col("step")).alias("pos"), "source", (F.col("source_pos") + F.col("step")).alias("source_pos"))
    chains = stored(_chains(matches), "chains")
    ids = stored(chains.select(F.explode(F.array("doc", "source")).alias("doc_id")).distinct(), "ids")

    def needed(side: int, doc: str, at: str):
        block = lambda word: F.floor(word / BLOCK_WORDS).cast("int")
        return chains.select(*KEY, F.lit(side).alias("side"), F.col(doc).alias("doc_"), F.explode(F.sequence(
            block(F.greatest(F.element_at(at, 1) - MARGIN, F.lit(0))), block(F.element_at(at, -1) + MARGIN))).alias("block"))

    none = F.lit(None).cast("array<int>")
    fetched = needed(1, "doc", "p").unionByName(needed(2, "source", "c")).join(stored(_blocks(docs, ids), "words"), ["doc_", "block"])
    rows = (fetched.select(*KEY, "side", "block", "words", none.alias("p"), none.alias("c"))
            .unionByName(chains.select(*KEY, F.lit(0).alias("side"), F.lit(0).alias("block"), none.alias("words"), "p", "c")))
    return _aligned(rows).distinct()


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with the words of their passages taken out of the text, and the white space before each word with it."""
    cuts = passages.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("cuts_"))
    schema, columns = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts = columns.index("text"), []
            for text, found in zip(batch.column(at), batch.column(len(columns))):
                text, found = text.as_py(), found.as_py()
                if found and text is not None:
                    spans = [m.span() for m in WORD.finditer(text)]
                    parts, done = [], 0
                    for a, b in sorted((x["start"], x["end"]) for x in found):
                        begin = spans[a - 1][1] if a else 0
                        parts.append(text[done:max(done, begin)])
                        done = max(done, spans[min(b, len(spans)) - 1][1])
                    text = "".join(parts) + text[done:]
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(batch.columns[:len(columns)])], names=columns)

    ours = _one_text(docs)
    return ours.join(cuts.withColumnRenamed("doc_id", "cut_id_"), ours["own_"] & (F.col("doc_id").cast("long") == F.col("cut_id_")), "left").select(
        *docs.columns, "cuts_").mapInArrow(run, schema)


@query("op8_substring")
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(table(spark, sf_dir, "documents"))
