"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (marked at both ends, hashed into buckets); its vector is
the mean of the n-gram vectors, so a misspelling that was never seen shares most of them. A passage
is the mean of the vectors of ``WINDOW`` words in a row, and a softmax over a linear layer gives its
chance of being toxic. A text is as toxic as its most toxic passage. Vectors and layer are learned
together from labels of whole texts: the log of the mean of exponentials over a text's passages
stands for its score, first nearly their mean and, as it sharpens, their maximum.

Learning uses a bounded sample: of the labelled texts that there are, ``PER_LABEL`` of each label, lowest hash
of the id first. Texts of more than ``TRAIN_BYTES`` bytes come last, and of them evenly spaced passages of about so
many bytes are learned from. Scoring reads every text whole. Rows whose
crc32(doc_id as text) mod 3 is 1 are never learned from. NULL and empty texts score 0. Without labels
of both kinds everything scores 0, so nothing is filtered. A NULL doc_id is not held out. Repeated rows score alike.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.registry import query, stored, table, text_or_empty

PER_LABEL = 2000
TRAIN_BYTES = 10_000
BUCKETS = 1 << 17
DIMENSIONS = 8
WINDOW = 5
GRAMS = (3, 4, 5)
ROUNDS = 100
RATE = 0.6
MIN_TEXTS = 4
THRESHOLD = 0.7
MEMO_WORDS = 150_000
#: Words, n-grams or buckets that training holds as floating-point numbers at a time.
PIECE = 1 << 16
#: Words that scoring looks up at a time, and characters of unknown words whose n-grams are hashed at a time.
BLOCK_WORDS, BLOCK_CHARS = 1 << 15, 1 << 16
#: Signs left out at the ends of words, and signs that stand for letters inside them.
MARKS = '.,;:!?"\'()[]{}<>*#&%$|-_/~`'
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
LETTERS = np.array([ord(chr(k).translate(LOOKALIKES)) for k in range(0x80)], np.uint32)
#: What a byte does to a CRC-32.
CRC_TABLE = np.array([zlib.crc32(bytes([255 ^ b])) for b in range(256)], np.uint32) ^ np.uint32(0xFF000000)


class Model(NamedTuple):
    vectors: np.ndarray  # BUCKETS x DIMENSIONS
    layer: np.ndarray    # DIMENSIONS x 2
    bias: np.ndarray     # 2

    def bucket_scores(self) -> np.ndarray:
        """What each n-gram adds to the difference of the two logits."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32)


def _marked(word: str) -> str:
    return f"<{word.lower().strip(MARKS) or word}>"


def buckets(word: str) -> list[int]:
    """Buckets of a word's n-grams; case and marks at its ends are left out."""
    marked = _marked(word).translate(LOOKALIKES)
    return [zlib.crc32(marked[i:i + n].encode()) % BUCKETS for n in GRAMS for i in range(max(1, len(marked) - n + 1))]


def _utf8(signs: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """How many bytes each code point has, and its first byte, second byte and so on, as far as any has one."""
    widths = 1 + (signs >= 0x80).astype(np.int8) + (signs >= 0x800) + (signs >= 0x10000)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0], np.uint32)[widths]
    shifted = (signs >> (6 * np.maximum(widths - 1 - k, 0)).astype(np.uint32) for k in range(widths.max()))
    return widths, [bits & 0x3F | 0x80 if k else bits | lead for k, bits in enumerate(shifted)]


def _buckets_of_alike(marked: list[str]) -> np.ndarray:
    """One row per word, the same as ``buckets``; all are of the same length. The n-grams of all places are hashed together."""
    length = len(marked[0])
    signs = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).reshape(-1, length)
    signs = np.where(signs < 0x80, LETTERS[signs & 0x7F], signs)
    widths, in_bytes = _utf8(signs)
    state = np.full(signs.shape, 0xFFFFFFFF, np.uint32)
    found = []
    for n in range(1, max(GRAMS) + 1):
        if n <= length:
            state = state[:, :length - n + 1]
            for k, of_byte in enumerate(in_bytes):
                after = CRC_TABLE[(state ^ of_byte[:, n - 1:]) & 0xFF] ^ (state >> 8)
                state = after if k == 0 else np.where(widths[:, n - 1:] > k, after, state)
        if n in GRAMS:
            found.append(~state % BUCKETS)
    return np.concatenate(found, axis=1)


def word_scores(words: Iterable[str], added: np.ndarray) -> dict[str, float]:
    """The mean of ``added`` over the buckets of each word."""
    alike = defaultdict(list)
    for word in words:
        marked = _marked(word)
        alike[len(marked)].append((word, marked))
    scores = {}
    for length, pairs in alike.items():
        rows = max(1, BLOCK_CHARS // length)
        for at in range(0, len(pairs), rows):
            some, marked = zip(*pairs[at:at + rows])
            scores.update(zip(some, added[_buckets_of_alike(marked)].mean(axis=1).tolist()))
    return scores


def _pieces(length: int) -> Iterator[slice]:
    """Slices that cover ``length`` entries, each of a bounded size."""
    return (slice(at, min(at + PIECE, length)) for at in range(0, length, PIECE))


def _spread(firsts: np.ndarray, length: int) -> list[tuple[slice, slice]]:
    """Pairs of slices of runs and of their entries, bounded unless one run is longer; ``firsts`` are the runs' first entries."""
    cuts = np.unique(np.append(np.searchsorted(firsts, np.arange(0, length, PIECE)), len(firsts)))
    ends = np.append(firsts, length)
    return [(slice(a, b), slice(ends[a], ends[b])) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def train(texts: list[str], toxic: list[int], seed: int = 7) -> Model:
    """Fit vectors and layer together over all passages of all texts, by gradient descent with momentum.

    The largest step of each parameter has a fixed length and all others keep their proportion to
    it, so n-grams that many toxic texts share are learned and those of single texts hardly are.
    Buckets met in fewer than ``MIN_TEXTS`` texts stay out. Each round leaves out half of the n-grams
    at random, so that none of a word's is needed to know it. Words and n-grams are gone through ``PIECE``
    at a time: beside the words as numbers, little memory is taken.
    """
    rng = np.random.default_rng(seed)
    known: dict[str, int] = {}
    numbers, lengths, label = array("i"), array("q"), array("q")
    for text, value in zip(texts, toxic):
        own = [known.setdefault(w, len(known)) for w in text.split()]
        if own:
            numbers.extend(own)
            lengths.append(len(own))
            label.append(value)
    words, lengths, label = np.frombuffer(numbers, np.int32), np.array(lengths), np.array(label)
    # passages: each text in windows, the last one shorter
    passages = -(-lengths // WINDOW)
    first_passage = np.cumsum(passages) - passages
    text_begins = np.cumsum(lengths) - lengths
    begins = np.arange(passages.sum()) - np.repeat(first_passage, passages)
    begins *= WINDOW
    begins += np.repeat(text_begins, passages)
    counts = np.diff(np.append(begins, len(words)))
    # the n-grams of the distinct words, without those of few texts
    grams, sizes = array("i"), array("q")
    for word in known:
        own = buckets(word)
        grams.extend(own)
        sizes.append(len(own))
    del known
    flat, sizes = np.frombuffer(grams, np.int32), np.array(sizes)
    n = len(sizes)
    word_of = np.repeat(np.arange(n, dtype=np.int32), sizes)
    texts_with = np.zeros(n, np.int64)  # of each word; at least as many of its n-grams
    for at, length in zip(text_begins.tolist(), lengths.tolist()):
        texts_with[np.unique(words[at:at + length])] += 1
    common = np.zeros(BUCKETS)
    for part in _pieces(len(flat)):
        np.add.at(common, flat[part], texts_with[word_of[part]])
    common = common >= MIN_TEXTS
    used = common[flat]
    flat, word_of = flat[used], word_of[used]
    del grams, used

    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    for part in _pieces(BUCKETS):
        vectors[part] = rng.normal(0, 0.05, (part.stop - part.start, DIMENSIONS)) * common[part, None]
    layer, bias = rng.normal(0, 0.5, (DIMENSIONS, 2)), np.zeros(2)
    weight = (0.5 / np.maximum(1, np.bincount(label, minlength=2)))[label]
    speed = [np.zeros_like(vectors), np.zeros_like(layer), np.zeros_like(bias)]
    by_passages = _spread(begins, len(words))
    step_of = np.zeros_like(vectors)
    margin = np.zeros(len(begins))
    for step in range(ROUNDS):
        sharp = min(20.0, 1.07 ** step)
        direction = layer[:, 1] - layer[:, 0]
        of_bucket, of_word = vectors @ direction, np.zeros(n)
        kept = np.zeros(len(flat), bool)
        for part in _pieces(len(flat)):
            np.less(rng.random(part.stop - part.start), 0.5, out=kept[part])
            np.add.at(of_word, word_of[part][kept[part]], of_bucket[flat[part][kept[part]]])
        of_word = 2 * of_word / sizes
        for some, part in by_passages:
            margin[some] = np.add.reduceat(of_word[words[part]], begins[some] - part.start) / counts[some]
        margin += bias[1]
        margin -= bias[0]
        top = np.maximum.reduceat(margin, first_passage)
        grown = np.exp(sharp * (margin - np.repeat(top, passages)))
        total = np.add.reduceat(grown, first_passage)
        chance = 1 / (1 + np.exp(-np.clip(top + np.log(total / passages) / sharp, -30, 30)))
        slope = weight * (chance - label)
        by_passage = np.repeat(slope / total, passages) * grown / counts
        by_word = np.zeros(n)
        for some, part in by_passages:
            np.add.at(by_word, words[part], np.repeat(by_passage[some], counts[some]))
        by_word /= sizes
        by_gram = np.zeros(BUCKETS)
        for part in _pieces(len(flat)):
            np.add.at(by_gram, flat[part][kept[part]], by_word[word_of[part][kept[part]]])
        pull = by_gram @ vectors
        np.multiply(by_gram[:, None], direction, out=step_of, casting="same_kind")
        grads = [step_of, np.stack([-pull, pull], axis=1), np.array([-slope.sum(), slope.sum()])]
        for p, g, s, most in zip((vectors, layer, bias), grads, speed, (RATE, 0.05, 0.1)):
            s *= 0.8
            s += 0.2 * g / max(np.abs(g).max(), 1e-9)
            p -= most * s
    return Model(vectors, layer, bias)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """At most ``PER_LABEL`` texts of each label, as lists on the driver."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").alias("labelled_"), F.col("toxic").alias("toxic_")).distinct()
    size = F.octet_length("text")
    there = docs.filter(size > 0).select("doc_id", (size > TRAIN_BYTES).alias("long_"))  # no texts are shuffled
    found = there.join(usable, F.col("doc_id") == F.col("labelled_")).select("labelled_", "toxic_", "long_", F.xxhash64("doc_id").alias("order_"))
    chosen = None
    for value in (0, 1):
        part = found.filter(F.col("toxic_") == value).orderBy("long_", "order_", "labelled_").limit(PER_LABEL)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = stored(chosen.distinct(), "sample")  # at most 2 * PER_LABEL rows
    step = F.ceil(size / F.lit(TRAIN_BYTES))
    thin = F.array_join(F.filter(F.split("text", r"\s+"), lambda word, i: F.floor(i / WINDOW) % step == 0), " ")
    text = F.when(step > 1, thin).otherwise(F.col("text")).alias("text_")
    own = docs.filter(size > 0).join(F.broadcast(chosen), (F.col("doc_id") == F.col("labelled_")) & ((size > TRAIN_BYTES) == F.col("long_")))
    rows = own.select(text, "toxic_", "order_").orderBy("order_", "toxic_", "text_").limit(2 * PER_LABEL).select("text_", "toxic_").toArrow()
    return rows.column(0).to_pylist(), rows.column(1).to_pylist()


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    texts, toxic = training_sample(docs, labels)
    return train(texts, toxic) if len(set(toxic)) == 2 else None


class TextScorer:
    """Scores of whole texts. Values of words are remembered in two generations, at most ``MEMO_WORDS`` in each unless a
    block has more; those that a block lacks are worked out together. Nothing depends on what is remembered."""

    def __init__(self, added: np.ndarray, bias: float):
        self.added, self.bias, self.young, self.old = added, bias, {}, {}

    def _values(self, words: list[str]) -> np.ndarray:
        values = np.empty(len(words))
        for at in range(0, len(words), BLOCK_WORDS):
            block = words[at:at + BLOCK_WORDS]
            distinct = set(block)
            if len(self.young) + len(distinct) > MEMO_WORDS:
                self.young, self.old = {}, self.young
            young, old = self.young, self.old
            young.update([(word, old[word]) for word in distinct if word in old])
            young.update(word_scores([word for word in distinct if word not in young], self.added))
            values[at:at + len(block)] = np.fromiter(map(young.__getitem__, block), np.float64, len(block))
        return values

    def _text(self, values: np.ndarray) -> float:
        if not len(values):
            return 0.0
        size = min(WINDOW, len(values))
        sums = np.concatenate([[0.0], np.cumsum(values)])
        best = (sums[size:] - sums[:-size]).max() / size + self.bias
        return float(1 / (1 + np.exp(-np.clip(best, -30, 30))))

    def _block(self, texts: list[list[str]]) -> list[float]:
        ends = np.cumsum([len(words) for words in texts])
        return [self._text(values) for values in np.split(self._values(list(chain.from_iterable(texts))), ends[:-1])]

    def scores(self, texts: Iterable[str]) -> list[float]:
        scores, held, words = [], [], 0
        for text in texts:
            held.append(text.split())
            words += len(held[-1])
            if words >= BLOCK_WORDS:
                scores += self._block(held)
                held, words = [], 0
        return scores + (self._block(held) if held else [])


def score(docs: DataFrame, model: Model | None, columns: list[str]) -> DataFrame:
    """``columns`` of all rows with ``score`` (0 to 1) of the whole text; a column ``score`` is replaced."""
    if model is None:
        return docs.select(*columns).withColumn("score", F.lit(0.0))
    added, bias = model.bucket_scores(), float(model.bias[1] - model.bias[0])
    columns = [c for c in columns if c != "score"]
    schema = docs.select(*columns).withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = TextScorer(added, bias)
        for batch in batches:
            scores = scorer.scores(text.as_py() for text in batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*columns, "score"])

    return docs.select(*columns, text_or_empty().alias("text_")).mapInArrow(run, schema)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
