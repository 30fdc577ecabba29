r"""Importance resampling toward a target distribution, on hashed features with a position-table CRC.

A feature is a run of words joined by one space; its bucket is the CRC-32 of its bytes. The CRC is
linear: but for a constant that its length decides, it is the XOR of what each byte adds, and that depends
on the byte and its distance from the end alone. So a table of bytes by distances gives the contributions
of all bytes of all features of a block of texts at once, and ``bitwise_xor.reduceat`` over the spans
of the features adds them up. Spans longer than the table are cut into blocks from their end, and the
blocks' sums are folded, each shifted by the bytes behind it.

Features of the documents and of the target are counted per bucket; a bucket's gain is the log of the
ratio of its smoothed shares. A document's weight is the floored mean gain of its features. Gumbel noise
from a hash of its id makes the highest scores a draw without replacement in proportion to the
weights. All counts cover all rows; what meets on the driver is one number per bucket.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` with A-Z as a-z. NULL and empty texts have no words and a weight of 0.
A NULL id is hashed as an empty one and loses ties. Rows that repeat are scored alike and ranked one after the other.
An empty target makes all buckets alike but for smoothing; an empty table gives no rows. Columns other than
the named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.registry import query, stored, table, text_or_empty

BUCKETS, LONGEST_RUN = 10_000, 1
MIN_WORDS, PERCENT, SEED = 20, 10, 2024
#: Distances from the end that the table covers; longer spans are folded from blocks of as many bytes.
DEPTH = 64
BLOCK_BYTES = 1 << 21
#: Reflected polynomial of CRC-32, a fixed value.
POLYNOMIAL = 0xEDB88320

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)
IS_WORD = (_BYTES >= 0x80) | (_BYTES >= 0x30) & (_BYTES <= 0x39) | (_BYTES >= 0x61) & (_BYTES <= 0x7A)


@lru_cache(1)
def crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position table by distance and byte, shift by ``DEPTH`` bytes by register byte and value, constants by length)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(POLYNOMIAL), step >> 1).astype(np.uint32)
    after = lambda register: step[register & 255] ^ register >> 8  # noqa: E731  one zero byte more
    place = np.empty((DEPTH, 256), np.uint32)
    place[0] = step
    for d in range(1, DEPTH):
        place[d] = after(place[d - 1])
    shift = np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(DEPTH):
        shift = after(shift)
    start = np.full(DEPTH + 1, 0xFFFFFFFF, np.uint32)
    for n in range(1, DEPTH + 1):
        start[n] = after(start[n - 1])
    return place, shift, start


def _shifted(register: np.ndarray, shift: np.ndarray) -> np.ndarray:
    return shift[0][register & 255] ^ shift[1][register >> 8 & 255] ^ shift[2][register >> 16 & 255] ^ shift[3][register >> 24]


def _contributions(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of the contributions of the bytes of each span of 1 to ``DEPTH`` bytes."""
    place, _, _ = crc_tables()
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)
    return np.bitwise_xor.reduceat(place[np.repeat(ends - 1, lengths) - at, data[at]], first)


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans (none of them empty) of the bytes ``data``; spans may overlap."""
    out = np.empty(len(starts), np.uint32)
    if not len(starts):
        return out
    _, shift, start = crc_tables()
    lengths = ends - starts
    short = lengths <= DEPTH
    if short.any():
        out[short] = _contributions(data, starts[short], ends[short]) ^ start[lengths[short]]
    if not short.all():
        own_starts, own_ends = starts[~short], ends[~short]
        blocks = -(-(own_ends - own_starts) // DEPTH)
        head = own_ends - own_starts - (blocks - 1) * DEPTH  # bytes of the block farthest from the end
        register = _contributions(data, own_starts, own_starts + head) ^ start[head]
        more = np.flatnonzero(blocks > 1)
        for k in range(1, int(blocks.max())):
            more = more[blocks[more] > k]
            begin = own_starts[more] + head[more] + (k - 1) * DEPTH
            register[more] = _shifted(register[more], shift) ^ _contributions(data, begin, begin + DEPTH)
        out[~short] = register
    return out ^ np.uint32(0xFFFFFFFF)


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, offsets, bytes) of runs of texts of about ``BLOCK_BYTES``, one whole text at least."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1)
        last = min(last, len(texts))
        yield row, last - row, offsets[row:last + 1] - offsets[row], data[offsets[row]:offsets[last]]
        row = last


def features(offsets: np.ndarray, data: np.ndarray, longest_run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, crc) of every feature of the texts at ``offsets``, and the number of words of each text."""
    data = LOWER[data]
    word = IS_WORD[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    apart = np.concatenate([[True], ~word]) | border
    starts = np.flatnonzero(word & apart[:-1])
    ends = np.flatnonzero(word & (np.concatenate([~word[1:], [True]]) | border[1:])) + 1 if len(word) else starts
    text = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(text, minlength=len(offsets) - 1)
    if longest_run > 1 and len(starts):  # the same words joined by one space
        lengths = ends - starts
        at = np.cumsum(lengths + 1) - lengths - 1
        joined = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
        inside = np.arange(int(lengths.sum())) + np.repeat(at - (np.cumsum(lengths) - lengths), lengths)
        joined[inside] = data[word]
        data, starts, ends = joined, at, at + lengths
    of, crc = [], []
    for n in range(1, longest_run + 1):
        first = np.flatnonzero(text[:len(text) - n + 1] == text[n - 1:]) if len(text) >= n else np.empty(0, np.int64)
        of.append(text[first])
        crc.append(span_crcs(data, starts[first], ends[first + n - 1]))
    return np.concatenate(of), np.concatenate(crc), counts


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest_run: int = LONGEST_RUN) -> DataFrame:
    """(bucket, n): how many features of all texts lie in each bucket, without empty buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, offsets, data in _blocks(batch.column(0)):
                total += np.bincount(features(offsets, data, longest_run)[1] % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    return texts.select(text_or_empty(text_col).alias("text_")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest_run: int = LONGEST_RUN) -> np.ndarray:
    """Gain of each bucket, in thousandths."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, rows in ((s, docs), (t, target)):
        for r in bucket_counts(rows, text_col, buckets, longest_run).collect():  # one number per bucket at most
            counts[r["bucket"]] = r["n"]
    source, wanted = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * source / ((a + 1.0) * wanted))) for a, b in zip(s.tolist(), t.tolist())])


def noise(id_column: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id, in thousandths and floored."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest_run: int = LONGEST_RUN) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, rows, offsets, data in _blocks(batch.column(1)):
                text, crc, words = features(offsets, data, longest_run)
                n = np.bincount(text, minlength=rows)
                total = np.zeros(rows, np.int64)
                np.add.at(total, text, gain[crc % np.uint32(buckets)])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, rows), *(pa.array(x, pa.int64()) for x in (words, n, weight))],
                    names=["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text_")).mapInArrow(
        run, f"doc_id {kind}, n_words long, n_features long, weight long")


def rank_draw(scored: DataFrame, drawn: Column, share: int, by: list[Column]) -> DataFrame:
    """``scored`` with ``rank``: of the rows where ``drawn`` holds, the first ``share`` per cent in the order ``by`` from 1 on.

    The rows are sorted across partitions, each notes its place in its own, and the partitions' sizes,
    one number for each, are summed up; no task holds more than a partition.
    """
    ordered = scored.withColumn("in_", drawn).orderBy(F.col("in_").desc(), *by).withColumn("place_", F.monotonically_increasing_id())
    kept = stored(ordered.withColumn("part_", F.shiftright("place_", 33)), "ranked")
    parts = kept.groupBy("part_").agg(F.count(F.lit(1)).alias("rows_"), F.count_if("in_").alias("eligible_"))
    before = parts.select(F.col("part_").alias("own_"), F.coalesce(F.sum("rows_").over(
        Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_"))
    eligible = parts.agg(F.coalesce(F.sum("eligible_"), F.lit(0))).first()[0]
    number = F.col("before_") + F.col("place_").bitwiseAND((1 << 33) - 1) + 1
    return (kept.join(before, F.col("part_") == F.col("own_"))
            .withColumn("rank", F.when(F.col("in_") & (number <= share * eligible // 100), number))
            .drop("in_", "place_", "part_", "own_", "before_"))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest_run: int = LONGEST_RUN, min_words: int = MIN_WORDS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text); ``rank`` is NULL for rows not drawn."""
    scored = weigh(docs, gains(docs, target, buckets=buckets, longest_run=longest_run), longest_run=longest_run)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return rank_draw(scored, F.col("n_words") >= min_words, percent, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_words")])


ORACLE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
dw AS MATERIALIZED (SELECT rid, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM d),
bw AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
tab AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
word_bytes AS (
  SELECT word, list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT) AS bytes
  FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
crcs AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM word_bytes, tab),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN crcs USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN crcs USING (word) GROUP BY bucket),
gain AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM crcs) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
scored AS (
  SELECT rid, doc_id, count(word) AS n, coalesce(floor(sum(gain)::DOUBLE / nullif(count(word), 0)), 0)::BIGINT AS weight
  FROM d LEFT JOIN dw USING (rid) LEFT JOIN crcs USING (word) LEFT JOIN gain USING (bucket) GROUP BY rid, doc_id),
full_score AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST, n) AS place, count(*) FILTER (n >= 20) OVER () AS eligible FROM full_score)
SELECT doc_id, n AS n_features, weight, score, CASE WHEN n >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank FROM placed"""


@query("op11_resampling", ORACLE)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
