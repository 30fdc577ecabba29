"""Product codes of vectors, with LAESA pivots in place of full distance tables.

Components become integers, vectors are cut into equal parts, and each part position has a codebook
that a fixed number of rounds refines: every part goes to its nearest entry, entries become the floored
means of their parts. The distances of all parts to a few fixed pivots are worked out once and stored
beside the parts. In each round the distances of the pivots to the entries, some hundred numbers,
give lower bounds of all part-to-entry distances by the triangle inequality. A part tries its entries
in the order of their bounds and stops at the first bound above its best exact distance, so the result
is that of trying all: bounds are loosened by more than their rounding error, and the distances that
decide are exact integers.

What goes through the driver is the codebooks and their sums, whose size is fixed by the parameters.
Each task sums up its own rows; a lost task is run again from the stored parts.

Vectors that are NULL or hold NULL or non-finite components are left out. The kept row with the least
id (NULL ids last) fixes the number of components; vectors of another length, and all vectors if that
length cannot be cut into equal parts, are left out too. Integers are held to +-2**27, that is
components to +-32,768, so that a vector's error fits in a long; the sum over a label is NULL where it
does not. With fewer vectors than entries the codebooks are as short. Rows that repeat count as often as
they stand; rows of one id are taken in the order of their vectors. Ties go to the lower entry. An empty
table gives no rows. Columns other than the three named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.registry import query, stored, table

SCALE, BOUND = 4096, 1 << 27
PARTS, ENTRIES, ROUNDS, PIVOTS = 8, 16, 6, 4
BLOCK_ROWS = 4096
#: By which share of the two distances a lower bound is loosened; rounding is some 1e-16 of them.
SLACK = 1e-12


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def whole(x: np.ndarray) -> np.ndarray:
    """floor(4096 x) of components in double precision."""
    return np.clip(np.floor(x.astype(np.float64) * SCALE), -BOUND, BOUND).astype(np.int64)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to the rows of ``y``, or to all of them where y has an axis more."""
    diff = x - y
    return np.einsum("...i,...i->...", diff, diff)


def choose_pivots(book: np.ndarray, count: int) -> np.ndarray:
    """For each part position the first entry and then the entries farthest from those chosen."""
    out = []
    for entries in book:
        chosen = [0]
        least = _squares(entries, entries[0])
        while len(chosen) < min(count, len(entries)):
            chosen.append(int(least.argmax()))
            least = np.minimum(least, _squares(entries, entries[chosen[-1]]))
        out.append(entries[chosen])
    return np.array(out)


def pivot_distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(position, n, pivot): distances of ``points`` (position, n, component) to the pivots of their position."""
    return np.sqrt(_squares(points[:, :, None], pivots[:, None]).astype(np.float64))


def nearest(points: np.ndarray, near: np.ndarray, entries: np.ndarray, entry_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance, exact evaluations) of each point of one position, the lower of equally near entries.

    ``near`` (n, pivot) and ``entry_near`` (entry, pivot) are the distances to the pivots.
    """
    a, b = near[:, None], entry_near[None]
    bound = np.maximum(np.abs(a - b) - SLACK * (a + b), 0.0).max(axis=2)
    order = bound.argsort(axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    active, evaluated = np.arange(len(points)), 0
    best, code = np.full(len(points), np.iinfo(np.int64).max), np.zeros(len(points), np.int64)
    for rank in range(len(entries)):
        if rank:
            active = active[bound[active, rank] ** 2 <= best[active] * (1 + SLACK)]
            if not len(active):
                break
        tried = order[active, rank]
        found = _squares(points[active], entries[tried])
        evaluated += len(active)
        won = (found < best[active]) | (found == best[active]) & (tried < code[active])
        best[active[won]], code[active[won]] = found[won], tried[won]
    return code, best, evaluated


def _assign(batch: pa.RecordBatch, dim: int, book: np.ndarray, entry_near: np.ndarray) -> Iterator[tuple]:
    """Blocks of (first row, points, codes, squared distances) of a batch with columns ``ints`` and ``near``."""
    parts = len(book)
    ints, near = _matrix(batch.column("ints"), dim), _matrix(batch.column("near"), parts * entry_near.shape[2])
    for at in range(0, len(ints), BLOCK_ROWS):
        points = ints[at:at + BLOCK_ROWS].astype(np.int64).reshape(-1, parts, dim // parts).swapaxes(0, 1)
        own = near[at:at + BLOCK_ROWS].reshape(-1, parts, entry_near.shape[2]).swapaxes(0, 1)
        found = [nearest(p, n, e, en)[:2] for p, n, e, en in zip(points, own, book, entry_near)]
        yield at, points, np.array([c for c, _ in found]), np.array([d for _, d in found])


def _sums(points: DataFrame, dim: int, book: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(part, entry, place, total, n): the sums of the parts assigned to each entry; place -1 has no total."""
    parts, entries, width = book.shape
    entry_near = pivot_distances(book, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(book.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, block, codes, _ in _assign(batch, dim, book, entry_near):
                for p in range(parts):
                    count[p] += np.bincount(codes[p], minlength=entries)
                    np.add.at(total[p], codes[p], block[p])
        part, entry, place = np.indices(book.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.ravel().astype(t)) for x, t in ((part, np.int32), (entry, np.int32), (place, np.int32), (total, np.int64),
                                                         (np.repeat(count[:, :, None], width, axis=2), np.int64))],
            names=["part", "entry", "place", "total", "n"])

    return (points.select("ints", "near").mapInArrow(run, "part int, entry int, place int, total long, n long")
            .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))


def refine(points: DataFrame, dim: int, book: np.ndarray, pivots: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after ``rounds`` rounds; a round that changes nothing is the last, since all later ones would not either."""
    for _ in range(rounds):
        new = book.copy()
        for r in _sums(points, dim, book, pivots).filter("n > 0").collect():  # as many numbers as the codebooks have
            new[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
        if (new == book).all():
            break
        book = new
    return book


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivot_count: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """One row per kept vector (id, label, code, error), and the codebooks (part, entry, component)."""
    kind = vectors.select(F.col(id_col).alias("id_"), F.col(label_col).alias("label_")).schema
    kept = vectors.select(F.col(id_col).alias("id_"), F.col(label_col).alias("label_"), F.col(vector_col).cast("array<double>").alias("v_"))
    kept = kept.filter(F.col("v_").isNotNull() & F.forall("v_", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    order = [F.col("id_").asc_nulls_last(), F.col("v_")]
    first = kept.orderBy(*order).limit(1).collect()
    dim = len(first[0]["v_"]) if first else 0
    out_schema = f"id_ {kind['id_'].dataType.simpleString()}, label_ {kind['label_'].dataType.simpleString()}, code string, error long"
    if not dim or dim % parts:
        return vectors.sparkSession.createDataFrame([], out_schema), np.zeros((parts, 0, dim // parts), np.int64)
    kept = kept.filter(F.size("v_") == dim)
    seeds = np.array([r["v_"] for r in kept.orderBy(*order).limit(entries).select("v_").collect()])
    book = whole(seeds).reshape(len(seeds), parts, dim // parts).swapaxes(0, 1)
    pivots = choose_pivots(book, pivot_count)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, BLOCK_ROWS):
                batch = big.slice(at, BLOCK_ROWS)
                ints = whole(_matrix(batch.column(2), dim))
                near = pivot_distances(ints.reshape(-1, parts, dim // parts).swapaxes(0, 1), pivots).swapaxes(0, 1)
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), lists(ints.astype(np.int32)), lists(near.reshape(len(ints), -1))],
                    names=["id_", "label_", "ints", "near"])

    points = stored(kept.mapInArrow(measure, f"id_ {kind['id_'].dataType.simpleString()}, label_ {kind['label_'].dataType.simpleString()}, "
                                             "ints array<int>, near array<double>"), "points")
    book = refine(points, dim, book, pivots, rounds)
    entry_near = pivot_distances(book, pivots)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block, codes, squares in _assign(batch, dim, book, entry_near):
                rows = batch.slice(at, block.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array([bytes(c).hex() for c in codes.T.astype(np.uint8)], pa.string()), pa.array(squares.sum(axis=0))],
                    names=["id_", "label_", "code", "error"])

    return points.mapInArrow(encode, out_schema), book


def codebooks_sha256(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def _oracle() -> str:
    square = "+".join(f"(x[{i}]-e[{i}])*(x[{i}]-e[{i}])" for i in range(1, 9))
    means = ",".join(f"floor(sum(x[{i}])::DOUBLE/count(*))::BIGINT" for i in range(1, 9))
    near = "SELECT rid, parts.p, x, min([{0}, k]) AS best FROM parts JOIN {1} USING (p) GROUP BY ALL"
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda c: floor(4096 * c::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
parts AS MATERIALIZED (SELECT rid, p, v[8*p+1:8*p+8] AS x FROM kept, range(8) AS r(p)),
book0 AS MATERIALIZED (SELECT p, rid - 1 AS k, x AS e FROM parts WHERE rid <= {ENTRIES})"""]
    for r in range(ROUNDS):
        steps.append(f"near{r} AS MATERIALIZED ({near.format(square, f'book{r}')})")
        steps.append(f"mean{r} AS (SELECT p, best[2] AS k, [{means}] AS e FROM near{r} GROUP BY ALL)")
        steps.append(f"book{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(m.e, b.e) AS e FROM book{r} b LEFT JOIN mean{r} m USING (p, k))")
    steps.append(f"last AS ({near.format(square, f'book{ROUNDS}')})")
    steps.append("coded AS (SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM last GROUP BY rid)")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (rid)"""


@query("op12_veccodes", _oracle())
def op12_veccodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, book = compress(table(spark, sf_dir, "embeddings"))
    coded = stored(coded, "codes")
    by_label = coded.groupBy(F.col("label_").alias("same_")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label_").eqNullSafe(F.col("same_"))).select(
        F.col("id_").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_sha256(book)).alias("codebooks_sha256"))
