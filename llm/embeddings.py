"""Near-duplicate vectors by lattice hashing.

In each of ``TABLES`` tables a vector of length 1 is projected onto ``BLOCKS`` random subspaces of
eight dimensions, and each projection is decoded to the nearest point of the E8 lattice; the points
together are its cell. It is filed in its own cell and looks into the ``PROBES`` cells whose lattice
points lie nearest to the projections, its own among them. Pairs that meet and agree in most of
their random signs are compared by cosine in double precision. Two vectors of cosine 0.9 miss each
other with a chance of about 1e-3, closer ones with far less; nothing is linked below 0.9.

Equal vectors are one class, filed once and counted as often as they occur. Cells are joined, not
gathered, so a crowded cell can be split. NULL, empty or zero vectors and those with NULL or
non-finite components are linked with nothing; vectors of different lengths are never linked. Rows
without vec_id are linked with nothing, their component is NULL and they are kept. Repeated rows are
vectors of their own. Other columns, labels too, are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.graph import components
from llm.minhash import mix
from llm.registry import query, stored, table

LEAST_COSINE = 0.9
TABLES, BLOCKS, PROBES = 15, 2, 9
#: Lattice units per unit of projection, and nearest lattice points considered in each block.
SCALE, NEAREST = 4.0, 6
#: Of 128 random signs a pair of cosine 0.9 differs in 18, with a deviation of 4; six deviations are allowed.
MOST_SIGNS = 42


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum: the worst-rounded coordinate goes the other way where the sum is odd."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: integers of even sum, or the same moved by one half everywhere."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1))[:, None], whole, half)


def shortest_vectors() -> np.ndarray:
    """The origin and the 240 lattice points nearest to it."""
    out = [np.zeros(8)]
    for i, j in itertools.combinations(range(8), 2):
        for signs in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = signs
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.stack(out)


def _fold(points: np.ndarray, seed: int) -> np.ndarray:
    """One 64-bit number for each lattice point (last axis)."""
    doubled = np.rint(points * 2).astype(np.int64).view(np.uint64)
    out = np.full(points.shape[:-1], seed, np.uint64)
    for k in range(points.shape[-1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + doubled[..., k])
    return out


def cells(unit: np.ndarray, probe: bool) -> Iterator[np.ndarray]:
    """For each table the keys (vectors x 1, or x PROBES, nearest first) of the cells to file or look in."""
    n, size = unit.shape
    rng = np.random.default_rng(size)
    around = shortest_vectors()
    for t in range(TABLES):
        folded, distance = None, None
        for b in range(BLOCKS):
            basis = np.linalg.qr(rng.normal(size=(max(size, 8), 8)))[0][:size]
            x = unit @ basis * (SCALE * np.sqrt(size / 64))
            base = decode_e8(x)
            if not probe:
                points, far = base[:, None, :], np.zeros((n, 1))
            else:
                d = ((x - base) ** 2).sum(axis=1)[:, None] - 2 * (x - base) @ around.T + (around ** 2).sum(axis=1)
                pick = np.argpartition(d, NEAREST, axis=1)[:, :NEAREST]
                points, far = base[:, None, :] + around[pick], np.take_along_axis(d, pick, axis=1)
            keys = _fold(points, 2 * t + b)
            if folded is None:
                folded, distance = keys, far
            else:
                folded = mix(folded[:, :, None] * np.uint64(0xD6E8FEB86659FD93) + keys[:, None, :]).reshape(n, -1)
                distance = (distance[:, :, None] + far[:, None, :]).reshape(n, -1)
        if probe:
            folded = np.take_along_axis(folded, np.argpartition(distance, PROBES, axis=1)[:, :PROBES], axis=1)
        yield folded.view(np.int64)


def _signs(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    planes = np.random.default_rng(1000 + unit.shape[1]).normal(size=(unit.shape[1], 128))
    packed = np.packbits(unit @ planes > 0, axis=1).view(np.int64)
    return packed[:, 0], packed[:, 1]


def _filed(classes: DataFrame, probe: bool) -> DataFrame:
    """(cell, id, s1, s2): where each vector is filed, or where it looks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids, vectors = batch.column(0).to_numpy(), batch.column(1)
                sizes = vectors.value_lengths().to_numpy()
                for size in np.unique(sizes):
                    mine = np.flatnonzero(sizes == size)
                    x = vectors.take(pa.array(mine)).flatten().to_numpy().astype(np.float64).reshape(-1, size)
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    s1, s2 = _signs(unit)
                    for keys in cells(unit, probe):
                        k = keys.shape[1]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.ravel()), pa.array(np.repeat(ids[mine], k)), pa.array(np.repeat(s1, k)), pa.array(np.repeat(s2, k))],
                            names=["cell", "id", "s1", "s2"])

    return classes.select("id", "embedding").mapInArrow(run, "cell long, id long, s1 long, s2 long")


def _confirmed(pairs: DataFrame) -> DataFrame:
    """(a, b) of the rows (a, b, x, y) whose vectors have the least cosine."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = batch.column(2), batch.column(3)
            sizes = x.value_lengths().to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for size in np.unique(sizes):
                rows = np.flatnonzero((sizes == size) & (y.value_lengths().to_numpy() == size))
                u, v = (c.take(pa.array(rows)).flatten().to_numpy().astype(np.float64).reshape(-1, size) for c in (x, y))
                u, v = (z / np.abs(z).max(axis=1, keepdims=True) for z in (u, v))
                cosine = (u * v).sum(axis=1) / np.sqrt((u * u).sum(axis=1) * (v * v).sum(axis=1))
                keep[rows] = cosine >= LEAST_COSINE
            yield batch.select([0, 1]).filter(pa.array(keep))

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    value = F.col("embedding")
    usable = F.coalesce(F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn("usable", usable & F.col("vec_id").isNotNull())
    classes = stored(rows.filter("usable").groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    filed, looking = _filed(classes, False), _filed(classes, True).toDF("cell", "id2", "t1", "t2")
    differ = F.bit_count(F.col("s1").bitwiseXOR(F.col("t1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("t2")))
    met = filed.join(looking, "cell").filter((F.col("id") != F.col("id2")) & (differ <= MOST_SIGNS))
    pairs = stored(met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct(), "pairs")
    each = classes.select("id", "embedding")
    links = stored(_confirmed(pairs.join(each.toDF("a", "x"), "a").join(each.toDF("b", "y"), "b")), "links")
    copies = classes.select("id", "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies.toDF("b", "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    found = stored(components(links), "components")
    known = (classes.join(others.withColumnRenamed("a", "id"), "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left")
             .select("embedding", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    linked = rows.filter("usable").join(known, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


@query("op3_embeddings")
def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
