"""Best-fit packing of token sequences by hierarchical residual packing.

Documents are tokenised where they lie and cut into pieces no longer than a sequence; only the first
piece of a cut document may be shorter. Full pieces are sequences of their own. The rest are dealt over
tasks of a bounded number of pieces, each with its share of every length however they were stored, and each task packs its own best-fit,
longest first. Nearly full bins are emitted; underfull bins go on as items and are merged as a tree: each
round deals them anew over fewer tasks, each of a bounded number of bins, so that bins of all fills
meet, and packs them best-fit again. Rounds go on until one lowers the number of bins by less than ``LEAST_GAIN``
of them, or by none where a single task holds all. What is underfull then is emitted as it is.

A bin has at most as many members as tokens, so rows are bounded. Each round is stored, hence a lost
task repeats one round at most. NULL text: an empty document, which is its end token alone. NULL
ids and repeated rows are packed like any other. Ties go to the bin made first. An empty table
gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.bpe import byte_letters
from llm.registry import per_worker, query, stored, table, text_or_empty

#: A bin with no more than this share of its capacity free is emitted at once.
NEARLY_FULL = 1 / 256
FAN_IN = 8
PIECES_PER_TASK = 20_000
BINS_PER_TASK = 10_000
LEAST_GAIN = 1 / 1000
BLOCK_ROWS = 256
#: How byte-level vocabularies of this kind cut a text, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = 20_000
RUN = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))


class ByteTokenizer:
    """Ids of whole texts, as the tokenizers library gives them, as little-endian uint32 bytes.

    The file's vocabulary is byte-level with ids in merge order, which tiktoken encodes several
    times faster to the same ids. Texts with the names of added tokens or with very long runs that
    no pattern cuts go to the library itself, and so does everything for files of another kind.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut, vocab = spec["pre_tokenizer"] or {}, spec["model"]["vocab"]
        plain = (spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
                 and sorted(vocab.values()) == list(range(len(vocab))))
        byte_of = {letter: ord(b) for b, letter in byte_letters().items()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in self.added} if plain else None
        self.fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if plain else None

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(a in text for a in self.added) or len(text) > LONG_RUN and RUN.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


def token_pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the pieces of each document with its end token."""
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = per_worker(f"pack:{path}", lambda: ByteTokenizer(path))
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, text in enumerate(batch.column(1)):
                    data = tokenizer.encode(text.as_py()) + end
                    n = len(data) // 4
                    cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(k)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(data[4 * a:4 * b]))
                        if keep_ids:
                            ids.append(np.frombuffer(data[4 * a:4 * b], "<u4").astype(np.int32))
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text_")).mapInArrow(
        run, schema + (", ids array<int>" if keep_ids else ""))


def best_fit(sizes: Iterable[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers, items taken longest first, each into the fullest bin with room for it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    sizes = np.asarray(sizes, np.int64)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        above = rooms >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[own].append(item)
        else:
            own, room = len(bins), capacity
            bins.append([item])
        by_room[room - size].append(own)
        if room > size:
            rooms |= 1 << (room - size)
    return bins


def _round(items: DataFrame, capacity: int, schema: str) -> DataFrame:
    """Each partition's items (fill, members) packed into bins (fill, members, offsets, open)."""
    spare = int(capacity * NEARLY_FULL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        table = pa.Table.from_batches(batches)
        fills = table.column("fill").to_numpy()
        members = table.column("members").combine_chunks()
        members = members.chunk(0) if isinstance(members, pa.ChunkedArray) else members
        bins = best_fit(fills, capacity)
        order = np.fromiter((i for b in bins for i in b), np.int64)
        taken = members.take(pa.array(order))
        counts = np.diff(taken.offsets.to_numpy())
        ends = np.cumsum([len(b) for b in bins])
        borders = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], ends])]
        rows = taken.flatten()
        lengths = rows.field("length").to_numpy()
        before = np.cumsum(lengths) - lengths
        offsets = before - np.repeat(before[borders[:-1]], np.diff(borders))
        fill = np.add.reduceat(lengths, borders[:-1])
        lists = pa.array(borders, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(fill, pa.int64()), pa.ListArray.from_arrays(lists, rows), pa.ListArray.from_arrays(lists, pa.array(offsets, pa.int64())),
             pa.array(capacity - fill > spare)], names=["fill", "members", "offsets", "open"])

    return items.select("fill", "members").mapInArrow(run, schema)


def _dealt(items: DataFrame, parts: int) -> DataFrame:
    """``items`` over ``parts`` tasks, each of which gets its share of the items of every size."""
    turn = (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) % parts).cast("int")
    return items.sortWithinPartitions("fill").withColumn("turn_", turn).repartitionById(parts, F.col("turn_")).drop("turn_")


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Stored ``pieces`` (any columns with a length of 1 to ``capacity``) with sequence_id and offset."""
    member = F.struct(*(F.col(c) for c in pieces.columns))
    kind = pieces.schema.simpleString().removeprefix("struct")
    schema = f"fill long, members array<struct{kind}>, offsets array<long>, open boolean"
    full = pieces.filter(F.col("length") == capacity).select(
        *pieces.columns, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = pieces.filter(F.col("length") < capacity).select(F.col("length").alias("fill"), F.array(member).alias("members"))
    count = items.count()
    parts, emitted = max(1, math.ceil(count / PIECES_PER_TASK)), []
    while True:
        bins = stored(_round(_dealt(items, parts), capacity, schema), "bins")
        made, left = bins.agg(F.count(F.lit(1)), F.count_if("open")).first()
        if left == 0 or made == count or parts > 1 and count - made < LEAST_GAIN * count:
            emitted.append(bins)
            break
        emitted.append(bins.filter("NOT open"))
        items, count = bins.filter("open").select("fill", "members"), left
        parts = max(math.ceil(parts / FAN_IN), math.ceil(left / BINS_PER_TASK))
    out = emitted[0]
    for more in emitted[1:]:
        out = out.unionByName(more)
    out = (out.withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).select("sequence_id", F.explode(F.arrays_zip("members", "offsets")).alias("m"))
           .select("m.members.*", "sequence_id", F.col("m.offsets").alias("offset")))
    return full.unionByName(out)


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    return pack(stored(token_pieces(docs, path, capacity, end_id, keep_ids=keep_ids), "pieces"), capacity)


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
