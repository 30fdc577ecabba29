"""BPE encoding and decoding over a prefix-sharing trie.

The words of the documents share one trie of their prefixes, which a worker keeps between tasks, with one node for
each prefix that a word's encoding may begin with, found by the prefix itself. Its state is
the last token of the encoding of the prefix. A prefix has exactly one
such token: the suffix of it that is in the vocabulary and may stand behind the state of the node
where the suffix begins; a second trie, of the vocabulary read backwards, lists these suffixes. Nodes are made when a
suffix is tried behind them, so that most prefixes of a word need none, and each shared prefix
is encoded once, whatever hangs below it. A node also holds the tokens up to it, and a word's are those of one node
and a last one. The last symbol of a word carries the word-end mark, hence leaves are no nodes. Words of more than
``LONG_WORD`` symbols hardly share prefixes and get their states by themselves, in a list.

Texts are encoded whole and where they lie: no shuffle, and a lost task is simply run again.
NULL and empty texts have no tokens. Repeated rows give repeated results. Other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.registry import Memo, per_worker, query, table, text_or_empty

#: White space of the tokenizer's patterns (Unicode White_Space), a fixed value.
WHITE = regex.compile(r"[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: What ``str.split()`` takes for white space besides.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
BLOCK_ROWS = 256
LONG_WORD = 64
MEMO_CHUNKS = 200_000
MEMO_PIECES = 200_000
MEMO_PREFIXES = 300_000


class TrieEncoder:
    """Encodes words, given as strings over the byte alphabet, with one vocabulary of merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], word_end: str = ""):
        self.vocab, self.word_end = vocab, word_end
        self.rank: dict[int, int] = dict.fromkeys(vocab.values(), -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            self.joined.setdefault(pair, rank)
            if made not in self.parts:
                self.rank[made], self.parts[made] = rank, pair
        self.symbols = {i: len(t.removesuffix(word_end)) if word_end else len(t) for t, i in vocab.items()}
        self.text = {i: t for t, i in vocab.items()}
        self.id_text = {i: str(i) for i in self.text}
        self.fits: dict[tuple[int, int], bool] = {}
        self.nodes: dict[str, tuple[int, str, str, int]] = {}  # prefix -> count, ids and tokens of its encoding, state
        self.reached: dict[int, bool] = {}
        # the usable tokens from their last symbol on, those with the word-end mark apart; a token is under None
        self.inner: dict = {}
        self.final: dict = {} if word_end else self.inner
        for token, i in vocab.items():
            if self._reachable(i):
                whole = bool(word_end) and token.endswith(word_end)
                node = self.final if whole else self.inner
                for symbol in reversed(token.removesuffix(word_end) if whole else token):
                    node = node.setdefault(symbol, {})
                node[None] = i

    def _reachable(self, token: int) -> bool:
        """Whether merging the token's own symbols ends in the token."""
        if token not in self.reached:
            pair = self.parts.get(token)
            self.reached[token] = pair is None or (
                self._reachable(pair[0]) and self._reachable(pair[1]) and self._apart(*pair, self.rank[token]))
        return self.reached[token]

    def _apart(self, left: int, right: int, before: int | None = None) -> bool:
        """Whether no merge (of a rank under ``before``) crosses the border between two tokens.

        Both tokens are taken apart step by step, the one made last first; at each step the two
        symbols at the border stood side by side until the earlier of their next merges.
        """
        joined, rank, parts = self.joined, self.rank, self.parts
        limit = len(joined) + 1 if before is None else before
        while True:
            merge = joined.get((left, right))
            if merge is not None and merge < limit:
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:  # the left one was made last; until then a merge of a lower rank could cross
                limit, left = a, parts[left][1]
            else:  # of equal ranks the left one is made first, and so may the crossing one be
                limit, right = b + 1, parts[right][0]

    def _suffixes(self, word: str, end: int, suffixes: dict) -> list[tuple[int, int]]:
        """(start, token) of the tokens that end the first ``end`` symbols, shortest first."""
        found, start, node = [], end, suffixes
        while start:
            start -= 1
            node = node.get(word[start])
            if node is None:
                break
            if None in node:
                found.append((start, node[None]))
        return found

    def _fit(self, state: int, token: int) -> bool:
        pair = (state, token)
        ok = self.fits.get(pair)
        if ok is None:
            ok = self.fits[pair] = self._apart(state, token)
        return ok

    def _node(self, prefix: str, suffixes: dict) -> tuple[int, str, str, int]:
        """The node of a whole prefix: the longest suffix that fits, behind the node where it begins."""
        nodes, found = self.nodes, self._suffixes(prefix, len(prefix), suffixes)
        while found:
            start, token = found.pop()
            if start == 0:
                return 1, self.id_text[token], self.text[token], token
            left = prefix[:start]
            before = nodes.get(left)
            if before is None:
                before = nodes[left] = self._node(left, self.inner)
            if self._fit(before[3], token):
                return before[0] + 1, f"{before[1]} {self.id_text[token]}", f"{before[2]} {self.text[token]}", token
        raise ValueError(f"no token ends {prefix!r}")

    def _long(self, word: str) -> tuple[int, str, str]:
        """As ``entry``, with the states of the word's own prefixes in a list."""
        states, length = [-1], len(word)
        for end in range(1, length + 1):
            found = self._suffixes(word, end, self.final if end == length else self.inner)
            token = next((t for start, t in reversed(found) if start == 0 or self._fit(states[start], t)), None)
            if token is None:
                raise ValueError(f"no token ends {word[:end]!r}")
            states.append(token)
        ids, end = [], length
        while end:
            ids.append(states[end])
            end -= self.symbols[states[end]]
        ids.reverse()
        return len(ids), " ".join([self.id_text[i] for i in ids]), " ".join([self.text[i] for i in ids])

    def entry(self, word: str) -> tuple[int, str, str]:
        """Number, ids and names of a word's tokens, both joined by a space; no word is empty."""
        if len(self.nodes) > MEMO_PREFIXES:
            self.nodes.clear()
        if len(self.fits) > MEMO_PREFIXES:
            self.fits.clear()
        return self._long(word) if len(word) > LONG_WORD else self._node(word, self.final)[:3]


def byte_letters() -> dict[str, str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): chr(b) for b in printable} | {chr(b): chr(0x100 + k) for k, b in enumerate(others)}


class TextEncoder:
    """Texts to ids and back as the tokenizer file says; all results are kept per word as strings."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, tokenizer = spec["model"], Tokenizer.from_file(path)
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.pieces = tokenizer.pre_tokenizer.pre_tokenize_str
        self.trie = TrieEncoder(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                                                 for m in model["merges"]], model["end_of_word_suffix"] or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = self.trie.text | {i: t for t, i in self.added.items()}
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.memo = Memo(self._entry, MEMO_CHUNKS)
        self.words = Memo(self.trie.entry, MEMO_PIECES)
        pattern = next((p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"), None)
        self.latin = regex.compile(pattern).findall if pattern and r"\p{L}]+" in pattern and tokenizer.normalizer else None
        self.letters = str.maketrans(byte_letters())

    def _pieces(self, chunk: str) -> list[str]:
        """The words of a chunk over the byte alphabet. Latin text needs no help from the library."""
        if self.latin and (chunk.isascii() or max(chunk) < "\u0250"):
            low = chunk.lower()
            # most chunks are a word, or one with a mark behind it
            pieces = [low] if low.isalpha() else [low[:-1], low[-1]] if low[-1] in ".,;:!?" and low[:-1].isalpha() else self.latin(low)
            return pieces if chunk.isascii() and chunk.isprintable() else [p.encode().decode("latin-1").translate(self.letters) for p in pieces]
        return [p for p, _ in self.pieces(self.normalize(chunk)) if p]

    def _entry(self, chunk: str) -> tuple[int, str, str]:
        if chunk in self.added:
            return 1, str(self.added[chunk]), chunk
        parts = [self.words[p] for p in self._pieces(chunk)]
        if len(parts) == 1:
            return parts[0]
        return sum([x[0] for x in parts]), " ".join([x[1] for x in parts]), " ".join([x[2] for x in parts])

    def chunks(self, text: str) -> list[str]:
        """Parts of the text, cut at white space and added tokens, that are encoded on their own."""
        cut = WHITE.split if any(c in text for c in SEPARATORS) else str.split
        if "<|" not in text:
            return [c for c in cut(text) if c] if cut is not str.split else text.split()
        return [c for part in self.split_added.split(text) for c in ([part] if part in self.added else cut(part)) if c]

    def encode_text(self, text: str) -> tuple[int, str, str]:
        """Number, ids and names of a text's tokens, both joined by a space."""
        entries = list(map(self.memo.__getitem__, self.chunks(text)))
        if not entries:
            return 0, "", ""
        counts, ids, names = zip(*entries)
        return sum(counts), " ".join(ids), " ".join(names)

    def encode_block(self, texts: Iterable[str]) -> Iterator[list[tuple[int, str, str]]]:
        """For each text the entries (count, ids, tokens) of its chunks."""
        for text in texts:
            yield list(map(self.memo.__getitem__, self.chunks(text)))

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder, so a decoded text is its tokens joined by a space."""
        return " ".join([self.names[i] for i in ids])


def _encoder(path: str) -> TextEncoder:
    return per_worker(f"bpe:{path}", lambda: TextEncoder(path))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False) -> DataFrame:
    """(id, n_tokens, ids array, decoded text) of each document's whole text.

    ``digests`` gives SHA-256 of the ids (decimal, joined by a space) and of the decoded text
    instead of the values. NULL text: as an empty one, with no ids. NULL ids and repeated rows are
    passed through. Only the two named columns are read.
    """
    name = id_col
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{name}` {kind}, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                n, ids, decoded = [], [], []
                for count, line, text in map(encoder.encode_text, batch.column(1).to_pylist()):
                    n.append(count)
                    if digests:
                        ids.append(hashlib.sha256(line.encode()).hexdigest())
                        decoded.append(hashlib.sha256(text.encode()).hexdigest())
                    else:
                        ids.append([int(i) for i in line.split()])
                        decoded.append(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string() if digests else pa.list_(pa.int32())),
                     pa.array(decoded, pa.string())],
                    names=[name, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))])

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text_")).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the text of the ids. NULL ids give NULL."""
    @F.pandas_udf("string")
    def decode(column):
        encoder = _encoder(path)
        return column.map(lambda ids: None if ids is None else encoder.decode(ids))

    return rows.withColumn("decoded", decode(F.col(ids_col)))


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)
