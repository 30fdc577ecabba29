"""Memory and work of operators whose results other tests check."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from llm import bpe, toxicity

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_training_takes_little_beside_the_words(monkeypatch):
    rng = random.Random(5)
    known = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(known, k=2000)) for _ in range(300)]
    toxic = [k % 2 for k in range(300)]
    monkeypatch.setattr(toxicity, "ROUNDS", 2)
    tracemalloc.start()
    toxicity.train(texts, toxic)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45e6  # 600,000 words; of it 25 MB for buckets, whatever the words


def test_training_in_pieces_is_training_at_once(monkeypatch):
    rng = random.Random(6)
    known = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 7))) for _ in range(200)]
    texts = [" ".join(rng.choices(known, k=rng.randrange(40))) for _ in range(120)] + ["", " ", "one"]
    toxic = [int("ab" in t) for t in texts]
    monkeypatch.setattr(toxicity, "ROUNDS", 10)
    whole = toxicity.train(texts, toxic)
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, toxicity.train(texts, toxic)))


def test_bpe_makes_few_nodes_for_unlike_words():
    rng = random.Random(7)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(8, 30))) for _ in range(500)]
    encoder = bpe.TextEncoder(WORD)
    entries = [e for block in encoder.encode_block(words) for e in block]
    library = Tokenizer.from_file(WORD)
    assert [e[1] for e in entries] == [" ".join(map(str, library.encode(w, add_special_tokens=False).ids)) for w in words]
    prefixes = {w[:k] for w in words for k in range(1, len(w))}
    assert len(encoder.trie.nodes) < 0.75 * len(prefixes)


def test_bpe_of_words_about_the_longest_with_nodes():
    rng = random.Random(8)
    encoder, library = bpe.TextEncoder(WORD), Tokenizer.from_file(WORD)
    texts = ["".join(rng.choice("aehnst") for _ in range(bpe.LONG_WORD + d)) + end for d in (-2, -1, 0, 1, 2, 500) for end in ("", "é", "!,", "7", "中")]
    texts += ["e" * 30_000, "Straße.", "ÉTÉ,", "été's", "İx", "<|endoftext|>", "a<|endoftext|>b", ""]
    for text in texts:
        count, ids, tokens = encoder.encode_text(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert (count, ids, tokens) == (len(want), " ".join(map(str, want)), library.decode(want, skip_special_tokens=False))


def _odd_words() -> list[str]:
    rng = random.Random(9)
    signs = "abAZ019!$@.-éßİΣς中字𝒳\x00\x7f\x80߿ࠀ￿\U0010ffff"
    words = {"".join(rng.choice(signs) for _ in range(rng.randrange(1, 14))) for _ in range(3000)}
    words |= {"İx", "ΑΣ", "!!!", "$", "a", "<>", "1!", "ß", "x" * 3000, "中" * 2000 + "𝒳"}
    return sorted(w for w in words if w.split() == [w])


def test_toxicity_hashes_unlike_words_together(spark, monkeypatch):
    words, grams = _odd_words(), toxicity.buckets
    added = np.random.default_rng(3).normal(0, 1, toxicity.BUCKETS).astype(np.float32)
    model = toxicity.Model(np.outer(added, np.eye(toxicity.DIMENSIONS)[0]).astype(np.float32), np.eye(toxicity.DIMENSIONS, 2, 1), np.zeros(2))

    def one_by_one(word):
        raise AssertionError("n-grams of a single word")

    monkeypatch.setattr(toxicity, "buckets", one_by_one)  # on check_l, most of the time went there
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    want = [float(added[grams(w)].mean()) for w in words]
    assert [got[i] for i in range(len(words))] == [float(1 / (1 + np.exp(-np.clip(v + 0.0, -30, 30)))) for v in want]


def test_toxicity_of_blocks_is_that_of_single_words(monkeypatch):
    words = _odd_words()
    added = np.random.default_rng(4).normal(0, 1, toxicity.BUCKETS).astype(np.float32)
    value = {w: float(added[toxicity.buckets(w)].mean()) for w in words}
    assert toxicity.word_scores(words, added) == value
    rng = random.Random(10)
    lists = [rng.choices(words, k=rng.choice([0, 0, 1, 2, 4, 5, 6, 30, 700])) for _ in range(60)]

    def by_definition(own):
        if not own:
            return 0.0
        size = min(toxicity.WINDOW, len(own))
        best = max(sum(value[w] for w in own[i:i + size]) / size for i in range(len(own) - size + 1))
        return 1 / (1 + np.exp(-(best + 0.25)))

    for block, chars, memo in ((1 << 16, 1 << 17, 300_000), (40, 30, 50), (1, 1, 1)):
        monkeypatch.setattr(toxicity, "BLOCK_WORDS", block)
        monkeypatch.setattr(toxicity, "BLOCK_CHARS", chars)
        monkeypatch.setattr(toxicity, "MEMO_WORDS", memo)
        scorer = toxicity.TextScorer(added, 0.25)
        got = scorer.scores(" ".join(own) for own in lists) + scorer.scores([]) + scorer.scores([" ", "\n"])
        assert np.allclose(got, [by_definition(own) for own in lists] + [0.0, 0.0], rtol=0, atol=1e-9)
