"""The operators of llm against brute force on small, awkward tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import bpe, chat, embeddings, graph, minhash, packing, quality, sharding, substring, toxicity, warc

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "aab cde\n\t'stéΣİ\x1c 　中\U0001f44d12²!?.<|endoftext|>"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, size=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(50))) for _ in range(300)]
    return texts + ["", "   ", "x<|endoftext|>y <|startoftext|>", "a" * 3000, "don't " * 500, "!" * 70]


def test_bpe_is_the_librarys(spark, odd_texts):
    library = Tokenizer.from_file(WORD)
    rows = list(enumerate([*odd_texts, None])) + [(None, "twice"), (0, "twice")]
    got = rows_of(bpe.encode_documents(docs_of(spark, rows), WORD))
    want = [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(i), w) for (i, _), w in zip(rows, want))
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) and r["n_tokens"] == len(r["ids"]) for r in got)
    again = bpe.decode_ids(bpe.encode_documents(docs_of(spark, rows), WORD).drop("decoded"), WORD)
    assert sorted(r["decoded"] for r in rows_of(again)) == sorted(r["decoded"] for r in got)


def test_bpe_merges_of_repeated_letters():
    encoder, library = bpe.TextEncoder(WORD), Tokenizer.from_file(WORD)
    texts = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 30)] + ["haha" * 9, "mississippi", "=-" * 20]
    for text, entries in zip(texts, encoder.encode_block(texts)):
        assert " ".join(e[1] for e in entries) == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))


def test_byte_ids_are_the_librarys(odd_texts):
    tokenizer = packing.ByteTokenizer(BYTE)
    assert tokenizer.fast
    for text in [*odd_texts, " " * 30_000 + "a", "b" * 30_000]:
        assert tokenizer.encode(text) == np.array(tokenizer.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing_round_trip(spark):
    rows = [(i, " ".join(words(i, 1 + (i * 37) % 900))) for i in range(80)] + [(500, "long " * 5000), (501, None), (502, ""), (None, "x")]
    library = Tokenizer.from_file(BYTE)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    got = rows_of(packing.pack_documents(docs_of(spark, rows).repartition(7), BYTE, keep_ids=True))
    for i, want in ids.items():
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [x for r in own for x in r["ids"]] == want and [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["length"] == 1024 for r in own[1:]) and (len(own) == 1 or len(want) > 1024)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["start"] == sum(x["length"] for x in own[:k])
                   for k, r in enumerate(own))
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= math.ceil(sum(map(len, ids.values())) / 1024) + 4
    assert packing.pack_documents(docs_of(spark, []), BYTE).count() == 0


def test_best_fit_takes_the_fullest_bin():
    bins = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert sorted(map(sorted, bins)) == [[0, 2], [1, 3, 4]]


def test_chat_keeps_maximal_conversations(spark):
    a = [("user", "hi"), ("assistant", "yes"), ("user", "more")]
    chats = {1: a[:1], 2: a[:2], 3: a, 4: a, 5: [("user", "hi"), ("assistant", "no")], 6: [(None, None)], 7: [("user", "")], None: a[:2]}
    rows = [(c, k, r, t, "x") for c, turns in chats.items() for k, (r, t) in enumerate(turns)] + [(3, 0, "user", "hi", "y")]
    got = {r["conv_id"]: r for r in rows_of(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, h1 string")))}
    assert set(got) == {3, 5, 6, 7}
    assert (got[3]["n_turns"], got[3]["n_copies"]) == (3, 2) and got[6]["text"] == "<|im_start|>user\n<|im_end|>\n"
    assert got[5]["text"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nno<|im_end|>\n"
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x
    for x, y in links:
        if x is not None and x != y:
            x, y = root(x), root(y)
            label[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in rows_of(graph.components(spark.createDataFrame(links, "a long, b long")))}
    assert got == {x: root(x) for x in label}


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for k in range(40):  # chains of near vectors, some beyond the border
        v = base[k % 10] / np.linalg.norm(base[k % 10])
        noise = rng.normal(size=64)
        noise -= noise @ v * v
        noise /= np.linalg.norm(noise)
        c = rng.uniform(0.85, 0.999)
        rows.append((100 + k, ((c * v + math.sqrt(1 - c * c) * noise) * rng.uniform(0.1, 9)).tolist()))
    rows += [(200, base[0].tolist()), (201, base[0].tolist()), (202, None), (203, [0.0] * 64), (204, [float("nan")] * 64), (205, []),
             (206, [None] + [1.0] * 63), (207, base[0][:32].tolist()), (None, base[0].tolist())]
    got = {r["vec_id"]: r for r in rows_of(embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))}
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i is not None and v and len(v) == 64 and None not in v and np.isfinite(v).all() and any(v)}
    near = {i: {j for j in good if j != i and good[i] @ good[j] >= 0.9} for i in good}
    for i in got:
        assert got[i]["n_links"] == len(near.get(i, ()))
        reach, todo = {i}, [i]
        while todo:
            new = near.get(todo.pop(), set()) - reach
            reach |= new
            todo += new
        assert got[i]["component_id"] == (min(reach) if i is not None else None) and got[i]["kept"] == (i is None or i == min(reach))
    assert len(got) == len(rows) and embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 8)) * 2
    points = embeddings.decode_e8(x)
    around = embeddings.shortest_vectors()
    assert len(around) == 241
    best = ((x[:, None] - points[:, None] - around[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (best == 0).all()


def brute_components(sets):
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_components(spark, size):
    rng = random.Random(size)
    base = words(9, 150)
    rows = [(i, " ".join(words(i, 60))) for i in range(20)]
    for k in range(60):  # copies of one text with more and more changes
        copy = list(base)
        for _ in range(rng.randrange(14)):
            copy[rng.randrange(150)] = f"x{rng.randrange(30)}"
        rows.append((100 + k, " ".join(copy).upper() if k % 2 else "\t".join(copy)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "ONE"), (305, "two"), (306, rows[0][1]), (306, rows[0][1])]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    want = brute_components(sets)
    got = rows_of(minhash.near_duplicates(docs_of(spark, [*rows, (None, rows[0][1])]), size))
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"]) == (want[r["doc_id"]], len(sets[r["doc_id"]])) and r["kept"] == (r["doc_id"] == want[r["doc_id"]])
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_quality(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(i, 60 + i % 50, 5000)), ["en", "de", None][i % 3], ["a", None][i % 2], None) for i in range(400)]
    rows += [(1000 + i, " ".join(w + rng.choice(["###", "$$$"]) for w in words(i, 90, 5000)), "en", "a", None) for i in range(20)]
    rows += [(2000, None, "en", "a", None), (2001, "", "en", "a", None), (2002, "again " * 80, "en", "a", None),
             (2003, "lé x\nlé x\n\x0b\n\nlé x", "fr", "b", None), (None, rows[0][1], "en", "a", None)]
    got = {r["doc_id"]: r for r in rows_of(quality.judge(spark.createDataFrame(rows, DOCS)))}
    assert all(got[i]["kept"] for i in range(400)) and not any(got[1000 + i]["kept"] or got[1000 + i]["base_failed"] for i in range(20))
    assert not got[2000]["kept"] and got[2001]["n_words"] == 0 and got[2002]["n_repeat_words"] == 80 and got[2002]["base_failed"]
    one = got[2003]
    assert (one["n_words"], one["word_chars"], one["n_dup_lines"], one["n_repeat_words"], one["n_symbols"]) == (6, 9, 2, 6, 0)
    assert got[None]["kept"] and quality.judge(spark.createDataFrame([], DOCS)).count() == 0


def test_quality_rejects_repetition_below_the_base_limit(spark):
    rows = [(i, " ".join(words(i, 60 + i % 50, 5000)), "en", "a", None) for i in range(200)]
    for k in range(5):
        lines = [" ".join(words(300 + 20 * k + j, 5, 5000)) for j in range(20)]
        rows.append((1000 + k, "\n".join(lines[:3] * 2 + lines[3:17]), "en", "a", None))  # 30 of 100 words in repeated lines
        rows.append((1100 + k, " ".join(words(500 + k, 70, 5000) + 10 * words(600 + k, 4, 5000)), "en", "a", None))
    got = {r["doc_id"]: r for r in rows_of(quality.judge(spark.createDataFrame(rows, DOCS)))}
    assert all(got[i]["kept"] for i in range(200))
    assert not any(r["base_failed"] or r["kept"] for i, r in got.items() if i >= 1000)


@pytest.mark.parametrize("copies", [True, False])
def test_quality_rejects_junk_of_a_third_of_a_group(spark, copies):
    rows = [(i, " ".join(words(i, 60 + i % 50, 5000)), "en", "a", None) for i in range(200)]
    for k in range(100):  # copies of one text, or texts that differ by a few words
        junk = [w + "###" for w in words(900, 80, 5000)] + ([] if copies else words(1000 + k, 1 + k % 7, 5000))
        rows.append((1000 + k, " ".join(junk), "en", "a", None))
    got = {r["doc_id"]: r for r in rows_of(quality.judge(spark.createDataFrame(rows, DOCS)))}
    assert all(got[i]["kept"] for i in range(200))
    assert not any(got[1000 + k]["kept"] or got[1000 + k]["base_failed"] for k in range(100))


def test_toxicity_learns_prefixes_and_spellings(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        w = words(i, 40, 3000)
        toxic = i % 3 == 0
        if toxic:
            w[rng.randrange(40)] = rng.choice(["stupid", "moron", "zorgat"]) + rng.choice(["", ".", "s", "er"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (None, "fine words"), (902, "w1 w2 m0rons w3 w4 w5 w6"), (902, "w1 w2 m0rons w3 w4 w5 w6")]
    docs = docs_of(spark, rows)
    model = toxicity.learn(docs, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int"))
    got = rows_of(toxicity.score(docs, model, ["doc_id", "lang"]))
    out = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = sum((r["score"] >= toxicity.THRESHOLD) == (r["doc_id"] % 3 == 0) for r in out)
    assert right >= 0.97 * len(out) and len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in got) and all(r["score"] == 0 for r in got if r["doc_id"] in (900, 901))
    assert all(r["score"] >= toxicity.THRESHOLD for r in got if r["doc_id"] == 902)
    assert toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None
    assert {r["score"] for r in rows_of(toxicity.score(docs, None, ["doc_id"]))} == {0.0}


def test_substring_passages(spark):
    passage, fuzzy = words(1, 80, 9000), words(1, 80, 9000)
    for k in (20, 45, 70):
        fuzzy[k] = "changed"
    rows = [(i, " ".join(words(100 + i, 200, 90_000))) for i in range(8)]
    rows += [(20, " ".join(words(20, 70, 90_000) + passage + words(21, 30, 90_000))), (21, " ".join(words(22, 10, 90_000) + passage)),
             (22, " ".join(fuzzy + words(23, 90, 90_000))), (23, " ".join(words(24, 60, 90_000) + passage[:30])), (30, rows[0][1].upper()),
             (40, None), (41, ""), (None, " ".join(passage)), (21, " ".join(words(22, 10, 90_000) + passage))]
    docs = docs_of(spark, rows)
    got = {(r["doc_id"], r["source_id"]): r for r in rows_of(substring.shared_passages(docs))}
    assert set(got) == {(21, 20), (22, 20), (30, 0)}
    assert (got[21, 20]["start"], got[21, 20]["end"], got[21, 20]["source_start"], got[21, 20]["agreed"]) == (10, 90, 70, 80)
    assert (got[22, 20]["start"], got[22, 20]["end"], got[22, 20]["agreed"]) == (0, 80, 77)
    cut = {r["doc_id"]: r["text"] for r in rows_of(substring.remove_passages(docs, substring.shared_passages(docs)))}
    assert cut[21] == " ".join(words(22, 10, 90_000)) and cut[22].split() == words(23, 90, 90_000) and cut[30] == "" and cut[20] == dict(rows)[20]
    assert cut[40] is None and cut[None] == " ".join(passage)
    assert substring.shared_passages(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("size,between", [(60, 50), (60, 100), (100, 50), (100, 100), (100, 300)])
def test_substring_splits_chains(spark, size, between):
    a, b = words(31, size, 90_000), words(32, size, 90_000)
    rows = [(k, " ".join(words(40 + k, 30, 90_000) + a + words(50 + k, between, 90_000) + b + words(60 + k, 30, 90_000))) for k in (0, 1)]
    got = sorted((r["start"], r["end"], r["source_start"], r["agreed"]) for r in rows_of(substring.shared_passages(docs_of(spark, rows))))
    second = 30 + size + between
    assert got == [(30, 30 + size, 30, size), (second, second + size, second, size)]


def test_substring_splits_at_an_insertion(spark):
    a = words(33, 200, 90_000)
    rows = [(0, " ".join(a)), (1, " ".join(a[:90] + words(34, 80, 90_000) + a[90:]))]
    got = sorted((r["start"], r["end"], r["source_start"], r["source_end"]) for r in rows_of(substring.shared_passages(docs_of(spark, rows))))
    assert got == [(0, 90, 0, 90), (170, 280, 90, 200)]


def test_chain_prefers_order_and_pays_gaps():
    p, c = np.array([0, 10, 20, 30, 40, 300]), np.array([100, 110, 500, 130, 140, 400])
    best = substring.chain(p, c)
    assert best[0] == [0, 1, 3, 4] and sorted(map(tuple, best[1:])) == [(2,), (5,)]
    assert substring.common_words(list("abcde"), list("xbxde")) == 3 and substring.common_words([], [1]) == 0


def test_warc_round_trip(spark, tmp_path):
    big = "<p>\r\n\r\nWARC/1.1 é</p>" * 20
    rows = [(3, "http://a/x", big), (1, "http://b/y z", big), (2, None, big), (4, "http://c", "small"), (5, "http://d", "small"),
            (6, "http://e", None), (7, "http://f", ""), (None, "http://g", big), (9, "http://h", "x" * 100), (9, "http://h", "x" * 100), (10, "h", "x" * 100)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    got = [r.asDict(True) for r in warc.assemble(warc.read_warc(spark, str(tmp_path / "w"))).collect()]
    refers = {3: 1, 2: 1, None: 1, 10: 9}
    assert len(got) == len(rows)
    for r in got:
        html = (next(h for i, _, h in rows if i == r["page_id"]) or "").encode()
        body = r["response"]
        assert r["refers_to"] == refers.get(r["page_id"]) and body["warc_type"] == ("revisit" if r["page_id"] in refers else "response")
        assert (bytes(body["payload"]), body["payload_bytes"], body["payload_digest"]) == (html, len(html), hashlib.sha256(html).hexdigest())
        assert r["request"]["http_header"].startswith("GET ")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(empty, str(tmp_path / "e"))
    assert warc.assemble(warc.read_warc(spark, str(tmp_path / "e"))).count() == 0


def test_sharding(spark):
    rows = [(i,) for i in range(4000)] + [(None,), (5,), (5,)]
    tree = sharding.even_tree(16)
    df = spark.createDataFrame(rows, "key long").withColumn("rack", F.lit("other"))
    place = lambda t: {r["key"]: (r["region"], r["rack"], r["shard"]) for r in rows_of(sharding.place(df, F.col("key"), t))}
    before, grown = place(tree), place([*tree, sharding.Leaf(2, 4, 16)])
    assert all(grown[k] == before[k] or grown[k][2] == 16 for k in before) and 100 < sum(v[2] == 16 for v in grown.values()) < 400
    heavier = place([x._replace(weight=2.0) if x.shard == 3 else x for x in tree])
    moved = [k for k in before if heavier[k] != before[k]]
    assert moved and all(heavier[k][:1] == (0,) for k in moved)  # only into the region whose weight grew
    assert all(heavier[k][1] == 0 for k in moved if before[k][0] == 0)  # and within it only into the rack
    sizes = [sum(v[2] == s for v in before.values()) for s in range(16)]
    assert min(sizes) > 180 and max(sizes) < 320
    slots = rows_of(sharding.number_slots(sharding.place(df, F.col("key"), tree), "shard", ["key"]))
    for s in range(16):
        own = sorted(r["slot"] for r in slots if r["shard"] == s)
        assert own == list(range(len(own)))
    assert len(slots) == len(rows)
