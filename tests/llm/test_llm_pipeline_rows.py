"""Every stage of the pipeline on rows without an id, with one id for several texts, NULL texts and other columns."""

import random

import pytest

import corpus_pipeline as pipeline
from llm import packing, substring, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row_ string, kept string, score double, cuts int"


def text(seed, n=120):
    rng = random.Random(seed)
    return [f"w{rng.randrange(40_000)}" for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 5, "x", "y", 0.5, 1) for i, t in rows], DOCS)


def stage(spark, name, rows, sf_dir=""):
    out = dict(pipeline.STAGES)[name](spark, frame(spark, rows), sf_dir)
    assert name == "packing" or out.columns == pipeline.COLUMNS
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def join(words):
    return " ".join(words)


def test_quality_judges_rows(spark):
    good, bad = [join(text(i)) for i in range(4)], "short text"
    rows = [(None, good[0]), (None, bad), (1, good[1]), (1, bad), (2, good[2]), (2, None), (None, None), (3, ""), (4, good[3]), (4, good[3])]
    assert stage(spark, "quality", rows) == sorted([(None, good[0]), (1, good[1]), (2, good[2]), (4, good[3]), (4, good[3])], key=str)


def test_toxicity_judges_rows(spark, tmp_path):
    clean = [(i, join(text(i, 40))) for i in range(300)]
    toxic = [(300 + i, join(text(300 + i, 20) + ["moron"] + text(900 + i, 20))) for i in range(150)]
    spark.createDataFrame([(i, 1, int(i >= 300)) for i in range(450)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    more = [(None, clean[0][1]), (None, toxic[0][1]), (1, toxic[1][1]), (None, None), (2, ""), (3, join(text(3, 20_000)))]
    kept = stage(spark, "toxicity", clean + toxic + more, str(tmp_path))
    assert (None, None) in kept and (None, clean[0][1]) in kept and (2, "") in kept
    assert (None, toxic[0][1]) not in kept and (1, toxic[1][1]) not in kept and sum(i is not None and i >= 300 for i, _ in kept) <= 5
    only_one = str(tmp_path / "one")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{only_one}/labels.parquet")
    assert len(stage(spark, "toxicity", toxic, only_one)) == len(toxic)  # one class only: nothing is filtered


def test_minhash_keeps_one_row_of_each_group(spark):
    a, b, c = text(1), text(2), text(3)
    near = join(a[:-1] + ["changed"])
    rows = [(1, join(a)), (1, join(b)), (2, near), (None, join(c)), (None, join(c)), (5, join(c)), (6, None), (6, ""), (None, None)]
    kept = stage(spark, "minhash", rows)
    assert sum(t in (join(a), near) for _, t in kept) == 1 and sum(t == join(b) for _, t in kept) == 1
    assert [i for i, t in kept if t == join(c)] == [5]
    assert sum(not t for _, t in kept) == 3


def test_substring_cuts_the_row_it_measured(spark):
    passage, tail = text(1, 80), text(2, 60)
    rows = [(1, join(text(3, 50) + passage)), (2, join(passage + tail)), (2, "two words"), (2, None), (None, join(text(4, 30) + passage)), (None, None), (3, "")]
    got = stage(spark, "substring", rows)
    assert sum(join(passage) in (t or "") for _, t in got) == 1 and len(got) == len(rows)
    words = sorted(tuple((t or "").split()) for _, t in got)
    assert tuple(text(3, 50)) in [w[:50] for w in words] and ("two", "words") in words and sum(not w for w in words) == 3
    assert {t for i, t in got if i == 2} >= {"two words", None}


def test_substring_library_cuts_one_text_of_an_id(spark):
    passage = text(1, 80)
    docs = frame(spark, [(1, join(text(3, 50) + passage)), (2, join(passage + text(2, 60))), (2, "two words"), (2, None), (None, None)])
    out = substring.remove_passages(docs, substring.shared_passages(docs)).collect()
    assert len(out) == 5 and {r["text"] for r in out} >= {"two words", None} and out[0].asDict().keys() == set(docs.columns)


def test_substring_sees_through_smaller_holders(spark):
    p, q = text(11, 80), text(12, 70)
    rows = [(1, text(13, 60) + p[:40] + text(14, 60)), (2, text(15, 60) + p[40:] + text(16, 60)), (3, text(17, 60) + p), (4, p + text(18, 60)),
            (11, q[:30] + text(19, 60) + q), (12, text(20, 10) + q)]
    got = [(r["doc_id"], r["source_id"], r["start"], r["end"]) for r in substring.shared_passages(frame(spark, [(i, join(w)) for i, w in rows])).collect()]
    assert sorted(got) == [(4, 3, 0, 80), (12, 11, 10, 80)]


def test_every_equal_run_of_ordinary_texts_is_covered(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    covered = {}
    for r in substring.shared_passages(docs).collect():
        covered.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    first, runs = {}, 0
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        w = [x.decode("utf-8") for x in (r["text"] or "").encode().lower().split()]
        for i in range(len(w) - 49):
            if first.setdefault(tuple(w[i:i + 50]), r["doc_id"]) != r["doc_id"]:
                runs += 1
                assert set(range(i, i + 50)) <= covered[r["doc_id"]]
    assert runs > 0


def test_packing_packs_all_rows(spark):
    rows = [(1, "a"), (1, "b"), (None, None), (None, "x"), (2, ""), (2, "")]
    out = pipeline.best_fit_packing(spark, frame(spark, rows), "").collect()
    assert sorted((str(r["doc_id"]) for r in out)) == ["1", "1", "2", "2", "None", "None"] and len({r["sequence_id"] for r in out}) == 1


def test_packing_pairs_sizes_of_different_partitions(spark):
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    side = lambda first, size: spark.createDataFrame([(first + i, 0, 0, size, 0) for i in range(25_000)], schema).coalesce(1)
    out = packing.pack(side(0, 600).unionByName(side(25_000, 400)))
    assert out.select("sequence_id").distinct().count() == 25_000 and out.count() == 50_000


def test_training_sample_is_drawn_of_the_texts_there_are(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_LABEL", 20)
    docs = frame(spark, [(i, join(text(i, 30))) for i in range(200)] + [(500, join(text(1, 20_000))), (501, None), (502, "")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 400)] + [(500, 1), (501, 1), (502, 1), (None, 1)], "doc_id long, toxic int")
    texts, toxic = toxicity.training_sample(docs, labels)
    assert len(texts) == 40 and sum(toxic) == 20
    long_only, _ = toxicity.training_sample(docs, spark.createDataFrame([(500, 1)], "doc_id long, toxic int"))
    assert len(long_only) == 1 and 0.5 * toxicity.TRAIN_BYTES < len(long_only[0]) < 1.5 * toxicity.TRAIN_BYTES


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_empty_table(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert dict(pipeline.STAGES)[name](spark, frame(spark, []), str(tmp_path)).count() == 0
