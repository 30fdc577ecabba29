"""Robust estimates against numpy, and groups of every size."""

import random
import re

import numpy as np
import pytest

from llm import quality

DOCS = "doc_id long, text string, lang string, source string"


def text(rng, odd=0.0):
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(rng.randint(60, 120))]
    return "\n".join(" ".join(w + ("#" if rng.random() < odd else "") for w in words[i:i + 12]) for i in range(0, len(words), 12))


def group(rng, n, lang, source, first, odd=0.02):
    return [(first + i, text(rng, odd * rng.random()), lang, source) for i in range(n)]


def judged(spark, rows):
    return {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, DOCS)).collect()}


def statistics(row):
    n = max(row["n_words"], 1)
    return (np.log(max(row["word_chars"], 1) / n), np.arcsinh(10 * row["n_symbols"] / n),
            np.sqrt(row["n_repeat_words"] / n), np.arcsinh(10 * row["n_dup_lines"] / n))


def moments(x, consistency, weight=None):
    w = np.ones(len(x)) if weight is None else weight
    mean = (w[:, None] * x).sum(0) / w.sum()
    return mean, consistency * ((w[:, None] * x).T @ x / w.sum() - np.outer(mean, mean)) + np.diag(np.square(quality.LEAST_SD))


def distance(x, estimate):
    y = x - estimate[0]
    return np.einsum("ij,jk,ik->i", y, np.linalg.inv(estimate[1]), y)


def estimate(x):
    """The method in plain numpy, over all rows of one group."""
    grid = lambda v: np.floor(np.abs(v) * quality.GRID + 0.5) * np.sign(v) / quality.GRID
    middle = np.median(grid(x), axis=0)
    spread = np.median(grid(np.abs(x - middle)), axis=0)
    first = (middle, np.diag(np.square(1.4826 * spread) + np.square(quality.LEAST_SD)))
    now = [first, moments(x, 1.0), moments(x, 1.0, 1 / (1 + distance(x, first)))]
    least, before = [None] * 3, None
    while True:
        for s in range(3):
            bins = np.ceil(quality.DOUBLING * np.log2(np.maximum(distance(x, now[s]), 1e-9)))
            now[s] = moments(x[bins <= np.ceil(np.percentile(bins, 100 * quality.NEAREST))], quality.CONSISTENCY)
            volume = np.linalg.slogdet(now[s][1])[1]
            if least[s] is None or volume < least[s][0]:
                least[s] = (volume, now[s])
        if before is not None and all(a >= b - quality.LEAST_GAIN for (a, _), b in zip(least, before)):
            break
        before = [v for v, _ in least]
    best = min(least, key=lambda e: e[0])[1]
    return moments(x[distance(x, best) <= quality.REWEIGHT], quality.REWEIGHT_CONSISTENCY)


def test_estimates_equal_numpy(spark):
    rng = random.Random(5)
    rows = group(rng, 150, "en", "a", 0) + group(rng, 40, "en", "a", 1000, odd=1.5) + group(rng, 120, None, "b", 2000)
    rows += [(3000 + i, rows[7][1], "en", "a") for i in range(200)]  # copies count once
    got = judged(spark, rows)
    for ids in ([r[0] for r in rows if r[2] == "en"], [r[0] for r in rows if r[2] is None]):
        x = np.array([statistics(got[i]) for i in ids])
        want = distance(x, estimate(np.unique(x, axis=0)))
        np.testing.assert_allclose([got[i]["d2"] for i in ids], want, rtol=1e-6, atol=1e-9)
        assert [got[i]["kept"] for i in ids] == [d <= quality.CUTOFF for d in want]
    assert not any(got[1000 + i]["kept"] for i in range(40) if got[1000 + i]["d2"] > quality.CUTOFF)


@pytest.mark.parametrize("small", [1, 49])
def test_few_rows_are_judged_by_all(spark, small):
    """A small language whose rows are too few, and as many left in all, is judged by the whole table."""
    rng = random.Random(small)
    rows = group(rng, 200, "en", "a", 0) + group(rng, small - 1, "xx", "b", 1000) + [(1999, text(rng, 2.0), "xx", "b")]
    got = judged(spark, rows)
    x = np.array([statistics(r) for r in got.values()])
    want = dict(zip(got, distance(x, estimate(np.unique(x, axis=0)))))
    for i in [r[0] for r in rows if r[2] == "xx"]:
        assert got[i]["d2"] == pytest.approx(want[i], rel=1e-6)
    assert not got[1999]["kept"]


def test_a_small_table_has_no_estimate(spark):
    rng = random.Random(1)
    got = judged(spark, group(rng, 40, "en", "a", 0) + [(99, "too short", "en", "a")])
    assert all(r["d2"] is None and r["kept"] for i, r in got.items() if i != 99) and not got[99]["kept"]


def test_base_statistics_of_odd_texts(spark):
    """Against a plain count in Python, over texts of odd characters."""
    rng = random.Random(3)
    pieces = ["a", "b", "ab", " ", "  ", "\t", "\n", "\n\n", "\x0b", "\x1f", "#", "$%", "é", " ", "\U0001f600", "x y z ", "\r"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 60))) for _ in range(300)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.base_statistics(df).collect():
        t = texts[r["doc_id"]] or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        at = {}
        for i in range(len(words) - 2):
            at.setdefault(tuple(words[i:i + 3]), []).append(i)
        covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        want = (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, repr(t)
