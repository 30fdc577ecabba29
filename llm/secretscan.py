r"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

The patterns (assignments, access keys, hex strings) find secrets by their shape. Besides them every run of at
least ``MIN_LENGTH`` of the characters ``[A-Za-z0-9+/_=-]`` is scored: first-order character models,
one for each kind of random string and one for ordinary identifiers, are trained from labelled samples, and a run
whose log-likelihood ratio of the best random kind against ordinary ones reaches ``THRESHOLD`` is a secret too,
unless it overlaps one that a pattern found.

Positions come from SQL functions alone: the pieces between the matches of a pattern and the matches
themselves, in turn, add up to the text, so a running sum of their lengths over a document's matches gives the
places. One shuffle by document carries the matches, not the texts. The models are tables of one number per pair
of characters, the only thing that meets on the driver.

Positions are in code points, ends exclusive. NULL and empty texts have no secrets. Rows that repeat are scanned
each for itself, and so are rows of one or no id. Without ordinary samples the ordinary model knows all pairs
alike and nothing is told apart. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.registry import query, table, text_or_empty

#: The contract's patterns, fixed values.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: What the models judge; possessive, so that a text is read once.
RUN = r"[A-Za-z0-9+/_=-]{16,}+"
#: The contract's hex runs of 24 characters or more: those under the limit are dropped anyway.
LONG_HEX = r"[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex", "markov")
MIN_LENGTH = 16
#: Log-likelihood ratio from which a run is random: odds of about nine million to one.
THRESHOLD = 16.0
#: Characters of runs, from '+' (43) to 'z' (122): pairs are numbered by their codes less 43.
LOWEST, CODES = 43, 80
ALPHABET = 67
PRIOR = 0.5
#: Labelled samples: documents (lowest hash of the id) whose words are ordinary, and random strings of each kind.
SAMPLE_DOCS = 500
SAMPLE_STRINGS = 2000
ORDINARY = "ordinary"


class Markov(NamedTuple):
    """Log-likelihood ratios against ordinary identifiers, by kind of random string."""

    first: dict[str, list[float]]  # by code of the first character
    pairs: dict[str, list[float]]  # by code of a character * CODES + code of the next


def random_samples(spark: SparkSession, strings: int = SAMPLE_STRINGS) -> DataFrame:
    """(value, kind): strings of hashes, written in the alphabets in which secrets are."""
    digest = lambda name: F.sha2(F.concat(F.lit(name), F.col("id").cast("string")).cast("binary"), 256)
    b64 = lambda name: F.rtrim(F.base64(F.unhex(digest(name))), F.lit("="))
    kinds = {"hex": F.substring(digest("a"), 1, 40), "HEX": F.upper(F.substring(digest("b"), 1, 40)),
             "base64": b64("c"), "base64url": F.translate(b64("d"), "+/", "-_"), "letters": F.regexp_replace(b64("e"), "[+/]", ""),
             "upper": F.regexp_replace(F.upper(b64("f")), "[+/]", "")}
    return spark.range(strings).select(F.explode(F.array(*(
        F.struct(value.alias("value"), F.lit(kind).alias("kind")) for kind, value in kinds.items()))).alias("x")).select("x.*")


def number_samples(spark: SparkSession, strings: int = SAMPLE_STRINGS) -> DataFrame:
    """(value, kind): decimal numbers, times and rulers of one character, which are ordinary however long they are."""
    digest = F.sha2(F.concat(F.lit("n"), F.col("id").cast("string")).cast("binary"), 256)
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10)
    time = F.timestamp_seconds(F.col("id") * 777_777 + 946_684_800)
    mark = F.substring(F.lit("+/_=-ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), (F.col("id") % 67 + 1).cast("int"), F.lit(1))
    values = F.array(F.concat(part(1), part(16)), F.date_format(time, "yyyy-MM-dd'T'HH-mm-ss"), F.date_format(time, "yyyyMMdd_HHmmss"), F.repeat(mark, F.lit(20)))
    return spark.range(strings).select(F.explode(values).alias("value"), F.lit(ORDINARY).alias("kind"))


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(value, kind): random strings, numbers and the like, and words of a bounded sample of ``docs``."""
    spark = docs.sparkSession
    return random_samples(spark).unionByName(number_samples(spark)).unionByName(ordinary_samples(docs))


def ordinary_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(value, kind): words of a bounded sample of documents as they stand and in upper case, and pairs of neighbours in the
    styles in which identifiers are joined. What the patterns find is taken out first."""
    ids = (docs.filter("doc_id IS NOT NULL").select("doc_id", F.xxhash64("doc_id").alias("order_")).distinct()
           .orderBy("order_", "doc_id").limit(sample_docs).select(F.col("doc_id").alias("sample_")))
    text = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("sample_"), "left_semi").select(text_or_empty().alias("text"))
    for pattern in (ASSIGN, ACCESS, LONG_HEX):
        text = text.withColumn("text", F.regexp_replace("text", pattern, " "))
    words = text.select(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{2,}+"), F.lit(0)).alias("w"))
    w = F.col("w")
    joined = F.transform(w, lambda x, i: F.concat(x, F.element_at(F.array(F.lit("_"), F.lit("-"), F.lit("/"), F.lit("=")), (i % 4 + 1).cast("int")),
                                                  F.coalesce(F.get(w, i + 1), F.lit("id"))))
    camel = F.transform(w, lambda x, i: F.concat(F.lower(x), F.initcap(F.coalesce(F.get(w, i + 1), F.lit("id")))))
    values = F.concat(w, joined, camel, F.transform(w, F.upper))
    return words.select(F.explode(values).alias("value"), F.lit(ORDINARY).alias("kind"))


def _codes(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.ascii(c) - LOWEST)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def train(samples: DataFrame) -> Markov:
    """Models of all kinds of the labelled samples (value, kind), of which one kind is ``ORDINARY``.

    Characters outside the alphabet of runs are left out.
    """
    counted = samples.groupBy("kind", "value").count()  # each distinct string is taken apart once
    codes = _codes(F.regexp_replace("value", "[^A-Za-z0-9+/_=-]", ""))
    steps = _once(codes, lambda c: F.concat(F.array(-1 - F.get(c, F.lit(0))), F.transform(
        F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), lambda x, i: F.get(c, i) * CODES + x)))
    pairs = counted.filter(F.col("value").rlike("[A-Za-z0-9+/_=-]")).select("kind", "count", F.explode(steps).alias("pair"))
    counts = pairs.groupBy("kind", "pair").agg(F.sum("count").alias("count")).collect()
    kinds = sorted({r["kind"] for r in counts} | {ORDINARY})
    seen = {kind: {} for kind in kinds}
    for r in counts:
        seen[r["kind"]][r["pair"]] = r["count"]
    log_first, log_pair = {}, {}
    for kind, n in seen.items():
        total = sum(v for k, v in n.items() if k < 0)
        log_first[kind] = [math.log((n.get(-1 - a, 0) + PRIOR) / (total + PRIOR * ALPHABET)) for a in range(CODES)]
        rows = [sum(n.get(a * CODES + b, 0) for b in range(CODES)) for a in range(CODES)]
        log_pair[kind] = [math.log((n.get(a * CODES + b, 0) + PRIOR) / (rows[a] + PRIOR * ALPHABET)) for a in range(CODES) for b in range(CODES)]
    ratio = lambda table, kind: [x - y for x, y in zip(table[kind], table[ORDINARY])]
    others = [k for k in kinds if k != ORDINARY]
    return Markov({k: ratio(log_first, k) for k in others}, {k: ratio(log_pair, k) for k in others})


def log_likelihood_ratio(value: Column, model: Markov) -> Column:
    """Of the likeliest random kind against ordinary identifiers; ``value`` consists of characters of runs."""
    literal = lambda numbers: F.split(F.lit(",".join(map(repr, numbers))), ",").cast("array<double>")  # noqa: E731  folded by the optimizer

    def of(kind, codes):
        pairs, first = literal(model.pairs[kind]), literal(model.first[kind])
        step = lambda total, i: total + F.get(pairs, F.get(codes, i) * CODES + F.get(codes, i + 1))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 2), F.get(first, F.get(codes, F.lit(0))), step)

    if not model.pairs:
        return F.lit(0.0)
    return _once(_codes(value), lambda codes: F.array_max(F.array(*(of(kind, codes) for kind in model.pairs))))


def _matches(text: Column, kind: int, pattern: str, possible: Column) -> Column:
    """Array of (kind, number, gap, value): the matches of a pattern and the code points between each and the one before.

    Where ``possible`` is false there are none.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    out = _once(F.split(text, pattern, -1), lambda gaps: F.transform(found, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("number"), F.length(F.get(gaps, i)).alias("gap"), x.alias("value"))))
    return F.when(possible & text.rlike(pattern), out).otherwise(F.array().cast("array<struct<kind:int,number:int,gap:int,value:string>>"))


def find_secrets(docs: DataFrame, model: Markov, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, found) of each row: the spans (start, order, end, kind, value, ratio) by start and then kind, with the
    log-likelihood ratio of those that the models found."""
    text = F.col("text_")
    run = F.col("run_")  # a long hex run is a run too, and the other two patterns need these characters
    patterns = ((ASSIGN, F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))), (ACCESS, F.contains(text, F.lit("AKIA"))), (LONG_HEX, run), (RUN, run))
    rows = docs.select(F.col(id_col).alias("id_"), text_or_empty(text_col).alias("text_")).withColumns(
        {"row_": F.monotonically_increasing_id(), "run_": text.rlike(RUN)})
    rows = rows.select("row_", "id_", F.concat(*(_matches(text, k, *p) for k, p in enumerate(patterns))).alias("m_"))
    hits = rows.select("row_", "id_", F.explode_outer("m_").alias("m")).select("row_", "id_", "m.*")
    own = Window.partitionBy("row_", "kind").orderBy("number")
    placed = hits.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("start", F.col("end") - F.length("value"))
    inner = F.regexp_extract("value", ASSIGN, 1)
    kept = (F.when(F.col("kind") == 0, F.length(inner) >= 6).when(F.col("kind") == 1, F.length("value") >= 20).when(F.col("kind") == 2, F.lit(True)))
    placed = placed.withColumn("base_", F.coalesce(kept, F.lit(False)))
    across = Window.partitionBy("row_").orderBy("start", "kind", "end")
    base_end, base_start = F.when(F.col("base_"), F.col("end")), F.when(F.col("base_"), F.col("start"))
    placed = placed.withColumn("covered_", (
        F.coalesce(F.max(base_end).over(across.rowsBetween(Window.unboundedPreceding, 0)) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(base_start).over(across.rowsBetween(0, Window.unboundedFollowing)) < F.col("end"), F.lit(False))))
    ratio = F.when((F.col("kind") == 3) & ~F.col("covered_"), log_likelihood_ratio(F.col("value"), model))
    placed = placed.withColumn("ratio", ratio)
    names = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    span = F.struct("start", F.col("kind").alias("order"), "end", names.alias("kind"), "value", "ratio")
    found = F.when(F.col("base_") | F.coalesce(F.col("ratio") >= threshold, F.lit(False)), span)
    return placed.groupBy("row_", "id_").agg(F.array_sort(F.collect_list(found)).alias("found")).select(F.col("id_").alias("doc_id"), "found")


@query("op13_secrets")
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(labelled_samples(docs))
    found = find_secrets(docs, model).withColumn("base", F.filter("found", lambda x: x["order"] < 3))
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x["order"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))
