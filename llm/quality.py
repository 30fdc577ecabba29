r"""Quality rules: base statistics of whole texts and robust multivariate outliers.

The statistics of texts that pass the base rules are transformed, and for each language and source
a minimum-covariance-determinant estimate of their centre and scatter is made from the distinct rows,
so that copies count once. Three starts (medians and median deviations, plain moments, moments
weighted by distance) go on by concentration steps, each of which estimates mean and covariance from the
half of the rows that lie nearest by Mahalanobis distance, until no start of any group finds a smaller
determinant. The least determinant wins, and mean and covariance of all rows near it are the estimate.
Medians and halves are taken over narrow fixed bins (``GRID``, ``DOUBLING``), so they depend neither on how rows
lie in partitions nor need more memory for larger groups. Groups of fewer than ``MIN_ROWS`` distinct rows are pooled
by language, small languages together, and should these be few as well, they are judged by the estimate of all rows.
A whole table of fewer distinct rows has no estimate, and nothing is rejected. Every covariance gets fixed variances on its diagonal, so a statistic that is
constant in a group rejects nobody for a trifle.

Words are ``[^\x20\x09-\x0D]+``. NULL texts have no words and fail the base rules. NULL languages
and sources are values of their own. Rows that repeat are judged alike. Only SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.registry import query, stored, table, text_or_empty

MIN_WORDS = 50
MIN_ROWS = 50
#: Share of a group's distinct rows that a concentration step takes, and the consistency of their covariance in four dimensions.
NEAREST, CONSISTENCY = 0.5, 2.109
#: Squared distance (97.5 % of a normal distribution) of the rows that make the last estimate, and the consistency of that.
REWEIGHT, REWEIGHT_CONSISTENCY = 11.143, 1.0645
#: Least standard deviations of the transformed statistics. After the base rules z2 is at most 0.707 and z3 about 3,
#: so that each statistic can pass the cutoff by itself: repeated words from 12 % on where a group has none.
LEAST_SD = (0.1, 0.2, 0.06, 0.12)
#: Squared Mahalanobis distance above which a text is rejected: the chi-square quantile of 1 - 1e-6 in four dimensions.
CUTOFF = 33.377
#: Concentration ends when the logarithm of no group's least determinant falls by this much any more.
LEAST_GAIN = 0.001
#: Bins to a unit of a statistic, for medians, and to a doubling of a squared distance, for the nearest half.
GRID, DOUBLING = 1024, 64
REST, ALL = "\t\t", "\t\t\t"
Z = [f"z{i}" for i in range(len(LEAST_SD))]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def base_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    These names replace columns of the same names.
    """
    text = text_or_empty(text_col)
    step = docs.withColumns({
        "words_": word_list(text), "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "lines_": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    words = F.col("words_")
    step = step.withColumns({
        "n_words": F.size(words).cast("long"), "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
        "windows_": F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                            F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))})
    windows = F.col("windows_")
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.drop(text_col, "words_", "lines_").withColumn(
        "placed_", F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed))
    ordered = F.col("placed_")
    same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
    repeated = F.array_sort(F.transform(
        F.filter(ordered, lambda x, k: same(x, F.get(ordered, k - 1)) | same(x, F.get(ordered, k + 1))), lambda x: x["i"]))
    step = step.drop("windows_").withColumn("repeated_", repeated)
    at = F.col("repeated_")
    new_words = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
    covered = F.aggregate(new_words, F.lit(0), lambda total, x: total + x)
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("placed_", "repeated_")


def _strata(rows: DataFrame) -> DataFrame:
    """``rows`` with the group whose estimate judges them: language and source, language, or all that is left."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = rows.withColumns({"lang_": part("lang"), "pair_": F.concat_ws("\t", part("lang"), part("source"))})
    pairs = stored(rows.filter(~F.col("base_failed")).select("lang_", "pair_", *Z).distinct().groupBy("lang_", "pair_").count(), "pairs")
    langs = pairs.filter(F.col("count") < MIN_ROWS).groupBy("lang_").agg(F.sum("count").alias("small_"))
    groups = pairs.join(langs, "lang_", "left").select("pair_", F.when(F.col("count") >= MIN_ROWS, F.col("pair_")).when(
        F.col("small_") >= MIN_ROWS, F.concat(F.lit("\t"), F.col("lang_"))).otherwise(F.lit(REST)).alias("stratum"))
    # one row per language and source, stored, so that Spark knows its size
    return (rows.join(stored(groups, "groups"), "pair_", "left")
            .withColumn("stratum", F.coalesce("stratum", F.lit(REST))).drop("lang_", "pair_"))


def _pooled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` and the distinct rows their estimates are made from. Where too few are left for an estimate
    of their own, they are judged by all."""
    fit = stored(rows.filter(~F.col("base_failed")).select("stratum", *Z).distinct(), "fit")
    if fit.filter(F.col("stratum") == REST).limit(MIN_ROWS).count() in (0, MIN_ROWS):
        return rows, fit
    to_all = F.when(F.col("stratum") == REST, ALL).otherwise(F.col("stratum"))
    return rows.withColumn("stratum", to_all), fit.unionByName(fit.withColumn("stratum", F.lit(ALL)).distinct())


def _distance(rows: DataFrame, estimates: DataFrame, *more: str) -> DataFrame:
    """``rows`` with ``more`` of their group's estimates and ``d2``, the squared Mahalanobis distance by the Cholesky factor."""
    joined, solved = rows.join(estimates, "stratum", "left"), []
    for i, z in enumerate(Z):
        joined = joined.withColumn(f"y{i}", (F.col(z) - F.col(f"m{i}") - sum(
            (F.col(f"l{i}{j}") * F.col(f"y{j}") for j in range(i)), F.lit(0.0))) / F.col(f"l{i}{i}"))
        solved.append(F.col(f"y{i}") * F.col(f"y{i}"))
    return joined.select(*rows.columns, *more, sum(solved[1:], solved[0]).alias("d2"))


def _factor(moments: DataFrame, cov) -> DataFrame:
    """Start, means and Cholesky factor of each group, and the logarithm of its determinant; ``cov(i, j)`` is a column of the moments."""
    out = moments
    for i in range(len(Z)):
        for j in range(i + 1):
            rest = cov(i, j) - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    return out.select("stratum", "start", sum((2 * F.log(f"l{i}{i}") for i in range(len(Z))), F.lit(0.0)).alias("volume"),
                      *(f"m{i}" for i in range(len(Z))), *(f"l{i}{j}" for i in range(len(Z)) for j in range(i + 1)))


def _sums(rows: DataFrame, *by: str, weight: Column | None = None) -> DataFrame:
    """Weights, weighted statistics and their products, summed by ``by``."""
    weight = F.lit(1.0) if weight is None else weight
    return rows.groupBy(*by).agg(
        F.sum(weight).alias("n"), *(F.sum(weight * F.col(z)).alias(f"t{i}") for i, z in enumerate(Z)),
        *(F.sum(weight * F.col(Z[i]) * F.col(Z[j])).alias(f"p{i}{j}") for i in range(len(Z)) for j in range(i + 1)))


def _moments(sums: DataFrame, consistency: float) -> DataFrame:
    """The estimates from means and covariances of the rows of each group and start."""
    means = sums.withColumns({f"m{i}": F.col(f"t{i}") / F.col("n") for i in range(len(Z))})
    return _factor(means, lambda i, j: consistency * (F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
                   + (LEAST_SD[i] ** 2 if i == j else 0.0))


def _nearest(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The sums over the nearest half of each group, by each of its estimates.

    Rows are summed by bins of distance in one pass over them; the half is found among the bins, of which a group
    has some thousands at most.
    """
    ranked = _distance(rows, estimates, "start").filter(F.col("d2").isNotNull()).withColumn(
        "bin_", F.ceil(DOUBLING * F.log2(F.greatest("d2", F.lit(1e-9)))))
    bins, group = _sums(ranked, "stratum", "start", "bin_"), Window.partitionBy("stratum", "start")
    names = [c for c in bins.columns if c not in ("stratum", "start", "bin_")]
    upto = F.sum("n").over(group.orderBy("bin_").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bins = bins.withColumn("upto_", upto).withColumn("place_", NEAREST * (F.max("upto_").over(group) - 1))
    bin_at = lambda place: F.min(F.when(F.col("upto_") > place, F.col("bin_"))).over(group)
    bins = bins.withColumns({"low_": bin_at(F.floor("place_")), "high_": bin_at(F.ceil("place_"))})
    reach = F.ceil(F.col("low_") + (F.col("place_") - F.floor("place_")) * (F.col("high_") - F.col("low_")))
    return bins.filter(F.col("bin_") <= reach).groupBy("stratum", "start").agg(*(F.sum(c).alias(c) for c in names))


def _binned(z: Column) -> Column:
    return F.round(z * GRID) / GRID


def _estimates(rows: DataFrame) -> DataFrame:
    """The reweighted minimum-covariance-determinant estimate of each group of at least ``MIN_ROWS`` distinct rows."""
    median = lambda x: F.percentile(_binned(x), 0.5)  # noqa: E731  (exact, of a bounded number of values)
    medians = rows.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *(median(F.col(z)).alias(f"m{i}") for i, z in enumerate(Z)))
    medians = stored(medians.filter(F.col("n") >= MIN_ROWS).drop("n"), "mcd")
    deviations = rows.join(medians, "stratum").groupBy("stratum").agg(
        *(F.first(f"m{i}").alias(f"m{i}") for i in range(len(Z))),
        *(median(F.abs(F.col(z) - F.col(f"m{i}"))).alias(f"s{i}") for i, z in enumerate(Z)))
    middle = stored(_factor(deviations.withColumn("start", F.lit(0)), lambda i, j: (
        F.pow(1.4826 * F.col(f"s{i}"), F.lit(2.0)) + LEAST_SD[i] ** 2 if i == j else F.lit(0.0))), "mcd")
    far = _distance(rows, middle).filter(F.col("d2").isNotNull())
    starts = [middle, _moments(_sums(far.withColumn("start", F.lit(1)), "stratum", "start"), 1.0),
              _moments(_sums(far.withColumn("start", F.lit(2)), "stratum", "start", weight=1 / (1 + F.col("d2"))), 1.0)]
    estimates = stored(starts[0].unionByName(starts[1]).unionByName(starts[2]), "mcd")
    values = F.struct("volume", *(c for c in estimates.columns if c not in ("stratum", "start", "volume")))
    # least estimates of halves only: the starts, of other rows, have no volume to compare
    before = estimates.select("stratum", "start", F.lit(None).cast(estimates.select(values.alias("v")).schema["v"].dataType).alias("before"))
    while True:
        step = _moments(_nearest(rows, estimates), CONSISTENCY).select("stratum", "start", values.alias("now")).join(before, ["stratum", "start"])
        state = stored(step.select("stratum", "start", "now", F.least("now", "before").alias("least"), F.coalesce(
            F.col("now.volume") < F.col("before.volume") - LEAST_GAIN, F.lit(True)).alias("fell")), "mcd")
        if state.filter("fell").isEmpty():
            break
        estimates, before = state.select("stratum", "start", "now.*"), state.select("stratum", "start", F.col("least").alias("before"))
    one = state.groupBy("stratum").agg(F.min("least").alias("least")).select("stratum", "least.*").withColumn("start", F.lit(0))
    near = _distance(rows, stored(one, "mcd"), "start").filter(F.col("d2") <= REWEIGHT)
    return stored(_moments(_sums(near, "stratum", "start"), REWEIGHT_CONSISTENCY), "mcd")


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (lang, source and text are needed): its columns without the text, the base
    statistics, base_failed, d2 (NULL without an estimate) and kept. Columns of these names are replaced; stratum,
    z0 to z3, lang_ and pair_ are names of the work and are not returned."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    measured = base_statistics(docs).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).withColumns({
            "z0": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), "z1": F.asinh(10.0 * F.col("n_symbols") / n),
            "z2": F.sqrt(F.col("n_repeat_words") / n), "z3": F.asinh(10.0 * F.col("n_dup_lines") / n)})
    rows = stored(measured, "statistics")
    rows, fit = _pooled(stored(_strata(rows), "strata"))
    verdict = F.col("base_failed") | F.coalesce(F.col("d2") > CUTOFF, F.lit(False))
    return _distance(rows, _estimates(fit)).withColumn("kept", ~verdict).drop("stratum", *Z)


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept", "d2")
