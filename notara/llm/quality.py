"""Quality rules: counts of each text and robust multivariate outliers, in DataFrame operations only.

Four smoothed statistics of a document form a vector.  For each language and source a minimum
covariance determinant estimate (deterministic starts, concentration steps on the nearest three
quarters of the rows until the determinant settles) gives a centre and a covariance, and a document whose squared Mahalanobis
distance passes a chi-square quantile is rejected.  A language and source with few rows is judged by
the estimate of its whole language, and a language with few rows by that of the whole table.
Everything of a group is a map-side sum or a percentile; no row of a group is collected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import drop, read, save, small

X = ("x1", "x2", "x3", "x4")
PAIRS = [(a, b) for i, a in enumerate(X) for b in X[: i + 1]]
SUBSET = 0.75
LEAST_ROWS = 40  # smaller groups are judged by a wider one
#: Added to each variance: statistics that are 0 in nearly all rows stay invertible, and a text with
#: a few symbols or one repeated line is no outlier.
RIDGE = {"x1": 0.02**2, "x2": 0.35**2, "x3": 0.35**2, "x4": 0.45**2}
#: Steps stop when no log determinant changes by SETTLED; percentiles are right to one row in ACCURACY.
MOST_STEPS, SETTLED, ACCURACY = 20, 1e-4, 10_000
CUTOFF = 33.4  # the 0.999999 quantile of chi-square with 4 degrees of freedom
_BLANKS = "\t\n\x0b\x0c\r"


def _chi2_cdf(x: float, even: int) -> float:
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(even // 2))


def _consistency(p: int = len(X)) -> float:
    """Factor that makes the covariance of the nearest SUBSET of normal rows consistent."""
    lo, hi = 0.0, 100.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, p) < SUBSET else (lo, mid)
    return SUBSET / _chi2_cdf(lo, p + 2)


def text_counts(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long); null text: 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.withColumn("_words", F.array_remove(F.split(F.translate(text, _BLANKS, " " * len(_BLANKS)), " "), ""))
    # hashes of the words, then of every five in a row
    two = one.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    five = lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(5)])
    windows = F.when(F.size("_hashes") >= 5, F.transform(F.sequence(F.lit(0), F.size("_hashes") - 5), five)).otherwise(F.array().cast("array<bigint>"))
    three = two.withColumn("_windows", windows)
    placed = F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    four = three.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed))
    repeats = F.sort_array(F.transform(F.filter("_sorted", lambda x, i: F.coalesce(F.get("_sorted", i + 1)["h"] == x["h"], F.lit(False)) | F.coalesce((i > 0) & (F.get("_sorted", F.greatest(i - 1, F.lit(0)))["h"] == x["h"]), F.lit(False))), lambda x: x["i"]))
    covered = F.aggregate(
        repeats,
        F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(5), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, _BLANKS, " " * len(_BLANKS))) != "")
    chars = lambda drop: F.length(F.translate(text, drop, ""))
    return four.withColumn("_lines", lines).select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        chars(_BLANKS + " ").cast("long").alias("word_chars"),
        (F.length(text) - chars("#*$%&|<>")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_sorted").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
    )


def vector(counts: DataFrame) -> DataFrame:
    """counts with base_failed and x1 to x4; 50 typical words are added to each text, so short texts stay near the middle."""
    n = F.col("n_words") + 50
    share = lambda c: F.log1p(100.0 * F.col(c) / n)
    return counts.withColumns({
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        "x1": F.log((F.col("word_chars") + 250) / n), "x2": share("n_symbols"), "x3": share("n_dup_lines"), "x4": share("n_repeat_words"),
    })


KEY = ["lang", "source"]
LEVELS = [KEY, ["lang"], []]  # narrow to wide; the last is the whole table


def _estimate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance (with the ridge) of each group of rows."""
    return rows.groupBy(*keys).agg(
        *[F.avg(a).alias(f"m_{a}") for a in X],
        *[(F.covar_pop(a, b) * _consistency() + (RIDGE[a] if a == b else 0.0)).alias(f"c_{a}_{b}") for a, b in PAIRS],
    )


def _with(rows: DataFrame, groups: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """rows with the columns of their group (null-safe)."""
    renamed = groups.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = rows.join(small(rows.sparkSession, renamed, 100_000), same, "left")
    return joined.drop(*[f"_{k}" for k in keys])


def _factored(groups: DataFrame) -> DataFrame:
    """groups with the Cholesky factor l_* of their covariance and its log determinant, one column after another."""
    for i, a in enumerate(X):
        for k, b in enumerate(X[:i]):
            groups = groups.withColumn(f"l_{a}_{b}", (F.col(f"c_{a}_{b}") - sum((F.col(f"l_{a}_{c}") * F.col(f"l_{b}_{c}") for c in X[:k]), F.lit(0.0))) / F.col(f"l_{b}_{b}"))
        groups = groups.withColumn(f"l_{a}_{a}", F.sqrt(F.greatest(F.col(f"c_{a}_{a}") - sum((F.col(f"l_{a}_{c}") * F.col(f"l_{a}_{c}") for c in X[:i]), F.lit(0.0)), F.lit(1e-9))))
    return groups.withColumn("det", sum((2 * F.log(f"l_{a}_{a}") for a in X), F.lit(0.0)))


def _distances(rows: DataFrame) -> DataFrame:
    """rows, which have their group's centre and factor, with the squared Mahalanobis distance d."""
    for i, a in enumerate(X):
        rows = rows.withColumn(f"y_{a}", (F.col(a) - F.col(f"m_{a}") - sum((F.col(f"l_{a}_{c}") * F.col(f"y_{c}") for c in X[:i]), F.lit(0.0))) / F.col(f"l_{a}_{a}"))
    return rows.withColumn("d", sum((F.col(f"y_{a}") * F.col(f"y_{a}") for a in X), F.lit(0.0)))


def _starts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Both starts of each group: medians with squared median deviations (0), and the classical mean and covariance (1)."""
    middle = rows.groupBy(*keys).agg(*[F.percentile_approx(a, 0.5, ACCURACY).alias(f"m_{a}") for a in X])
    spread = _with(rows, middle, keys).groupBy(*keys).agg(*[F.first(f"m_{a}").alias(f"m_{a}") for a in X], *[F.percentile_approx(F.abs(F.col(a) - F.col(f"m_{a}")), 0.5, ACCURACY).alias(f"s_{a}") for a in X])
    robust = spread.select(*keys, *[f"m_{a}" for a in X], *[(F.pow(1.4826 * F.col(f"s_{a}"), 2) + RIDGE[a] if a == b else F.lit(0.0)).alias(f"c_{a}_{b}") for a, b in PAIRS])
    return robust.withColumn("start", F.lit(0)).unionByName(_estimate(rows, keys).withColumn("start", F.lit(1)))


def estimates(rows: DataFrame, steps: int = MOST_STEPS, keys: list[str] = KEY) -> DataFrame:
    """Centre and covariance of each group (by default lang, source) by minimum covariance determinant over rows(x1..x4).

    From both starts of a group, concentration steps go on until no group's determinant changes
    (`steps` at most); the start whose last subset has the smaller determinant wins.
    """
    both = [*keys, "start"]
    now = save(_factored(_starts(rows, keys)), "estimates")
    for _ in range(steps):
        far = _distances(_with(rows, now, keys)).select(*both, *X, "d")  # a row for each start
        cut = save(far.groupBy(*both).agg(F.percentile_approx("d", SUBSET, ACCURACY).alias("cut")), "cuts")
        after = save(_factored(_estimate(_with(far, cut, both).where("d <= cut"), both)), "estimates")
        moved = _with(after.select(*both, "det"), now.select(*both, F.col("det").alias("before")), both).agg(F.max(F.abs(F.col("det") - F.col("before")))).first()[0]
        drop(now, cut)
        now = after
        if (moved or 0.0) < SETTLED:
            break
    rest = [c for c in now.columns if c not in both]
    return now.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("det", "start")).alias("e")).select(*keys, "e.*")


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept).

    docs(doc_id, text, lang, source).  Null texts count as empty; null languages and sources are
    groups of their own.  A (lang, source) of fewer than LEAST_ROWS usable rows is judged by its
    language, and a language of fewer by the whole table.  Only where the whole table has fewer,
    so that nothing can be estimated, the base rules stand alone and distance is null.  Rows at equal
    distance are on the same side of every cut.  A long text is counted in one row, its words as one
    array.  Repeated rows are judged each for itself; columns of other names are ignored; an empty
    table gives an empty result.
    """
    table = save(vector(text_counts(docs.select("doc_id", "text", "lang", "source")).drop("text")), "counts")
    sizes = table.groupBy(*KEY).agg(F.count_if(~F.col("base_failed")).alias("rows"))
    wider = _with(_with(sizes, sizes.groupBy("lang").agg(F.sum("rows").alias("lang_rows")), LEVELS[1]), sizes.agg(F.sum("rows").alias("all_rows")), LEVELS[2])
    level = F.when(F.col("rows") >= LEAST_ROWS, 0).when(F.col("lang_rows") >= LEAST_ROWS, 1).when(F.col("all_rows") >= LEAST_ROWS, 2)
    groups = save(wider.select(*KEY, level.alias("level")), "levels")
    placed = save(_with(table, groups), "placed")
    parts = [placed.where("level IS NULL").withColumn("distance", F.lit(None).cast("double")).select(*table.columns, "distance")]
    for n in sorted(r["level"] for r in groups.where("level IS NOT NULL").select("level").distinct().collect()):
        keys = LEVELS[n]
        rows = placed.where("NOT base_failed")
        if n < 2:  # all usable rows of the groups of this level that judge anything
            wanted = groups.where(F.col("level") == n).select(*keys).distinct().withColumn("wanted", F.lit(True))
            rows = _with(rows, wanted, keys).where("wanted")
        usable = save(rows.select(*keys, *X), "rows")
        final = save(estimates(usable, keys=keys), "estimates")
        parts.append(_distances(_with(placed.where(F.col("level") == n), final, keys)).withColumnRenamed("d", "distance").select(*table.columns, "distance"))
    judged = parts[0]
    for part in parts[1:]:
        judged = judged.unionByName(part)
    kept = ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= CUTOFF))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"))
