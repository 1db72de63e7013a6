"""Quality rules: robust multivariate outliers by minimum covariance determinant, in SQL functions only.

Five counts are taken of every whole text. Four statistics derived from them form a vector per
document; per language and source, concentration steps look for the mean and covariance of the
tightest ``SHARE`` of the vectors, and a document is rejected when its Mahalanobis distance from that
core is above the chi-square quantile ``QUANTILE``. The final covariance, not the steps', is widened so
that one event (a word twice as long, a symbol, a repeated line, a phrase said twice) in a text of the
group's median length is at most ``EVENT`` standard deviations, which alone is no outlier.

Only sums and quantile sketches per group are shuffled, so a group with a third of all rows is no
larger a task than any other. The group table is broadcast while it has at most ``MAX_GROUPS`` rows;
above, documents are salted and the table repeated per salt.

Defined results: a null text has no words; null languages and sources are groups of their own; texts
below the base rules are not part of any estimate and not kept; equal vectors get equal verdicts, so
repeated rows do too; a group of one document keeps it; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.columns import settle

WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD_LETTER = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 5

SHARE = 0.75  # of a group's vectors that its estimate rests on
STEPS = 3  # concentration steps
QUANTILE = 0.99
POOLED = 50.0  # documents' worth of the pooled covariance in each group's
EVENT = 3.0  # standard deviations that one event is at most
BASE_REPEATS = 20  # percent of words in repeated windows above which a text is below the base rules
MAX_GROUPS = 100_000
SALTS = 64

GROUP = ["group_lang", "group_source"]
DIM = 4
PAIRS = [(row, column) for row in range(DIM) for column in range(row + 1)]


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _covered(keys: Column) -> Column:
    """Words in windows whose key occurs twice or more, the windows starting at each word."""
    pairs = F.sort_array(F.transform(keys, lambda key, place: F.struct(key.alias("key"), place.alias("place"))))

    def repeated(pairs: Column) -> Column:
        def twice(pair: Column, number: Column) -> Column:
            before, after = F.get(pairs, number - 1), F.get(pairs, number + 1)
            return F.coalesce(before["key"] == pair["key"], F.lit(False)) | F.coalesce(
                after["key"] == pair["key"], F.lit(False)
            )

        return F.sort_array(F.transform(F.filter(pairs, twice), lambda pair: pair["place"]))

    def words(places: Column) -> Column:
        step = F.transform(
            places, lambda place, number: F.least(F.lit(WINDOW), F.coalesce(F.get(places, number + 1) - place, F.lit(WINDOW)))
        )
        return F.aggregate(step, F.lit(0), lambda total, words: total + words)

    return _bound(_bound(pairs, repeated), words)


def _repeat_words(words: Column) -> Column:
    def keys(words: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda start: F.xxhash64(*[F.get(words, start + offset) for offset in range(WINDOW)]),
        )

    found = _bound(
        keys(words),
        lambda keys: F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(_covered(keys)),
    )
    return F.when(F.size(words) >= WINDOW, found).otherwise(F.lit(0))


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the five counts and ``base_failed`` of every row."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD_LETTER))
    counted = (
        docs.select(
            "doc_id", "lang", "source", text.alias("text"),
            F.array_remove(F.split(text, WORD_BREAK), "").alias("words"),
        )
        .select(
            "doc_id", "lang", "source",
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("text", NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
            _bound(lines, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        )
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > BASE_REPEATS * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def with_statistics(counts: DataFrame) -> DataFrame:
    """Adds the vector ``x0`` to ``x3``; its logarithms keep rates of any size comparable."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")

    def percent(part: str, whole: Column) -> Column:
        return F.log1p(100 * F.col(part).cast("double") / whole)

    def key(name: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))

    return counts.withColumns({
        "x0": F.log(chars / words),
        "x1": percent("n_symbols", chars),
        "x2": percent("n_dup_lines", words),
        "x3": percent("n_repeat_words", words),
        GROUP[0]: key("lang"),
        GROUP[1]: key("source"),
    })


def chi_square_share(value: float, dim: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    half = value / 2
    return 1 - math.exp(-half) * sum(half**k / math.factorial(k) for k in range(dim // 2))


def chi_square_quantile(share: float, dim: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, dim) < share else (low, middle)
    return low


def _attach(rows: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    if n_groups <= MAX_GROUPS:
        return rows.join(F.broadcast(groups), GROUP)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "x0", "x1"), F.lit(SALTS)))
    repeated = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(repeated, [*GROUP, "salt"]).drop("salt")


def _events(words: Column, chars: Column) -> list[Column]:
    """What one event adds to each statistic in a text of so many words and characters.

    A phrase said twice covers two windows. In short texts that is as much as the base rule allows, so
    the last event is at most half of the base rule and the statistic can always reject.
    """
    repeats = F.least(100 * 2 * WINDOW / words, F.lit(BASE_REPEATS / 2))
    return [F.log1p(1 / words), F.log1p(100 / chars), F.log1p(100 / words), F.log1p(repeats)]


def _with_factor(groups: DataFrame, floored: bool = False) -> DataFrame:
    """Mean, and the Cholesky factor of each group's covariance blended with the pooled one.

    ``floored`` adds the variances ``e0`` to ``e3``.
    """
    pooled = groups.agg(*[
        (F.sum(F.col(f"c{i}{j}") * F.col("n")) / F.sum("n")).alias(f"c{i}{j}") for i, j in PAIRS
    ]).first()
    blended = groups.select(
        *GROUP,
        *[f"m{i}" for i in range(DIM)],
        *[
            (
                (F.col(f"c{i}{j}") * F.col("n") + POOLED * (pooled[f"c{i}{j}"] or 0.0)) / (F.col("n") + POOLED)
                + (F.col(f"e{i}") if floored and i == j else F.lit(0.0))
            ).alias(f"s{i}{j}")
            for i, j in PAIRS
        ],
    )
    for i, j in PAIRS:
        rest = F.col(f"s{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        factor = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
        blended = blended.withColumn(f"l{i}{j}", factor)
    return blended.select(*GROUP, *[f"m{i}" for i in range(DIM)], *[f"l{i}{j}" for i, j in PAIRS])


def _with_distance(rows: DataFrame, factors: DataFrame, n_groups: int) -> DataFrame:
    """``rows`` with ``distance``, the squared Mahalanobis distance from the group's core."""
    placed = _attach(rows, factors, n_groups)
    for i in range(DIM):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        placed = placed.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    distance = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, DIM)), F.col("y0") * F.col("y0"))
    return placed.select(*rows.columns, distance.alias("distance"))


def robust_groups(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Centre and Cholesky factor per group by concentration steps, and the number of groups."""
    quarters = vectors.groupBy(*GROUP).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(DIM)],
        *[F.percentile_approx(name, 0.5, 1000).cast("double").alias(name) for name in ("n_words", "word_chars")],
    )
    events = _events(F.col("n_words"), F.col("word_chars"))
    spread = [(F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 for i in range(DIM)]
    first = settle(quarters.select(
        *GROUP, "n",
        *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(DIM)],
        *[(spread[i] * spread[i] if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS],
        *[(events[i] * events[i] / EVENT**2).alias(f"e{i}") for i in range(DIM)],
    ))
    groups, floors = first.drop(*[f"e{i}" for i in range(DIM)]), first.select(*GROUP, *[f"e{i}" for i in range(DIM)])
    n_groups = groups.count()
    cut = chi_square_quantile(SHARE, DIM)
    widen = SHARE / chi_square_share(cut, DIM + 2)  # a core's covariance is too small by this factor
    for _ in range(STEPS):
        placed = _with_distance(vectors, settle(_with_factor(groups)), n_groups)
        limits = settle(placed.groupBy(*GROUP).agg(F.percentile_approx("distance", SHARE, 1000).alias("limit")))
        core = _attach(placed, limits, n_groups).filter(F.col("distance") <= F.col("limit"))
        moments = core.groupBy(*GROUP).agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            *[F.avg(f"x{i}").alias(f"m{i}") for i in range(DIM)],
            *[F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in PAIRS],
        )
        groups = settle(moments.select(
            *GROUP, "n",
            *[f"m{i}" for i in range(DIM)],
            *[(widen * (F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))).alias(f"c{i}{j}") for i, j in PAIRS],
        ))
    return settle(_with_factor(groups.join(floors, GROUP), floored=True)), n_groups


def verdicts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``distance`` (null if failed) and ``kept`` of every row."""
    rows = settle(with_statistics(base_counts(docs)))
    passed = rows.filter(~F.col("base_failed"))
    factors, n_groups = robust_groups(passed)
    limit = chi_square_quantile(QUANTILE, DIM)
    judged = _with_distance(passed, factors, n_groups).withColumn("kept", F.col("distance") <= limit)
    failed = rows.filter("base_failed").withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    return judged.unionByName(failed).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "distance", "kept",
    )
