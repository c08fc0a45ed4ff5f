"""Quality rules: per-text statistics, and robust outliers among them.

Everything here is DataFrame expressions. Per language and source the minimum
covariance determinant is searched for: the half (or more) of the rows whose covariance
has the smallest determinant. Rows far from its centre, by its own covariance, go.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialise

#: Share of a group's rows the estimate rests on, and concentration steps per start.
SUBSET = 0.75
STEPS = 4
#: Rows a group needs for an estimate of its own; smaller ones use that of all rows.
LEAST_ROWS = 60
#: Squared distance beyond which a row goes: the 0.999 point of chi-square, 5 degrees.
CUTOFF = 20.515
#: Scale grid of medians and distance grid of subset borders (steps per unit and doubling).
GRID, DOUBLING = 1024, 64

REPEAT_WORDS = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

#: The statistic vector and the least spread of each, near what one more count changes in a
#: short text: without it, a group whose texts all agree would reject a text for a single
#: odd line or sign. Its square is added to the variance, so it matters only where the rows
#: spread less than that. Alone, a statistic rejects from about 4.5 spreads on.
STATISTICS = ("log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate")
LEAST_SPREAD = (0.3, 0.1, 0.02, 0.05, 0.03)


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(hashes: Column) -> Column:
    """Words in windows that occur twice, from the hashes of all windows."""

    def of_sorted(pairs):
        def twice(pair, i):
            same = lambda k: F.get(pairs, k)["h"] == pair["h"]
            return F.coalesce(same(i - 1), F.lit(False)) | F.coalesce(same(i + 1), F.lit(False))

        places = F.sort_array(F.transform(F.filter(pairs, twice), lambda p: p["i"]))
        start = F.named_struct(F.lit("n"), F.lit(0).cast("bigint"), F.lit("end"), F.lit(0))
        return F.aggregate(
            places,
            start,
            lambda done, i: F.named_struct(
                F.lit("n"), done["n"] + REPEAT_WORDS - F.greatest(done["end"] - i, F.lit(0)),
                F.lit("end"), i + REPEAT_WORDS,
            ),
            lambda done: done["n"],
        )

    numbered = F.transform(hashes, lambda h, i: F.named_struct(F.lit("h"), h, F.lit("i"), i))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
        _with(F.sort_array(numbered), of_sorted)
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Words are runs without white space. Windows of five words are compared by 64-bit
    hashes within their text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        text.alias("text"),
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words):
        windows = F.when(
            F.size(words) >= REPEAT_WORDS,
            F.transform(
                F.sequence(F.lit(1), F.size(words) - REPEAT_WORDS + 1),
                lambda i: F.xxhash64(F.slice(words, i, REPEAT_WORDS)),
            ),
        ).otherwise(F.array().cast("array<bigint>"))
        return F.named_struct(
            F.lit("n_words"), F.size(words).cast("bigint"),
            F.lit("word_chars"), F.aggregate(words, F.lit(0).cast("bigint"), lambda n, w: n + F.length(w)),
            F.lit("n_repeat_words"), _with(windows, _covered),
        )

    words = F.filter(F.split("text", WHITE), lambda w: w != "")
    symbols = F.when(F.col("text").rlike(SYMBOLS), F.regexp_count("text", F.lit(SYMBOLS))).otherwise(F.lit(0))
    return base.select(
        "doc_id", "lang", "source",
        _with(words, of_words).alias("w"),
        symbols.cast("bigint").alias("n_symbols"),
        _with(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _with(lines, F.size).alias("n_lines"),
    ).select("doc_id", "lang", "source", "w.*", "n_symbols", "n_dup_lines", "n_lines")


def with_base_rule(stats: DataFrame) -> DataFrame:
    short = F.col("n_words") < LEAST_WORDS
    return stats.withColumn("base_failed", short | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def with_vector(stats: DataFrame) -> DataFrame:
    """Add the statistic vector ``x``: the counts as rates of the text's length, so that long
    texts are no outliers for being long, and on the log scale where they spread by factors."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    columns = {
        "log_words": F.log1p("n_words"),
        "word_length": F.log1p(F.col("word_chars") / words),
        "symbol_rate": F.log1p(F.col("n_symbols") / words),
        "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
    }
    return stats.withColumn("x", F.array(*[columns[name].cast("double") for name in STATISTICS]))


D = len(STATISTICS)
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def _quantile(df: DataFrame, keys: list[str], cell: Column, share: float, name: str) -> DataFrame:
    """Per group the smallest cell that ``share`` of its rows do not exceed.

    Cells are whole numbers on a grid, so a group is reduced to a row per cell by every
    task, however many of the rows it holds.
    """
    cells = df.select(*keys, cell.cast("bigint").alias("cell")).groupBy(*keys, "cell").agg(F.count("*").alias("n"))
    up = Window.partitionBy(*keys).orderBy("cell")
    counted = cells.withColumns({"upto": F.sum("n").over(up), "total": F.sum("n").over(Window.partitionBy(*keys))})
    return counted.filter(F.col("upto") >= F.ceil(F.col("total") * share)).groupBy(*keys).agg(F.min("cell").alias(name))


def _cell(distance: Column) -> Column:
    return F.floor(F.log2(F.greatest(distance, F.lit(1e-9))) * DOUBLING)


def _centre_and_scale(rows: DataFrame) -> DataFrame:
    """Median and median absolute deviation of each statistic: ``grp, centre, scale`` (arrays)."""
    long = rows.select("grp", F.posexplode("x").alias("k", "v"))
    median = _quantile(long, ["grp", "k"], F.round(F.col("v") * GRID), 0.5, "cell").select(
        "grp", "k", (F.col("cell") / GRID).alias("m")
    )
    off = long.join(median, ["grp", "k"]).withColumn("off", F.abs(F.col("v") - F.col("m")))
    spread = _quantile(off, ["grp", "k"], F.round(F.col("off") * GRID), 0.5, "cell").select(
        "grp", "k", (F.col("cell") / GRID * 1.4826).alias("s")
    )
    least = F.element_at(F.array(*[F.lit(v) for v in LEAST_SPREAD]), F.col("k") + 1)
    both = median.join(spread, ["grp", "k"]).withColumn("s", F.greatest("s", least))
    parts = F.sort_array(F.collect_list(F.struct("k", "m", "s")))
    return both.groupBy("grp").agg(parts.alias("p")).select(
        "grp", F.transform("p", lambda p: p["m"]).alias("centre"), F.transform("p", lambda p: p["s"]).alias("scale")
    )


def _moments(rows: DataFrame, keys: list[str], vector: str = "x") -> DataFrame:
    """Per group: number of rows, mean ``mu`` and covariance ``cov`` (lower triangle, by rows).

    Products are taken of values shifted by the group's first centre, so that sums of
    squares lose no digits.
    """
    v = [F.element_at(vector, i + 1) - F.element_at("centre", i + 1) for i in range(D)]
    sums = rows.groupBy(*keys, "centre").agg(
        F.count("*").alias("rows"),
        *[F.avg(v[i]).alias(f"m{i}") for i in range(D)],
        *[F.avg(v[i] * v[j]).alias(f"p{i}_{j}") for i, j in PAIRS],
    )
    mean = F.array(*[F.element_at("centre", i + 1) + F.col(f"m{i}") for i in range(D)])
    cov = F.array(*[F.col(f"p{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}") for i, j in PAIRS])
    return sums.select(*keys, "centre", "rows", mean.alias("mu"), cov.alias("cov"))


def _factor(moments: DataFrame) -> DataFrame:
    """Add the inverse ``white`` of the Cholesky factor of the covariance plus the squared
    least spreads, and ``logdet``, the logarithm of the determinant.

    Entries are computed column by column, one per step, on a row per group; the rows of
    the table are then only multiplied with them.
    """
    at = lambda i, j: F.element_at("cov", PAIRS.index((i, j)) + 1)
    low, inverse = (lambda i, j: F.col(f"l{i}_{j}")), (lambda i, j: F.col(f"w{i}_{j}"))
    df = moments
    for i, j in PAIRS:
        total = at(i, j) if i != j else F.greatest(at(i, i), F.lit(0.0)) + LEAST_SPREAD[i] ** 2
        for k in range(j):
            total = total - low(i, k) * low(j, k)
        df = df.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(total, F.lit(1e-12))) if i == j else total / low(j, j))
    for i, j in sorted(PAIRS, key=lambda p: (p[0], -p[1])):
        total = F.lit(1.0) if i == j else reduce(lambda a, b: a + b, [-low(i, k) * inverse(k, j) for k in range(j, i)])
        df = df.withColumn(f"w{i}_{j}", total / low(i, i))
    logdet = reduce(lambda a, b: a + b, [2 * F.log(low(i, i)) for i in range(D)])
    return df.select(*moments.columns, F.array(*[inverse(*p) for p in PAIRS]).alias("white"), logdet.alias("logdet"))


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from ``mu``: the length of the whitened difference."""
    away = [F.element_at("x", i + 1) - F.element_at("mu", i + 1) for i in range(D)]
    parts = [
        reduce(lambda a, b: a + b, [F.element_at("white", PAIRS.index((i, j)) + 1) * away[j] for j in range(i + 1)])
        for i in range(D)
    ]
    return reduce(lambda a, b: a + b, [p * p for p in parts])


def _starts(rows: DataFrame, centre: DataFrame) -> DataFrame:
    """Three first estimates per group: the scales alone, and the covariances of rows
    standardised by them and pulled in, by the hyperbolic tangent and to the unit sphere."""
    known = rows.join(centre, "grp")
    zs = F.transform(F.zip_with("x", "centre", lambda a, b: a - b), lambda d, k: d / F.get("scale", k))
    length = F.sqrt(F.aggregate("z", F.lit(0.0), lambda n, v: n + v * v))
    back = lambda f: F.transform("z", lambda v, k: F.get("centre", k) + F.get("scale", k) * f(v))
    shaped = known.withColumn("z", zs).withColumn("r", F.greatest(length, F.lit(1e-9))).select(
        "grp", "centre", "scale",
        F.explode(F.array(
            F.struct(F.lit(1).alias("start"), back(F.tanh).alias("v")),
            F.struct(F.lit(2).alias("start"), back(lambda v: v / F.col("r")).alias("v")),
        )).alias("s"),
    ).select("grp", "centre", "s.*")
    pulled = _moments(shaped, ["grp", "start"], "v").select("grp", "start", "centre", "rows", "mu", "cov")
    zero = F.lit(0.0)
    plain = centre.select(
        "grp", F.lit(0).alias("start"), "centre", F.lit(0).cast("bigint").alias("rows"), F.col("centre").alias("mu"),
        F.array(*[F.pow(F.element_at("scale", i + 1), 2) if i == j else zero for i, j in PAIRS]).alias("cov"),
    )
    return _factor(plain.unionByName(pulled))


def _concentrate(rows: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """One step: the nearest ``share`` of a group's rows give its next estimate.

    All rows of the grid cell that completes the share are taken, so no rank is computed
    over a group and ties are treated alike.
    """
    near = rows.join(estimates, "grp").withColumn("cell", _cell(_distance()))
    border = _quantile(near, ["grp", "start"], F.col("cell"), share, "border")
    inside = near.join(border, ["grp", "start"]).filter(F.col("cell") <= F.col("border"))
    return _factor(_moments(inside.select("grp", "start", "centre", "x"), ["grp", "start"]))


def _consistency(share: float) -> float:
    """Factor that makes the covariance of the nearest ``share`` of normal rows that of all."""
    def below(q, dof):  # chi-square distribution function by its series
        term = total = 1 / math.gamma(dof / 2 + 1)
        for k in range(1, 400):
            term *= (q / 2) / (dof / 2 + k)
            total += term
        return total * (q / 2) ** (dof / 2) * math.exp(-q / 2)

    low, high = 0.0, 100.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle, D) < share else (low, middle)
    return share / below(low, D + 2)


def robust_estimates(rows: DataFrame, share: float = SUBSET, steps: int = STEPS) -> DataFrame:
    """``grp, mu, white`` per group of ``rows`` (``grp, x``): the estimate of least determinant."""
    estimates = _starts(rows, materialise(_centre_and_scale(rows), "centres"))
    for _ in range(steps):
        estimates = materialise(_concentrate(rows, estimates, share), "estimates")
    best = estimates.groupBy("grp").agg(
        F.min(F.struct("logdet", "start", "mu", "cov")).alias("b")
    ).select("grp", "b.mu", F.transform("b.cov", lambda v: v * _consistency(share)).alias("cov"))
    return _factor(best).select("grp", "mu", "white")


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    distance, kept`` for each row of ``docs`` (``doc_id, text, lang, source``).

    A row fails the base rule with fewer than ten words, or with more than a fifth of its
    words in five-word windows that the text holds twice. The others are estimated from
    and judged by their language and source; a null is a language or source of its own,
    and groups of fewer than ``least_rows`` such rows are judged by the estimate of all.
    Distance is squared and null where the base rule failed; ``kept`` is false there and
    where the distance is above ``cutoff``.

    A null, empty or blank text has no words and fails the base rule; equal rows each
    give a row; other columns are not read; an empty table gives an empty table.
    """
    stats = materialise(with_vector(with_base_rule(text_statistics(docs))), "text-statistics")
    fit = stats.filter("not base_failed")
    sizes = fit.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    own = sizes.filter(F.col("rows") >= least_rows).select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"),
        F.concat_ws("\u0001", F.lit("own"), F.coalesce("lang", F.lit("\u0002")), F.coalesce("source", F.lit("\u0002"))).alias("grp"),
    )
    own = materialise(own, "groups")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    grouped = fit.join(own, same, "left").withColumn("grp", F.coalesce("grp", F.lit("all")))
    # Every row counts in the estimate of all rows, and in that of its group.
    rows = grouped.select(F.explode(F.array_distinct(F.array("grp", F.lit("all")))).alias("grp"), "x")
    estimates = materialise(robust_estimates(materialise(rows, "fit-rows")), "estimates")
    judged = stats.join(own, same, "left").withColumn("grp", F.coalesce("grp", F.lit("all"))).join(
        estimates, "grp", "left"
    )
    distance = F.when(~F.col("base_failed"), _distance())
    return judged.withColumn("distance", distance).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        F.coalesce(~F.col("base_failed") & (F.col("distance") <= cutoff), F.lit(False)).alias("kept"),
    )
