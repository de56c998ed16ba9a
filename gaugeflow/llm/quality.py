"""Quality rules: statistics of each document and robust multivariate outliers (DataFrame functions only).

Per language and source, location and scatter of transformed statistics are estimated by minimum covariance
determinant. Three deterministic starts (medians with quartile ranges, medians with equal scales, means with the
whole covariance) are improved side by side by concentration steps, "estimate from the half of the documents that is
nearest", until no group's determinant falls any more or ``STEPS`` are done; each group keeps the start of least
determinant. As usual the estimate is then reweighted once: it is made again from all documents within the 97.5 % point
of the chi-square law. A document is rejected if its squared distance from that is beyond ``CUTOFF`` times the
group's median distance in units of the law.

* Statistics are stored as whole thousandths, so sums of them and of their products are exact and don't
  depend on the order in which tasks finish: reruns agree.
* The nearest half is found from sums per fixed logarithmic distance bin (one row per group and bin), not by
  sorting a group: it ends with the bin that completes it.
* ``FLOORS`` is added to the diagonal of each scatter against singular ones. Signs, repeated lines and repeated words
  are zero in most texts of a group, so there the floor is all the scatter they have: it says how much of them
  is no reason to reject. For the two lengths it is a small part; ``scatter`` reports the shares.

Defined results: null text has no words and fails the base rule; null language or source forms a group of its
own; a group of few documents is judged by the same formula; an empty table gives an empty result; repeated
rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import SPACE_RUN, SPACES, words
from gaugeflow.operators.skew import salted_lookup
from gaugeflow.session import discard, stage

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
STATS = ("length", "word_length", "symbols", "dup_lines", "repeats")
FLOORS = (0.2, 0.05, 0.5, 0.6, 0.8)  # standard deviations, in transformed units
SCALE = 1000  # whole thousandths
STARTS = 3
STEPS = 12  # at most; groups settle in about four
FALL = 1e-9  # least fall of a determinant's logarithm that counts
CUTOFF = 41.0  # five statistics: chi-square beyond one in ten million
CHI2_MEDIAN = 4.351  # chi-square with five degrees of freedom: median and 97.5 % point
CHI2_NEAR = 12.833
BINS_PER_UNIT = 16


def repeated_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; ``hashes`` has one hash per window."""
    order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    n = F.size(hashes)
    before, after = F.concat(nothing, F.slice(order, 1, n - 1)), F.concat(F.slice(order, 2, n - 1), nothing)
    left = F.zip_with(order, before, lambda a, b: F.when(a["h"] == b["h"], a["i"]))
    right = F.zip_with(order, after, lambda a, b: F.when(a["h"] == b["h"], a["i"]))
    starts = F.sort_array(F.array_compact(F.zip_with(left, right, lambda a, b: F.coalesce(a, b))))
    gaps = F.zip_with(
        starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))
    )
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counted statistics of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", "lang", "source", text.alias("_t")).select(
        "doc_id",
        "lang",
        "source",
        words(F.col("_t")).alias("_w"),
        F.length(F.regexp_replace("_t", SPACE_RUN, "")).cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.split("_t", "\n").alias("_lines"),
    )
    lines = F.filter(F.col("_lines"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.withColumn("_lines", lines).withColumn(
        "n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")
    )
    hashed = F.transform("_w", lambda w: F.xxhash64(w))
    df = df.withColumn("n_words", F.size("_w").cast("bigint")).withColumn("_h", hashed).drop("_w", "_lines")
    # Windows of 2, 4 and 8 words: each pairs the hashes of two windows of half its length.
    size, half = F.size("_h"), 1
    while half < WINDOW:
        rest = F.greatest(size - (2 * half - 1), F.lit(0))
        df = df.withColumn("_h", F.zip_with(F.slice("_h", 1, rest), F.slice("_h", half + 1, rest), lambda a, b: F.xxhash64(a, b)))
        size, half = F.col("n_words").cast("int"), 2 * half
    df = df.withColumnRenamed("_h", "_windows")
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return df.select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(repeats, repeated_words(F.col("_windows"))).otherwise(0).cast("bigint").alias("n_repeat_words"),
    )


def with_base(df: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return df.withColumn("base_failed", failed)


def transformed() -> list[Column]:
    """The statistics as they are judged: logarithms of counts and rates, in whole thousandths."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = (
        F.log1p(n),
        F.log1p(F.col("word_chars") / n),
        F.log1p(F.col("n_symbols") * 100 / n),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.log1p(F.col("n_repeat_words") * 100 / n),
    )
    return [F.round(v * SCALE).cast("bigint").alias(f"x{i}") for i, v in enumerate(values)]


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(STATS)) for j in range(i, len(STATS))]


GROUP = ["lang", "source"]
_K = range(len(STATS))
_SUMS = ["n", *[f"s{i}" for i in _K], *[f"p{i}{j}" for i, j in _pairs()]]


def _sums(df: DataFrame, by: list[str]) -> DataFrame:
    """Counts, sums and sums of products, exact."""
    products = [F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).alias(f"p{i}{j}") for i, j in _pairs()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in _K], *products)


def _moments(sums: DataFrame, by: list[str]) -> DataFrame:
    """Means and scatter of the summed documents, the floors added."""
    n = F.col("n").cast("double")
    cov = []
    for i, j in _pairs():
        c = (F.col(f"p{i}{j}").cast("double") - F.col(f"s{i}").cast("double") * F.col(f"s{j}").cast("double") / n) / n
        cov.append((c + (FLOORS[i] * SCALE) ** 2 if i == j else c).alias(f"c{i}{j}"))
    return sums.select(*by, *[(F.col(f"s{i}") / n).alias(f"m{i}") for i in _K], *cov)


def _nearest_half(df: DataFrame) -> DataFrame:
    """Estimates from the nearest half per group and start.

    Sums are kept per distance bin, so one aggregation over the documents serves to find the half and to sum it.
    """
    by = [*GROUP, "start"]
    half = _upto_half(_sums(df, [*by, "bin"]), by)
    return _moments(half.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _SUMS]), by)


def _upto_half(bins: DataFrame, by: list[str]) -> DataFrame:
    """Bins of each group up to the one that completes half of its documents."""
    group = Window.partitionBy(*by)
    before = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    counted = bins.select("*", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("n").over(group).alias("_all"))
    return counted.filter(F.col("_before") * 2 < F.col("_all")).drop("_before", "_all")


def _quartiles(df: DataFrame) -> DataFrame:
    """Medians ``m`` and scaled quartile ranges ``d`` per group, from counts of values in steps of a fiftieth."""
    step = SCALE // 50
    cells = df.select(*GROUP, F.posexplode(F.array(*[F.floor(F.col(f"x{i}") / step) for i in _K])).alias("i", "v"))
    counts = cells.groupBy(*GROUP, "i", "v").agg(F.count(F.lit(1)).alias("c"))
    group = Window.partitionBy(*GROUP, "i")
    upto = F.sum("c").over(group.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    share = counts.select("*", upto.alias("upto"), F.sum("c").over(group).alias("all"))

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("v"))) * step + step / 2

    q = share.groupBy(*GROUP, "i").agg(quantile(0.5).alias("mid"), ((quantile(0.75) - quantile(0.25)) / 1.349).alias("sd"))
    pick = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c)))
    return q.groupBy(*GROUP).agg(*[pick("mid", i).alias(f"m{i}") for i in _K], *[pick("sd", i).alias(f"d{i}") for i in _K])


def _starts(df: DataFrame) -> DataFrame:
    """The estimates that the concentration steps start from, per group and ``start``."""
    quartiles = stage(_quartiles(df), "quality-quartiles")

    def diagonal(start: int, scale) -> DataFrame:
        cov = [(scale(i) + (FLOORS[i] * SCALE) ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _pairs()]
        return quartiles.select(*GROUP, F.lit(start).alias("start"), *[f"m{i}" for i in _K], *cov)

    whole = _moments(_sums(df, GROUP), GROUP).withColumn("start", F.lit(2))
    return diagonal(0, lambda i: F.col(f"d{i}") * F.col(f"d{i}")).unionByName(diagonal(1, lambda i: F.lit(0.0))).unionByName(whole)


def _factor(moments: DataFrame, by: list[str]) -> DataFrame:
    """Cholesky factor of each group's scatter, one column per entry; the inverse of the diagonal as ``r``,
    the logarithm of the determinant as ``log_det``."""
    df = moments
    for j in _K:
        d, below = F.col(f"c{j}{j}"), {}
        for t in range(j):
            d = d - F.col(f"l{j}{t}") * F.col(f"l{j}{t}")
        for i in range(j + 1, len(STATS)):
            c = F.col(f"c{j}{i}")
            for t in range(j):
                c = c - F.col(f"l{i}{t}") * F.col(f"l{j}{t}")
            below[f"l{i}{j}"] = c / F.sqrt(d)
        df = df.withColumns({f"r{j}": 1 / F.sqrt(d)} | below)
    lower = [f"l{i}{j}" for i in _K for j in range(i)]
    log_det = -2 * sum((F.ln(f"r{i}") for i in _K), F.lit(0.0))
    return df.select(*by, *[f"m{i}" for i in _K], *[f"r{i}" for i in _K], *lower, log_det.alias("log_det"), *[f"c{i}{i}" for i in _K])


def _distance(df: DataFrame, estimates: DataFrame, by: list[str]) -> DataFrame:
    """``df`` with the squared Mahalanobis distance ``d2``, by forward substitution, and its ``bin``."""
    kept = [c for c in estimates.columns if c == "scale"]
    used = estimates.select(*by, *[f"m{i}" for i in _K], *[f"r{i}" for i in _K], *[f"l{i}{j}" for i in _K for j in range(i)], *kept)
    joined = salted_lookup(df, used, by, spread="_salt_by", null_safe=by)
    total = F.lit(0.0)
    for i in _K:
        z = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            z = z - F.col(f"l{i}{j}") * F.col(f"z{j}")
        joined = joined.withColumn(f"z{i}", z * F.col(f"r{i}"))
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    bin_of = F.floor(F.log2(F.col("d2") + 1e-6) * BINS_PER_UNIT)
    return joined.withColumn("d2", total).withColumn("bin", bin_of).select(*df.columns, "d2", "bin", *kept)


def _scaled(df: DataFrame, estimates: DataFrame) -> DataFrame:
    """Estimates with ``scale``: the group's median squared distance in units of the chi-square law, 1 at least.

    At least 1, as the floors already hold a group together whose half is nearly one point.
    """
    bins = _distance(df, estimates, GROUP).groupBy(*GROUP, "bin").agg(F.count(F.lit(1)).alias("n"))
    half = _upto_half(bins, GROUP).groupBy(*GROUP).agg(F.max("bin").alias("half"))
    scale = F.greatest(F.lit(1.0), F.pow(2.0, (F.col("half") + 1) / BINS_PER_UNIT) / CHI2_MEDIAN)
    scales = half.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), scale.alias("scale"))
    return estimates.join(scales, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))).drop("_l", "_s")


def estimates(judged: DataFrame, steps: int = STEPS) -> DataFrame:
    """Location and scatter per group: minimum covariance determinant, reweighted, with ``scale``.

    ``judged`` has lang, source, _salt_by and the transformed statistics.
    """
    by = [*GROUP, "start"]
    now = stage(_factor(_starts(judged), by), "quality-start")
    side_by_side = judged.withColumn("start", F.explode(F.array(*[F.lit(i) for i in range(STARTS)])))
    for step in range(steps):
        following = stage(_factor(_nearest_half(_distance(side_by_side, now, by)), by), "quality-step")
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        before = now.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("log_det").alias("_log_det"))
        fallen = following.join(before, same).filter(F.col("log_det") < F.col("_log_det") - FALL).count()
        discard(now)
        now = following
        # The first step leaves the starts, whose determinants are of no half; then they only count if they fall.
        if step and not fallen:
            break
    least = now.groupBy(*GROUP).agg(F.min(F.struct("log_det", "start")).alias("b")).select(*[F.col(c).alias(f"_{c}") for c in GROUP], F.col("b.start").alias("_start"))
    chosen = now.join(least, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).drop("start", *[f"_{c}" for c in by])
    raw = stage(_scaled(judged, chosen), "quality-raw")
    near = _distance(judged, raw, GROUP).filter(F.col("d2") <= CHI2_NEAR * F.col("scale"))
    reweighted = stage(_factor(_moments(_sums(near, GROUP), GROUP), GROUP), "quality-reweighted")
    return stage(_scaled(judged, reweighted), "quality-estimates")


def _judged(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("base_failed")).select(*GROUP, "_salt_by", *transformed())


def _prepared(df: DataFrame) -> DataFrame:
    return stage(with_base(df).withColumn("_salt_by", F.xxhash64("doc_id", "n_words", "word_chars")), "quality-statistics")


def outliers(df: DataFrame, steps: int = STEPS, cutoff: float = CUTOFF) -> DataFrame:
    """``df`` of statistics with base_failed, and ``kept`` and ``distance`` by the robust estimates."""
    rows = _prepared(df)
    final = estimates(_judged(rows), steps)
    counted = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    vectors = _distance(rows.select(*counted, *GROUP, "_salt_by", *transformed()), final, GROUP)
    distance = F.when(~F.col("base_failed"), F.col("d2") / F.col("scale"))
    kept = ~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))
    return vectors.select(*counted, kept.alias("kept"), F.sqrt(distance).alias("distance"), *GROUP)


def scatter(docs: DataFrame, steps: int = STEPS) -> DataFrame:
    """Per language and source: log_det, scale, and for each statistic the share of its scatter that is floor."""
    found = estimates(_judged(_prepared(statistics(docs))), steps)
    shares = [((FLOORS[i] * SCALE) ** 2 / F.col(f"c{i}{i}")).alias(f"floor_{STATS[i]}") for i in _K]
    return found.select(*GROUP, "log_det", "scale", *shares)


def quality(docs: DataFrame, **rules) -> DataFrame:
    return outliers(statistics(docs), **rules)
