"""Quality rules: robust multivariate outliers, DataFrame operations only.

Every document gets a vector of transformed statistics.  For each language and
source a minimum-covariance-determinant (MCD) estimate of centre and scatter is
found by concentration steps: from several fixed starts, the ``KEEP`` share of
rows closest to the present estimate gives the next one, and the start whose
scatter ends with the smallest determinant wins.  A row whose Mahalanobis
distance from its group's estimate is above the cutoff is rejected; so is a row
that fails the base rules.

Scale: texts are scanned once into a narrow statistics table.  Each step is one
or two aggregations per group with partial sums (a hot source is summed inside
every task); the table of estimates has one row per group and is joined by a
broadcast only below ``common.BROADCAST_GROUPS`` rows, else by a shuffle with the
group salted.

Defined cases: a null or empty text has zero words, fails the base rules and is
not kept.  Null ``lang`` or ``source`` are groups of their own.  Groups with
fewer than ``MIN_GROUP`` rows use the estimate of the rest of their language,
then that of all such rows; with fewer than ``MIN_GROUP`` rows even there, only
the base rules decide.  Repeated rows and rows without an id are judged row by row.  Equal
statistics (no spread) are covered by ``FLOOR``, the least standard deviation
of each statistic.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, cut, join_groups, text_of, words_of

#: Base rules.
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
SYMBOLS = "#*$%&|<>"
#: Share of a group's rows that an estimate is made of, concentration steps, rows that a group needs.
KEEP, STEPS, MIN_GROUP = 0.75, 3, 50
#: For five normal statistics the KEEP rows nearest to the centre have a scatter smaller by this factor.
CONSISTENCY = 1.41
#: Least standard deviation of each transformed statistic.
FLOOR = {"z_length": 0.1, "z_symbols": 0.35, "z_lines": 0.8, "z_repeats": 0.8, "z_variety": 0.15}
Z = list(FLOOR)
#: Squared Mahalanobis distance above which a row is an outlier.
CUTOFF = 60.0
ACCURACY = 2000  # of percentile_approx: a rank is right to 1/2000
STARTS = ("round", "box", "plain")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base statistics of every whole text, ``base_failed`` and the
    transformed vector (null without words)."""
    df = df.withColumn("_text", text_of(text)).withColumn("_words", words_of(F.col("_text")))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "_n_lines": F.size("_lines"),
        "word_chars": F.length(F.translate("_text", WHITE, "")).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        "_n_kinds": F.size(F.array_distinct("_words")),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.when(F.size("_words") >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(F.col("_words"), i, WINDOW)))),
    }).drop("_words", "_lines", "_text")
    # Only texts with a repeated window sort their windows by (hash, place).
    df = df.withColumn("_pairs", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.transform("_hashes", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("_hashes")

    def repeated(p: Column, k: Column) -> Column:
        return (F.coalesce(F.get(F.col("_pairs"), k - 1)["x"] == p["x"], F.lit(False))
                | F.coalesce(F.get(F.col("_pairs"), k + 1)["x"] == p["x"], F.lit(False)))

    df = df.withColumn("_hits", F.sort_array(
        F.transform(F.filter("_pairs", repeated), lambda p: p["i"]))).drop("_pairs")
    covered = F.aggregate(
        F.col("_hits"), F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"])
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_hits")
    some = F.col("n_words") > 0
    z = {"z_length": F.log(F.col("word_chars") / F.col("n_words")),
         "z_symbols": F.log(0.002 + F.col("n_symbols") / F.col("word_chars")),
         "z_lines": F.log(0.01 + F.col("n_dup_lines") / F.col("_n_lines")),
         "z_repeats": F.log(0.01 + F.col("n_repeat_words") / F.col("n_words")),
         "z_variety": F.log(F.col("_n_kinds") / F.col("n_words"))}
    return df.withColumns({k: F.when(some, v) for k, v in z.items()} | {
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))}).drop("_n_lines", "_n_kinds")


def _row_salt() -> Column:
    return F.xxhash64("n_words", "word_chars", "n_symbols", "n_repeat_words", *Z)


def _squares(at: str) -> Column:
    """Squared Mahalanobis distance by the estimate whose columns end in ``at``."""
    rows = [reduce(lambda a, b: a + b, [F.col(f"w{i}{j}_{at}") * (F.col(Z[j]) - F.col(f"m{j}_{at}"))
                                        for j in range(i + 1)]) for i in range(len(Z))]
    return reduce(lambda a, b: a + b, [y * y for y in rows])


def _whitened(estimates: DataFrame, at: str) -> DataFrame:
    """From the covariances ``c<i><j>`` that end in ``at``: the inverse of the Cholesky factor of
    consistency * covariance + floor (``w<i><j>``) and the log determinant.

    Columns that don't depend on one another are added at once: planning a
    projection for each takes the driver's time and memory.
    """
    p, df = len(Z), estimates

    def left(i: int, j: int) -> Column:
        v = CONSISTENCY * F.coalesce(F.col(f"c{i}{j}_{at}"), F.lit(0.0))
        v = v + FLOOR[Z[i]] ** 2 if i == j else v
        for k in range(j):
            v = v - F.col(f"l{i}{k}_{at}") * F.col(f"l{j}{k}_{at}")
        return v

    def inverse(i: int, j: int) -> Column:
        v = reduce(lambda a, b: a + b, [F.col(f"l{i}{k}_{at}") * F.col(f"w{k}{j}_{at}") for k in range(j, i)])
        return -v / F.col(f"l{i}{i}_{at}")

    for j in range(p):
        df = df.withColumn(f"l{j}{j}_{at}", F.sqrt(F.greatest(left(j, j), F.lit(1e-12))))
        if j + 1 < p:
            df = df.withColumns({f"l{i}{j}_{at}": left(i, j) / F.col(f"l{j}{j}_{at}") for i in range(j + 1, p)})
    df = df.withColumns({f"w{j}{j}_{at}": 1 / F.col(f"l{j}{j}_{at}") for j in range(p)})
    for d in range(1, p):
        df = df.withColumns({f"w{j + d}{j}_{at}": inverse(j + d, j) for j in range(p - d)})
    log_det = reduce(lambda a, b: a + b, [F.log(F.col(f"l{i}{i}_{at}")) for i in range(p)])
    return (df.withColumn(f"det_{at}", 2 * log_det)
            .drop(*[f"{x}{i}{j}_{at}" for i in range(p) for j in range(i + 1) for x in "cl"]))


def _concentrate(rows: DataFrame) -> DataFrame:
    """One concentration step: estimates per group and start of the KEEP share
    of its rows with the smallest distance.  ``rows`` has group, start, Z and
    the distance ``d``; starts are rows, not columns, so that plans and the
    code made of them, which the driver holds, are those of one start."""
    limits = cut(rows.groupBy("group", "start").agg(F.percentile_approx("d", KEEP, ACCURACY).alias("q")), "mcd-limits")
    near = join_groups(rows, limits, ["group", "start"], F.xxhash64(*Z)).filter("d <= q")
    found = near.groupBy("group", "start").agg(
        *[F.avg(c).alias(f"m{i}_best") for i, c in enumerate(Z)],
        *[F.covar_pop(Z[i], Z[j]).alias(f"c{i}{j}_best") for i in range(len(Z)) for j in range(i + 1)])
    return cut(_whitened(found, "best"), "mcd-estimates")


def fit(stats: DataFrame) -> DataFrame:
    """MCD estimates as one row per (lang, source): centre ``m<i>_best`` and
    whitening matrix ``w<i><j>_best``, null where there are too few rows.

    ``stats`` is the output of ``with_statistics``, read from files.
    """
    sound = stats.filter(~F.col("base_failed")).select("lang", "source", *Z)
    sizes = cut(stats.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n")), "mcd-sizes")
    small = F.col("n") < MIN_GROUP
    by_lang = (sizes.filter(small).groupBy("lang").agg(F.sum("n").alias("n_lang"))
               .withColumn("n_rest", F.lit(0)))
    rest = by_lang.filter(F.col("n_lang") < MIN_GROUP).agg(F.coalesce(F.sum("n_lang"), F.lit(0))).first()[0]
    name = (F.when(~small, F.to_json(F.struct(F.lit(0).alias("level"), "lang", "source")))
            .when(F.col("n_lang") >= MIN_GROUP, F.to_json(F.struct(F.lit(1).alias("level"), "lang")))
            .when(F.lit(rest >= MIN_GROUP), F.lit('{"level":2}')))
    by_lang = by_lang.select(F.col("lang").alias("_l"), "n_lang")
    groups = cut(sizes.join(by_lang, F.col("lang").eqNullSafe(F.col("_l")), "left")
                 .select("lang", "source", name.alias("group")), "mcd-groups")
    columns = [f"m{i}" for i in range(len(Z))] + [f"w{i}{j}" for i in range(len(Z)) for j in range(i + 1)]
    if groups.filter("group is not null").isEmpty():
        return groups.select("lang", "source", *[F.lit(None).cast("double").alias(f"{c}_best") for c in columns])
    salt = F.xxhash64(*Z)
    rows = cut(join_groups(sound, groups.filter("group is not null"), ["lang", "source"], salt)
               .select("group", *Z), "mcd-rows")

    middle = cut(rows.groupBy("group").agg(*[F.percentile_approx(c, 0.5, ACCURACY).alias(f"mid_{c}") for c in Z]),
                 "mcd-middle")
    centred = join_groups(rows, middle, ["group"], salt)
    spread = cut(centred.groupBy("group").agg(
        *[F.max(f"mid_{c}").alias(f"mid_{c}") for c in Z],
        *[F.greatest(1.4826 * F.percentile_approx(F.abs(F.col(c) - F.col(f"mid_{c}")), 0.5, ACCURACY),
                     F.lit(FLOOR[c])).alias(f"scale_{c}") for c in Z]), "mcd-spread")
    start = join_groups(rows, spread, ["group"], salt)
    unit = [F.abs(F.col(c) - F.col(f"mid_{c}")) / F.col(f"scale_{c}") for c in Z]
    by_start = {"round": reduce(lambda a, b: a + b, [u * u for u in unit]),
                "box": F.greatest(*unit),
                "plain": reduce(lambda a, b: a + b, unit)}
    found = _concentrate(start.select("group", *Z, F.explode(F.array(*[
        F.struct(F.lit(i).alias("start"), by_start[s].alias("d")) for i, s in enumerate(STARTS)])).alias("x"))
        .select("group", "x.start", *Z, "x.d"))
    for _ in range(STEPS):
        found = _concentrate(join_groups(rows, found, ["group"], salt)
                             .select("group", "start", *Z, _squares("best").alias("d")))

    best = found.groupBy("group").agg(F.min(F.struct("det_best", "start", *[f"{c}_best" for c in columns])).alias("x"))
    best = best.select("group", *[f"x.{c}_best" for c in columns])
    return cut(groups.join(best.withColumnRenamed("group", "_g"), F.col("group") == F.col("_g"), "left")
               .drop("_g", "group"), "mcd-best")


def judge(stats: DataFrame, estimates: DataFrame) -> DataFrame:
    """Add ``distance`` (squared Mahalanobis; null without an estimate) and ``kept``."""
    df = join_groups(stats, estimates, ["lang", "source"], _row_salt(), "left")
    df = df.withColumn("distance", _squares("best"))
    df = df.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)))
    return df.drop(*[c for c in estimates.columns if c.endswith("_best")], *Z)


def statistics_table(docs: DataFrame) -> DataFrame:
    """Statistics of every row, written once."""
    return cut(with_statistics(docs.select("doc_id", "lang", "source", "text")).drop("text"), "quality-stats")


def rate(docs: DataFrame) -> DataFrame:
    """Every row's statistics, distance and verdict."""
    stats = statistics_table(docs)
    return judge(stats, fit(stats))


def keep(docs: DataFrame) -> DataFrame:
    """The rows that pass, with all their columns."""
    estimates = fit(statistics_table(docs))
    rows = docs.select(F.struct("*").alias("_row"), "text", "lang", "source")
    stats = with_statistics(rows)
    # A condition that isn't deterministic stays above the statistics; pushed
    # below them, the filter would repeat their whole expressions many times.
    stats = stats.withColumn("base_failed", F.col("base_failed") & (F.spark_partition_id() >= 0))
    return judge(stats, estimates).filter("kept").select("_row.*")
