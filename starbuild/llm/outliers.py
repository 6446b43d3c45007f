"""Quality rules: robust multivariate outliers.

Each document gets four transformed statistics: mean word length, symbols, repeated
lines and words in repeated five-word windows (the last three as logs of shrunken
percentages).  Per language and source, a minimum-covariance-determinant estimate gives
a centre and covariance: from two starts (all rows; rows without symbols and
repetitions), concentration steps keep the ``SUPPORT`` share of rows nearest by
Mahalanobis distance and estimate again, and the start with the smaller determinant
wins.  Documents whose squared distance from it exceeds ``CUTOFF`` are rejected.

Only sums travel: per step a histogram of distances finds each group's threshold and one
aggregation gives its moments, both partially added up before the shuffle, so a hot
source costs no more than others.  Group tables are joined as stored tables of known
size, so Spark broadcasts them only below its threshold.

Variances get the floors in ``FLOOR`` added (a regularised covariance): a group whose
documents all lack symbols would else reject the first ``&``.

Defined cases: NULL text counts as no words (fails the base rule); NULL language or
source is a group of its own; groups under ``MIN_ROWS`` rows are pooled by language, and
pools still under it together; an empty table gives an empty result; other columns pass
through inside ``row``.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import null_safe_key, packed, stage, text_or_empty

WORD = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: A column that a filter on the statistics must name: Spark then filters what was computed,
#: instead of computing the statistics anew inside the filter.
BARRIER = "_barrier"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: Share of a group's rows that an estimate rests on: half, so that copies of one text that are fewer cannot fill it.
SUPPORT = 0.5
#: Makes the covariance of that share comparable to a normal one: share / P(chi2(6) <= q), q the share's chi2(4) quantile.
CONSISTENCY = 2.110
STEPS = 3
MIN_ROWS = 50
#: Words of the group's mean that each document's statistics are shrunken towards.
PRIOR_WORDS = 30
PRIOR_LINES = 10
#: Added to the variances of the four statistics; small enough that each can reject alone (repeated words are at most
#: ``MAX_REPEAT_PERCENT``, so the square of the last is at most 9.3).
FLOOR = (0.06, 0.12, 0.7, 0.3)
#: Largest squared distance kept: the 0.9999 quantile of chi2(4).
CUTOFF = 23.51
DIMS = range(len(FLOOR))
PAIRS = tuple(combinations_with_replacement(DIMS, 2))
#: Histogram bins per doubling of 1 + squared distance.
BINS = 256
DECIMALS = 9


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows as ``row`` with the base statistics of the whole text."""
    text = F.col("_text")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    bare = F.translate(text, SPACES, "")
    df = packed(docs, text_or_empty(text_col).alias("_text")).select(
        "row",
        words.alias("_words"),
        lines.alias("_lines"),
        F.char_length(bare).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    size = F.size("_words")
    window = F.transform("_words", lambda w, i: F.xxhash64(w, *[F.get("_words", i + k) for k in range(1, WINDOW)]))
    df = df.select(
        "row",
        "word_chars",
        "n_symbols",
        size.cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(size >= WINDOW, F.slice(window, F.lit(1), size - (WINDOW - 1))).alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    in_order = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(repeats, in_order))
    twice = F.filter(
        "_sorted",
        lambda x, i: (x.h == F.get("_sorted", i - 1).h) | (x.h == F.get("_sorted", i + 1).h),
    )
    df = df.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x.i)))
    steps = F.transform("_starts", lambda x, i: F.coalesce(F.least(F.get("_starts", i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    repeated = F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")
    return df.select("row", *COUNTS[:4], repeated, "n_lines", F.monotonically_increasing_id().alias(BARRIER))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _share(part: str, whole: str, prior: int) -> Column:
    return F.log1p(100.0 * F.col(part) / (F.col(whole) + prior))


def _statistics(mean_length: Column) -> list[Column]:
    shrunken = (F.col("word_chars") + PRIOR_WORDS * mean_length) / (F.col("n_words") + PRIOR_WORDS)
    return [
        shrunken,
        _share("n_symbols", "n_words", PRIOR_WORDS),
        _share("n_dup_lines", "n_lines", PRIOR_LINES),
        _share("n_repeat_words", "n_words", PRIOR_WORDS),
    ]


def _groups(counts: DataFrame) -> DataFrame:
    """``k`` (language and source) to its group ``g`` and the group's mean word length."""
    sized = counts.groupBy("lang_key", "k").agg(
        F.count("*").alias("n"), F.sum("n_words").alias("words"), F.sum("word_chars").alias("chars")
    )
    small = F.col("n") < MIN_ROWS
    pools = sized.where(small).groupBy("lang_key").agg(F.sum("n").alias("pool_n"))
    placed = sized.join(pools, "lang_key", "left").withColumn(
        "g",
        F.when(~small, F.col("k"))
        .when(F.col("pool_n") >= MIN_ROWS, F.concat(F.lit("pool "), "lang_key"))
        .otherwise(F.lit("pool")),
    )
    means = placed.groupBy("g").agg(F.round(F.sum("chars") / F.sum("words"), DECIMALS).alias("mean_length"))
    return placed.select("k", "g").join(means, "g")


def _parameters(summed: DataFrame, starts: int) -> DataFrame:
    """Centre, factor of the covariance and its log determinant from sums, per start."""
    keep = [F.col("g")]
    for s in range(starts):
        n = F.col(f"n{s}")
        centre = [F.round(F.col(f"s{s}_{i}") / n, DECIMALS) for i in DIMS]
        cov = {
            (i, j): F.round(F.col(f"q{s}_{i}{j}") / n - F.col(f"s{s}_{i}") / n * F.col(f"s{s}_{j}") / n, DECIMALS)
            for i, j in PAIRS
        }
        keep += [c.alias(f"c{s}_{i}") for i, c in zip(DIMS, centre)]
        keep += [(CONSISTENCY * c + (FLOOR[i] if i == j else 0.0)).alias(f"v{s}_{i}{j}") for (i, j), c in cov.items()]
    df = summed.select(*keep)
    for s in range(starts):  # Cholesky, a column at a time
        for j in DIMS:
            rest = F.col(f"v{s}_{j}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{s}_{j}{k}") * F.col(f"l{s}_{j}{k}")
            df = df.withColumn(f"l{s}_{j}{j}", F.sqrt(rest))
            for i in range(j + 1, len(FLOOR)):
                rest = F.col(f"v{s}_{j}{i}")
                for k in range(j):
                    rest = rest - F.col(f"l{s}_{i}{k}") * F.col(f"l{s}_{j}{k}")
                df = df.withColumn(f"l{s}_{i}{j}", rest / F.col(f"l{s}_{j}{j}"))
        logs = [F.log(F.col(f"l{s}_{i}{i}")) for i in DIMS]
        df = df.withColumn(f"det{s}", F.round(2 * sum(logs[1:], logs[0]), DECIMALS))
    return df.drop(*[f"v{s}_{i}{j}" for s in range(starts) for i, j in PAIRS])


def _distance(df: DataFrame, s: str, x: list[str], out: str) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution."""
    for i in DIMS:
        rest = F.col(x[i]) - F.col(f"c{s}_{i}")
        for k in range(i):
            rest = rest - F.col(f"l{s}_{i}{k}") * F.col(f"_y{s}{k}")
        df = df.withColumn(f"_y{s}{i}", rest / F.col(f"l{s}_{i}{i}"))
    squares = [F.col(f"_y{s}{i}") * F.col(f"_y{s}{i}") for i in DIMS]
    return df.withColumn(out, sum(squares[1:], squares[0])).drop(*[f"_y{s}{i}" for i in DIMS])


def _sums(selected: list[Column]) -> list[Column]:
    out = []
    for s, use in enumerate(selected):
        x = [F.when(use, F.col(f"x{i}")) for i in DIMS]
        out.append(F.count(F.when(use, F.lit(1))).alias(f"n{s}"))
        out += [F.sum(x[i]).alias(f"s{s}_{i}") for i in DIMS]
        out += [F.sum(x[i] * F.col(f"x{j}")).alias(f"q{s}_{i}{j}") for i, j in PAIRS]
    return out


def _bin(d: Column) -> Column:
    return F.floor(F.log2(1.0 + d) * BINS).cast("long")


def _nearest(points: DataFrame, parameters: DataFrame, starts: int) -> DataFrame:
    """Points with, per start, whether they are among the ``SUPPORT`` share nearest to the centre."""
    near = points.join(parameters, "g")
    for s in range(starts):
        near = _distance(near, str(s), [f"x{i}" for i in DIMS], f"_d{s}").withColumn(f"b{s}", _bin(F.col(f"_d{s}")))
    near = near.select("g", *[f"x{i}" for i in DIMS], *[f"b{s}" for s in range(starts)])
    bins = near.select("g", F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"b{s}").alias("b")) for s in range(starts)])).alias("e"))
    counted = bins.groupBy("g", "e.s", "e.b").agg(F.count("*").alias("n"))
    below = F.sum("n").over(Window.partitionBy("g", "s").orderBy("b"))
    whole = F.sum("n").over(Window.partitionBy("g", "s"))
    # the first bin with which the share is reached
    reached = counted.withColumn("enough", below >= SUPPORT * whole).where("enough").groupBy("g")
    limits = reached.agg(*[F.min(F.when(F.col("s") == s, F.col("b"))).alias(f"limit{s}") for s in range(starts)])
    return near.join(stage(limits, "outlier-limits"), "g")


def fit(counts: DataFrame) -> DataFrame:
    """Per language and source ``k``: the estimate its documents are judged by.

    ``counts`` has ``lang``, ``source`` and the base statistics.
    """
    keyed = counts.select(
        null_safe_key(F.col("lang"), F.col("source")).alias("k"),
        null_safe_key(F.col("lang")).alias("lang_key"),
        *COUNTS,
    ).where(~base_failed())
    groups = stage(_groups(keyed), "outlier-groups")
    placed = keyed.join(groups, "k")
    x = _statistics(F.col("mean_length"))
    plain = (F.col("n_symbols") == 0) & (F.col("n_dup_lines") == 0) & (F.col("n_repeat_words") == 0)
    points = stage(placed.select("g", plain.alias("plain"), *[x[i].alias(f"x{i}") for i in DIMS]), "outlier-points")
    every = F.lit(True)
    start = points.groupBy("g").agg(*_sums([every, F.col("plain")]))
    start = start.select("g", *[F.when(F.col("n1") > 0, F.col(c)).otherwise(F.col(c.replace("1", "0", 1))).alias(c) if c[1] == "1" else F.col(c) for c in start.columns[1:]])
    parameters = stage(_parameters(start, 2), "outlier-start")
    for _ in range(STEPS):
        near = _nearest(points, parameters, 2)
        summed = near.groupBy("g").agg(*_sums([F.col(f"b{s}") <= F.col(f"limit{s}") for s in range(2)]))
        parameters = stage(_parameters(summed, 2), "outlier-step")
    names = [f"c_{i}" for i in DIMS] + [f"l_{i}{j}" for i in DIMS for j in range(i + 1)]
    better = F.col("det1") < F.col("det0")
    chosen = parameters.select(
        "g",
        *[F.when(better, F.col(n.replace("_", "1_"))).otherwise(F.col(n.replace("_", "0_"))).alias(n) for n in names],
    )
    return stage(groups.join(chosen, "g").select("k", "mean_length", *names), "outlier-model")


def judge(counted: DataFrame, model: DataFrame, lang: Column, source: Column) -> DataFrame:
    """``counted`` with ``base_failed``, ``distance`` (squared; NULL if it failed) and ``kept``."""
    joined = counted.withColumn("k", null_safe_key(lang, source)).join(model, "k", "left")
    x = _statistics(F.col("mean_length"))
    joined = joined.select(*counted.columns, *model.columns[2:], *[c.alias(f"_x{i}") for i, c in enumerate(x)])
    joined = _distance(joined, "", [f"_x{i}" for i in DIMS], "_d")
    failed = base_failed()
    return joined.select(
        *counted.columns,
        failed.alias("base_failed"),
        F.when(~failed, F.round("_d", 6)).alias("distance"),
        (~failed & (F.round("_d", 6) <= CUTOFF)).alias("kept"),
    )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One slim row per document: identifier, base statistics, distance and verdict."""
    named = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("text")
    )
    counts = stage(with_counts(named).select("row.doc_id", "row.lang", "row.source", *COUNTS), "outlier-counts")
    judged = judge(counts, fit(counts), F.col("lang"), F.col("source"))
    return judged.select("doc_id", *COUNTS, "base_failed", "distance", "kept")


def reject_outliers(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that stay, with their columns as they came."""
    counted = with_counts(docs, text_col)
    lang, source = F.col(f"row.`{lang_col}`"), F.col(f"row.`{source_col}`")
    counts = stage(counted.select(lang.alias("lang"), source.alias("source"), *COUNTS), "outlier-counts")
    model = fit(counts)
    return judge(counted, model, lang, source).where(F.col("kept") & (F.col(BARRIER) >= 0)).select("row.*")
