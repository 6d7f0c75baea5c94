"""Quality rules as robust multivariate outliers, in DataFrame operations only.

Each text becomes a vector of transformed statistics. For every language and source the minimum-covariance-determinant
estimate of centre and scatter is sought from three deterministic starts around the medians (see ``_starts``) by
concentration steps: the share H of the group's rows with the smallest distances gives the next mean and covariance. After
FIRST_STEPS steps the start of least determinant goes on for STEPS more. The covariance is scaled to be consistent for
normal data and a text is rejected if its squared Mahalanobis distance exceeds CUTOFF.

All texts of all groups go into one grouped aggregate a step (map-side sums), so a hot source costs no more than others.
Quantiles are exact counts over fine bins, at most some ten thousand a group, so they do not depend on the partitioning.
Every group's moments are drawn to those of its language, which count as PRIOR rows, and these to those of all: a source of
a few rows is judged by its language, a large one by itself, with no size at which the rule changes. FLOOR is added to each
variance: statistics that are constant in a group, such as the share of symbols, have no scatter of their own.

Defined cases: a null or empty text has zeros everywhere and fails the base rules. Null language and source are the group of
the empty name. Repeated rows are judged equally and all count. An empty table gives no rows. Other columns are carried.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.common import GAP, packed, staged, unpacked, words_of

STATISTICS = ("x_length", "x_word", "x_symbols", "x_lines", "x_repeats")
#: Standard deviations that are always allowed for, by statistic.
FLOOR = (0.6, 0.3, 0.05, 0.2, 0.12)
H = 0.75
FIRST_STEPS, STEPS = 2, 2
#: Rows that the moments of the language count in those of a source, and those of all in those of a language.
PRIOR = 50.0
#: Bins of a unit of a statistic, and of a doubling of a squared distance.
RESOLUTION, RINGS = 1024, 64
#: The 0.99999 quantile of chi-squared with five degrees of freedom, and the consistency factor of H = 0.75 there.
CUTOFF = 30.86
CONSISTENCY = 1.57
_P = range(len(STATISTICS))
_PAIRS = [(i, j) for i in _P for j in range(i + 1)]


def statistics(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text; see ``repeated_words`` for the last."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "words": words_of(text),
        "word_chars": F.length(F.regexp_replace(whole, GAP, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(whole, r"[^#*$%&|<>]", "")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def repeated_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``words``: the words that lie in a 3-word window found twice or more in the text.

    Windows are 64-bit hashes; sorting them with their places puts equal ones side by side. Each step has a column of its own
    that is read more than once or explodes nothing, and works in n log n.
    """
    shifted = F.arrays_zip(F.col("words").alias("a"), F.expr("slice(words, 2, greatest(size(words) - 1, 0))").alias("b"), F.expr("slice(words, 3, greatest(size(words) - 2, 0))").alias("c"))
    hashes = F.transform(F.slice(shifted, F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))), lambda t: F.xxhash64(t["a"], t["b"], t["c"]))
    df = df.withColumn("hashes", hashes)
    placed = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Most texts repeat no window and stop here.
    df = df.withColumn("placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed).otherwise(F.expr("array()").cast("array<struct<h:bigint,i:int>>")))
    n = F.size("placed")
    missing = F.lit(None).cast("struct<h:bigint,i:int>")
    sides = F.arrays_zip(
        F.col("placed").alias("own"),
        F.concat(F.array(missing), F.slice("placed", F.lit(1), F.greatest(n - 1, F.lit(0)))).alias("before"),
        F.slice("placed", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("after"),
    )
    again = F.filter(sides, lambda s: (s["own"]["h"] == s["before"]["h"]) | (s["own"]["h"] == s["after"]["h"]))
    places = F.sort_array(F.transform(again, lambda s: s["own"]["i"]))
    df = df.withColumn("places", F.when(n > 0, places).otherwise(F.expr("array()").cast("array<int>")))
    # A window covers three words, less where the next one begins sooner.
    gaps = F.zip_with("places", F.slice("places", F.lit(2), F.greatest(F.size("places"), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)
    return df.withColumn("n_repeat_words", covered).drop("hashes", "placed", "places")


def vector(df: DataFrame) -> DataFrame:
    """The transformed statistics beside the counts they are made of."""
    share = lambda part, of: F.col(part) / F.greatest(F.col(of), F.lit(1))
    values = (
        F.log1p("n_words"), F.log1p(share("word_chars", "n_words")), F.sqrt(share("n_symbols", "word_chars")),
        F.sqrt(share("n_dup_lines", "n_lines")), F.sqrt(share("n_repeat_words", "n_words")),
    )
    return df.select("*", *[v.alias(c) for c, v in zip(STATISTICS, values)])


def _bins(rows: DataFrame, keys: list[str], value: Column, share: float) -> DataFrame:
    """The bin that a group's ``share`` quantile of ``value`` (a bin number) lies in, as ``limit``: counts of bins, no sketch."""
    counts = rows.groupBy(*keys, value.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*keys)
    upto = counts.select(*keys, "bin", F.sum("n").over(group.orderBy("bin")).alias("upto"), F.sum("n").over(group).alias("total"))
    return upto.where(F.col("upto") >= share * F.col("total")).groupBy(*keys).agg(F.min("bin").alias("limit"))


def _medians(rows: DataFrame, values: list[Column], out: str) -> DataFrame:
    """Medians of each group's values as <out>_0, <out>_1, ..., to 1 / RESOLUTION."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.round(v * RESOLUTION).cast("long").alias("at")) for i, v in enumerate(values)]))
    long = rows.select("lang", "source", each.alias("e")).select("lang", "source", "e.i", "e.at")
    found = _bins(long, ["lang", "source", "i"], F.col("at"), 0.5)
    return found.groupBy("lang", "source").agg(*[F.max(F.when(F.col("i") == i, F.col("limit") / RESOLUTION)).alias(f"{out}_{i}") for i in range(len(values))])


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """n, means (m_i) and covariances (s_i_j, i >= j) of the groups' rows, rounded so that the order of sums does not show."""
    sums = [F.count(F.lit(1)).alias("n"), *[F.round(F.avg(STATISTICS[i]), 9).alias(f"m_{i}") for i in _P]]
    return rows.groupBy(*keys).agg(*sums, *[F.round(F.covar_pop(STATISTICS[i], STATISTICS[j]), 9).alias(f"s_{i}_{j}") for i, j in _PAIRS])


def _starts(rows: DataFrame) -> DataFrame:
    """Moments to start from, by lang, source and start: medians with deviations alone (0), with correlations of the
    hyperbolic tangents of the standardised values (1), and with those of their spatial signs (2)."""
    medians = staged(_medians(rows, [F.col(c) for c in STATISTICS], "m"), "medians")
    near = rows.join(medians, ["lang", "source"])
    deviations = _medians(near, [F.abs(F.col(c) - F.col(f"m_{i}")) for i, c in enumerate(STATISTICS)], "v")
    known = staged(medians.join(deviations, ["lang", "source"]), "deviations")
    z = rows.join(known, ["lang", "source"])
    z = z.select("*", *[((F.col(c) - F.col(f"m_{i}")) / F.sqrt(F.pow(1.4826 * F.col(f"v_{i}"), 2) + FLOOR[i] ** 2)).alias(f"z_{i}") for i, c in enumerate(STATISTICS)])
    size = F.greatest(F.sqrt(sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in _P), F.lit(0.0))), F.lit(1e-9))
    z = z.select("lang", "source", *[F.tanh(f"z_{i}").alias(f"t_{i}") for i in _P], *[(F.col(f"z_{i}") / size).alias(f"u_{i}") for i in _P])
    sums = [F.count(F.lit(1)).alias("n"), *[F.avg(F.col(f"u_{i}") * F.col(f"u_{j}")).alias(f"u_{i}_{j}") for i, j in _PAIRS]]
    sums += [F.covar_pop(f"t_{i}", f"t_{j}").alias(f"t_{i}_{j}") for i, j in _PAIRS]
    like = staged(z.groupBy("lang", "source").agg(*sums), "starts").join(known, ["lang", "source"])
    frames = []
    for start, name in enumerate(("", "t", "u")):
        values = []
        for i, j in _PAIRS:
            scale = 1.4826 * 1.4826 * F.col(f"v_{i}") * F.col(f"v_{j}")
            together = F.lit(0.0) if not name else F.coalesce(F.try_divide(F.col(f"{name}_{i}_{j}"), F.sqrt(F.col(f"{name}_{i}_{i}") * F.col(f"{name}_{j}_{j}"))), F.lit(0.0))
            values.append(F.round(scale if i == j else scale * together, 9).alias(f"s_{i}_{j}"))
        frames.append(like.select("lang", "source", F.lit(start).alias("start"), "n", *[f"m_{i}" for i in _P], *values))
    return reduce(DataFrame.union, frames)


def _pooled(moments: DataFrame, keys: list[str]) -> DataFrame:
    """The moments of unions of groups, from those of the groups."""
    n = F.sum("n")
    means = moments.groupBy(*keys).agg(
        n.alias("n"), *[(F.sum(F.col("n") * F.col(f"m_{i}")) / n).alias(f"m_{i}") for i in _P],
        *[(F.sum(F.col("n") * (F.col(f"s_{i}_{j}") + F.col(f"m_{i}") * F.col(f"m_{j}"))) / n).alias(f"s_{i}_{j}") for i, j in _PAIRS],
    )
    return means.select(*keys, "n", *[f"m_{i}" for i in _P], *[(F.col(f"s_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")).alias(f"s_{i}_{j}") for i, j in _PAIRS])


def _towards(moments: DataFrame, wider: DataFrame, keys: list[str]) -> DataFrame:
    """``moments`` drawn to those of the wider groups, which count as PRIOR rows."""
    names = [f"m_{i}" for i in _P] + [f"s_{i}_{j}" for i, j in _PAIRS]
    w = wider.select(*keys, *[F.col(c).alias(f"w_{c}") for c in names])
    own = [c for c in moments.columns if c not in names]
    return moments.join(w, keys).select(*own, *[((F.col("n") * F.col(c) + PRIOR * F.col(f"w_{c}")) / (F.col("n") + PRIOR)).alias(c) for c in names])


def _shrunk(moments: DataFrame) -> DataFrame:
    """The groups' moments drawn to those of their language, and these to those of all, at every size by the same rule."""
    by_language = _towards(_pooled(moments, ["start", "lang"]), _pooled(moments, ["start"]), ["start"])
    return _towards(moments, by_language, ["start", "lang"])


def _factors(moments: DataFrame, consistency: float) -> DataFrame:
    """Cholesky factors (l_i_j) of the scaled covariances with the floor on the diagonal, and the logarithm of their determinant."""
    df = _shrunk(moments)
    for i, j in _PAIRS:
        value = F.col(f"s_{i}_{j}") * consistency
        if i == j:
            value = value + FLOOR[i] ** 2
        for k in range(j):
            value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        df = df.withColumn(f"l_{i}_{j}", F.sqrt(value) if i == j else value / F.col(f"l_{j}_{j}"))
    spread = sum((F.log(F.col(f"l_{i}_{i}")) for i in _P), F.lit(0.0))
    names = [f"l_{i}_{j}" for i, j in _PAIRS] + [f"m_{i}" for i in _P]
    return staged(df.select("lang", "source", "start", F.round(spread, 9).alias("spread"), *names), "factors")


def _least(factors: DataFrame) -> DataFrame:
    """The start of least determinant in each group; the first of equal ones."""
    best = factors.groupBy("lang", "source").agg(F.min_by("start", F.struct("spread", "start")).alias("start"))
    return factors.join(best, ["lang", "source", "start"], "left_semi")


def _distances(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """``start`` and ``d2``: squared Mahalanobis distances, by forward substitution, once for each start of the group."""
    joined = rows.join(factors, ["lang", "source"])
    total = F.lit(0.0)
    for i in _P:
        value = F.col(STATISTICS[i]) - F.col(f"m_{i}")
        for k in range(i):
            value = value - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        joined = joined.withColumn(f"z_{i}", value / F.col(f"l_{i}_{i}"))
        total = total + F.col(f"z_{i}") * F.col(f"z_{i}")
    return joined.select(*rows.columns, "start", total.alias("d2"))


def _concentrated(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """Factors of the share H of each group's rows that are nearest by ``factors``."""
    keys = ["lang", "source", "start"]
    near = _distances(rows, factors).withColumn("bin", F.floor(F.log2(F.col("d2") + 2.0**-20) * RINGS).cast("long"))
    limits = staged(_bins(near, keys, F.col("bin"), H), "limits")
    within = near.join(limits, keys).where(F.col("bin") <= F.col("limit"))
    return _factors(_moments(within, keys), CONSISTENCY)


def mcd_distances(rows: DataFrame) -> DataFrame:
    """``rows`` (lang, source, the statistics) with ``d2``, by the estimate of their group."""
    rows = staged(rows, "statistics")
    values = rows.select("lang", "source", *STATISTICS)
    factors = _factors(_starts(values), 1.0)
    for _ in range(FIRST_STEPS):
        factors = _concentrated(values, factors)
    factors = staged(_least(factors), "least")
    for _ in range(STEPS):
        factors = _concentrated(values, factors)
    return _distances(rows, factors).drop("start")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(doc_id, n_words, the base statistics, base_failed, kept, distance) for each row of ``docs``."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), name(lang_col).alias("lang"), name(source_col).alias("source"), *[v.alias(k) for k, v in statistics(F.col(text_col)).items()])
    df = repeated_words(df.withColumn("n_words", F.size("words").cast("long"))).drop("words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    done = mcd_distances(vector(df.withColumn("base_failed", failed)))
    kept = ~F.col("base_failed") & (F.col("d2") <= CUTOFF)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return done.select(*names, kept.alias("kept"), F.sqrt("d2").alias("distance"))


def keep_typical(docs: DataFrame, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """``docs`` without the rows that the rules reject; rows are joined by id, and rows that repeat an id go if any is rejected."""
    gone = judged(docs, id_col, **columns).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = packed(docs, id=id_col)
    return unpacked(rows.join(gone, rows.id.eqNullSafe(gone.gone), "left_anti"), {})
