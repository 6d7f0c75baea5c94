"""How unlikely a value is within its group, relative to the group's mean.

Group statistics are aggregated and joined back; no window ever gathers a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX = "scored_"


def discrete_score(
    df: DataFrame, field: str, group: Sequence[str], out: str | None = None, source: DataFrame | None = None
) -> DataFrame:
    """-ln of the Laplace-smoothed frequency within the group, over its mean; NULL counts as unseen.

    ``source`` has the rows to count, if ``df`` is a costlier form of them.
    """
    out = out or f"{PREFIX}{field}"
    keys = [f"_g{i}" for i in range(len(group))]
    named = (df if source is None else source).select(
        *[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(field).alias("_v")
    )
    cells = named.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_rows"))
    sizes = cells.groupBy(*keys).agg(
        F.sum("_rows").alias("_total"), F.count("_v").alias("_distinct"),
        # The sum of rows * ln(rows + 1) gives the group's mean score without a second pass.
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_rows") * F.log(F.col("_rows") + 1))).alias("_logs"),
    )
    spread = F.log(F.col("_total") + F.col("_distinct"))
    raw = spread - F.log(F.when(F.col("_v").isNull(), F.lit(0)).otherwise(F.col("_rows")) + 1)
    mean = spread - F.coalesce(F.col("_logs"), F.lit(0.0)) / F.col("_total")
    match = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    scored = (
        cells.alias("c").join(sizes.alias("s"), _all(match))
        .select(*[F.col(f"c.{k}") for k in keys], "_v", F.try_divide(raw, mean).alias(out))
    )
    back = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(group, keys)] + [F.col(field).eqNullSafe(F.col("_v"))]
    return df.join(scored, _all(back), "left").drop(*keys, "_v")


def continuous_scores(
    df: DataFrame, fields: dict[str, str], group: Sequence[str], log_residual: bool = True,
    source: DataFrame | None = None,
) -> DataFrame:
    """Normal negative log-likelihood of ln(1+x) within the group, over its mean; 1.0 without variance.

    ``fields`` names each field's output; they share one aggregate and one join. With ``log_residual``
    false the residual is taken from the raw value.
    """
    keys = [f"_g{i}" for i in range(len(group))]
    aggs = []
    for i, field in enumerate(fields):
        x = F.col(field).cast("double")
        aggs += [F.avg(F.log1p(x)).alias(f"_mean{i}"), F.var_pop(F.log1p(x)).alias(f"_var{i}")]
        if not log_residual:
            aggs += [F.avg(x).alias(f"_raw_mean{i}"), F.var_pop(x).alias(f"_raw_var{i}")]
    stats = (df if source is None else source).groupBy(*[F.col(g).alias(k) for g, k in zip(group, keys)]).agg(*aggs)
    joined = df.join(stats, _all([F.col(g).eqNullSafe(F.col(k)) for g, k in zip(group, keys)]), "left")
    for i, (field, out) in enumerate(fields.items()):
        x, mean, var = F.col(field).cast("double"), F.col(f"_mean{i}"), F.col(f"_var{i}")
        base = 0.5 * F.log(2 * F.pi() * var)
        if log_residual:
            squares, mean_squares = F.pow(F.log1p(x) - mean, 2), var
        else:
            squares = F.pow(x - mean, 2)
            mean_squares = F.col(f"_raw_var{i}") + F.pow(F.col(f"_raw_mean{i}") - mean, 2)
        score = F.try_divide(
            F.try_divide(squares * 0.5, var) + base, F.try_divide(mean_squares * 0.5, var) + base
        )
        joined = joined.withColumn(out, F.when(var > 0, score).otherwise(F.lit(1.0)))
    return joined.drop(*stats.columns)


def continuous_score(
    df: DataFrame, field: str, group: Sequence[str], out: str | None = None, log_residual: bool = True
) -> DataFrame:
    """:func:`continuous_scores` of one field."""
    return continuous_scores(df, {field: out or f"{PREFIX}{field}"}, group, log_residual)


def score_groups(
    df: DataFrame, group: Sequence[str], discrete: Sequence[str] = (), continuous: Sequence[str] = (),
    description: str = "", keep_columns: bool = True, log_residual: bool = True,
) -> DataFrame:
    """Score several fields per group as ``scored_<description><field>``."""
    wanted = lambda fields: {
        f: f"{PREFIX}{description}{f}" for f in fields if f not in group and not f.startswith(PREFIX)
    }
    result = df
    for field, out in wanted(discrete).items():
        result = discrete_score(result, field, group, out, source=df)
    if wanted(continuous):
        result = continuous_scores(result, wanted(continuous), group, log_residual, source=df)
    if keep_columns:
        return result
    return result.select(*group, *wanted(discrete).values(), *wanted(continuous).values())


def _all(conditions):
    total = conditions[0]
    for c in conditions[1:]:
        total = total & c
    return total
