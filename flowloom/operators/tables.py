"""Row-set operators: unions on common columns, trims, one row per key, top-k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_columns(frames: Sequence[DataFrame]) -> list[str]:
    shared = set(frames[0].columns).intersection(*[set(f.columns) for f in frames[1:]])
    return [c for c in frames[0].columns if c in shared]


def concat_common(*frames: DataFrame) -> DataFrame:
    """Bag union on the columns all frames share."""
    if not frames:
        raise ValueError("nothing to concatenate")
    cols = common_columns(frames)
    return reduce(DataFrame.unionByName, [f.select(*cols) for f in frames])


def concat_all(*frames: DataFrame) -> DataFrame:
    """Bag union on all columns; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def has_columns(df: DataFrame, cols: Sequence[str] | None) -> bool:
    return cols is None or set(cols) <= set(df.columns)


def trim_columns(df: DataFrame, cols: Sequence[str] | None) -> DataFrame:
    """Keep ``cols``; the same set keeps the frame's own order, an absent column is an error."""
    if cols is None or set(cols) == set(df.columns):
        return df
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the frame: {absent}")
    return df.select(*cols)


def drop_arrays(df: DataFrame) -> DataFrame:
    """Without the list-typed columns."""
    return df.select(*[f.name for f in df.schema.fields if not isinstance(f.dataType, T.ArrayType)])


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the other columns.

    An aggregate rather than a window, so a hot key is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    body = [*order, *rest]
    if not body:
        return df.dropDuplicates(list(keys))
    picked = df.groupBy(*keys).agg(F.min(F.struct(*body)).alias("_row"))
    fields = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return picked.select(*fields)


def top_k(
    df: DataFrame, score: str, cols: Sequence[str] = (), k: int = 42, ties: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` rows with the highest score; NULL scores come last."""
    top = df.orderBy(F.col(score).desc_nulls_last(), *[F.col(c) for c in ties]).limit(k)
    if not cols:
        return top
    shown = list(cols)
    return top.select(*(shown if score in shown else [score, *shown]))
