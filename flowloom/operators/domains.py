"""Registered domains by a table of public suffixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.nets import is_ip
from flowloom.functions.text import request_host


def _ask(rule: Column, exception: int, take: Column) -> Column:
    return F.struct(rule.alias("_rule"), F.lit(exception).alias("_exception"), take.alias("_take"))


def split_hosts(df: DataFrame, host: str, suffixes: DataFrame, rule: str = "suffix") -> DataFrame:
    """Distinct hosts with ``subdomain``, ``domain`` and ``suffix``.

    Rules are plain (``co.uk``), wildcards (``*.ck``) or exceptions (``!www.ck``); the longest wins, an
    exception beats all. A host without a listed suffix, or an address, has the suffix ''. Each host
    asks for its own endings by equi join, so the rule table may have any size.
    """
    names = (
        df.select(F.col(host).alias("_host"))
        .where(F.col("_host").isNotNull())
        .distinct()
        .withColumn("_name", request_host("_host"))
        .withColumn("_ip", is_ip("_name") == 1)
        .withColumn("_labels", F.when(F.col("_ip"), F.array("_name")).otherwise(F.split("_name", r"\.")))
    )
    size = F.size("_labels")
    ending = F.lower(F.concat_ws(".", F.slice("_labels", size - F.col("_len") + 1, F.col("_len"))))
    parent = F.lower(F.concat_ws(".", F.slice("_labels", size - F.col("_len") + 2, F.col("_len"))))
    asked = (
        names.withColumn("_len", F.explode(F.sequence(F.lit(1), size)))
        .withColumn(
            "_ask",
            F.explode(
                F.array(
                    _ask(ending, 0, F.col("_len")),
                    _ask(F.concat(F.lit("*."), parent), 0, F.col("_len")),
                    _ask(F.concat(F.lit("!"), ending), 1, F.col("_len") - 1),
                )
            ),
        )
        .select("_host", "_labels", "_ip", "_ask.*")
    )
    rules = suffixes.select(F.lower(F.col(rule)).alias("_rule")).distinct().withColumn("_hit", F.lit(1))
    hit = F.col("_hit").isNotNull() & ~F.col("_ip")
    best = (
        asked.join(rules, "_rule", "left")
        .groupBy("_host", "_labels")
        .agg(F.max(F.when(hit, F.struct("_exception", "_take"))).alias("_best"))
    )
    take = F.coalesce(F.col("_best._take"), F.lit(0))
    body = F.greatest(size - take, F.lit(0))
    return best.select(
        F.col("_host").alias(host),
        F.concat_ws(".", F.slice("_labels", F.lit(1), F.greatest(body - 1, F.lit(0)))).alias("subdomain"),
        F.when(body > 0, F.get("_labels", body - 1)).otherwise("").alias("domain"),
        F.concat_ws(".", F.slice("_labels", body + 1, F.greatest(take, F.lit(0)))).alias("suffix"),
    )


def with_domain(df: DataFrame, host: str, suffixes: DataFrame, rule: str = "suffix") -> DataFrame:
    """Add ``<host>_subdomain`` and ``<host>_domain``; ``missing`` for a NULL host."""
    parts = split_hosts(df, host, suffixes, rule).select(
        host, F.col("subdomain").alias(f"{host}_subdomain"), F.col("domain").alias(f"{host}_domain")
    )
    return df.join(parts, host, "left").fillna("missing", [f"{host}_subdomain", f"{host}_domain"])


def with_registered_domains(
    df: DataFrame, names: str, suffixes: DataFrame, out: str = "domain_suffix_from_sandns", rule: str = "suffix"
) -> DataFrame:
    """Distinct ``domain.suffix`` of a list of host names; an empty list for NULL.

    Equal lists are worked out once and joined back by the list itself.
    """
    lists = df.select(F.col(names).alias("_names")).where(F.size("_names") > 0).distinct()
    single = lists.select("_names", F.explode(F.array_distinct("_names")).alias("_one"))
    parts = split_hosts(single, "_one", suffixes, rule)
    sets = (
        single.join(parts, "_one")
        .groupBy("_names")
        .agg(F.array_sort(F.collect_set(F.concat("domain", F.lit("."), "suffix"))).alias(out))
    )
    empty = F.array().cast("array<string>")
    return (
        df.join(sets, F.col(names) == F.col("_names"), "left")
        .drop("_names")
        .withColumn(out, F.coalesce(out, empty))
    )
