"""Labels and scores per connection, host or alert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.scores import alert_score, as_flag, is_established, is_scored_alert
from flowloom.functions.text import request_host

TUPLE = ("id_orig_h", "id_resp_h", "id_resp_p")


def without_partner(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def with_partner(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def ssl_mismatch_label(
    ssl: DataFrame, conn: DataFrame, uid: str = "uid", ts: str = "ts", keys: Sequence[str] = TUPLE,
    port: str = "id_resp_p", state: str = "conn_state", established: str = "established",
    tls_port: int = 443, by: Sequence[str] = (),
) -> DataFrame:
    """Label 0 to 5 per connection.

    0 another port; for established connections on the TLS port: 1 TLS succeeded, 2 TLS failed but a
    sibling (same endpoints and port) succeeded, 3 failed without such a sibling, 4 no TLS but a sibling
    has some, 5 no TLS and no such sibling. Sibling facts are aggregated per tuple, not windowed.
    """
    on_port = F.coalesce(F.col(port) == tls_port, F.lit(False))
    other_port = conn.where(~on_port).select(*by, ts, uid, F.lit(0).alias("label"))
    tls = conn.where(on_port & is_established(state)).select(*by, ts, uid, *keys)
    facts = ssl.select(*by, uid, as_flag(established).alias("_ok"), F.lit(True).alias("_ssl"))
    pairs = tls.join(facts, [*by, uid], "left")
    # Tuples without TLS may stay or go. The test keeps the time in use, so that both uses of the pairs are
    # alike and share the exchanges below their join.
    shared = [*by, *keys]
    siblings = (
        pairs.groupBy(*[F.col(k).alias(f"_{k}") for k in shared])
        .agg(F.max("_ssl").alias("_any_ssl"), F.max("_ok").alias("_any_ok"), F.max(ts).alias("_last"))
        .where(F.col("_any_ssl") | F.col("_last").isNotNull())
        .drop("_last")
    )
    label = (
        F.when(F.col("_ssl").isNull(), F.when(F.col("_any_ssl"), 4).otherwise(5))
        .when(F.col("_ok"), 1)
        .when(~F.col("_ok"), F.when(F.col("_any_ok"), 2).otherwise(3))
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in shared])
    labelled = pairs.join(siblings, same, "left").select(*by, ts, uid, label.alias("label"))
    return other_port.unionByName(labelled.where(F.col("label").isNotNull()))


def alert_scores(matches: DataFrame, host: str = "host", event: str = "eventName", by: Sequence[str] = ()) -> DataFrame:
    """Host and score of every alert of a scored type."""
    return matches.where(is_scored_alert(event)).select(*by, host, alert_score(event).alias("fe_score"))


def callback_targets(
    alerts: DataFrame, event: str = "eventName", request: str = "request", kind: str = "malware-callback",
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct requests of callback alerts with their host."""
    hits = alerts.where(F.col(event) == kind)
    return hits.select(*by, F.col(request).alias("request"), request_host(request).alias("fqdn")).distinct()
