"""Score and predicate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowloom.functions.text import _col

# Alert types of interest with their score.
ALERT_SCORES = {
    "malware-callback": 1.0,
    "malware-object": 0.01,
    "infection-match": 0.009,
    "ips-event": 0.008,
}

# Connection states that count as established.
ESTABLISHED_STATES = ("SF", "S1", "S2", "S3", "RSTO", "RSTR")


def alert_score(event: str | Column, scores: dict[str, float] = ALERT_SCORES) -> Column:
    event = _col(event)
    score = F.lit(0.0)
    for name, value in scores.items():
        score = F.when(event == name, F.lit(value)).otherwise(score)
    return score


def is_scored_alert(event: str | Column, scores: dict[str, float] = ALERT_SCORES) -> Column:
    return _col(event).isin(*scores)


def is_established(state: str | Column) -> Column:
    return _col(state).isin(*ESTABLISHED_STATES)


def detection_ratio(positives: str | Column, total: str | Column) -> Column:
    """positives / total; 0 when the total is 0 or unknown."""
    total = _col(total)
    return F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(0.0)).otherwise(_col(positives) / total)


def as_flag(c: str | Column) -> Column:
    """Boolean of a flag logged as boolean, ``T``/``F``, ``1``/``0`` or ``true``/``false``."""
    text = F.lower(_col(c).cast("string"))
    return F.when(text.isin("t", "true", "1"), F.lit(True)).when(text.isin("f", "false", "0"), F.lit(False))
