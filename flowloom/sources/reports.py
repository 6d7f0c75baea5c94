"""Reputation reports: one Python-literal dict per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators.tables import keep_one
from flowloom.plans.slots import Slot, moment_lit

REPORT = (
    "query string, query_date string, positives int, total int, "
    "scans map<string, struct<detected: string, result: string>>"
)

# A quoted string with its prefix and escapes, a word, text between them, or a quote that is never closed.
_STRING = (
    r"""(?:[uU]|[rR])?(?:\'\'\'(?:[^'\\]|\\.|'(?!''))*+\'\'\'|\"\"\"(?:[^"\\]|\\.|"(?!""))*+\"\"\""""
    r"""|'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")"""
)
_PIECE = rf"""(?s)({_STRING}|[A-Za-z_]\w*+|[^'"A-Za-z_]++|['"])"""
# One escape, or text without any.
_UNIT = r"(?s)(\\[0-7]{1,3}|\\x[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]++)"
# Stand for the quotes of strings until adjacent strings are joined; inside strings they are written as escapes.
_OPEN, _CLOSE = "\x01", "\x02"


def _unicode(code: Column) -> Column:
    """JSON's escape of a code point, which is two above the basic plane; no valid one for what is no code point."""
    four = lambda c: F.concat(F.lit("\\u"), F.lpad(F.hex(c), 4, "0"))
    above = code - 0x10000
    pair = F.concat(four(F.shiftright(above, 10) + 0xD800), four(above.bitwiseAND(F.lit(0x3FF)) + 0xDC00))
    return F.when(code < 0x10000, four(code)).when(code <= 0x10FFFF, pair).otherwise(F.lit("\\?"))


def _plain(text: Column) -> Column:
    """Text without escapes as it stands in a JSON string."""
    for raw in ("\\", '"', _OPEN, _CLOSE):
        text = F.replace(text, F.lit(raw), F.lit("\\\\" if raw == "\\" else f"\\u{ord(raw):04x}"))
    return text


def _unit(unit: Column) -> Column:
    kind, digits = F.substring(unit, 2, 1), F.substring(unit, 3, 8)
    return (
        F.when(~F.startswith(unit, F.lit("\\")), _plain(unit))
        .when(kind.between("0", "7"), _unicode(F.conv(F.substring(unit, 2, 3), 8, 10).cast("long")))
        .when(kind.isin("x", "u", "U") & (F.length(unit) > 2), _unicode(F.conv(digits, 16, 10).cast("long")))
        .when(kind.isin("n", "r", "t", "b", "f", "\\"), unit)
        .when(kind == "a", F.lit("\\u0007")).when(kind == "v", F.lit("\\u000b"))
        .when(kind == "'", kind).when(kind == '"', F.lit("\\u0022"))
        # Unfinished, these are errors; before others the backslash stays.
        .when(kind.isin("x", "u", "U", "N"), F.lit("\\?"))
        .otherwise(_plain(unit))
    )


def _string(piece: Column) -> Column:
    marks = F.regexp_extract(piece, r"""^([uUrR]?)('{3}|"{3}|.)""", 2)
    prefix = F.length(F.regexp_extract(piece, "^([uUrR]?)", 1))
    edge = F.length(marks)
    body = F.substring(piece, prefix + edge + 1, F.length(piece) - prefix - 2 * edge)
    escaped = F.array_join(F.transform(F.regexp_extract_all(body, F.lit(_UNIT), F.lit(1)), _unit), "")
    easy = ~F.contains(body, F.lit("\\")) | F.lower(F.substring(piece, 1, 1)).eqNullSafe("r")
    return F.concat(F.lit(_OPEN), F.when(easy, _plain(body)).otherwise(escaped), F.lit(_CLOSE))


def literal_to_json(text: str | Column) -> Column:
    """The JSON of a literal of dicts, lists, strings, numbers, None, True and False.

    Strings may have any quotes, a prefix u or r, all escapes but named characters (``\\N{...}``, which make the line
    unreadable), and stand side by side; the last item of a dict or list may be followed by a comma.
    """
    text = F.col(text) if isinstance(text, str) else text

    def translated(piece: Column) -> Column:
        return (
            F.when(piece.rlike(r"^[uUrR]?['\"](?s:.)"), _string(piece))
            .when(piece == "None", "null").when(piece == "True", "true").when(piece == "False", "false")
            # Words that only JSON has make the line unreadable.
            .when(piece.isin("null", "true", "false"), F.concat(F.lit("?"), piece))
            .otherwise(F.regexp_replace(piece, r",(\s*[}\]])", "$1"))
        )

    joined = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(1)), translated), "")
    return F.translate(F.regexp_replace(joined, rf"{_CLOSE}\s*{_OPEN}", ""), _OPEN + _CLOSE, '""')


def _verdict(detected: Column) -> Column:
    """1 or 0 of a truth value or a whole number."""
    truth = F.when(F.lower(detected) == "true", 1).when(F.lower(detected) == "false", 0)
    return F.coalesce(truth, detected.try_cast("int"))


def vendor_name(name: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.lower(F.regexp_replace(name, r"[^\p{L}\p{N}]", ""))


def parse_reports(lines: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """``fqdn, date, positives, total, verdicts`` per readable line.

    ``verdicts`` lists (vendor, detected, result). ``strict`` also drops incomplete and all-clean reports
    and keeps one report per host.
    """
    options = {"allowUnescapedControlChars": "true", "allowSingleQuotes": "false"}
    report = lines.select(F.from_json(literal_to_json(value), REPORT, options).alias("r")).select("r.*")
    entries = F.map_entries("scans")
    readable = F.col("scans").isNotNull() & F.forall(entries, lambda e: _verdict(e["value"]["detected"]).isNotNull())
    verdicts = F.transform(
        entries,
        lambda e: F.struct(
            vendor_name(e["key"]).alias("vendor"),
            _verdict(e["value"]["detected"]).alias("detected"),
            F.coalesce(e["value"]["result"], F.lit("None")).alias("result"),
        ),
    )
    reports = report.where(readable).select(
        F.col("query").alias("fqdn"), F.col("query_date").alias("date"), "positives", "total", verdicts.alias("verdicts")
    )
    if not strict:
        return reports
    complete = F.col("fqdn").isNotNull() & F.col("date").isNotNull()
    complete &= F.col("positives").isNotNull() & F.col("total").isNotNull()
    flagged = F.exists("verdicts", lambda v: v["detected"] != 0)
    return keep_one(reports.where(complete & flagged), ["fqdn"], ["date"])


def vendors_of(reports: DataFrame) -> list[str]:
    """Sorted vendor names: the column names of the pivoted table, so the driver holds as many as there are columns."""
    names = reports.select(F.explode("verdicts.vendor").alias("vendor")).distinct().collect()
    return sorted(r.vendor for r in names)


def _is_vendor(name: str):
    return lambda verdict: verdict["vendor"] == name


def pivot_verdicts(reports: DataFrame, vendors: Sequence[str] | None = None) -> DataFrame:
    """Columns ``<vendor>_detected`` and ``<vendor>_result``; NULL where a vendor did not answer."""
    vendors = vendors_of(reports) if vendors is None else vendors
    cols = []
    for v in vendors:
        last = F.try_element_at(F.filter("verdicts", _is_vendor(v)), F.lit(-1))
        cols += [last["detected"].alias(f"{v}_detected"), last["result"].alias(f"{v}_result")]
    return reports.select("fqdn", "date", "positives", "total", *cols)


def section_average(
    items: DataFrame, keys: Sequence[str], positives: str = "positives", total: str = "total"
) -> DataFrame:
    """Mean detections and scans per report section to one digit; 0 when no item has detections."""
    none = F.count(positives) == 0
    mean = lambda c: F.when(none, F.lit(0.0)).otherwise(F.bround(F.sum(c) / F.count(F.lit(1)), 1))
    return items.groupBy(*keys).agg(mean(positives).alias("positives"), mean(total).alias("total"))


class ReportLoader:
    """All report files ``root/<type>/<date>/*``, whatever their date, for any slot asked for."""

    def __init__(self, kind: str = "virustotal", vendors: Sequence[str] | None = None, strict: bool = False):
        self.kind = kind
        self.vendors = vendors
        self.strict = strict

    def path(self, root: str, slot: Slot) -> str:
        return f"{root}/{self.kind}"

    def read(self, spark: SparkSession, root: str, slots: list[Slot]) -> DataFrame:
        lines = spark.read.text(f"{root}/{self.kind}/*/*")
        wide = pivot_verdicts(parse_reports(lines, strict=self.strict), self.vendors)
        return wide.withColumn("slot_start", F.explode(F.array(*[moment_lit(s) for s, _ in slots])))

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [], "fqdn string, date string, positives int, total int, slot_start timestamp"
        )
