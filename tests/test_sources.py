"""Reports and logs as their writers leave them."""

from __future__ import annotations

import ast
import json

import pytest

from flowloom.sources.logs import LOG_SCHEMAS, as_schema, further_columns, scan_json
from flowloom.sources.reports import literal_to_json, parse_reports


def test_report_text_inside_quotes_is_kept(spark):
    line = r"""{'query': 'x, None, y', 'query_date': "it's True", 'positives': 1, 'total': 2, 'scans': {'A': {'detected': 1, 'result': '\x41\\x41'}, 'B': {'detected': False, 'result': None}}}"""
    row = parse_reports(spark.createDataFrame([(line,)], "value string")).first()
    assert (row.fqdn, row.date) == ("x, None, y", "it's True")
    assert [tuple(v) for v in row.verdicts] == [("a", 1, r"A\x41"), ("b", 0, "None")]


def test_unlisted_columns_are_kept_when_asked_for(spark, tmp_path):
    path = str(tmp_path / "log.json")
    with open(path, "w") as f:
        f.write(json.dumps({"uid": "u", "ts": 1.5, "id.orig_h": "a", "referrer": "r", "n.x": 3}))
    wide = further_columns(spark, [path], as_schema(LOG_SCHEMAS["http"]))
    row = scan_json(spark, [path], wide).first()
    assert (row.uid, row.id_orig_h, row.referrer, row.n_x) == ("u", "a", "r", 3)


LITERALS = [
    r"{'a': 'x\101y\x41A\U0001F600\0\377\777'}",
    r"""{'a': '\a\v\b\f\n\r\t\\\'\"\q'}""",
    r"""{u'a': U'uni', 'b': r'\d\'"'}""",
    r"""{'a': 'one' "two"  r'\three', 'b' 'c': 1,}""",
    "[1, 2.5, -3, None, True, False, [], {}, ]",
    """{'a': ' , }', "b": ",]", 'c': '" "', 'd': " ' ", 'e': '', 'f': "" '',}""",
    "{'a': 'tab\there \x01\x02', }",
    """{'a': \'\'\'it's "so" ''\'\'\', 'b': \"\"\"a\\n"b" \"\"\", 'c': \'\'\'\'\'\'}""",
    "{'a': 'None True', 'b': \"None\", 'c': 'é漢😀'}",
    r"'\\' '\\'",
    "{'a' : {'b':[{'c':'d'} , ] , } , }",
    "{'a': '" + r"long \x41 \'x\' " * 3000 + "'}",
    "{'a': '" + "long text " * 20_000 + "'}",
]


@pytest.mark.filterwarnings("ignore:.*escape sequence")
def test_literals_become_json(spark):
    df = spark.createDataFrame(list(enumerate(LITERALS)), "i long, value string")
    got = {r.i: r.j for r in df.select("i", literal_to_json("value").alias("j")).collect()}
    for i, text in enumerate(LITERALS):
        assert json.loads(got[i], strict=False) == ast.literal_eval(text), text


def test_reports_that_are_no_literals_are_dropped(spark):
    line = "{'query': 'q', 'query_date': 'd', 'positives': 1, 'total': 2, 'scans': {'A': {'detected': %s, 'result': %s}}}"
    bad = [("true", "'x'"), ("1", r"'\x4'"), ("1", r"'\U00110000'"), ("1", "'x"), ("1", "null"), ("1", r"'\N{DASH}'")]
    df = spark.createDataFrame([(line % b,) for b in bad] + [("",), (None,), (line % ("True", "'x'"),)], "value string")
    assert [tuple(r.verdicts[0]) for r in parse_reports(df).collect()] == [("a", 1, "x")]
