"""String expressions: distinguished names, organisation names, hosts, URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUBJECT_FIELDS = ("CN", "O", "C", "L", "ST")
ISSUER_FIELDS = ("CN", "O", "C")

# A CA organisation name is cut at the first of these legal suffixes.
LEGAL_SUFFIXES = (
    " Inc", " INC", " L.L.C.", " LLC", " llc", " Co.", " CO.", " Ltd", " Limited", " GmbH",
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dn_pattern(key: str) -> str:
    # The greedy prefix makes the last part win; a part holds exactly one '='.
    return rf"(?s)^(?:.*,)?{key}=([^=,]*)(?:,.*)?$"


def dn_field(dn: str | Column, key: str, default: str | None = "") -> Column:
    """Value of ``key`` in a comma-separated DN; keys match exactly, the last one wins."""
    dn = _col(dn)
    pattern = _dn_pattern(key)
    if default == "":
        return F.coalesce(F.regexp_extract(dn, pattern, 1), F.lit(""))
    found = F.when(dn.rlike(pattern), F.regexp_extract(dn, pattern, 1))
    return found if default is None else F.coalesce(found, F.lit(default))


def dn_subject(dn: str | Column) -> Column:
    """Struct of CN, O, C, L and ST."""
    return F.struct(*[dn_field(dn, k).alias(k) for k in SUBJECT_FIELDS])


def dn_issuer(dn: str | Column) -> Column:
    """Struct of CN, O and C."""
    return F.struct(*[dn_field(dn, k).alias(k) for k in ISSUER_FIELDS])


def dn_organisation(dn: str | Column) -> Column:
    """O of a DN, NULL when it has none."""
    return dn_field(dn, "O", default=None)


def normalise_ca(name: str | Column) -> Column:
    """CA name without backslashes, double quotes and anything from a legal suffix on."""
    plain = F.regexp_replace(_col(name), r'[\\"]', "")
    tails = "|".join(s.replace(".", r"\.") for s in LEGAL_SUFFIXES)
    return F.regexp_replace(plain, rf"(?s)(?:{tails}).*$", "")


def cert_key(serial: str | Column, issuer_cn: str | Column, subject_cn: str | Column) -> Column:
    """md5 of ``serial,issuer_CN,subject_CN``; a NULL is spelled ``None`` in the hashed text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("None")) for c in (serial, issuer_cn, subject_cn)]
    return F.md5(F.concat_ws(",", *parts))


def label_missing(host: str | Column, address: str | Column) -> Column:
    """``missing_<address>`` for a host that is blank or ``missing``; NULL stays NULL."""
    host = _col(host)
    return F.when(host.isin("missing", ""), F.concat(F.lit("missing_"), _col(address))).otherwise(host)


def request_host(request: str | Column) -> Column:
    """Host part of a request: scheme, credentials, port, path, query and fragment removed."""
    rest = F.regexp_replace(_col(request), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//", "")
    rest = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    rest = F.regexp_replace(rest, r"^.*@", "")
    return F.regexp_replace(F.regexp_replace(rest, r":\d*$", ""), r"^\.+|\.+$", "")


def uri_tokens(uri: str | Column) -> Column:
    """Pieces between slashes, blank ones included."""
    return F.split(_col(uri), "/")


def array_json(values: str | Column) -> Column:
    """JSON text of an array; NULL stays NULL."""
    return F.to_json(_col(values))
