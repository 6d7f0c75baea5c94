"""Address expressions: literal tests, integer form, subnet index, endpoint roles."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowloom.functions.text import _col

# Site subnets in index order (shorter prefixes first).
SITE_SUBNETS = (
    "99.120.0.0/13", "99.196.0.0/14", "99.88.0.0/15", "99.68.0.0/15", "99.116.0.0/15",
    "151.229.0.0/16", "181.230.0.0/16", "151.235.0.0/16", "151.227.0.0/16", "151.238.0.0/16",
    "151.230.0.0/16", "151.234.0.0/16", "151.236.0.0/16", "186.31.192.0/17", "193.32.0.0/18",
    "151.237.64.0/18", "186.31.0.0/18", "151.237.192.0/18", "151.237.128.0/18", "186.31.64.0/18",
    "151.228.192.0/19", "193.32.96.0/19", "193.32.192.0/20", "193.32.208.0/21", "151.228.240.0/22",
    "181.230.6.0/23",
)

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def _v6_pattern() -> str:
    group = "[0-9A-Fa-f]{1,4}"
    forms = [rf"(?:{group}:){{7}}{group}", rf"(?:{group}:){{6}}{_V4}"]
    # ``left`` groups, then '::', then at most the groups that still fit.
    for left in range(8):
        head = rf"{group}(?::{group}){{{left - 1}}}" if left else ""
        room = 7 - left
        tails = []
        if room > 0:
            tails.append(rf"{group}(?::{group}){{0,{room - 1}}}")
        if room > 1:
            tails.append(rf"(?:{group}:){{0,{room - 2}}}{_V4}")
        tail = f"(?:{'|'.join(tails)})?" if tails else ""
        forms.append(f"{head}::{tail}")
    return rf"(?:{'|'.join(forms)})(?:%[^%/]+)?"


IPV4_PATTERN = rf"\A{_V4}\z"
IP_PATTERN = rf"\A(?:{_V4}|{_v6_pattern()})\z"


def is_ip(text: str | Column) -> Column:
    """1 for an IPv4 or IPv6 literal, else 0."""
    return F.coalesce(_col(text).rlike(IP_PATTERN), F.lit(False)).cast("int")


def ip_to_long(ip: str | Column) -> Column:
    """Integer value of a dotted IPv4 address, NULL when malformed."""
    ip = _col(ip)
    octets = F.when(ip.rlike(IPV4_PATTERN), F.split(ip, r"\."))
    return F.aggregate(octets, F.lit(0).cast("long"), lambda total, part: total * 256 + part.try_cast("long"))


def subnet_index(ip: str | Column, subnets: tuple[str, ...] = SITE_SUBNETS) -> Column:
    """Index of the last listed IPv4 block holding the address, -1 for none.

    A literal list, so it costs neither a join nor a shuffle; long lists belong in a table (range_lookup).
    """
    # A block may be written with host bits set; its prefix counts.
    blocks = [ipaddress.ip_network(s, strict=False) for s in subnets]

    def last_holding(address: Column) -> Column:
        found = F.lit(-1)
        # Later blocks win, so they are asked first.
        for i, block in enumerate(blocks):
            low, high = int(block.network_address), int(block.broadcast_address)
            found = F.when(address.between(low, high), F.lit(i)).otherwise(found)
        return found

    # The one-element array binds the address, which is then worked out once and not per block.
    return F.get(F.transform(F.array(ip_to_long(ip)), last_holding), F.lit(0))


def internal_ip(anon_orig: str | Column, orig: str | Column, resp: str | Column) -> Column:
    """Originator unless its site tag is ``none``; a NULL tag counts as internal."""
    return F.when(_col(anon_orig).cast("string").eqNullSafe(F.lit("none")), _col(resp)).otherwise(_col(orig))


def external_ip(anon_orig: str | Column, orig: str | Column, resp: str | Column) -> Column:
    """The endpoint that :func:`internal_ip` does not pick."""
    return F.when(_col(anon_orig).cast("string").eqNullSafe(F.lit("none")), _col(orig)).otherwise(_col(resp))
