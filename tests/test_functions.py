import hashlib
import ipaddress
import random
from datetime import datetime, timezone

from flowloom.functions import arrays, nets, scores, text, times

DNS = [
    "CN=a,O=First,O=Second,C=US", "CN=a, O=Blank,C=US", "CN=a,O=x=y,C=US", "CN=a,C=US", None, "", "O=", "XCN=b,CN=c",
    "CN=one,CN=two\nlines,L=l,ST=s", "CN", "=,CN=z",
]


def python_field(dn, key, default=""):
    found = default
    for part in (dn or "").split(","):
        sides = part.split("=")
        if len(sides) == 2 and sides[0] == key:
            found = sides[1]
    return found


def test_dn_fields_follow_the_rule(values):
    for key in ("CN", "O", "C", "L", "ST"):
        got = values("dn string", [(d,) for d in DNS], text.dn_field("dn", key))
        assert got == [python_field(d, key) for d in DNS]
    assert values("dn string", [(d,) for d in DNS], text.dn_organisation("dn")) == [python_field(d, "O", None) for d in DNS]


def test_ca_names_are_cut_at_the_first_suffix(values):
    names = ['DigiCert Inc', 'Let\\"s "Encrypt" LLC and Co.', "Sectigo Limited", "Big Ltd Inc", "X GmbH & Co. KG", "Incident", None]
    want = []
    for n in names:
        if n is not None:
            n = n.replace("\\", "").replace('"', "")
            for s in text.LEGAL_SUFFIXES:
                n = n.split(s)[0]
        want.append(n)
    assert values("n string", [(n,) for n in names], text.normalise_ca("n")) == want


def test_cert_key_spells_null_as_none(values):
    got = values("a string, b string, c string", [("1", None, "x")], text.cert_key("a", "b", "c"))
    assert got == [hashlib.md5(b"1,None,x").hexdigest()]


def test_missing_hosts_are_labelled(values):
    rows = [("missing", "1.1.1.1"), ("", "2.2.2.2"), (None, "3.3.3.3"), ("h", "4.4.4.4")]
    assert values("h string, a string", rows, text.label_missing("h", "a")) == ["missing_1.1.1.1", "missing_2.2.2.2", None, "h"]


def test_request_host(values):
    rows = [("http://u:p@a.b.com:8080/x?y",), ("a.b.com/x",), ("//c.d/",), ("10.0.0.1:80",), ("ftp://e.f.",), (None,)]
    assert values("r string", rows, text.request_host("r")) == ["a.b.com", "a.b.com", "c.d", "10.0.0.1", "e.f", None]


def _is_ip(s):
    try:
        ipaddress.ip_address(s)
        return 1
    except ValueError:
        return 0


def test_is_ip_agrees_with_the_standard_library(values):
    texts = [
        "1.2.3.4", "01.2.3.4", "256.1.1.1", "1.2.3", "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
        "1:2:3:4:5:6:7:8:9", "1::2::3", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "fe80::1%eth0", "g::1",
        "host.example.com", "", "1.2.3.4 ", "12345::", ":1", "1:", "1:2:3:4:5:6::1.2.3.4", "1:2:3:4:5::1.2.3.4", "::1.2.3.4\n",
    ]
    rng = random.Random(5)
    for _ in range(300):
        parts = [rng.choice(["", "0", "ab", "ffff", "12345"]) for _ in range(rng.randint(2, 9))]
        texts.append(":".join(parts))
    got = values("t string", [(t,) for t in texts], nets.is_ip("t"))
    assert got == [_is_ip(t) for t in texts]


def test_subnet_index_takes_the_last_match(values):
    blocks = [ipaddress.ip_network(s, strict=False) for s in nets.SITE_SUBNETS]
    rng = random.Random(1)
    ips = [str(rng.choice(blocks)[rng.randint(0, 511)]) for _ in range(200)] + ["8.8.8.8", "193.32.200.1", "not", None]
    want = []
    for ip in ips:
        try:
            hits = [i for i, b in enumerate(blocks) if ipaddress.ip_address(ip) in b]
        except ValueError:
            hits = []
        want.append(hits[-1] if hits else -1)
    assert values("ip string", [(i,) for i in ips], nets.subnet_index("ip")) == want


def test_internal_and_external_end(values):
    rows = [("none", "o", "r"), ("site", "o", "r"), (None, "o", "r")]
    assert values("a string, o string, r string", rows, nets.internal_ip("a", "o", "r")) == ["r", "o", "o"]
    assert values("a string, o string, r string", rows, nets.external_ip("a", "o", "r")) == ["o", "r", "r"]
    flags = [(False, "o", "r"), (True, "o", "r")]
    assert values("a boolean, o string, r string", flags, nets.internal_ip("a", "o", "r")) == ["o", "o"]


def test_epoch_seconds(values):
    assert values("t double", [(1566000000.25,), (None,)], times.epoch_seconds("t")) == [1566000000.25, 0.0]
    assert values("t string", [("2019-08-22 01:02:03.5",), ("junk",)], times.epoch_seconds("t")) == [1566435723.5, 0.0]


def test_local_epoch_follows_the_zone(values):
    stamps = [datetime(2024, 1, 15, 12), datetime(2024, 7, 15, 12), datetime(2024, 3, 10, 6, 59, 59), datetime(2024, 3, 10, 7)]
    rows = [(int(s.replace(tzinfo=timezone.utc).timestamp()),) for s in stamps]
    import pyspark.sql.functions as F

    got = values("e long", rows, times.local_epoch(F.timestamp_seconds("e")))
    assert [e - g for (e,), g in zip(rows, got)] == [5 * 3600, 4 * 3600, 5 * 3600, 4 * 3600]


def test_parse_time(values):
    import pyspark.sql.functions as F

    got = values("t string", [("2019-08-06",), ("2019-08-06 00:30:00",), ("x",)], F.unix_timestamp(times.parse_time("t")))
    assert got == [1565049600, 1565051400, None]


def test_arrays(values):
    rows = [([3, 0, 1], [1, 1, 1]), (None, [1, 2, 3]), ([1, 2, 3], None), (None, None)]
    assert values("a array<int>, b array<int>", rows, arrays.add_series("a", "b")) == [[4, 1, 2], [1, 2, 3], [1, 2, 3], None]
    assert values("a array<int>, b array<int>", rows, arrays.active_bins("a")) == [2, None, 3, None]
    assert values("c array<string>", [(["x", "y"],), ([],), (None,)], arrays.first_or_blank("c")) == ["x", "", ""]


def test_scores_and_flags(values):
    names = [("malware-callback",), ("malware-object",), ("infection-match",), ("ips-event",), ("scan",), (None,)]
    assert values("e string", names, scores.alert_score("e")) == [1.0, 0.01, 0.009, 0.008, 0.0, 0.0]
    assert values("p int, t int", [(1, 4), (1, 0), (None, None)], scores.detection_ratio("p", "t")) == [0.25, 0.0, 0.0]
    assert values("f string", [("T",), ("F",), ("1",), ("true",), ("-",), (None,)], scores.as_flag("f")) == [True, False, True, True, None, None]
    assert values("s string", [("RSTO",), ("RSTOS0",), ("RSTRH",)], scores.is_established("s")) == [True, False, False]
