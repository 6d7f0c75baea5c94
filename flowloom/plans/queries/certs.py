"""Certificate and domain queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.functions.text import dn_issuer, dn_organisation, dn_subject, normalise_ca, request_host
from flowloom.operators import certs, domains
from flowloom.plans.queries.bindings import CERT, CHAIN, Tables, ca_sql, dn_sql, query


@query(
    "dn_parse",
    f"""WITH {CERT} SELECT id, {', '.join(f"{dn_sql('certificate_subject', k)} AS subject_{k.lower()}" for k in ('CN', 'O', 'C', 'L', 'ST'))},
      {', '.join(f"{dn_sql('certificate_issuer', k)} AS issuer_{k.lower()}" for k in ('CN', 'O', 'C'))} FROM cert""",
)
def dn_parse(t: Tables):
    named = t.cert().select(
        "id", dn_subject("certificate_subject").alias("s"), dn_issuer("certificate_issuer").alias("i")
    )
    return named.select(
        "id", *[F.col(f"s.{k}").alias(f"subject_{k.lower()}") for k in ("CN", "O", "C", "L", "ST")],
        *[F.col(f"i.{k}").alias(f"issuer_{k.lower()}") for k in ("CN", "O", "C")],
    )


@query(
    "ca_normalise",
    f"""WITH {CERT}, o AS (SELECT id, {dn_sql('certificate_subject', 'O', 'NULL')} AS org FROM cert)
    SELECT id, org, {ca_sql('org')} AS ca FROM o""",
)
def ca_normalise(t: Tables):
    org = dn_organisation("certificate_subject")
    return t.cert().select("id", org.alias("org"), normalise_ca(org).alias("ca"))


@query(
    "cert_inventory",
    f"""WITH {CERT}, names AS (
      SELECT *, {', '.join(f"{dn_sql('certificate_issuer', k)} AS certificate_issuer_{k}" for k in ('CN', 'O', 'C'))},
        {', '.join(f"{dn_sql('certificate_subject', k)} AS certificate_subject_{k}" for k in ('CN', 'O', 'C'))}
      FROM cert WHERE id IN (SELECT l_partkey FROM lineitem))
    SELECT DISTINCT CAST(epoch(nva) AS BIGINT) AS certificate_not_valid_after_ts,
      CAST(epoch(nvb) AS BIGINT) AS certificate_not_valid_before_ts, certificate_serial,
      "certificate_issuer_CN", "certificate_issuer_O", "certificate_issuer_C",
      "certificate_subject_CN", "certificate_subject_O", "certificate_subject_C",
      CAST(epoch(nva) - epoch(nvb) AS BIGINT) AS certificate_validity_seconds,
      md5(concat(certificate_serial, ',', "certificate_issuer_CN", ',', "certificate_subject_CN")) AS hashkey,
      concat('["', san1, '","www.shop.co.uk"]') AS san_dns_json
    FROM names""",
)
def cert_inventory(t: Tables):
    """The certificate log has a row per use of a certificate."""
    uses = t.table("lineitem").select(F.col("l_partkey").alias("id"))
    return certs.cert_inventory(uses.join(t.cert(), "id"))


@query(
    "cert_validity",
    f"""WITH {CERT} SELECT l_orderkey AS uid, id, l_shipdate < nvb AS cert_not_yet_valid, l_shipdate > nva AS cert_expired,
      date_diff('day', CAST(nvb AS DATE), CAST(nva AS DATE)) AS validity_days,
      round((epoch(date_trunc('second', l_shipdate)) - epoch(nvb)) / 86400, 6) AS cert_age
    FROM lineitem JOIN cert ON l_partkey = id""",
)
def cert_validity(t: Tables):
    uses = t.table("lineitem").select(
        F.col("l_orderkey").alias("uid"), F.col("l_partkey").alias("id"), F.col("l_shipdate").cast("timestamp").alias("ts")
    )
    seen = certs.with_validity(uses.join(t.cert(), "id"))
    return seen.select(
        "uid", "id", "cert_not_yet_valid", "cert_expired", F.col("validity_days").cast("long").alias("validity_days"),
        F.round("cert_age", 6).alias("cert_age"),
    )


@query(
    "chain_expand",
    f"""WITH {CERT}, {CHAIN} SELECT uid, CAST(pos AS INTEGER) AS pos, cert_id, certificate_issuer FROM chain JOIN cert ON cert_id = id""",
)
def chain_expand(t: Tables):
    return certs.expand_chains(t.chains(), t.cert()).select("uid", "pos", "cert_id", "certificate_issuer")


LEAF_ROOT = f"""{CERT}, {CHAIN}, known AS (SELECT * REPLACE (CASE WHEN p_size <= 40 THEN id ELSE -id END AS id) FROM cert),
  pairs AS (SELECT l.uid, l.len, k.certificate_issuer, k.certificate_subject, k.id,
      r.id AS root_id, r.certificate_issuer AS root_certificate_issuer
    FROM chain l JOIN known k ON l.cert_id = k.id
    JOIN chain e ON e.uid = l.uid AND e.pos = e.len - 1
    LEFT JOIN known r ON r.id = e.cert_id WHERE l.pos = 0)"""


def _pairs(t: Tables):
    """Certificates of large parts go by numbers that no chain names, so leaves get lost and roots stay empty."""
    return certs.leaf_with_root(t.chains(), t.cert().withColumn("id", F.when(F.col("p_size") <= 40, F.col("id")).otherwise(-F.col("id"))).drop("p_size"))


@query(
    "leaf_root",
    f"""WITH {LEAF_ROOT} SELECT uid, CAST(len AS INTEGER) AS cert_chain_fuids_len, id, certificate_issuer, root_id,
        root_certificate_issuer FROM pairs""",
)
def leaf_root(t: Tables):
    return _pairs(t).select(
        "uid", "cert_chain_fuids_len", "id", "certificate_issuer", "root_id", "root_certificate_issuer"
    )


CATEGORY = """CASE CAST(substr(name, 7) AS INTEGER) % 8 WHEN 0 THEN 'public' WHEN 1 THEN 'private' WHEN 2 THEN 'semi'
  WHEN 3 THEN 'intercept' WHEN 4 THEN 'error' WHEN 5 THEN 'suspicious' END"""


@query(
    "ca_category",
    f"""WITH {LEAF_ROOT}, profiles AS (
      SELECT DISTINCT CAST(len AS INTEGER) AS cert_chain_fuids_len, certificate_issuer, certificate_subject,
             root_certificate_issuer FROM pairs),
    parsed AS (SELECT *, {ca_sql(dn_sql('certificate_issuer', 'O', 'NULL'))} AS parsed_issuer_o FROM profiles),
    lists AS (SELECT name, {CATEGORY} AS category FROM (SELECT DISTINCT p_brand AS name FROM part))
    SELECT p.*, coalesce(category, 'other') AS ca_category FROM parsed p LEFT JOIN lists ON name = parsed_issuer_o""",
)
def ca_category(t: Tables):
    """Brands play CA organisations; each brand is on one list, some on none."""
    number = F.substring("p_brand", 7, 10).cast("int") % 8
    category = F.get(F.array(*[F.lit(c) for c in certs.CATEGORY_ORDER]), number)
    lists = t.table("part").select(F.col("p_brand").alias("issuer_name"), category.alias("category")).distinct()
    out = certs.categorise_issuers(_pairs(t), lists, profile=[
        "cert_chain_fuids_len", "certificate_issuer", "certificate_subject", "root_certificate_issuer"])
    return out.select(
        "cert_chain_fuids_len", "certificate_issuer", "certificate_subject", "root_certificate_issuer",
        F.col("parsed_issuer_O").alias("parsed_issuer_o"), "ca_category",
    )


@query(
    "find_ca",
    f"""WITH {CERT}, uses AS (
      SELECT {dn_sql('certificate_subject', 'CN')} AS subject_cn, {dn_sql('certificate_issuer', 'O')} AS issuer_o,
             CASE WHEN l_linenumber = 1 THEN NULL ELSE 's' || l_linenumber END AS server_name
      FROM lineitem JOIN cert ON l_partkey = id WHERE l_linestatus = 'F' AND l_returnflag = 'A'),
    single AS (SELECT *, row_number() OVER (PARTITION BY subject_cn
               ORDER BY issuer_o NULLS FIRST, server_name NULLS FIRST) AS n FROM uses)
    SELECT issuer_o, count(server_name) AS count FROM single WHERE n = 1 GROUP BY issuer_o""",
)
def find_ca(t: Tables):
    log = t.table("lineitem").select(
        F.col("l_partkey").alias("id"),
        F.when(F.col("l_linestatus") == "F", "home").otherwise("none").alias("anon_orig"),
        F.when(F.col("l_returnflag") == "A", "ok").otherwise("self signed").alias("validation_status"),
        F.when(F.col("l_linenumber") != 1, F.concat(F.lit("s"), "l_linenumber")).alias("server_name"),
    ).join(t.cert(), "id")
    ranking = certs.issuer_ranking(log, "home", subject="certificate_subject", issuer="certificate_issuer")
    return ranking.withColumnRenamed("issuer_O", "issuer_o")


# Suffix rules: two plain, one private, one wildcard.
RULES = ("com", "org", "example.org", "*.example.net")
HOSTS = """hosts AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages),
  labelled AS (SELECT *, string_split(host, '.') AS l, len(string_split(host, '.')) AS n,
    CASE WHEN host LIKE '%example.org' THEN 2 WHEN host LIKE '%.example.net' THEN 3
         WHEN host LIKE '%.com' THEN 1 ELSE 0 END AS take FROM hosts),
  split AS (SELECT page_id, host,
    CASE WHEN n - take > 1 THEN array_to_string(l[1:n - take - 1], '.') ELSE '' END AS subdomain,
    CASE WHEN n > take THEN l[n - take] ELSE '' END AS domain,
    array_to_string(l[n - take + 1:n], '.') AS suffix FROM labelled)"""


def _suffixes(t: Tables):
    return t.spark.createDataFrame([(r,) for r in RULES], "suffix string")


@query("registered_domain", f"WITH {HOSTS} SELECT DISTINCT host, subdomain, domain, suffix FROM split")
def registered_domain(t: Tables):
    hosts = t.table("pages").select(request_host("url").alias("host"))
    return domains.split_hosts(hosts, "host", _suffixes(t))


@query(
    "host_domain",
    f"WITH {HOSTS} SELECT page_id, host, subdomain AS host_subdomain, domain AS host_domain FROM split",
)
def host_domain(t: Tables):
    hosts = t.table("pages").select("page_id", request_host("url").alias("host"))
    return domains.with_domain(hosts, "host", _suffixes(t))


@query(
    "san_domains",
    f"""WITH {HOSTS} SELECT page_id, array_to_string(list_sort(list_distinct([domain || '.' || suffix,
        CASE WHEN take = 3 AND n = 3 THEN 'cdn.' || suffix ELSE domain || '.' || suffix END, 'example.com'])), ',') AS names
    FROM split JOIN labelled USING (page_id, host)""",
)
def san_domains(t: Tables):
    """Each page's certificate names its host, a delivery host below it and a shared one."""
    host = request_host("url")
    lists = t.table("pages").select(
        "page_id", F.array(host, F.concat(F.lit("cdn."), host), F.lit("static.example.com")).alias("san_dns")
    )
    out = domains.with_registered_domains(lists, "san_dns", _suffixes(t))
    return out.select("page_id", F.concat_ws(",", "domain_suffix_from_sandns").alias("names"))
