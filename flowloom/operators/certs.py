"""Certificates: validity, chains, inventory, issuers and their category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.text import (
    ISSUER_FIELDS,
    SUBJECT_FIELDS,
    array_json,
    cert_key,
    dn_field,
    dn_organisation,
    normalise_ca,
)
from flowloom.functions.times import age_days, validity_days, validity_seconds
from flowloom.operators.tables import keep_one

# Issuer categories, the first one that lists a name wins.
CATEGORY_ORDER = ("public", "private", "semi", "intercept", "error", "suspicious")

# Columns of the certificate inventory.
INVENTORY_COLUMNS = (
    "basic_constraints_ca", "basic_constraints_path_len", "certificate_curve", "certificate_exponent",
    "certificate_key_alg", "certificate_key_length", "certificate_key_type", "certificate_not_valid_after_ts",
    "certificate_not_valid_before_ts", "certificate_serial", "certificate_sig_alg", "certificate_version",
    "certificate_issuer_CN", "certificate_issuer_O", "certificate_issuer_C", "certificate_subject_CN",
    "certificate_subject_O", "certificate_subject_C", "san_dns_len", "certificate_validity_seconds", "hashkey",
    "san_dns_json",
)

# Certificate columns repeated for the root of a chain.
ROOT_COLUMNS = (
    "basic_constraints_ca", "basic_constraints_path_len", "certificate_curve", "certificate_exponent",
    "certificate_issuer", "certificate_key_alg", "certificate_key_length", "certificate_key_type",
    "certificate_not_valid_after", "certificate_not_valid_before", "certificate_serial", "certificate_sig_alg",
    "certificate_subject", "certificate_version", "id",
)

# Columns that tell one leaf and root profile from another.
PROFILE_COLUMNS = (
    "server_name", "cert_chain_fuids_len", "validity_days", "certificate_issuer", "certificate_serial",
    "certificate_subject", "certificate_version", "san_dns_len", "root_certificate_issuer",
    "root_certificate_subject", "root_certificate_version",
)


def with_validity(
    x509: DataFrame, ts: str = "ts", before: str = "certificate_not_valid_before",
    after: str = "certificate_not_valid_after",
) -> DataFrame:
    """Not yet valid, expired, calendar days of validity and age in days at the time seen."""
    return x509.withColumns(
        {
            "cert_not_yet_valid": F.col(ts) < F.col(before),
            "cert_expired": F.col(ts) > F.col(after),
            "validity_days": validity_days(before, after),
            "cert_age": age_days(ts, before),
        }
    )


def expand_chains(
    ssl: DataFrame, x509: DataFrame, chain: str = "cert_chain_fuids", cert: str = "id"
) -> DataFrame:
    """One row per connection and known certificate of its chain, with the position."""
    links = ssl.select("*", F.posexplode(chain).alias("pos", "cert_id"))
    return links.join(x509, F.col("cert_id") == F.col(cert))


def leaf_with_root(
    ssl: DataFrame, x509: DataFrame, chain: str = "cert_chain_fuids", cert: str = "id",
    root_columns: Sequence[str] = ROOT_COLUMNS, on: Sequence[str] = (),
) -> DataFrame:
    """Connections with a known leaf certificate, and the root's columns as ``root_*`` where known.

    Both ends are read off the chain, so the middle of a chain is never unfolded. ``on`` names further
    shared columns, such as a slot.
    """
    links = ssl.where(F.size(chain) > 0).select(
        "*",
        F.lit(0).alias("pos"),
        F.get(chain, F.lit(0)).alias("cert_id"),
        F.get(chain, F.size(chain) - 1).alias("_root"),
    )
    leaves = x509.withColumn("cert_id", F.col(cert))
    roots = x509.select(
        *on, F.col(cert).alias("_root"), *[F.col(c).alias(f"root_{c}") for c in root_columns if c in x509.columns]
    )
    return links.join(leaves, ["cert_id", *on]).join(roots, ["_root", *on], "left").drop("_root")


def issuer_ranking(
    ssl: DataFrame, site: str, anon: str = "anon_orig", status: str = "validation_status",
    subject: str = "subject", issuer: str = "issuer", server: str = "server_name", by: Sequence[str] = (),
) -> DataFrame:
    """Named servers per issuing organisation over the validated connections of one site.

    One connection counts per subject CN: the first by issuer, then server.
    """
    ok = ssl.where((F.col(anon) == site) & (F.col(status) == "ok")).select(
        *by, dn_field(subject, "CN").alias("subject_CN"), dn_field(issuer, "O").alias("issuer_O"),
        F.col(server).alias("server_name"),
    )
    single = keep_one(ok, [*by, "subject_CN"], ["issuer_O", "server_name"])
    counted = single.groupBy(*by, "issuer_O").agg(F.count("server_name").alias("count"))
    return counted.orderBy(*by, F.desc("count"), "issuer_O")


def parse_names(x509: DataFrame, issuer: str = "certificate_issuer", subject: str = "certificate_subject") -> DataFrame:
    """Columns ``<issuer>_CN`` ... and ``<subject>_CN`` ... of the two distinguished names."""
    cols = {f"{issuer}_{k}": dn_field(issuer, k) for k in ISSUER_FIELDS}
    cols |= {f"{subject}_{k}": dn_field(subject, k) for k in SUBJECT_FIELDS}
    return x509.withColumns(cols)


def cert_inventory(x509: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct certificates with parsed names, epoch validity and a key.

    Copies of a certificate go first, on the raw columns, so that names are parsed once per certificate;
    then one row is kept per key.
    """
    before, after = "certificate_not_valid_before", "certificate_not_valid_after"
    raw_names = ["certificate_serial", "certificate_issuer", "certificate_subject"]
    raw = [c for c in (*raw_names, *INVENTORY_COLUMNS, before, after, "san_dns") if c in x509.columns]
    single = keep_one(x509.select(*by, *dict.fromkeys(raw)), [*by, *raw_names])
    full = parse_names(single).withColumns(
        {
            f"{before}_ts": F.unix_timestamp(before),
            f"{after}_ts": F.unix_timestamp(after),
            "certificate_validity_seconds": validity_seconds(before, after),
            "hashkey": cert_key("certificate_serial", "certificate_issuer_CN", "certificate_subject_CN"),
        }
    )
    if "san_dns" in x509.columns:
        full = full.withColumn("san_dns_json", array_json("san_dns"))
    kept = full.select(*by, *[c for c in INVENTORY_COLUMNS if c in full.columns])
    return keep_one(kept, [*by, "hashkey"])


def categorise_issuers(
    df: DataFrame, issuers: DataFrame, issuer: str = "certificate_issuer", subject: str = "certificate_subject",
    profile: Sequence[str] = PROFILE_COLUMNS, by: Sequence[str] = (),
) -> DataFrame:
    """Distinct profiles with the category of the issuing organisation, ``other`` when not listed.

    ``issuers`` has ``issuer_name`` and ``category``.
    """
    order = F.coalesce(
        F.array_position(F.array(*[F.lit(c) for c in CATEGORY_ORDER]), F.col("category")), F.lit(0)
    )
    lookup = (
        issuers.where(order > 0)
        .groupBy(F.col("issuer_name").alias("parsed_issuer_O"))
        .agg(F.min_by("category", order).alias("ca_category"))
    )
    named = keep_one(df, [*by, *[c for c in profile if c in df.columns]]).withColumns(
        {
            "certificate_issuer_O": dn_organisation(issuer),
            "certificate_subject_O": dn_organisation(subject),
            "parsed_issuer_O": normalise_ca(dn_organisation(issuer)),
        }
    )
    return named.join(lookup, "parsed_issuer_O", "left").fillna("other", ["ca_category"])
