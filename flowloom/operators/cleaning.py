"""Log cleaning: names, list fields, times, endpoint roles, missing strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.arrays import first_or_blank
from flowloom.functions.nets import SITE_SUBNETS, external_ip, internal_ip, subnet_index
from flowloom.functions.times import epoch_seconds, to_time

# Column roles in the logs.
ID_FIELDS = (
    "index", "uid", "id_orig_p", "id_resp_p", "id_orig_h", "id_resp_h", "ts",
    "_lpp_ver", "_lpp_plugin", "ExternalIP", "InternalIP",
)
COUNT_FIELDS = (
    "cert_chain_fuids", "client_cert_chain_fuids", "tunnel_parents", "san_dns", "analyzers",
    "resp_mime_types", "resp_filenames", "resp_fuids", "orig_filenames", "orig_fuids", "orig_mime_types",
)
FIRST_FIELDS = (
    "cert_chain_fuids", "tx_hosts", "rx_hosts", "conn_uids", "tunnel_parents", "resp_mime_types",
    "resp_filenames", "resp_fuids", "orig_filenames", "orig_fuids", "orig_mime_types", "proxied", "tags",
)
TIME_FIELDS = ("ts", "certificate_not_valid_before", "certificate_not_valid_after")
CONTINUOUS_FIELDS = (
    "duration", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts", "request_body_len",
    "response_body_len", "certificate_not_valid_after", "certificate_not_valid_before", "dcc_file_size",
    "overflow_byes", "missing_bytes", "seen_bytes", "missed_bytes", "orig_ip_bytes", "resp_ip_bytes",
    "Num_IP_addresses_using_UA", "Ratio_of_failure", "Num_2xx_connection", "Num_3xx_connection",
    "Num_4xx_connection", "Num_5xx_connection", "Num_total_connection", "IP_Popularity_Total_Counts",
    "IP_Popularity_Total_Counts_Norm",
)
IGNORED_FIELDS = ("ts_x", "ts_y", "user_agent_x", "user_agent_y")

# Further columns the wide classification leaves out.
WIDE_IGNORED_FIELDS = IGNORED_FIELDS + (
    "likely_benign", "info_code", "status_code", "kudu_score", "fe_score", "tc_score", "vt_score",
)

# Derived measures the wide classification counts as continuous.
DERIVED_MEASURES = (
    "distinct_ct", "frac_ct_empty", "frac_ct_img", "frac_ct_video", "frac_ct_text", "frac_ct_app",
    "frac_ct_sh", "frac_ct_exe", "frac_ct_jar", "frac_ct_js", "frac_ct_html", "frac_no_ref", "frac_http_ref",
    "num_distinct_ref", "ratio_ref_over_host", "avg_ref_perhost", "min_ref_perhost", "max_ref_perhost",
    "has_diff_ref", "num_100", "num_200", "num_300", "num_400", "num_500", "frac_100", "frac_200", "frac_300",
    "frac_400", "frac_500", "ratio_fail", "num_distinct_ua", "frac_no_ua", "ratio_ua_over_host",
    "ua_inverse_pop", "ua_norm_pop", "frac_ua1", "frac_ua10", "avg_ua_perhost", "min_ua_perhost",
    "max_ua_perhost", "num_distinct_urls", "num_files", "avg_url_len", "max_url_len", "min_url_len",
    "avg_url_depth", "max_url_depth", "min_url_depth", "num_params", "avg_params", "max_params", "min_params",
    "num_sh", "num_tmp", "num_wget", "num_chmod", "num_tmp_sh", "frac_bare", "frac_sh", "frac_tmp",
    "frac_wget", "frac_chmod", "frac_tmp_sh", "total_hosts", "total_logs", "avg_logs", "min_logs", "max_logs",
    "total_sent_bytes", "total_recv_bytes", "avg_recv_over_sent", "min_recv_over_sent", "max_recv_over_sent",
    "total_GET", "total_POST", "avg_ratio_PG", "min_ratio_PG", "max_ratio_PG", "cnt_distinct_hosts",
    "fqdn_norm", "dom_length", "dom_level", "dom_sld_entropy", "dom_sub_cnt",
)

# Per-row measures.
ROW_MEASURES = (
    "cisco1m_index", "cnt_distinct_hosts_pop_host", "cnt_logs", "fqdn_norm", "cnt_distinct_hosts_pop_ua",
    "ua_norm", "max_cnt_distinct_ip_uri_token", "max_cnt_log_uri_token", "max_ip_uri_token_freq",
    "max_log_uri_token_freq", "min5day_cnt_logs", "max5day_cnt_logs", "min5day_fqdn_norm",
    "max5day_fqdn_norm", "min5day_cnt_distinct_hosts_pop_host", "max5day_cnt_distinct_hosts_pop_host",
    "min5day_ua_norm", "max5day_ua_norm", "min5day_cnt_distinct_hosts_pop_ua",
    "max5day_cnt_distinct_hosts_pop_ua", "min5day_max_cnt_distinct_ip_uri_token",
    "max5day_max_cnt_distinct_ip_uri_token", "min5day_max_cnt_log_uri_token", "max5day_max_cnt_log_uri_token",
    "min5day_max_ip_uri_token_freq", "max5day_max_ip_uri_token_freq", "min5day_max_log_uri_token_freq",
    "max5day_max_log_uri_token_freq",
)

# Extremes and means of the per-row measures.
ROW_MEASURE_SUMMARIES = (
    "min_cisco1m_index", "min_cnt_distinct_hosts_pop_host", "min_cnt_logs", "min_fqdn_norm",
    "min_cnt_distinct_hosts_pop_ua", "min_ua_norm", "min_max_cnt_distinct_ip_uri_token",
    "min_max_cnt_log_uri_token", "min_max_ip_uri_token_freq", "min_max_log_uri_token_freq",
    "min_min5day_cnt_logs", "min_max5day_cnt_logs", "min_min5day_fqdn_norm", "min_max5day_fqdn_norm",
    "min_min5day_cnt_distinct_hosts_pop_host", "min_max5day_cnt_distinct_hosts_pop_host",
    "min_min5day_ua_norm", "min_max5day_ua_norm", "min_min5day_cnt_distinct_hosts_pop_ua",
    "min_max5day_cnt_distinct_hosts_pop_ua", "min_min5day_max_cnt_distinct_ip_uri_token",
    "min_max5day_max_cnt_distinct_ip_uri_token", "min_min5day_max_cnt_log_uri_token",
    "min_max5day_max_cnt_log_uri_token", "min_min5day_max_ip_uri_token_freq",
    "min_max5day_max_ip_uri_token_freq", "min_min5day_max_log_uri_token_freq",
    "min_max5day_max_log_uri_token_freq", "max_cisco1m_index", "max_cnt_distinct_hosts_pop_host",
    "max_cnt_logs", "max_fqdn_norm", "max_cnt_distinct_hosts_pop_ua", "max_ua_norm",
    "max_max_cnt_distinct_ip_uri_token", "max_max_cnt_log_uri_token", "max_max_ip_uri_token_freq",
    "max_max_log_uri_token_freq", "max_min5day_cnt_logs", "max_max5day_cnt_logs", "max_min5day_fqdn_norm",
    "max_max5day_fqdn_norm", "max_min5day_cnt_distinct_hosts_pop_host",
    "max_max5day_cnt_distinct_hosts_pop_host", "max_min5day_ua_norm", "max_max5day_ua_norm",
    "max_min5day_cnt_distinct_hosts_pop_ua", "max_max5day_cnt_distinct_hosts_pop_ua",
    "max_min5day_max_cnt_distinct_ip_uri_token", "max_max5day_max_cnt_distinct_ip_uri_token",
    "max_min5day_max_cnt_log_uri_token", "max_max5day_max_cnt_log_uri_token",
    "max_min5day_max_ip_uri_token_freq", "max_max5day_max_ip_uri_token_freq",
    "max_min5day_max_log_uri_token_freq", "max_max5day_max_log_uri_token_freq", "avg_cisco1m_index",
    "avg_cnt_distinct_hosts_pop_host", "avg_cnt_logs", "avg_fqdn_norm", "avg_cnt_distinct_hosts_pop_ua",
    "avg_ua_norm", "avg_max_cnt_distinct_ip_uri_token", "avg_max_cnt_log_uri_token",
    "avg_max_ip_uri_token_freq", "avg_max_log_uri_token_freq", "avg_min5day_cnt_logs", "avg_max5day_cnt_logs",
    "avg_min5day_fqdn_norm", "avg_max5day_fqdn_norm", "avg_min5day_cnt_distinct_hosts_pop_host",
    "avg_max5day_cnt_distinct_hosts_pop_host", "avg_min5day_ua_norm", "avg_max5day_ua_norm",
    "avg_min5day_cnt_distinct_hosts_pop_ua", "avg_max5day_cnt_distinct_hosts_pop_ua",
    "avg_min5day_max_cnt_distinct_ip_uri_token", "avg_max5day_max_cnt_distinct_ip_uri_token",
    "avg_min5day_max_cnt_log_uri_token", "avg_max5day_max_cnt_log_uri_token",
    "avg_min5day_max_ip_uri_token_freq", "avg_max5day_max_ip_uri_token_freq",
    "avg_min5day_max_log_uri_token_freq", "avg_max5day_max_log_uri_token_freq",
)

WIDE_CONTINUOUS = frozenset((*CONTINUOUS_FIELDS, *DERIVED_MEASURES, *ROW_MEASURES, *ROW_MEASURE_SUMMARIES))


def discrete_columns(df: DataFrame, wide: bool = False) -> list[str]:
    """Columns that are neither identifiers nor continuous.

    The wide form also leaves out the list and time fields and the derived measures.
    """
    if wide:
        out = {*WIDE_CONTINUOUS, *ID_FIELDS, *WIDE_IGNORED_FIELDS, *COUNT_FIELDS, *FIRST_FIELDS, *TIME_FIELDS}
    else:
        out = {*ID_FIELDS, *CONTINUOUS_FIELDS, *IGNORED_FIELDS}
    return [c for c in df.columns if c not in out]


def continuous_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in WIDE_CONTINUOUS and c not in WIDE_IGNORED_FIELDS]


def sanitise_names(df: DataFrame) -> DataFrame:
    """Dots and blanks in column names become underscores."""
    return df.toDF(*[c.replace(".", "_").replace(" ", "_") for c in df.columns])


def clean_log(df: DataFrame, subnets: tuple[str, ...] = SITE_SUBNETS) -> DataFrame:
    """The cleaning every raw log goes through; one projection, no shuffle."""
    df = sanitise_names(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name in df.columns:
        if name == "ts":
            cols.append(epoch_seconds(name).alias(name))
        elif name in TIME_FIELDS:
            cols.append(to_time(name).alias(name))
        else:
            cols.append(F.col(name))
    is_list = {name: isinstance(kind, T.ArrayType) for name, kind in types.items()}
    cols += [F.size(c).alias(f"{c}_len") for c in COUNT_FIELDS if is_list.get(c)]
    cols += [first_or_blank(c).alias(f"first_{c}") for c in FIRST_FIELDS if is_list.get(c)]
    if {"anon_orig", "id_orig_h", "id_resp_h"} <= set(df.columns):
        inside = internal_ip("anon_orig", "id_orig_h", "id_resp_h")
        outside = external_ip("anon_orig", "id_orig_h", "id_resp_h")
        cols += [
            inside.alias("InternalIP"),
            outside.alias("ExternalIP"),
            subnet_index(inside, subnets).alias("subnet"),
        ]
    cleaned = df.select(*cols)
    text = {f.name for f in cleaned.schema.fields if isinstance(f.dataType, T.StringType)}
    return cleaned.fillna("missing", subset=[c for c in discrete_columns(cleaned) if c in text])


def prefix_cover(low: Column, high: Column, bits: int) -> Column:
    """The fewest aligned blocks that make up [low, high], at most two of each size: an array of (size, prefix)."""
    blocks = []
    for size in range(bits + 1):
        first = F.shiftright(low + ((1 << size) - 1), size)
        last = F.shiftright(high + 1, size) - 1
        # Of the blocks inside, only an odd first and an even last one are not half of a larger block inside.
        for prefix, parity in ((first, 1), (last, 0)):
            lone = (first <= last) & (prefix.bitwiseAND(F.lit(1)) == parity)
            blocks.append(F.when(lone, F.struct(F.lit(size).alias("size"), prefix.alias("prefix"))))
    return F.filter(F.array(*blocks), lambda b: b.isNotNull())


def range_lookup(
    df: DataFrame, value: str, ranges: DataFrame, low: str, high: str, index: str,
    out: str, bits: int = 32, default: int = -1,
) -> DataFrame:
    """Largest ``index`` among the ranges holding ``value``; ``default`` for none.

    Ranges lie in [0, 2**bits) and may be of any length, as may their table: each becomes at most two blocks of each
    size, and the match is an equi join on (size, prefix). Only distinct values are matched, so a hot value is looked up
    once. Large blocks, which many values share, are at most 2**17 rows and broadcast; a small one holds at most 2**15
    distinct values, so no key of the shuffle join is hot.
    """
    wide = max(bits - 16, 0)
    bounds = ranges.select(F.col(low).cast("long").alias("_low"), F.col(high).cast("long").alias("_high"), F.col(index).alias("_index"))
    blocks = (
        bounds.select("_index", F.inline(prefix_cover(F.col("_low"), F.col("_high"), bits)))
        .groupBy(F.col("size").alias("_size"), F.col("prefix").alias("_prefix")).agg(F.max("_index").alias("_found"))
    )
    values = df.select(F.col(value).cast("long").alias("_value")).where(F.col("_value").isNotNull()).distinct()

    def matched(sizes: range, held: DataFrame) -> DataFrame:
        prefixes = [F.struct(F.lit(s).alias("_size"), F.shiftright("_value", s).alias("_prefix")) for s in sizes]
        return values.select("_value", F.inline(F.array(*prefixes))).join(held, ["_size", "_prefix"]).select("_value", "_found")

    found = matched(range(wide, bits + 1), F.broadcast(blocks.where(F.col("_size") >= wide)))
    if wide:
        found = found.union(matched(range(wide), blocks.where(F.col("_size") < wide)))
    best = found.groupBy("_value").agg(F.max("_found").alias("_found"))
    joined = df.join(best, F.col(value) == F.col("_value"), "left")
    return joined.withColumn(out, F.coalesce("_found", F.lit(default))).drop("_value", "_found")
