"""Sliced JSON logs and daily alert logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.nets import SITE_SUBNETS
from flowloom.operators.cleaning import clean_log
from flowloom.plans.slots import Slot

# Times come as epoch seconds or as text, so they are read as text.
_ENDS = "uid string, ts string, `id.orig_h` string, `id.resp_h` string, `id.orig_p` int, `id.resp_p` int"
_SITES = "anon_orig string, anon_resp string"
_FILES = (
    "tunnel_parents array<string>, analyzers array<string>, resp_mime_types array<string>, "
    "resp_filenames array<string>, resp_fuids array<string>, orig_filenames array<string>, "
    "orig_fuids array<string>, orig_mime_types array<string>"
)

# The columns of each log type; pass another schema for further ones.
LOG_SCHEMAS = {
    "http": f"{_ENDS}, {_SITES}, host string, uri string, user_agent string, anon_host string, method string, "
            f"status_code int, request_body_len long, response_body_len long, proxied array<string>, "
            f"tags array<string>, {_FILES}",
    "ssl": f"{_ENDS}, {_SITES}, server_name string, established string, validation_status string, version string, "
           "cipher string, curve string, ja3 string, ja3s string, last_alert string, next_protocol string, "
           "resumed string, issuer string, subject string, client_issuer string, client_subject string, "
           "cert_chain_fuids array<string>, client_cert_chain_fuids array<string>",
    "x509": "id string, ts string, `certificate.serial` string, `certificate.issuer` string, "
            "`certificate.subject` string, `certificate.not_valid_before` string, "
            "`certificate.not_valid_after` string, `certificate.key_length` int, `certificate.key_alg` string, "
            "`certificate.key_type` string, `certificate.sig_alg` string, `certificate.curve` string, "
            "`certificate.exponent` string, `certificate.version` int, `basic_constraints.ca` boolean, "
            "`basic_constraints.path_len` int, `san.dns` array<string>",
    "conn": f"{_ENDS}, {_SITES}, proto string, service string, conn_state string, history string, "
            "community_id string, orig_cc string, resp_cc string, duration double, orig_bytes long, "
            "resp_bytes long, orig_ip_bytes long, resp_ip_bytes long, orig_pkts long, resp_pkts long, "
            "missed_bytes long, tunnel_parents array<string>",
    "ssh": f"{_ENDS}, {_SITES}, version int, auth_attempts int, auth_success string, client string, server string",
    "dns": f"{_ENDS}, {_SITES}, proto string, query string, qtype_name string, rcode_name string, answers array<string>",
    "files": "fuid string, ts string, tx_hosts array<string>, rx_hosts array<string>, conn_uids array<string>, "
             "analyzers array<string>, source string, mime_type string, filename string, seen_bytes long, "
             "missing_bytes long",
    "irc": f"{_ENDS}, {_SITES}, nick string, user string, command string, value string, dcc_file_size long",
    "fireeye": "src string, dst string, spt int, dpt int, anon_src string, anon_dst string, rt string, "
               "eventName string, request string, _lpp_ver string, _lpp_plugin string",
}


def log_type(kind: str) -> str:
    """Log type of a copy such as ``http_vt`` or ``conn_long``."""
    return kind.removesuffix("_vt").removesuffix("_long")


def both_spellings(schema: T.StructType) -> tuple[T.StructType, dict[str, str]]:
    """The schema with every dotted name also spelled with an underscore, and the pairs."""
    fields, pairs = list(schema.fields), {}
    for f in schema.fields:
        if "." in f.name:
            plain = f.name.replace(".", "_")
            pairs[f.name] = plain
            fields.append(T.StructField(plain, f.dataType))
    return T.StructType(fields), pairs


def _merge_spellings(df: DataFrame, schema: T.StructType, pairs: dict[str, str]) -> DataFrame:
    cols = [
        F.coalesce(F.col(f"`{f.name}`"), F.col(pairs[f.name])).alias(pairs[f.name]) if f.name in pairs else F.col(f.name)
        for f in schema.fields
    ]
    return df.select(*cols, *[c for c in df.columns if c.startswith("_source")])


def as_schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def scan_json(spark: SparkSession, paths: list[str], schema: str | T.StructType, base: str | None = None) -> DataFrame:
    """JSON lines (gzip or plain) of many slots in one scan, with the file name as ``_source``."""
    schema = as_schema(schema)
    wide, pairs = both_spellings(schema)
    reader = spark.read.schema(wide)
    if base:
        reader = reader.option("basePath", base)
    raw = reader.json(paths).withColumn("_source", F.col("_metadata.file_path"))
    return _merge_spellings(raw, schema, pairs)


def further_columns(spark: SparkSession, paths: list[str], schema: T.StructType) -> T.StructType:
    """The schema and whatever columns the files have besides, of the types found in one pass over them."""
    known = {f.name.replace(".", "_") for f in schema.fields}
    found = {f.name.replace(".", "_"): f for f in spark.read.json(paths).schema.fields}
    return T.StructType([*schema.fields, *[f for name, f in found.items() if name not in known]])


class LogLoader:
    """Half-hour log slices ``root/<type>/<date>/anon.<type>_<YYYYMMDD>_<HHMM>-<HHMM>.log.gz``.

    ``every_column`` keeps the columns of the files that the schema does not name, at the cost of a pass to find them.
    """

    def __init__(self, kind: str, schema: str | T.StructType | None = None, subnets=SITE_SUBNETS, every_column: bool = True):
        self.kind = kind
        self.every_column = every_column
        self._schema = schema or LOG_SCHEMAS[log_type(kind)]
        self.subnets = subnets

    @property
    def schema(self) -> T.StructType:
        return as_schema(self._schema)

    def path(self, root: str, slot: Slot) -> str:
        start, end = slot
        name = f"anon.{self.kind}_{start:%Y%m%d}_{start:%H%M}-{end:%H%M}.log.gz"
        return f"{root}/{self.kind}/{start:%Y-%m-%d}/{name}"

    def slot_of(self, source):
        """Slot start of a row from its file name."""
        return F.to_timestamp(F.regexp_extract(source, r"_(\d{8}_\d{4})-\d{4}\.log", 1), "yyyyMMdd_HHmm")

    def read(self, spark: SparkSession, root: str, slots: list[Slot]) -> DataFrame:
        """Cleaned rows of the slots with their ``slot_start``."""
        paths = [self.path(root, s) for s in slots]
        schema = further_columns(spark, paths, self.schema) if self.every_column else self.schema
        raw = scan_json(spark, paths, schema)
        return self._with_slot(raw.withColumn("slot_start", self.slot_of(F.col("_source"))))

    def _with_slot(self, df: DataFrame) -> DataFrame:
        # slot_start is a timestamp and not in any cleaning list, so it passes through unchanged.
        return clean_log(df.drop("_source"), self.subnets)

    def empty(self, spark: SparkSession) -> DataFrame:
        wide, pairs = both_spellings(self.schema)
        raw = _merge_spellings(spark.createDataFrame([], wide), self.schema, pairs)
        return self._with_slot(raw.withColumn("slot_start", F.lit(None).cast("timestamp")))


class AlertLoader(LogLoader):
    """Daily alert logs ``root/<type>/<date>/<type>_<YYYYMMDD>.log.gz``."""

    def path(self, root: str, slot: Slot) -> str:
        day: datetime = slot[0]
        return f"{root}/{self.kind}/{day:%Y-%m-%d}/{self.kind}_{day:%Y%m%d}.log.gz"

    def slot_of(self, source):
        return F.to_timestamp(F.regexp_extract(source, r"_(\d{8})\.log", 1), "yyyyMMdd")
