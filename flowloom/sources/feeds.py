"""CSV feeds: blacklists, reputation caches, rank lists."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.plans.slots import Slot
from flowloom.sources.logs import as_schema

# Columns of the feeds that the recipes read; pass another schema for further ones.
FEED_SCHEMAS = {
    "honeypot": "indicator string, description string",
    "renisac": "indicator string, description string",
    "virustotal_cache": "fqdn string, date string, positives int, total int",
}


def _headers(spark: SparkSession, paths: list[str] | str) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. Only first lines reach the driver, one per file."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), place.alias("place"), "value")
    first = lines.where("place.block = 0").groupBy("path").agg(F.min_by("value", "place").alias("header"))
    files: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(tuple(r) for r in first.collect()):
        names = tuple(name.strip() for name in next(csv.reader([header.lstrip("\ufeff")])))
        files.setdefault(names, []).append(unquote(path))
    return files


def scan_csv(spark: SparkSession, paths: list[str] | str, schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with a header row, columns matched by the names in each file's own header; without a schema every column is text.

    Files of one header are one scan. Reading never infers types, which would cost a second pass.
    """
    parts = []
    for names, files in _headers(spark, paths).items():
        text = T.StructType([T.StructField(name, T.StringType()) for name in names])
        part = spark.read.schema(text).option("header", True).option("enforceSchema", True).csv(files)
        parts.append(part.withColumn("_source", F.col("_metadata.file_path")))
    if not parts:
        parts = [spark.createDataFrame([], "_source string")]
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema is None:
        return raw
    wanted = [
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in as_schema(schema).fields
    ]
    return raw.select(*wanted, "_source")


class CsvLoader:
    """Feeds ``root/<type>/<date>/<type>_<date>.csv``, dated by the slot's first day."""

    def __init__(self, kind: str, schema: str | T.StructType | None = None):
        self.kind = kind
        self._schema = schema or FEED_SCHEMAS[kind]

    @property
    def schema(self) -> T.StructType:
        return as_schema(self._schema)

    def path(self, root: str, slot: Slot) -> str:
        return f"{root}/{self.kind}/{slot[0]:%Y-%m-%d}/{self.kind}_{slot[0]:%Y-%m-%d}.csv"

    def read(self, spark: SparkSession, root: str, slots: list[Slot]) -> DataFrame:
        raw = scan_csv(spark, [self.path(root, s) for s in slots], self.schema)
        day = F.regexp_extract("_source", r"_(\d{4}-\d{2}-\d{2})\.csv", 1)
        return raw.withColumn("slot_start", F.to_timestamp(day, "yyyy-MM-dd")).drop("_source")

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema).withColumn("slot_start", F.lit(None).cast("timestamp"))


def read_rank_list(spark: SparkSession, path: str, host: str = "host") -> DataFrame:
    """Rank list with one host per line below a header; ``rank`` is the position in the list, from 0.

    Files count in the order of their names. The position is the row's place in its block of a file plus the rows of the
    blocks before; only the latter, one row per block, is gathered in one place.
    """
    row = F.monotonically_increasing_id()
    lines = spark.read.option("header", True).csv(path).select(
        F.col(host).alias("host"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), row.alias("_row")
    )
    sizes = lines.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", "_block", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    return lines.join(offsets, ["_file", "_block"]).select("host", (F.col("_offset") + F.col("_row")).alias("rank"))


def read_ca_lists(spark: SparkSession, lists: dict[str, str]) -> DataFrame:
    """One table (issuer_name, category) from a CSV path per category."""
    parts = [
        spark.read.option("header", True).csv(path).select("issuer_name", F.lit(category).alias("category"))
        for category, path in lists.items()
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table
