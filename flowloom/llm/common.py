"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.session import shared_dir

#: The white space of all contracts, ``[\x20\x09-\x0D]``, as a set of characters for ``btrim``.
SPACES = " \t\n\x0b\x0c\r"
#: A run of that white space, and a word, as regular expressions.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


#: Rows in one Arrow batch: texts are long, and a batch is held in both the executor's and Python's memory.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> SparkSession:
    """Let the session hand texts to Python in batches of at most BATCH_ROWS rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` written below the shared folder and read back: computed once, lost with no executor."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discarded(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``shared_dir`` that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def replaced(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``df`` with the columns of ``values`` added at the end or, where a name exists in any case, put in its place."""
    new = {name.lower(): (name, value) for name, value in values.items()}
    kept = [new.pop(c.lower())[1].alias(c) if c.lower() in new else df[_quoted(c)] for c in df.columns]
    return df.select(*kept, *[value.alias(name) for name, value in new.values()])


def packed(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under names of our own plus all columns as the struct ``row``: no name can clash."""
    return df.select(*[F.col(_quoted(c)).alias(k) for k, c in columns.items()], F.struct(*map(_quoted, df.columns)).alias("row"))


def unpacked(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """The columns of the struct ``row``, with ``values`` (over the columns beside it) replaced or added."""
    new = {name.lower(): (name, value) for name, value in values.items()}
    fields: Iterable[str] = df.schema["row"].dataType.names
    kept = [new.pop(c.lower())[1].alias(c) if c.lower() in new else F.col(f"row.{_quoted(c)}").alias(c) for c in fields]
    return df.select(*kept, *[value.alias(name) for name, value in new.values()])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
