"""Line dedup: documents probe a sharded minimal perfect hash of the repeated lines.

1. Every document's distinct line keys become 128-bit hashes, written once.
2. Hashes in two or more documents are reduced, map-side first, to owner (the smallest doc_id) and document count.
   Lines of one document need no slot: a probe for them fails on the fingerprint.
3. Shards of about SHARD_KEYS hashes each become one row: the perfect hash and, indexed by it, arrays of 64-bit
   fingerprints, owners and counts.
4. Probes (doc_id and hash, no text) go to the shard of their hash and stream past its arrays. A shard whose lines are in
   many documents is copied to as many places as its counts ask for, and its probes are dealt over the copies.
5. Only documents that lose lines get the list of them, by one join on doc_id; the text moves once.

Lines are held together by 128 bits, so two different keys are one with a chance of about 2**-128 a pair.

Defined cases: a null or empty text is one empty line and stays as it is; a null text stays null. A row without a doc_id
keeps all its lines and supports no key. Rows that repeat a doc_id are one document: the same lines stay in each.
A text all of whose lines go becomes empty. Columns named like a result column are replaced by it, others are carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import packed, staged, unpacked
from flowloom.llm.perfect_hash import Index, build, fingerprint

MIN_POINTS = 10
SHARD_KEYS = 1 << 16
_STRIP = b" \t\n\x0b\x0c\r"
_ROWS = 1 << 16


def line_keys(text: bytes, min_points: int) -> list[bytes | None]:
    """The 16-byte hash of each line's key, or None for a key that is too short."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(_STRIP).lower()
        if len(key) < min_points or (len(key) < 4 * min_points and not key.isascii() and len(key.decode("utf-8", "replace")) < min_points):
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(key))
    return out


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2)
    return both[:, 0].astype(np.int64, casting="unsafe"), both[:, 1].astype(np.int64, casting="unsafe")


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_points: int = MIN_POINTS) -> DataFrame:
    """(doc_id, h1, h2): each document's distinct line keys."""

    def run(batches):
        for batch in batches:
            ids, digests = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {k for k in line_keys(text, min_points) if k}
                digests += own
                ids += [doc_id] * len(own)
                if len(ids) >= _ROWS:
                    yield _rows(ids, digests)
                    ids, digests = [], []
            if ids:
                yield _rows(ids, digests)

    def _rows(ids, digests):
        h1, h2 = _halves(digests)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(h1), pa.array(h2)], ["doc_id", "h1", "h2"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return source.where("doc_id is not null and text is not null").mapInArrow(run, "doc_id long, h1 long, h2 long")


def line_index(hashed: DataFrame, partitions: int) -> tuple[DataFrame, int]:
    """One row a shard: the perfect hash of its repeated lines and the arrays it indexes; and how many shards there are."""
    counted = hashed.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("docs")
    )
    keys = staged(counted.where("owner < last").drop("last"), "line-keys")
    shards = max(partitions, math.ceil(keys.count() / SHARD_KEYS))

    def make(table: pa.Table) -> pa.Table:
        h1, h2 = (table.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        sizes, bits, index = build(h1, h2)
        prints, owners, counts = (np.empty(len(h1), t) for t in (np.uint64, np.int64, np.uint32))
        docs = table.column("docs").to_numpy()
        prints[index] = fingerprint(h1, h2)
        owners[index] = table.column("owner").to_numpy()
        counts[index] = np.minimum(docs, 2**32 - 1)
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()), "hits": pa.array([int(docs.sum())], pa.int64()),
            "sizes": pa.array([sizes], pa.list_(pa.int32())), "bits": pa.array([bits], pa.binary()),
            "prints": pa.array([prints.tobytes()], pa.binary()), "owners": pa.array([owners.tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
        })

    schema = "shard long, hits long, sizes array<int>, bits binary, prints binary, owners binary, counts binary"
    sharded = keys.withColumn("shard", F.pmod("h1", F.lit(shards)))
    return staged(sharded.groupBy("shard").applyInArrow(make, schema), "line-index"), shards


def _probe(batches):
    """Rows sorted by place, each place's index before its probes: the probes whose line belongs to another document."""
    index = None
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        cuts = [0, *np.flatnonzero(kind == 0).tolist(), len(kind)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if kind[a] == 0:
                index = Index(*(batch.column(c)[a].as_py() for c in ("sizes", "bits", "prints", "owners", "counts")))
                a += 1
            if index is None or a == b:
                continue
            part = batch.slice(a, b - a)
            h1, h2, ids = (part.column(c).to_numpy() for c in ("h1", "h2", "doc_id"))
            at = index.find(h1.view(np.uint64), h2.view(np.uint64))
            drop = (at >= 0) & (index.owners[np.maximum(at, 0)] != ids)
            if drop.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[drop]) for x in (ids, h1, h2)], ["doc_id", "h1", "h2"])


def lines_to_drop(hashed: DataFrame) -> DataFrame:
    """(doc_id, h1, h2): the keys that a document loses, as another document with a smaller id has them."""
    spark = hashed.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index, shards = line_index(hashed, partitions)
    total = index.agg(F.sum("hits")).first()[0] or 1
    # A shard with the hits of k partitions is read in k places.
    copies = index.select("shard", F.ceil(F.col("hits") * partitions / F.lit(total)).cast("long").alias("copies"))
    copies = staged(copies, "line-copies")
    places = copies.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"))
    arrays = index.drop("hits").join(places, "shard")
    # Shards without repeated lines have no row; their probes end here.
    probes = hashed.withColumn("shard", F.pmod("h1", F.lit(shards))).join(copies, "shard")
    probes = probes.withColumn("salt", F.pmod(F.xxhash64("doc_id"), "copies")).drop("copies")
    both = arrays.withColumn("kind", F.lit(0)).unionByName(probes.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    placed = both.repartition(partitions, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    return placed.mapInArrow(_probe, "doc_id long, h1 long, h2 long")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = MIN_POINTS) -> DataFrame:
    """``docs`` with the text of the lines kept, and ``n_lines`` (before) and ``n_dropped``."""
    hashed = staged(hashed_lines(docs, id_col, text_col, min_points), "lines")
    drops = lines_to_drop(hashed).groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("drops"))
    drops = drops.withColumnRenamed("doc_id", "drop_id")
    rows = packed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = rows.join(drops, rows.doc_id == drops.drop_id, "left")

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def cut(texts, dropped):
        import pandas as pd

        kept, n_lines, n_dropped = [], [], []
        for text, drop in zip(texts, dropped):
            lines = (text or "").split("\n")
            n_lines.append(len(lines))
            if drop is None or not len(drop):
                kept.append(text)
                n_dropped.append(0)
                continue
            gone = {((d["h1"] & (2**64 - 1)) << 64 | d["h2"] & (2**64 - 1)).to_bytes(16, "big") for d in drop}
            stay = [line for line, key in zip(lines, line_keys(text.encode(), min_points)) if key not in gone]
            kept.append("\n".join(stay))
            n_dropped.append(len(lines) - len(stay))
        return pd.DataFrame({"text": kept, "n_lines": n_lines, "n_dropped": n_dropped})

    done = joined.withColumn("cut", cut("text", "drops"))
    return unpacked(done, {text_col: F.col("cut.text"), "n_lines": F.col("cut.n_lines"), "n_dropped": F.col("cut.n_dropped")})
