"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item is contained in a document if the document has at least PERCENT of the item's distinct five-word shingles. A
signature of the document cannot show that: an item of 30 shingles is a thousandth of a document of 30,000. So the
signature is the item's: its shingles of smallest hash. Items are partitioned by size, in classes of sizes below the next
power of two, and a class with at most n shingles takes the n - ceil(PERCENT * n) + 1 smallest. A document that
contains the item lacks fewer shingles than that, so it holds one of the signature: no match is missed.

The distinct sets of the items are written to the shared folder; items of equal sets are searched once and joined to the
matches. Sets are taken in blocks of about BLOCK_SHINGLES shingles, the bound of what driver and executors hold at a time: one
block is loaded, sent, searched in all documents, whole texts, without a shuffle, and freed before the next. Only documents
that hold a shingle of a signature are compared in full.

Defined cases: an item with fewer than five words is contained in a document that has its words in a row; an item or a
document without words matches nothing. A document without an id is searched like others (its id in a match is null).
Repeated rows of either side give repeated matches. Other columns are carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import packed, staged, unpacked
from flowloom.llm.shingles import WIDTH, chunks, shingle_hashes, shingle_sets, words

PERCENT = 80
BLOCK_SHINGLES = 1 << 21


def item_sets(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, width, n, shingles): the distinct shingles of each item, by hash; items without words have none."""

    def run(batches):
        for batch in batches:
            at = 0
            for chunk in chunks(batch.column("text").to_pylist()):
                sets = list(shingle_sets(chunk))
                _, first = words(chunk)
                width = np.minimum(first[1:] - first[:-1], WIDTH)
                lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").slice(at, len(sets)), pa.array(width, pa.int32()), pa.array([len(s) for s in sets], pa.int64()), lists],
                    ["item_id", "width", "n", "shingles"],
                )
                at += len(sets)

    source = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(run, "item_id long, width int, n long, shingles array<long>").where("n > 0")


def signature_size(n: int, percent: int) -> int:
    """Shingles in the signature of an item with n: as many as the largest item of its size class needs."""
    largest = (1 << n.bit_length()) - 1
    return min(n, largest - math.ceil(largest * percent / 100) + 1)


class Block:
    """Signatures and full sets of some items, for the search in one text after the other."""

    def __init__(self, rows, percent: int):
        self.percent = percent
        self.ids = [r.set_id for r in rows]
        self.sets = [np.array(r.shingles, np.int64).view(np.uint64) for r in rows]
        self.by_width = {}
        for width in sorted({r.width for r in rows}):
            of = [k for k, r in enumerate(rows) if r.width == width]
            cut = [np.sort(self.sets[k])[: signature_size(len(self.sets[k]), percent)] for k in of]
            hashes, item = np.concatenate(cut), np.repeat(of, [len(c) for c in cut])
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(1 << 16, bool)
            seen[hashes >> np.uint64(48)] = True
            self.by_width[width] = (hashes[order], item[order], seen)

    def search(self, texts: list[bytes]):
        """(text's number, item's number, shingles found) of each match."""
        hashes, first = words(texts)
        for width, (signature, item, seen) in self.by_width.items():
            runs = shingle_hashes(hashes, width)
            at = np.flatnonzero(seen[runs >> np.uint64(48)])
            lo = np.searchsorted(signature, runs[at], "left")
            hi = np.searchsorted(signature, runs[at], "right")
            hit = hi > lo
            candidates = set()
            for place, a, b in zip(at[hit].tolist(), lo[hit].tolist(), hi[hit].tolist()):
                doc = int(np.searchsorted(first, place, "right")) - 1
                candidates.update((doc, int(k)) for k in item[a:b])
            held = None
            for doc, k in sorted(candidates):
                if held is None or held[0] != doc:
                    held = doc, np.unique(runs[first[doc] : max(first[doc], first[doc + 1] - width + 1)])
                found = len(np.intersect1d(held[1], self.sets[k], assume_unique=True))
                if 100 * found >= self.percent * len(self.sets[k]):
                    yield doc, k, found


def _distinct_sets(sets: DataFrame) -> DataFrame:
    """(set_id, width, n, shingles): each set once, by the hash of its shingles."""
    sets = sets.withColumn("set_id", F.sha2(F.concat_ws(",", F.col("width").cast("string"), F.col("shingles").cast("array<string>")), 256))
    return sets.select("set_id", "item_id", "width", "n", "shingles")


def _blocks(sets: DataFrame, percent: int):
    """The distinct sets, block by block: (block, whether it is the only one)."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_SHINGLES))
    for k in range(n):
        part = sets.where(F.pmod(F.xxhash64("set_id"), F.lit(n)) == k).collect()
        if part:
            block, part = Block(part, percent), None
            yield block, n == 1


def _found(docs: DataFrame, shared) -> DataFrame:
    """(doc_id, set_id, n_item_shingles, n_found) for the sets of one block."""

    def run(batches):
        block = shared.value
        for batch in batches:
            ids, at, rows = batch.column("doc_id").to_pylist(), 0, []
            for chunk in chunks(batch.column("text").to_pylist()):
                rows += [(ids[at + d], block.ids[k], len(block.sets[k]), n) for d, k, n in block.search(chunk)]
                at += len(chunk)
            if rows:
                doc_ids, set_ids, sizes, counts = zip(*rows)
                longs = [pa.array(c, pa.int64()) for c in (doc_ids, sizes, counts)]
                yield pa.RecordBatch.from_arrays([longs[0], pa.array(set_ids), *longs[1:]], ["doc_id", "set_id", "n_item_shingles", "n_found"])

    return docs.mapInArrow(run, "doc_id long, set_id string, n_item_shingles long, n_found long")


def _written_sets(items: DataFrame, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """(set_id, item_id) of all items, and the distinct sets, both in the shared folder."""
    named = staged(_distinct_sets(item_sets(items, item_id, item_text)), "items")
    sets = named.groupBy("set_id").agg(*[F.first(c).alias(c) for c in ("width", "n", "shingles")])
    return named.select("set_id", "item_id"), staged(sets, "item-sets")


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_found): every item contained in a document."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    named, sets = _written_sets(items, item_id, item_text)
    found = spark.createDataFrame([], "doc_id long, set_id string, n_item_shingles long, n_found long")
    for block, only in _blocks(sets, percent):
        shared = spark.sparkContext.broadcast(block)
        del block
        part = _found(source, shared)
        if not only:
            part = staged(part, "contained")
            shared.destroy()
        found = found.union(part)
    return found.join(named, "set_id").select("doc_id", "item_id", "n_item_shingles", "n_found")


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", percent: int = PERCENT,
) -> DataFrame:
    """``docs`` without the documents that contain an item: one pass over the texts for each block, no shuffle of them."""
    spark = docs.sparkSession
    rows = packed(docs, text=text_col)
    for block, only in _blocks(_written_sets(items, item_id, item_text)[1], percent):
        shared = spark.sparkContext.broadcast(block)
        del block

        @F.pandas_udf("boolean")
        def clean(texts, shared=shared):
            import pandas as pd

            keep, at = np.ones(len(texts), bool), 0
            for chunk in chunks(texts.tolist()):
                for doc, _, _ in shared.value.search(chunk):
                    keep[at + doc] = False
                at += len(chunk)
            return pd.Series(keep)

        rows = rows.where(clean(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
        if not only:
            rows = staged(rows, "decontaminated")
            shared.destroy()
    return unpacked(rows, {})
