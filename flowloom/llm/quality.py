"""Quality classifier: supervised subword embeddings trained by numpy stochastic gradient descent.

A document has four families of hashed traits: byte 3-grams and 4-grams as written, words, and pairs of neighbouring
words (a word after itself is one trait of its own). Each feature's bucket has a learned vector; the vectors are
averaged within a family and the families are averaged; a softmax layer on top gives the two classes. Vectors and softmax
are learned together, as in supervised word-vector classifiers.

The fit takes a bounded, documented sample: SAMPLE labelled documents of each class, those of smallest hash of doc_id; the
share of the classes among all labelled documents of the fit is put back as a bias. Traits are counted in parallel and
written; one task on an executor then takes them step by step, sorted by epoch and a hash, and holds no more than the
vectors and one batch. Neither texts nor traits reach the driver: it gets the model, one number for each trait (2 MB).
Scoring takes every whole text, in one pass without a shuffle: as averages and logits are linear, a feature's vector
comes down to one number, so the model sent to the executors is one table of fixed size.

Defined cases: an empty or null text has no traits and scores as the bias alone says. Without labels of both classes
every score is the share of label 1 (0.5 without any label). Null labels and labels of unknown documents are ignored; of
repeated labels the smallest counts. Repeated rows get equal scores; a doc_id is learned once, by its smallest text. Rows without doc_id are scored and held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import staged
from flowloom.llm.shingles import chunks, shingle_hashes, words

BUCKET_BITS = 16
FAMILIES = 4
DIMENSIONS = 16
SAMPLE = 2000
EPOCHS = 6
RATE = 0.5
SEED = 11
_SALT = np.array([0x9E3779B1, 0x85EBCA77], np.uint32)


def grams(texts: list[bytes]):
    """For each family: the buckets of all texts in order, and each text's begin and end in them."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8).astype(np.uint32)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    begin, end = offsets[:-1], offsets[1:] - 1
    shift = np.uint32(32 - BUCKET_BITS)
    for k, n in enumerate((3, 4)):
        size = max(len(data) - n + 1, 0)
        grams = np.zeros(size, np.uint32)
        for i in range(n):
            grams |= data[i : i + size] << np.uint32(8 * i)
        mixed = grams * _SALT[k]
        mixed ^= mixed >> np.uint32(15)
        yield ((mixed * np.uint32(0x2C1B3C6D)) >> shift).astype(np.int32), begin, np.maximum(begin, end - n + 1)
    hashes, first = words(texts)
    wide = np.uint64(64 - BUCKET_BITS)
    yield (hashes >> wide).astype(np.int32), first[:-1], first[1:]
    pairs = shingle_hashes(hashes, 2)
    pairs[hashes[1:] == hashes[:-1]] = 0
    yield (pairs >> wide).astype(np.int32), first[:-1], np.maximum(first[:-1], first[1:] - 1)


class Model:
    """One number for each feature, and the bias: the difference of the two logits."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        logit = np.full(len(texts), self.bias)
        for table, (ids, begin, end) in zip(self.weights, grams(texts)):
            running = np.zeros(len(ids) + 1)
            np.cumsum(table[ids], out=running[1:])
            logit += (running[end] - running[begin]) / np.maximum(end - begin, 1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


class Trainer:
    """Stochastic gradient descent over (trait ids, their counts, class) that come one after the other."""

    def __init__(self, steps: int):
        rng = np.random.default_rng(SEED)
        self.vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (FAMILIES << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
        self.top, self.bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
        self.steps, self.done = steps, 0

    def step(self, ids: np.ndarray, counts: np.ndarray, label: int) -> None:
        rate = np.float32(RATE * (1 - self.done / self.steps))
        self.done += 1
        family = ids >> BUCKET_BITS
        total = np.bincount(family, counts, FAMILIES)
        parts = (counts / (np.maximum(total, 1)[family] * FAMILIES)).astype(np.float32)
        mean = parts @ self.vectors[ids]
        logits = mean @ self.top + self.bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[label] -= 1
        back = self.top @ p
        self.top -= rate * np.outer(mean, p)
        self.bias -= rate * p
        self.vectors[ids] -= (rate * 20) * np.outer(parts, back)

    def model(self, seen: float, share: float) -> Model:
        """``seen`` and ``share``: those of class 1 among the rows that came and among all labelled."""
        prior = np.log(share / (1 - share)) - np.log(seen / (1 - seen))
        weights = (self.vectors @ (self.top[:, 1] - self.top[:, 0])).astype(float).reshape(FAMILIES, -1) / FAMILIES
        return Model(weights, float(self.bias[1] - self.bias[0] + prior))


def labelled(docs: DataFrame, labels: DataFrame, label: str, fit_rows: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label, pick): the labelled documents that the fit may see, with the order of sampling."""
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    marks = marks.where(F.col("label").isin(0, 1) & fit_rows).groupBy("doc_id").agg(F.min("label").alias("label"))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    return marks.join(texts, marks.doc_id == texts["_id"]).drop("_id").withColumn("pick", F.xxhash64("doc_id", F.lit(SEED)))


def sample_ids(docs: DataFrame, labels: DataFrame, label: str, fit_rows: Column, sizes: tuple[int, int], id_col: str) -> tuple[DataFrame, dict[int, int]]:
    """The bounded sample's labels, and how many labelled documents each class has."""
    ids = docs.select(id_col).withColumn("_text", F.lit(""))
    known = labelled(ids, labels, label, fit_rows, id_col, "_text").select("doc_id", "label", "pick").distinct()
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [known.where(F.col("label") == k).orderBy("pick", "doc_id").limit(sizes[k]) for k in (0, 1)]
    return parts[0].union(parts[1]).select(F.col("doc_id").alias("sample_id"), "label"), counts


def sample_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, label, text) of the sample, one text for each id: the smallest of repeated ones. The sample is the small side of
    the join, of at most its documented bound."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    found = texts.join(F.broadcast(chosen), texts.doc_id == chosen.sample_id)
    return found.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))


def _traits(texts: DataFrame) -> DataFrame:
    """(doc_id, label, ids, counts): the distinct trait ids of each text and how often each stands there."""

    def run(batches):
        for batch in batches:
            at = 0
            for chunk in chunks(batch.column("text").to_pylist()):
                families = list(grams(chunk))
                ids, counts = [], []
                for i in range(len(chunk)):
                    own = [np.unique(of[begin[i] : end[i]], return_counts=True) for of, begin, end in families]
                    ids.append(np.concatenate([x + (k << BUCKET_BITS) for k, (x, _) in enumerate(own)]).astype("<i4").tobytes())
                    counts.append(np.concatenate([n for _, n in own]).astype("<i4").tobytes())
                held = [batch.column(c).slice(at, len(chunk)) for c in ("doc_id", "label")]
                yield pa.RecordBatch.from_arrays([*held, pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "label", "ids", "counts"])
                at += len(chunk)

    return texts.mapInArrow(run, "doc_id long, label int, ids binary, counts binary")


def train(docs: DataFrame, labels: DataFrame, label: str, fit_rows: Column, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    chosen, counts = sample_ids(docs, labels, label, fit_rows, (sample, sample), id_col)
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(counts) < 2:
        return Model(np.zeros((FAMILIES, 1 << BUCKET_BITS)), float(np.log(share / (1 - share))))
    used = {k: min(n, sample) for k, n in counts.items()}
    steps = EPOCHS * sum(used.values())

    def run(batches):
        trainer = Trainer(steps)
        for batch in batches:
            for ids, n, mark in zip(*(batch.column(c) for c in ("ids", "counts", "label"))):
                trainer.step(np.frombuffer(ids.as_buffer(), "<i4"), np.frombuffer(n.as_buffer(), "<i4"), mark.as_py())
        model = trainer.model(used[1] / sum(used.values()), counts[1] / sum(counts.values()))
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    traits = staged(_traits(sample_texts(docs, chosen, id_col, text_col)), "traits")
    # Each epoch sees the rows in an order of its own; one task takes them one after the other.
    shuffled = traits.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS)))).coalesce(1)
    shuffled = shuffled.sortWithinPartitions("epoch", F.xxhash64("doc_id", "epoch"), "doc_id").select("label", "ids", "counts")
    (fitted,) = shuffled.mapInArrow(run, "weights binary, bias double").collect()
    return Model(np.frombuffer(fitted.weights).reshape(FAMILIES, -1), fitted.bias)


def score_column(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """The score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts, shared=shared):
        import pandas as pd

        parts = [shared.value.scores(chunk) for chunk in chunks(texts.tolist())]
        return pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return score(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus
