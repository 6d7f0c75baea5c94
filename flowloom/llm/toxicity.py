"""Toxicity by compression distance: windows of a text are compressed with two zstandard dictionaries.

The ordinary dictionary is trained by zstandard on windows of ordinary labelled text. The toxic one continues it with the
pieces of words that tell toxic text apart: 6-byte strings that stand in at least CONTEXTS different surroundings in the
toxic texts of the sample and RATIO times as often, per byte, as in the ordinary ones. Surroundings are counted instead
of places, so a passage copied over many documents counts once. Whatever both dictionaries share costs both the same, so
the difference of the two compressed lengths of a window is what the toxic pieces save.

A window is WINDOW words; all windows of the whole text count. How many windows save 1, 2, ... bytes, as counts and as
shares, is calibrated on the sample by logistic regression, which sets the thresholds of the savings.

The fit takes a bounded, documented sample: TOXIC toxic and ORDINARY ordinary labelled rows, those of smallest hash of
doc_id. Of the windows of its ordinary rows, wherever in a text, some ORDINARY_WINDOWS of smallest hash train the ordinary
dictionary; pieces are counted in Spark over all its toxic texts. Dictionaries and calibration are a few kB at any input.

Defined cases: a text without words (or null) has no windows and scores as the calibration of no windows says. Without
labels of both classes every score is the share of label 1 (0.5 without any label). Labels and rows as in ``quality``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.quality import sample_ids, sample_texts

WINDOW = 8
TOXIC, ORDINARY = 3000, 5000
CONTEXTS, RATIO, PIECES = 6, 10.0, 3
ORDINARY_BYTES = 1024
#: Windows that the ordinary dictionary is trained on, about: those of smallest hash among all windows of the sample.
ORDINARY_WINDOWS = 60_000
_FINE = 1 << 30
PRIMER = 48
_GRAM, _SIDE = 6, 3


def folded(text: bytes) -> bytes:
    return b" ".join(text.decode("utf-8", "replace").lower().encode().split())


def windows(text: bytes) -> list[bytes]:
    held = folded(text).split()
    return [b" " + b" ".join(held[i : i + WINDOW]) + b" " for i in range(0, len(held), WINDOW)]


def contexts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The 6-byte strings of a text and the six bytes around each, as numbers, each pair once."""
    pad = b" " * (_GRAM + 2 * _SIDE)
    data = np.frombuffer(pad + folded(text) + pad, np.uint8)
    n = len(data) - _GRAM - 2 * _SIDE + 1
    gram, around = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(_GRAM + 2 * _SIDE):
        target = gram if _SIDE <= i < _SIDE + _GRAM else around
        target <<= 8
        target |= data[i : i + n]
    both = np.unique(np.stack([gram, around], 1), axis=0)
    return both[:, 0], both[:, 1]


def telling_grams(sample: DataFrame) -> set[bytes]:
    """6-byte strings with many more surroundings in toxic texts than in ordinary ones, counted in Spark."""

    def run(batches):
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                gram, around = contexts(text)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(around), pa.array(np.full(len(gram), label, np.int32))], ["gram", "around", "label"])

    seen = sample.mapInArrow(run, "gram long, around long, label int")
    seen = seen.groupBy("gram", "around").agg(F.max("label").alias("toxic"), (1 - F.min("label")).alias("plain"))
    counts = seen.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    size = sample.groupBy("label").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    size = {r.label: max(1, r.n) for r in size}
    rate = F.col("toxic") / size[1] >= RATIO * (F.col("plain") + 0.5) / size[0]
    return {r.gram.to_bytes(_GRAM, "big") for r in counts.where((F.col("toxic") >= CONTEXTS) & rate).select("gram").collect()}


def pieces(text: bytes, telling: set[bytes]) -> list[bytes]:
    """The parts of words that telling strings cover."""
    data = b" " + folded(text) + b" "
    spans: list[list[int]] = []
    for i in range(len(data) - _GRAM + 1):
        if data[i : i + _GRAM] in telling:
            if spans and i <= spans[-1][1]:
                spans[-1][1] = i + _GRAM
            else:
                spans.append([i, i + _GRAM])
    return [b" " + p for a, b in spans for p in data[a:b].split() if len(p) >= 4]


class Model:
    def __init__(self, ordinary: bytes, toxic: bytes, weights: np.ndarray):
        self.ordinary, self.toxic, self.weights = ordinary, toxic, weights
        self._compressors = None

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights, "_compressors": None}

    def _compressor(self, content: bytes):
        plain = zstandard.ZstdCompressionParameters(
            window_log=12, hash_log=11, chain_log=12, search_log=7, min_match=4, target_length=16, strategy=zstandard.STRATEGY_LAZY,
            write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=plain)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=plain)

    def savings(self, text: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves, window by window."""
        if self._compressors is None:
            self._compressors = self._compressor(self.ordinary).compress, self._compressor(self.toxic + self.ordinary).compress
        plain, toxic = self._compressors
        # Both dictionaries end with the primer, so a window is never too short to be compressed.
        primer = self.ordinary[-PRIMER:]
        return np.array([len(plain(primer + w)) - len(toxic(primer + w)) for w in windows(text)])

    def traits(self, text: bytes) -> np.ndarray:
        g = self.savings(text)
        n = len(g)
        if not n:
            return np.array([0.0] * 15 + [1.0])
        counts = [np.log1p((g == k).sum() if k < 7 else (g >= k).sum()) for k in range(1, 8)]
        shares = [np.sqrt((g >= k).mean()) for k in (2, 3, 4, 6)]
        top = np.sort(g)[::-1]
        return np.array([*counts, *shares, top[0], top[:3].mean(), g.mean(), np.log(n), 1.0])

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.traits(text) @ self.weights, -30, 30))))


def _calibrated(rows: np.ndarray, labels: np.ndarray, share: float) -> np.ndarray:
    """Logistic regression by Newton's steps, with the classes weighted to their share of all labels."""
    part = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    scale = rows.std(0)
    scale[scale == 0] = 1
    x = rows / scale
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (part * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (part * (p - labels)) + 0.05 * w)
    return w / scale


def _constant(share: float) -> Model:
    weights = np.zeros(16)
    weights[-1] = np.log(share / (1 - share))
    return Model(b"", b"", weights)


def train(
    docs: DataFrame, labels: DataFrame, label: str, fit_rows: Column, sample: tuple[int, int] = (ORDINARY, TOXIC), id_col: str = "doc_id", text_col: str = "text",
) -> Model:
    from flowloom.llm.common import staged

    chosen, counts = sample_ids(docs, labels, label, fit_rows, sample, id_col)
    toxic_share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(counts) < 2:
        return _constant(toxic_share)
    texts = staged(sample_texts(docs, chosen, id_col, text_col), "toxic-sample").repartition(64)
    telling = telling_grams(texts)

    def found(batches):
        for batch in batches:
            for doc_id, text, mark in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label"))):
                held = pieces(text, telling) if mark else windows(text)
                n = len(held)
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([mark] * n, pa.int32()), pa.array(held, pa.binary())], ["doc_id", "place", "label", "held"])

    parts = staged(texts.mapInArrow(found, "doc_id long, place long, label int, held binary"), "toxic-parts")
    often = {bytes(r.held): r.n for r in parts.where("label = 1").groupBy("held").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= PIECES).collect()}
    toxic = b"".join(sorted(often, key=lambda p: (often[p], p)))
    own = parts.where("label = 0")
    share = min(1.0, ORDINARY_WINDOWS / max(1, own.count()))
    own = own.where(F.pmod(F.xxhash64("doc_id", "place"), F.lit(_FINE)) < int(share * _FINE))
    plain = [bytes(r.held) for r in sorted(own.collect(), key=lambda r: (r.doc_id, r.place))]
    try:
        ordinary = zstandard.train_dictionary(ORDINARY_BYTES, plain, d=6, k=50).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the windows themselves
        ordinary = b"".join(plain)[-ORDINARY_BYTES:]
    model = Model(ordinary, toxic, np.zeros(16))

    def measured(batches):
        for batch in batches:
            for doc_id, text, mark in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label"))):
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([mark], pa.int32()), pa.array([model.traits(text).tolist()])], ["doc_id", "label", "x"])

    rows = sorted(texts.mapInArrow(measured, "doc_id long, label int, x array<double>").collect(), key=lambda r: r.doc_id)
    model.weights = _calibrated(np.array([r.x for r in rows]), np.array([r.label for r in rows]), toxic_share)
    return model


def score_column(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """The score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts, shared=shared):
        import pandas as pd

        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return score(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
