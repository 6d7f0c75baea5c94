"""Best-fit packing of documents into sequences: bounded-space online best-fit.

1. Each task tokenizes its documents and cuts those longer than a sequence; the first piece takes the remainder, so all
   other pieces are whole sequences. It packs pieces as they come, STEP at a time and these from the longest on: OPEN_BINS sequences at most are open, lists
   of them are keyed by free space, and a bitset marks the keys in use, so the tightest fit is the lowest set bit at or
   above a piece's length. If a new sequence is needed and all places are taken, the fullest closes first.
2. The sequences that are still open when a task ends are at most OPEN_BINS rows, whatever it read. They are packed once
   more as wholes, BINS_PER_TASK to a task, the fullest first. So the number of sequences does not depend on how the
   table was split, and no text moves. Pieces are written before that: a repeated task cannot deal them differently.

Ids come from the tokenizer file, whose words are cut before white space; a unit of white space and what follows it
therefore has the same ids everywhere, and each worker remembers those of the short units it met last, about UNITS.

Defined cases: a null or empty text has the end id alone. Repeated rows are packed one by one. Very long texts are cut up
unit by unit, never held as token objects. Strings of special tokens in a text are ordinary text. A null doc_id is kept.
An empty table has no pieces. Ties (equal free space) go to the sequence filled last. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import staged

CAPACITY = 2048
OPEN_BINS = 2048
#: Pieces that come in one step of the online packing, the longest first; no more than OPEN_BINS, so that none of a
#: step's sequences has to close before shorter pieces came.
STEP = 2000
BINS_PER_TASK = 2000
END_ID = 0
#: Units that a worker remembers of each of two generations, and how long they are at most.
UNITS, LONG = 300_000, 40
#: Code points that are cut into units at once.
PART = 1 << 20
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: White space with what follows it, up to the end of a run of letters if a sign comes next, else to the next white space;
#: no word of the vocabulary reaches across the start of such a unit.
UNIT = re.compile(f"[{_SPACE}]*[{_LETTER}]+(?![^!-@\\[-`{{-~{_SPACE}])|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
WORD = re.compile(f" ?[{_LETTER}]+")


class Packer:
    """Open bins by free space; ``fill`` is known for those still open."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.n_open = self.n_bins = 0

    def put(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            own = self._taken(free)
        else:
            if self.n_open == self.open_bins and length < self.capacity:
                self._taken((self.bits & -self.bits).bit_length() - 1)
            free, own = self.capacity, self.n_bins
            self.n_bins += 1
        if free > length:
            self.by_free[free - length].append(own)
            self.bits |= 1 << (free - length)
            self.n_open += 1
        return own, self.capacity - free

    def _taken(self, free: int) -> int:
        held = self.by_free[free]
        own = held.pop()
        if not held:
            self.bits ^= 1 << free
        self.n_open -= 1
        return own

    def still_open(self) -> list[tuple[int, int]]:
        """(bin, fill) of the open bins."""
        return [(own, self.capacity - free) for free, held in enumerate(self.by_free) for own in held]


class Ids:
    """Token ids of texts as little-endian bytes, by a tokenizer file.

    The ids of short units are remembered: those seen since the last change of generation, and of the generation before
    those seen again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        in_bytes = self.tokenizer.pre_tokenizer.pre_tokenize_str
        #: How the tokenizer's own first step writes the bytes of a blank and of each letter.
        self.signs = {ord(c): "".join(part for part, _ in in_bytes(c)) for c in map(chr, range(256)) if WORD.fullmatch(f"a{c}") or c == " "}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, units: set[str]) -> list[str]:
        """Let ``known`` have all ``units``; gives those too long to be kept."""
        if len(self.known) > UNITS:
            self.known, self.older = {}, self.known
        new = list(units.difference(self.known))
        if self.older:
            self.known.update((u, self.older[u]) for u in new if u in self.older)
            new = [u for u in new if u not in self.older]
        signs, merged = self.signs, self.tokenizer.model.tokenize
        for unit in filter(WORD.fullmatch, new):
            # One word of the vocabulary: only its merges are left to do.
            found = [token.id for token in merged(unit.translate(signs))]
            self.known[unit] = pack(f"<{len(found)}I", *found)
        rest = [u for u in new if u not in self.known]
        for k in range(0, len(rest), 10_000):
            for unit, found in zip(rest[k : k + 10_000], self.tokenizer.encode_batch_fast(rest[k : k + 10_000], add_special_tokens=False)):
                self.known[unit] = pack(f"<{len(found)}I", *found.ids)
        return [u for u in new if len(u) > LONG]

    def of(self, text: str) -> bytes:
        return next(self.of_all([text]))

    def of_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; units are learned for about PART code points of texts at a time."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) > PART:
                yield from self._told(held)
                found = (m[0] for m in UNIT.finditer(text))
                parts = iter(lambda: list(islice(found, PART >> 4)), [])
                yield b"".join([b"".join(self._told([units])) for units in parts])
                held, size = [], 0
                continue
            if size + len(text) > PART:
                yield from self._told(held)
                held, size = [], 0
            held.append(UNIT.findall(text))
            size += len(text)
        yield from self._told(held)

    def _told(self, lists: list[list[str]]) -> list[bytes]:
        long = self._learn(set().union(*lists))
        known = self.known.__getitem__
        out = [b"".join(map(known, units)) for units in lists]
        for unit in long:
            del self.known[unit]
        return out


_ids: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """The worker's own ``Ids`` of a file."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


def piece_bounds(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = length % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


_PIECES = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "task": pa.int64(), "bin": pa.int64(), "offset": pa.int64(), "fill": pa.int64()}
_MOVED = {"task": pa.int64(), "bin": pa.int64(), "sequence": pa.int64(), "base": pa.int64()}


def _batch(rows: list[tuple], fields: dict) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values())], list(fields))


def pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """A row for each piece with its bin, and at the end of a task one with ``fill`` for each bin still open."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        known, packer, task = ids_of(tokenizer), Packer(capacity, open_bins), TaskContext.get().partitionId()
        held: list[tuple] = []

        def placed():
            held.sort(key=lambda piece: -piece[3])
            rows = [(*piece, task, *packer.put(piece[3]), None) for piece in held]
            held.clear()
            return _batch(rows, _PIECES)

        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), known.of_all(texts)):
                ids = memoryview(found + end)
                for k, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    held.append((doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    if len(held) == STEP:
                        yield placed()
        yield placed()
        yield _batch([(None, None, None, None, None, task, own, None, fill) for own, fill in packer.still_open()], _PIECES)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task long, bin long, offset long, fill long")


def repacked(left: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """(task, bin, sequence, base): where each bin left open goes as a whole, and at which offset it starts there."""

    def run(batches):
        packer, task = Packer(capacity, open_bins), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for own_task, own, fill in zip(*(batch.column(c).to_pylist() for c in ("task", "bin", "fill"))):
                to, base = packer.put(fill)
                # Numbers below zero: they cannot meet those of bins that stay.
                rows.append((own_task, own, -1 - ((task << 32) | to), base))
            yield _batch(rows, _MOVED)

    tasks = -(-left.count() // BINS_PER_TASK)
    dealt = left.repartition(max(1, tasks), "task", "bin").sortWithinPartitions(F.desc("fill"), "task", "bin")
    return dealt.mapInArrow(run, "task long, bin long, sequence long, base long")


def packed_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece of every document and its place."""
    written = staged(pieces(docs, tokenizer, id_col, text_col, capacity, open_bins), "pieces")
    moved = repacked(written.where("fill is not null").select("task", "bin", "fill"), capacity, open_bins)
    placed = written.where("fill is null").join(moved, ["task", "bin"], "left")
    sequence = F.coalesce("sequence", F.shiftleft("task", 32).bitwiseOR(F.col("bin")))
    offset = F.col("offset") + F.coalesce("base", F.lit(0))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), offset.alias("offset"))
