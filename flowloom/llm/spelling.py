"""Spelling variant grouping: a bidirectional FM-index search scheme finds all words at one error from a word.

1. One pass over the texts counts words; a task sums its own counts before the shuffle, so a frequent word is a row a task.
2. Two words at one error agree in the first or in the second half of either. So the vocabulary is dealt twice, by its
   words' first KEY and by their last KEY code points, neither of which is longer than half a word. Each task builds
   FM-indexes over the words it holds, INDEX_WORDS or one key at a time, and looks all of them up: the second half matched
   exactly and the first with one error over the words, the first exactly and the second with one error over the reversed
   words (``fm_index``). A key with more than INDEX_WORDS words is cut into blocks, and its words are looked up in each.
3. Pairs are reduced to one row per word; forms are followed to their roots by doubling the way with each join.

Defined cases: a null or empty text has no words. A null doc_id counts as empty text in ``<doc_id>:<run>``. Repeated rows
count again. Ties for the form: the smallest word in code-point order. Roots end, as each form is at least FACTOR
times as frequent as its word. An empty table has no words. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import staged
from flowloom.llm.fm_index import FmIndex

MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5
KEY = MIN_LENGTH // 2
#: Every run whose hash this number divides loses a code point; 0 for none.
TYPO_EVERY = 199
INDEX_WORDS = 20_000
#: Words that a task counts before it passes the counts on.
HELD_WORDS = 200_000


def runs_of(text: bytes | None, least: int) -> list[str]:
    """Maximal runs of at least ``least`` letters; only A-Z are lower-cased."""
    return re.findall(f"[a-zÀ-ÿ]{{{least},}}", (text or b"").lower().decode("utf-8", "replace"))


def misspelt(doc_id: int | None, run: str, every: int) -> str:
    """The run without one code point, if the hash of it and the document says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH, every: int = TYPO_EVERY, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts with at least ``least`` code points and ``min_count`` occurrences."""

    def run(batches):
        total: Counter[str] = Counter()

        def handed_on():
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for run, n in Counter(runs_of(text, least)).items():
                    word = misspelt(doc_id, run, every)
                    if len(word) >= least:
                        total[word] += n
                if len(total) > HELD_WORDS:
                    yield handed_on()
                    total.clear()
        yield handed_on()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    counted = source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


class _Searcher:
    """Takes the rows of one task in order and gives pairs of near words; holds one index and one block of words."""

    def __init__(self, limit: int):
        self.limit = limit
        self.side = self.group = self.index = None
        self.own: dict[str, int] = {}
        self.asked: list[str] = []

    def take(self, side: int, key: str, block: int, asks: bool, indexed: bool, word: str, n: int):
        if (side, key, block) != self.group:
            # Blocks of one key are asked for the same words, so they never share an index.
            if side != self.side or len(self.own) >= self.limit or (side, key) == (self.group or (0, 0, 0))[:2]:
                yield self.flushed()
                self.side, self.own = side, {}
            self.group = (side, key, block)
        if indexed:
            self.own[word] = n
            self.index = None
        if asks:
            self.asked.append(word)
            # The rows to be indexed come first within a group: from here on the index is whole, if there are more to ask than it has words.
            if not indexed and len(self.asked) >= self.limit:
                yield self.flushed()

    def flushed(self) -> pa.RecordBatch:
        out: tuple[list, list, list] = ([], [], [])
        if self.asked and self.own:
            if self.index is None:
                self.words = sorted(w[:: -1 if self.side else 1] for w in self.own)
                self.index = FmIndex(self.words)
            turn = -1 if self.side else 1
            exact = [len(w) // 2 if self.side else len(w) - len(w) // 2 for w in self.asked]
            for places, numbers in self.index.near([w[::turn] for w in self.asked], exact):
                for place, number in zip(places.tolist(), numbers.tolist()):
                    word, near = self.asked[place], self.words[number][::turn]
                    half = len(word) // 2
                    # Words with a common first half are found there.
                    if self.side or near[:half] != word[:half]:
                        for column, value in zip(out, (word, near, self.own[near])):
                            column.append(value)
        self.asked = []
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], ["word", "near", "near_n"])


def near_pairs(vocabulary: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """(word, near, near_n): each word with every word at one inserted, deleted or replaced code point, once."""
    keyed = vocabulary.select("word", "n", F.posexplode(F.array(F.expr(f"right(word, {KEY})"), F.expr(f"left(word, {KEY})"))).alias("side", "key"))
    groups = keyed.groupBy("side", "key").agg(F.ceil(F.count(F.lit(1)) / index_words).cast("int").alias("blocks"))
    wide = groups.where("blocks > 1")
    keyed = keyed.join(wide, ["side", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    home = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = keyed.withColumn("home", home).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    dealt = dealt.withColumn("indexed", F.col("home") == F.col("block"))

    def run(batches):
        searcher = _Searcher(index_words)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("side", "key", "block", "indexed", "word", "n"))
            for side, key, block, indexed, word, n in zip(*columns):
                yield from searcher.take(side, key, block, True, indexed, word, n)
        yield searcher.flushed()

    dealt = dealt.repartition("side", "key", "block").sortWithinPartitions("side", "key", "block", F.desc("indexed"), "word")
    return dealt.select("side", "key", "block", "indexed", "word", "n").mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where the forms lead in the end; each join doubles the way."""
    ways = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        next_way = ways.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = ways.join(next_way, ways.root == next_way["_at"], "left")
        if joined.where("_next is not null").isEmpty():
            return ways
        ways = staged(joined.select("word", F.coalesce("_next", "root").alias("root")), "forms")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH, every: int = TYPO_EVERY, min_count: int = MIN_COUNT, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary."""
    if least < MIN_LENGTH:
        raise ValueError(f"words need {MIN_LENGTH} code points: half of them must hold the key")
    words = staged(word_counts(docs, id_col, text_col, least, every, min_count), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left")
    formed = -F.col("best.minus_n") >= factor * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.minus_n")).alias("form_n"))
    known = staged(known, "near-words")
    ends = roots(known.where("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
