"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

1. One pass over the texts gives each document its number of shingles, a 128-bit hash of its shingle set and the keys of
   BANDS bands of ROWS places of its SuperMinHash signature. Documents of one set form a class; only its smallest
   doc_id goes on, so thousands of exact copies cost one row each and no pair.
2. Classes that share a band key are candidates. With 32 bands of 5 places a pair at the threshold of 85 % shares none
   with a chance of 7e-9. Their sets are written once.
3. Two rounds of stars: each class is compared with the smallest, then with the largest id of its buckets, links are
   confirmed by intersecting full sets, and linked classes are united. This is linear in the size of a bucket.
4. What is left are pairs in different components, among classes of a bucket with more than one component. An index of
   each set's rarest shingles, long enough that no similar pair can miss each other in it, gives the pairs that can
   be similar; these alone, and all of these, are checked on full sets. Nothing is capped.
5. Union-find: each task unites the edges it holds, then roots hook onto their smallest neighbour and paths are
   compressed, in joins, until no edge joins two roots. No list of links or components reaches the driver.

Defined cases: a null or empty text has no shingles, and is a component of its own. A row without a doc_id links with
nothing, is kept and has no component_id. Rows that repeat a doc_id are one node with the links of all its texts' classes.
Ties cannot occur: components are named by their smallest id. Other columns are carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import packed, staged, unpacked
from flowloom.llm.shingles import CHUNK_BYTES, WIDTH, band_keys, chunks, mix, shingle_sets, super_minhash

PERCENT = 85
BANDS, ROWS = 32, 5
#: Ratio of sizes within a size class of the shingle index.
CLASS = 1.02


def _sets(batch) -> list:
    """Chunks of a batch's shingle sets, in order."""
    for chunk in chunks(batch.column("text").to_pylist(), CHUNK_BYTES):
        yield list(shingle_sets(chunk, WIDTH))


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, bands): size and hash of each set, and its band keys (none for an empty set)."""

    def run(batches):
        for batch in batches:
            at = 0
            for sets in _sets(batch):
                sizes = np.array([len(s) for s in sets])
                elements = np.concatenate(sets)
                owner = np.repeat(np.arange(len(sets)), sizes)
                keys = band_keys(super_minhash(elements, owner, len(sets), bands * rows), bands, rows)
                sums = np.zeros((2, len(sets)), np.uint64)
                np.add.at(sums[0], owner, mix(elements ^ np.uint64(0x5851F42D4C957F2D)))
                np.add.at(sums[1], owner, mix(elements + np.uint64(0x14057B7EF767814F)))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(bands * (sizes > 0))]), pa.int32()), pa.array(keys[sizes > 0].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(sets)), pa.array(sizes), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), lists],
                    ["doc_id", "n_shingles", "s1", "s2", "bands"],
                )
                at += len(sets)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    found = source.mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>")
    # An empty set is a class of its own.
    return found.withColumn("s2", F.when(F.col("n_shingles") == 0, F.coalesce("doc_id", F.lit(-1))).otherwise(F.col("s2")))


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, items): the full shingle sets of the documents wanted."""

    def run(batches):
        for batch in batches:
            at = 0
            for sets in _sets(batch):
                ends = np.cumsum([0, *map(len, sets)])
                items = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(sets)), items], ["id", "items"])
                at += len(sets)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    source = source.join(wanted, source.doc_id == wanted.id, "left_semi")
    return source.mapInArrow(run, "id long, items array<long>")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left, right = (sets.select(F.col("id").alias(c), F.col("items").alias(f"{c}_items")) for c in ("a", "b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - F.col("shared")
    return both.select("a", "b", "a_items", "b_items", shared.alias("shared")).where(100 * F.col("shared") >= percent * union).select("a", "b")


def _united(batches):
    """Union-find over the edges of one task: each node with its root."""
    parent: dict[int, int] = {}

    def root(x):
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for k in range(0, len(nodes), 1 << 16):
        part = nodes[k : k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["a", "b"])


def _followed(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` replaced by its parent where it has one."""
    up = parents.select(F.col("id").alias("_id"), F.col("parent").alias("_parent"))
    return df.join(up, df[column] == up["_id"], "left").withColumn(column, F.coalesce("_parent", column)).drop("_id", "_parent")


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id each node can reach, for nodes that are not the smallest themselves."""
    edges = staged(edges.select("a", "b").mapInArrow(_united, "a long, b long").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        ways = edges.union(edges.select("b", "a"))
        parents = ways.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("parent")).where("parent < id")
        parents = staged(parents, "parents")
        while True:  # compress: a parent that has a parent gives way to it
            higher = parents.select(F.col("id").alias("_p"))
            if parents.join(higher, parents.parent == higher["_p"], "left_semi").isEmpty():
                break
            parents = staged(_followed(parents, "parent", parents), "parents")
        if labels is None:
            labels = parents.select("id", F.col("parent").alias("label"))
        else:
            old = labels.select(F.col("id").alias("_old"))
            fresh = parents.join(old, parents.id == old["_old"], "left_anti").select("id", F.col("parent").alias("label"))
            labels = staged(_followed(labels, "label", parents).union(fresh), "labels")
        edges = _followed(_followed(edges, "a", parents), "b", parents).where("a <> b")
        edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if labels is None:
        labels = edges.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return labels


def _labelled(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return nodes.withColumn("label", F.col("id"))
    known = labels.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
    return nodes.join(known, nodes.id == known["_id"], "left").withColumn("label", F.coalesce("_label", "id")).drop("_id", "_label")


def _close(a, b, percent: int):
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _class(n):
    """The size class of a set; sizes of one class differ by a factor of CLASS at most."""
    return F.floor(F.log(n) / math.log(CLASS)).cast("int")


def _prefix(n, other, percent: int):
    """How many of a set's rarest shingles are enough to meet one of a similar set of ``other`` shingles or more."""
    shared = F.floor((percent * (n + other) + 99 + percent) / (100 + percent))
    return (n - shared + 1).cast("int")


def _rest(keys: DataFrame, sets: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """Pairs (a, b) of two components, in buckets of more than one, that share a shingle of their prefixes.

    All shingles have one order, the rarest first. Similar sets of n and m shingles share at least one of the first
    n - c + 1 and m - c + 1, c the least common number. So pairs of sets that have more rare shingles of their own than
    similar ones could, as pages of one template have, never meet, and no pair is lost. The prefix depends on
    the sizes of both: each is listed for every size class that a similar set can be of.
    """
    keys = _labelled(keys, labels)
    mixed = keys.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    nodes = staged(keys.join(mixed, "key", "left_semi").select("id", "n", "label").distinct(), "open-nodes")
    items = sets.join(nodes, "id").select("id", "n", "label", F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count(F.lit(1)).alias("often"), (F.min("label") < F.max("label")).alias("common"))
    ranked = items.join(often, "item").groupBy("id").agg(
        F.first("n").alias("n"), F.first("label").alias("label"), F.array_sort(F.collect_list(F.struct("often", "item", "common"))).alias("ranked"))
    n = F.col("n")
    least = F.ceil(n * percent / 100)
    shown = ranked.select("id", "n", "label", "ranked", _class(n).alias("own"), F.explode(F.sequence(_class(least) - 1, _class(F.floor(n * 100 / percent)) + 1)).alias("other"))
    smallest = F.greatest(F.floor(F.pow(F.lit(CLASS), F.col("other"))) - 1, least)
    shown = shown.withColumn("length", _prefix(n, smallest, percent)).where("length > 0")
    listed = shown.select("id", "n", "label", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), F.posexplode(F.slice("ranked", F.lit(1), F.col("length"))).alias("place", "shingle"))
    listed = staged(listed.where("shingle.common").select("id", "n", "label", "own", "lo", "hi", "place", F.col("shingle.item").alias("item")), "prefixes")
    # A shingle that only one component lists joins nothing.
    met = listed.groupBy("item", "lo", "hi").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b").select("item", "lo", "hi")
    listed = listed.join(met, ["item", "lo", "hi"], "left_semi")
    x, y = (listed.select("item", "lo", "hi", *[F.col(c).alias(f"{p}_{c}") for c in ("id", "n", "label", "own", "place")]) for p in ("x", "y"))
    sizes = _close("x_n", "y_n", percent) & (F.col("x_own") + F.col("y_own") == x["lo"] + x["hi"])
    most = F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place"))
    enough = (100 + percent) * most >= percent * (F.col("x_n") + F.col("y_n"))
    here = (x["item"] == y["item"]) & (x["lo"] == y["lo"]) & (x["hi"] == y["hi"])
    # The first shingle that a pair shares bounds all it can share.
    pairs = x.join(y, here & (F.col("x_label") < F.col("y_label")) & sizes).groupBy("x_id", "y_id").agg(F.max(F.struct(most.alias("most"), enough.alias("enough"))).alias("first"))
    return pairs.where("first.enough").select(F.col("x_id").alias("a"), F.col("y_id").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept)."""
    signed = staged(signatures(docs, id_col, text_col), "signatures")
    classes = signed.where("doc_id is not null").groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("id"))
    classes = staged(classes, "classes")
    heads = classes.where("n_shingles > 0").select("id", F.col("n_shingles").alias("n"), F.col("s1").alias("c1"), F.col("s2").alias("c2"))
    own = signed.select("doc_id", "s1", "s2", "bands")
    heads = own.join(heads, (own.doc_id == heads.id) & (own.s1 == heads.c1) & (own.s2 == heads.c2)).dropDuplicates(["id", "s1", "s2"])
    keys = heads.select("id", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    keys = staged(keys.join(shared, "key"), "keys")
    sets = staged(_full_sets(docs, keys.select("id").distinct(), id_col, text_col), "sets")
    labels = edges = None
    for end in ("lo", "hi"):
        nodes = _labelled(keys.select("id", "n").distinct(), labels)
        member = _labelled(keys.select("id", "n", F.col(end).alias("head")).where("id <> head").distinct(), labels)
        head = nodes.select(F.col("id").alias("head"), F.col("n").alias("head_n"), F.col("label").alias("head_label"))
        star = member.join(head, "head").where((F.col("label") != F.col("head_label")) & _close("n", "head_n", percent))
        found = linked(star.select(F.col("head").alias("a"), F.col("id").alias("b")), sets, percent)
        found = staged(found, "links")
        edges = found if edges is None else edges.union(found)
        labels = components(edges)
    found = staged(linked(_rest(keys.select("id", "n", "key"), sets, labels, percent), sets, percent), "links")
    if not found.isEmpty():
        labels = components(edges.union(found))
    named = _labelled(classes, labels).select("n_shingles", "s1", "s2", F.col("label").alias("component_id"))
    result = signed.join(named, ["n_shingles", "s1", "s2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` without those that have a near-duplicate component with a smaller id; rows without an id stay."""
    gone = near_duplicates(docs, id_col, text_col, percent).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = packed(docs, id=id_col)
    return unpacked(rows.join(gone, rows.id == gone.gone, "left_anti"), {})
