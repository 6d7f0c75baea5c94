"""Spelling variants, packing and clustering against brute force, and on edges."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_operators_on_edges import EDGES, docs

from flowloom.llm import clustering, packing, spelling
from flowloom.llm.fm_index import FmIndex

LETTERS = "abcdefghijklmnopqrstuvwxyzàéüß"


def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("letters", [2, 3, 8, 30])
def test_search_finds_all_words_at_one_error_of_the_front(letters):
    rng = random.Random(letters)
    words = sorted({"".join(rng.choice(LETTERS[:letters]) for _ in range(rng.randrange(6, 10))) for _ in range(300)})
    asked = words + ["zzzzzzz", "aaabbb€"]
    exact = [len(w) - len(w) // 2 for w in asked]
    got = {(asked[p], words[n]) for places, numbers in FmIndex(words).near(asked, exact) for p, n in zip(places, numbers)}
    assert got == {(a, b) for a in asked for b in words if one_error(a, b) and b.endswith(a[len(a) // 2 :])}


def plain_variants(rows, every):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if one_error(w, v)] for w in n}
    form = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: v for w, v in form.items() if n[v] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def spelling_rows():
    rng = random.Random(8)
    base = ["".join(rng.choice(LETTERS[:6]) for _ in range(rng.randrange(6, 9))) for _ in range(25)]
    rows = [*EDGES, (50, "Éclairs éclairs ÉCLAIRS " * 3), (51, "chainaaa " * 5 + "chainaab " * 25 + "chainabb " * 125 + "chainabbb " * 625), (52, "tie" + "xxxx " * 5)]
    for i in range(60):
        words = []
        for _ in range(60):
            w = rng.choice(base[: 1 + rng.randrange(25)])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice((w[:at] + w[at + 1 :], w[:at] + rng.choice("abc") + w[at:], w[:at] + rng.choice("abc") + w[at + 1 :]))
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((100 + i, rng.choice((" ", "\n", "1", "_")).join(words)))
    return rows


@pytest.mark.parametrize("every", [199, 3])
def test_variants_equal_brute_force(spark, every):
    rows = spelling_rows()
    got = spelling.variants(docs(spark, rows), every=every)
    assert {tuple(r) for r in got.collect()} == plain_variants(rows, every)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_of_nothing(spark):
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [(1, None), (2, "short words")])).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(docs(spark, []), least=5)


@pytest.mark.parametrize("limit", [1, 7, 100])
def test_pairs_do_not_depend_on_the_size_of_an_index(spark, limit):
    """Keys with more words than an index holds are cut into blocks; nothing is lost or doubled."""
    rng = random.Random(3)
    words = sorted({"aaa" + "".join(rng.choice("ab") for _ in range(rng.randrange(3, 6))) for _ in range(60)} | {"bbbcccddd", "bbbcccdd", "xbbcccddd"})
    table = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n long")
    got = Counter(tuple(r) for r in spelling.near_pairs(table, limit).collect())
    assert got == Counter((a, b, k + 1) for a in words for k, b in enumerate(words) if one_error(a, b))


TOKENIZER = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_ids_equal_those_of_whole_texts():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    whole.encode_special_tokens = True
    rng = random.Random(2)
    signs = ["a", "Be", "é", "ß", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "​", "1", "23", "²", "'s", "'", "!?", "…", "日本", "\U0001f600", "<|endoftext|>", "_"]
    ids = packing.Ids(TOKENIZER)
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(14)))
        assert np.frombuffer(ids.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
    long = " ".join(f"word{i % 700}x\n" for i in range(150_000))
    assert np.frombuffer(ids.of(long), "<u4").tolist() == whole.encode(long, add_special_tokens=False).ids


def test_packer_takes_the_tightest_fit_and_closes_the_fullest():
    rng = random.Random(1)
    for open_bins in (1, 3, 50):
        packer, free, order = packing.Packer(100, open_bins), {}, 0
        for _ in range(600):
            length = rng.choice((rng.randrange(1, 101), 100))
            own, offset = packer.put(length)
            fits = [f for f in free.values() if f >= length]
            if fits:
                assert free[own] == min(fits)
            else:
                assert own not in free and offset == 0
                if len(free) == open_bins and length < 100:
                    (gone,) = set(free) - {b for b, _ in packer.still_open()}
                    assert free[gone] == min(free.values())
                    del free[gone]
            assert offset == 100 - free.get(own, 100)
            free[own] = free.get(own, 100) - length
            if not free[own]:
                del free[own]
            assert dict(packer.still_open()) == {b: 100 - f for b, f in free.items()} and len(free) <= open_bins


def packed_rows(spark, rows, **how):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    whole.encode_special_tokens = True
    capacity = how.get("capacity", packing.CAPACITY)
    got = [r.asDict() for r in packing.packed_pieces(docs(spark, rows), TOKENIZER, **how).collect()]
    want = Counter()
    for i, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        for k, start in enumerate([0, *range(first, len(ids), capacity)]):
            own = ids[start : start + (first if k == 0 else capacity)]
            want[(i, k, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(k[3] * n for k, n in want.items())
    return len(sequences), total


def test_packing_on_edges(spark):
    n, total = packed_rows(spark, EDGES)
    assert n == -(-total // packing.CAPACITY)
    assert packing.packed_pieces(docs(spark, []), TOKENIZER).count() == 0
    rng = random.Random(5)
    rows = [(i, "ab " * rng.randrange(1, 90)) for i in range(400)]
    n, total = packed_rows(spark, rows, capacity=64)
    assert n <= 1.05 * total / 64 + 1


def test_packing_merges_what_tasks_leave_open(spark):
    rows = [(i, "word " * 9) for i in range(600)]
    few, total = packed_rows(spark, rows)
    whole = -(-total // packing.CAPACITY)
    # Each of three tasks leaves a sequence open; merged, at most one more than needed is left.
    assert whole <= few <= whole + 1


def plain_clusters(vectors, k, rounds, seed=3):
    rows = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in vectors]
    centres = [v for i, v in sorted(rows, key=lambda r: hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest())[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((apart(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = {}
        for _, v in rows:
            own.setdefault(nearest(v)[1], []).append(v)
        for j, held in own.items():
            centres[j] = [sum(x) // len(held) for x in zip(*held)]
    found = [(i, *nearest(v)[::-1]) for i, v in rows]
    sums = Counter()
    for _, j, d in found:
        sums[j] += d
    name = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return Counter((i, j, d, sums[j], sum(sums.values()), name(centres[j])) for i, j, d in found)


@pytest.mark.parametrize("kind", ["spread", "ties", "far"])
def test_clusters_equal_brute_force(spark, kind):
    rng = random.Random(kind)
    value = {"spread": lambda: rng.gauss(0, 1), "ties": lambda: rng.choice((0.0, 1 / 1024, -1 / 1024)), "far": lambda: rng.choice((-30.0, 0.001, 31.9, 900.0))}[kind]
    vectors = [(i, [value() for _ in range(4)]) for i in range(300)] + [(7, [0.0] * 4)] * 3
    bad = [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0, None, 1.0, 1.0]), (904, [1.0, float("nan"), 1.0, 1.0]), (905, [1.0, float("inf"), 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors + bad], "vec_id long, embedding array<double>, cluster string, Distance int").repartition(4)
    got = clustering.clustered(df, clusters=6, rounds=10, size=4)
    assert Counter(tuple(r) for r in got.collect()) == plain_clusters(vectors, 6, 10)


def test_clusters_of_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert clustering.clustered(spark.createDataFrame([], schema), size=4).count() == 0
    one = clustering.clustered(spark.createDataFrame([(1, [0.5] * 4)], schema), size=4).collect()
    assert [tuple(r)[:5] for r in one] == [(1, 0, 0, 0, 0)]
    same = clustering.clustered(spark.createDataFrame([(i, [0.5] * 4) for i in range(20)] + [(None, [1.0] * 4)], schema), size=4).collect()
    assert len(same) == 21 and {r.cluster for r in same if r.vec_id is not None} == {min(r.cluster for r in same if r.vec_id is not None)}
    with pytest.raises(Exception, match="64 bits"):
        clustering.clustered(spark.createDataFrame([(1, [1e9] * 4)], schema), size=4)


def test_search_prunes_and_stays_exact():
    """Most vectors of separate groups are not searched again, and the remembered second is the true one after a search."""
    rng = np.random.default_rng(4)
    middle = rng.integers(-3000, 3000, (8, 16))
    vectors = middle[rng.integers(0, 8, 2000)] + rng.integers(-60, 60, (2000, 16))
    centroids = clustering.Centroids(middle)
    start = (np.zeros(2000, np.int32), np.ones(2000, np.int32), np.full(2000, np.inf), np.full(2000, -np.inf))
    state, searched = clustering.assigned(vectors, start, centroids, np.zeros(8))
    every = ((vectors[:, None] - middle[None]) ** 2).sum(2)
    assert searched == 2000 and (state[0] == every.argmin(1)).all()
    assert (np.sort(every, 1)[:, 1] == every[np.arange(2000), state[1]]).all()
    moved = middle + rng.integers(-5, 5, middle.shape)
    state, searched = clustering.assigned(vectors, state, clustering.Centroids(moved), np.sqrt(((moved - middle) ** 2).sum(1)))
    assert searched < 200 and (state[0] == ((vectors[:, None] - moved[None]) ** 2).sum(2).argmin(1)).all()
