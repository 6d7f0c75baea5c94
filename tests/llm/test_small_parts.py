"""Numpy parts and plain functions against definitions."""

import random

import numpy as np

from flowloom.llm import decontaminate, perfect_hash, templates
from flowloom.llm.shingles import band_keys, chunks, shingle_sets, super_minhash, words


def plain_sets(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text)) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_shingles_equal_those_of_split_words():
    texts = ["", "a", "A b  c", "x y z u v", "x y z u v w", "É é b \t c\nd e f", "one two three four five " * 40]
    sets = list(shingle_sets([t.encode() for t in texts]))
    assert [len(s) for s in sets] == [len(plain_sets(t)) for t in texts]
    same = list(shingle_sets([b"x Y z u v", b"X y Z U V", b"x y z u w"]))
    assert same[0].tolist() == same[1].tolist() != same[2].tolist()
    assert [len(c) for c in chunks([b"a" * 10, None, b"b" * 10], 12)] == [2, 1] and words([b""])[1].tolist() == [0, 0]


def test_signatures_estimate_similarity_and_ignore_order():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 900, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 100, dtype=np.uint64)])
    s = super_minhash(np.concatenate([a, b, a[::-1], a[:3]]), np.repeat([0, 1, 2, 3], [900, 900, 900, 3]), 4, 160, block=500)
    assert (s[0] == s[2]).all() and (s[3] != 2**64 - 1).all()
    assert abs((s[0] == s[1]).mean() - 800 / 1000) < 0.12
    assert (band_keys(s, 32, 5)[0] == band_keys(s, 32, 5)[2]).all()


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 5000):
        h1, h2 = rng.integers(0, 2**63, (2, n), dtype=np.uint64)
        sizes, bits, index = perfect_hash.build(h1, h2)
        assert sorted(index.tolist()) == list(range(n))
        prints = np.zeros(n, np.uint64)
        prints[index] = perfect_hash.fingerprint(h1, h2)
        shard = perfect_hash.Index(sizes, bits, prints.tobytes(), b"", b"")
        assert (shard.find(h1, h2) == index).all()
        o1, o2 = rng.integers(0, 2**63, (2, 3000), dtype=np.uint64)
        assert (shard.find(o1, o2) == -1).all()


def test_signature_of_an_item_cannot_be_missed():
    for n in range(1, 400):
        lacking = n - -(-80 * n // 100)  # the most that a containing document lacks
        assert min(n, lacking + 1) <= decontaminate.signature_size(n, 80) <= n


def test_pages():
    text = lambda page, gone=frozenset(): templates.main_text(templates.parsed(page), gone)
    assert text("") == "" and text("plain &amp; simple") == "plain & simple"
    page = (
        "<!DOCTYPE html><html><head><title>t</title><script>var t='</p>';</script></head><body><nav>menu</nav><!-- <p>no</p> -->"
        "<div class='ad'>buy</div><article><h1>Head &lt;1&gt;</h1><p><b>A\n b<br><p>C&#233; <i>d</i>e</p><div class=\"comments\">nice</div><form>x</form>"
        "<ul><li>one<li>two</ul></article><footer>&copy; foot</footer>"
    )
    assert text(page) == "Head <1>\n\nA b\n\nCé de\n\none\n\ntwo"
    assert text("<body><p>a</p><aside>b</aside><p>c") == "a\n\nc"
    root = templates.parsed("<body><div>same</div><p>own</p></body>")
    gone = {h for h, inside in templates.subtrees(root)}
    root.hashed()
    assert templates.main_text(root, gone) == "" and templates.main_text(root) == "same\n\nown"
    deep = "<div>" * 5000 + "x"
    assert text(deep) == "x"


def test_random_markup_does_not_break_the_parser():
    rng = random.Random(3)
    pieces = ["<p>", "</p>", "<div class=x>", "</div>", "<article>", "</article>", "<", ">", "&am", "<!--", "-->", "<script>", "</script", "text ", "<br/>", "<li>", "</ul>", "\"", "<a href='"]
    for _ in range(300):
        root = templates.parsed("".join(rng.choice(pieces) for _ in range(30)))
        list(templates.subtrees(root))
        templates.main_text(root)
