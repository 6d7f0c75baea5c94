"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing names; and brute-force checks."""

import datetime
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import decontaminate, line_dedup, mixing, near_dedup, outliers, pseudonyms, quality, secret_scan, templates, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, kept string, Hash string, row string, n_dropped string"


def docs(spark, rows):
    full = [(i, t, "en", "s1", len(t or ""), "x", "x", "x", "x", "x") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


EDGES = [(1, None), (2, ""), (3, "  \n\t"), (None, "a line that repeats\nown"), (4, "a line that repeats\nA LINE that repeats \nshort"), (5, "a line that repeats"),
         (6, "word " * 30_000), (7, "same row here"), (7, "same row here"), (8, "é" * 9 + "\n" + "é" * 10), (9, "é" * 9 + "\n" + "é" * 10)]


def test_line_dedup_on_edges(spark):
    df = line_dedup.dedup_lines(docs(spark, EDGES))
    got = {(r.doc_id, r.text if r.doc_id != 6 else "", r.n_lines, r.n_dropped) for r in df.collect()}
    assert got == {(1, None, 1, 0), (2, "", 1, 0), (3, "  \n\t", 2, 0), (None, "a line that repeats\nown", 2, 0), (4, "a line that repeats\nA LINE that repeats \nshort", 3, 0),
                   (5, "", 1, 1), (6, "", 1, 0), (7, "same row here", 1, 0), (8, "é" * 9 + "\n" + "é" * 10, 2, 0), (9, "é" * 9, 2, 1)}
    assert df.columns == [*SCHEMA.replace(" long", "").replace(" string", "").split(", "), "n_lines"]
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def similar(a, b):
    return 100 * len(a & b) >= 85 * len(a | b)


def test_near_dedup_equals_brute_force(spark):
    """Families of copies, some linked only through others, some close to all but linked to none."""
    from test_small_parts import plain_sets

    rng = random.Random(5)
    rows = list(EDGES)
    at = 100
    for _ in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 2, 3, 4, 5, 6))):
                copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                base = copy
            rows.append((at, " ".join(copy)))
            at += 1
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs(spark, rows)).collect()}
    sets = {i: plain_sets(t or "") for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and similar(sets[i], sets[j]) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = {(i, len(s), root(i), root(i) == i) for i, s in sets.items()} | {(None, 2, None, True)}
    assert {g for g in got if g[0] is not None} == {w for w in want if w[0] is not None}
    assert {(g[2], g[3]) for g in got if g[0] is None} == {(None, True)}
    kept = near_dedup.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    assert {r.doc_id for r in kept.collect()} == {w[0] for w in want if w[3]}


def test_near_dedup_of_nothing(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0
    assert near_dedup.drop_near_duplicates(docs(spark, [(1, None), (2, "a b c d e f")])).count() == 2


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 150)]
    df = spark.createDataFrame([(max(e), min(e)) for e in edges], "a long, b long").repartition(7)
    assert {(r.id, r.label) for r in near_dedup.components(df).collect()} == {(i, 1) for i in range(2, 61)} | {(150, 100), (200, 100)}


def test_decontamination_on_edges(spark):
    item = " ".join(f"b{i}" for i in range(30))
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny words"), (5, item)], "item_id long, text string")
    long = " ".join(f"f{i}" for i in range(20_000))
    rows = [*EDGES, (20, f"{long} {item} {long}"), (21, " ".join(item.split()[:20])), (22, "x TINY  words y"), (23, "tiny other words"),
            (24, " ".join(w if i != 2 else "zz" for i, w in enumerate(item.split())))]
    df = docs(spark, rows)
    got = sorted(tuple(r) for r in decontaminate.contained_items(df, items).collect())
    assert got == [(20, 1, 26, 26), (20, 5, 26, 26), (22, 4, 1, 1), (24, 1, 26, 23), (24, 5, 26, 23)]
    kept = decontaminate.decontaminate(df, items)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {20, 22, 24}
    assert decontaminate.contained_items(docs(spark, []), items).count() == 0
    assert decontaminate.decontaminate(df, items.limit(0)).count() == len(rows)


def test_decontamination_block_by_block(spark, monkeypatch):
    """Many blocks find what one block finds; a text that stands in many item rows is one set of one block."""
    text = lambda k: " ".join(f"i{k}x{j}" for j in range(12))
    items = spark.createDataFrame([(k, text(k)) for k in range(30)] + [(100 + k, text(0)) for k in range(40)] + [(None, text(1))], "item_id long, text string")
    df = docs(spark, [(k, f"before {text(k)} after") for k in range(0, 60, 3)] + [(None, text(6)), (70, "clean words only")])
    key = lambda r: tuple(-1 if v is None else v for v in r)
    found = lambda: sorted(key(r) for r in decontaminate.contained_items(df, items).collect())
    whole, kept = found(), sorted(key((r.doc_id,)) for r in decontaminate.decontaminate(df, items).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 40)
    assert found() == whole and len(whole) == 10 + 40 + 1
    assert sorted(key((r.doc_id,)) for r in decontaminate.decontaminate(df, items).collect()) == kept == sorted((k,) for k in [*range(30, 60, 3), 70])
    sets = decontaminate._written_sets(items, "item_id", "text")[1]
    assert sets.count() == 30 and max(len(b.ids) for b, _ in decontaminate._blocks(sets, 80)) < 30


def test_mixing_budgets(spark):
    leaves = spark.createDataFrame([("a", "en", "1", 100), ("a", "en", "2", 1000), ("a", "de", "1", 50), ("b", "en", "1", 5000)], "domain string, lang string, source string, tokens long")
    got = {tuple(r)[:3]: r.target for r in mixing.targets(leaves, {"domain": {"a": 1, "b": 1}}, 50, 1).collect()}
    # 3075: half would be 1537, of which a has 1150; b takes the rest. Below a every node is full.
    assert got == {("a", "en", "1"): 100, ("a", "en", "2"): 1000, ("a", "de", "1"): 50, ("b", "en", "1"): 1925}
    got = {tuple(r)[:3]: r.target for r in mixing.targets(leaves, {}, 20, 1).collect()}
    # 1230: 615 each; de has 50 of its 307, so en takes 565, of which source 1 has 100.
    assert got == {("a", "en", "1"): 100, ("a", "en", "2"): 465, ("a", "de", "1"): 50, ("b", "en", "1"): 615}


def test_mixing_budgets_of_large_corpora(spark):
    """Tokens times weights beyond a long; the shares are exact."""
    tokens, heavy = 3 * 10**13, 10**6
    leaves = spark.createDataFrame([(d, "en", "1", tokens) for d in "ab"], "domain string, lang string, source string, tokens long")
    got = {r.domain: r.target for r in mixing.targets(leaves, {"domain": {"a": heavy, "b": 3 * heavy + 1}}, 40, 1).collect()}
    budget = 2 * tokens * 40 // 100
    assert got["a"] + got["b"] == budget and got["a"] - budget * heavy // (4 * heavy + 1) in (0, 1)


def test_mixing_on_edges(spark):
    df = docs(spark, EDGES)
    out = mixing.mix(df, {}, F.lit(None), percent=100, max_epochs=1)
    assert out.columns == [*df.columns, "n_tokens", "copies"] and {r.doc_id for r in out.collect()} == {None, 4, 5, 6, 7, 8, 9}
    assert mixing.mix(docs(spark, []), {}, F.col("source")).count() == 0
    twice = mixing.selection(df, {}, F.col("source"), percent=200)
    assert {r.copies for r in twice.collect()} == {2}
    with pytest.raises(ValueError):
        mixing.selection(df, {"lang": {"en": 0}}, F.col("source"))


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_edges(spark, module, label):
    df = docs(spark, EDGES)
    for labels, low, high in (([], 0.5, 0.5), ([(1, 1, 1), (2, None, None), (99, 0, 0)], 0.6, 0.8), ([(4, 1, 1), (5, 0, 0), (5, 1, 1), (6, 0, 0)], 0.0, 1.0)):
        model = module.train(df, spark.createDataFrame(labels, LABELS), label, F.lit(True))
        scores = [r.s for r in df.select(module.score_column(df, model).alias("s")).collect()]
        assert len(scores) == len(EDGES) and all(low <= s <= high for s in scores)
    assert docs(spark, []).select(module.score_column(df, model)).count() == 0


def test_secret_candidates_and_their_places(spark):
    text = "é token = \"0123456789abcdef0123\" and plain_words_that_are_long, 4111111111111111"
    rows = [*EDGES, (30, text)]
    found = secret_scan.candidates(docs(spark, rows))
    want = {(i, m.start(), m[0]) for i, t in rows for m in re.finditer(secret_scan.CANDIDATE, t or "")}
    assert {(r.doc_id, r.start, r.value) for r in found.collect()} == want
    labelled = found.withColumn("label", secret_scan.distant_labels(found)).where("doc_id = 30").orderBy("start").collect()
    assert [r.label for r in labelled] == [1.0, 0.0, 0.0]
    assert secret_scan.scan(docs(spark, []), F.lit(True)).count() == 0
    assert secret_scan.scan(docs(spark, EDGES), F.lit(True)).count() == 0
    # A forest over two classes.
    many = [(i, f'token = "{i:04d}deadbeefcafe{i:04d}" then 55555555{i:08d} end') for i in range(40)]
    scored = secret_scan.scan(docs(spark, many), F.col("doc_id") % 4 != 0).where("doc_id % 4 = 0").collect()
    assert len(scored) == 20 and all(r.predicted == r.label for r in scored)


def test_values_of_secret_names_of_any_length_and_characters(spark):
    texts = {
        1: 'password = "hunter2secret" end', 2: "pwd: Tr0ub4dor&3", 3: "auth='a.b!c$d:e 1'", 4: "token=abc123.def456.ghi789, then", 5: '{"api_key": "x9", "user": "bob"}',
        6: "?token=abc1&id=0123456789abcdef0123", 7: 'password = ""', 8: "no name 0123456789abcdef0123!", 9: "SECRET => q7", 10: "passwd: é1", 11: "token=" + "a1!" * 30_000, 12: 'pwd = "a\\"b1"',
        13: "DATABASE_PASSWORD=hun&ter2 x", 14: "OUR_DATABASE_PASSWORD = 'hun ter2'", 15: "0123456789pwd0123456789== next", 16: "a0123456789_token=",
    }
    found = secret_scan.candidates(docs(spark, list(texts.items())))
    got = {}
    for r in found.withColumn("label", secret_scan.distant_labels(found)).orderBy("doc_id", "start").collect():
        assert texts[r.doc_id][r.start : r.start + len(r.value)] == r.value and texts[r.doc_id][: r.start].endswith(r.before) and texts[r.doc_id][r.start + len(r.value) :].startswith(r.after)
        got.setdefault(r.doc_id, []).append((r.value, r.label))
    assert got == {
        1: [("hunter2secret", 1.0)], 2: [("Tr0ub4dor&3", 1.0)], 3: [("a.b!c$d:e 1", 1.0)], 4: [("abc123.def456.ghi789", 1.0)], 5: [("x9", 1.0)], 6: [("abc1", 1.0), ("id=0123456789abcdef0123", 0.0)],
        8: [("0123456789abcdef0123", 0.0)], 9: [("q7", 1.0)], 10: [("é1", 1.0)], 11: [("a1!" * 30_000, 1.0)], 12: [('a\\"b1', 1.0)],
        13: [("hun&ter2", 1.0)], 14: [("hun ter2", 1.0)], 15: [("0123456789pwd0123456789==", 0.0)], 16: [("a0123456789_token=", 0.0)],
    }
    scored = secret_scan.scan(docs(spark, list(texts.items())), F.lit(True))
    assert scored.count() == 16 and scored.where("score is null").count() == 0


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def test_feistel_is_a_permutation(spark):
    domain = spark.range(7 * 13).select(pseudonyms.permuted(F.col("id"), F.lit(7).cast("long"), F.lit(13).cast("long"), "k", "t").alias("p"))
    got = [r.p for r in domain.collect()]
    assert sorted(got) == list(range(91)) and got != list(range(91))
    other = spark.range(91).select(pseudonyms.permuted(F.col("id"), F.lit(7).cast("long"), F.lit(13).cast("long"), "other", "t").alias("p"))
    assert got != [r.p for r in other.collect()]


def test_pseudonyms_keep_formats_and_links(spark):
    text = "Card 4111-1111 1111 1111, again 4111111111111111; not 4111111111111112. +1 (017) 555-7713 at 10.0.0.255 or 300.1.1.1; 123-45-6789, 666-45-6789; 2020-02-29 = 29.02.2020 = 02/29/2020, 2021-02-29; Bob.9@mail2.example.com"
    rows = [*EDGES, (30, text), (31, text)]
    df = pseudonyms.pseudonymised(docs(spark, rows), "key")
    got = {r.doc_id: r for r in df.collect()}
    assert got[30].text == got[31].text != text and got[1].text is None and got[2].text == "" and got[1].n_card == 0
    assert [got[30][f"n_{k}"] for k in pseudonyms.KINDS] == [1, 3, 1, 1, 1, 2]
    m = re.fullmatch(
        r"Card (\d{4}-\d{4} \d{4} \d{4}), again (\d{16}); not 4111111111111112\. (\+1 \(\d{3}\) \d{3}-\d{4}) at ([\d.]+) or 300\.1\.1\.1; (\d{3}-\d{2}-\d{4}), 666-45-6789; "
        r"(\d{4}-\d\d-\d\d) = (\d\d\.\d\d\.\d{4}) = (\d\d/\d\d/\d{4}), 2021-02-29; ([A-Z][a-z][a-z]\.\d)@mail2\.example\.com", got[30].text)
    assert m and re.sub(r"\D", "", m[1]) == m[2] and luhn(m[2]) and m[2] != "4111111111111111"
    assert all(0 <= int(x) <= 255 for x in m[4].split("."))
    day = datetime.date.fromisoformat(m[6])
    assert f"{day:%d.%m.%Y}" == m[7] and f"{day:%m/%d/%Y}" == m[8] and m[9] != "Bob.9"
    assert pseudonyms.pseudonymised(docs(spark, []), "key").count() == 0
    assert got[6].text == dict(EDGES)[6] and df.columns[:10] == docs(spark, []).columns


def test_pseudonyms_beside_other_numbers(spark):
    """Cards, telephone numbers, dates and addresses next to one another; everything personal changes, nothing else does."""
    card = "4111111111111111"
    texts = {
        1: ("card 4111111111111111 12/27", {"card": 1}, " 12/27"), 2: ("card 4111 1111 1111 1111 123 ok", {"card": 1}, " 123 ok"), 3: ("7 4111111111111111", {"card": 1}, ""),
        4: ("12 34 4111 1111 1111 1111 99", {"card": 1}, " 99"), 5: ("4111 1111 1111 1111 5500 0000 0000 0004", {"card": 2}, ""),
        6: ("4111111111111111 10.0.0.1", {"card": 1, "ip": 1}, ""), 7: ("4111111111111111 02/29/2020", {"card": 1, "date": 1}, ""),
        8: ("12345 123-45-6789", {"ssn": 1}, ""), 9: ("+33 6 12 34 56 78", {"phone": 1}, ""), 10: ("+49 30 901820", {"phone": 1}, ""),
        11: ("+44 20 7946 0958.", {"phone": 1}, "."), 12: ("+33612345678", {"phone": 1}, ""), 13: ("+49 30 901820 4111 1111 1111 1111", {"phone": 1, "card": 1}, ""),
        14: ("+49 30 901820 2020-02-29", {"phone": 1, "date": 1}, ""), 15: ("+1.23456789 and 12 34", {}, "+1.23456789 and 12 34"), 16: ("+33.6.12.34.56.78", {"phone": 1}, ""),
        17: (card, {"card": 1}, ""),
    }
    got = {r.doc_id: r for r in pseudonyms.pseudonymised(docs(spark, [(i, t) for i, (t, _, _) in texts.items()]), "key").collect()}
    for i, row in got.items():
        text, counts, end = texts[i]
        assert {k: row[f"n_{k}"] for k in pseudonyms.KINDS if row[f"n_{k}"]} == counts, text
        assert row.text.endswith(end) and len(row.text) == len(text) or "ip" in counts
        assert not counts or row.text != text
    digits = lambda i: re.sub(r"[^0-9]", "", got[i].text)
    new = got[17].text
    assert luhn(new) and digits(1) == new + "1227" and digits(2) == new + "123" and digits(3) == "7" + new and digits(4) == "1234" + new + "99"
    assert digits(5).startswith(new) and luhn(digits(5)[16:]) and digits(13).endswith(new) and got[6].text.startswith(new)
    assert digits(9) == digits(12) == digits(16) and digits(9).startswith("33") and digits(9) != "33612345678"


def plain_statistics(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_outlier_statistics_equal_brute_force(spark):
    rng = random.Random(4)
    rows = EDGES + [(40 + k, "".join(rng.choice(["a ", "b ", "c\n", "é# ", "\t", "d|"]) for _ in range(rng.randrange(120)))) for k in range(40)]
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in outliers.judged(docs(spark, rows)).collect()}
    assert got == {(i, *plain_statistics(t)) for i, t in rows}
    assert outliers.judged(docs(spark, [])).count() == 0


def mcd_by_brute_force(groups):
    """d2 of all rows of {(lang, source): array of vectors}, by the definition in ``outliers``, in numpy."""
    floor, k = np.diag(np.square(outliers.FLOOR)), len(outliers.FLOOR)

    def median(x):
        bins = np.sort(np.floor(x * outliers.RESOLUTION + 0.5), axis=0)
        return bins[(len(x) + 1) // 2 - 1] / outliers.RESOLUTION

    def blend(own, wider):
        n, m, s = own
        return n, (n * m + outliers.PRIOR * wider[1]) / (n + outliers.PRIOR), (n * s + outliers.PRIOR * wider[2]) / (n + outliers.PRIOR)

    def pool(parts):
        n = sum(p[0] for p in parts)
        m = sum(p[0] * p[1] for p in parts) / n
        return n, m, sum(p[0] * (p[2] + np.outer(p[1], p[1])) for p in parts) / n - np.outer(m, m)

    def shrunk(moments):
        whole = pool(list(moments.values()))
        wide = {lang: blend(pool([v for g, v in moments.items() if g[0] == lang]), whole) for lang, _ in moments}
        return {g: blend(v, wide[g[0]]) for g, v in moments.items()}

    def distances(x, estimate, scale):
        centred = x - estimate[1]
        return np.einsum("ij,ij->i", centred @ np.linalg.inv(scale * estimate[2] + floor), centred)

    def step(estimates, scale):
        moments = {}
        for g, x in groups.items():
            ring = np.floor(np.log2(distances(x, estimates[g], scale) + 2.0**-20) * outliers.RINGS)
            own = x[ring <= np.sort(ring)[int(np.ceil(outliers.H * len(x))) - 1]]
            moments[g] = len(own), own.mean(0), np.cov(own.T, bias=True).reshape(k, k)
        return shrunk(moments)

    def corr(s):
        d = np.sqrt(np.outer(np.diag(s), np.diag(s)))
        return np.divide(s, d, out=np.zeros_like(s), where=d > 0)

    runs = []
    for start in range(3):
        moments = {}
        for g, x in groups.items():
            m = median(x)
            v = 1.4826 * median(np.abs(x - m))
            z = (x - m) / np.sqrt(v**2 + np.square(outliers.FLOOR))
            signs = z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
            c = [np.zeros((k, k)), corr(np.cov(np.tanh(z).T, bias=True).reshape(k, k)), corr(signs.T @ signs / len(z))][start]
            np.fill_diagonal(c, 1.0)
            moments[g] = len(x), m, c * np.outer(v, v)
        estimates, scale = shrunk(moments), 1.0
        for _ in range(outliers.FIRST_STEPS):
            estimates, scale = step(estimates, scale), outliers.CONSISTENCY
        runs.append(estimates)
    spread = lambda e: round(np.linalg.slogdet(outliers.CONSISTENCY * e[2] + floor)[1] / 2, 9)
    estimates = {g: min(runs, key=lambda r: spread(r[g]))[g] for g in groups}
    for _ in range(outliers.STEPS):
        estimates = step(estimates, outliers.CONSISTENCY)
    return {g: distances(x, estimates[g], outliers.CONSISTENCY) for g, x in groups.items()}


def test_outlier_distances_equal_brute_force_on_any_partitions(spark):
    """A large source, a skew one, one of three rows and one of a single row: all by the same rule."""
    rng = np.random.default_rng(3)
    sizes = {("en", "a"): 300, ("en", "b"): 120, ("en", "c"): 3, ("de", "a"): 1}
    groups = {}
    for i, (g, n) in enumerate(sizes.items()):
        x = rng.normal(size=(n, 5)) @ rng.normal(size=(5, 5)) * 0.3 + i + 4
        x[: n // 8] += rng.normal(3, 1, size=(n // 8, 5))
        groups[g] = np.round(x, 3)
    rows = [(*g, *map(float, v)) for g, x in groups.items() for v in x]
    df = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{c} double" for c in outliers.STATISTICS))
    key = lambda r: (r.lang, r.source, *[r[c] for c in outliers.STATISTICS])
    got = {key(r): r.d2 for r in outliers.mcd_distances(df.repartition(7)).collect()}
    want = {(*g, *map(float, v)): d for g, d2 in mcd_by_brute_force(groups).items() for v, d in zip(groups[g], d2)}
    assert got.keys() == want.keys()
    assert max(abs(got[r] - want[r]) / (1 + want[r]) for r in want) < 1e-5


def test_outliers_are_rejected_and_the_rest_kept(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(80, 400)))) for i in range(260)]
    rows += [(1000 + i, "###".join(word() for _ in range(3)) + " " + " ".join(word() + "***" for _ in range(150))) for i in range(12)]
    kept = outliers.keep_typical(docs(spark, rows))
    assert {r.doc_id for r in kept.collect()} == set(range(260))


def test_templates_are_counted_by_host(spark):
    page = lambda i: f"<body><div>Welcome to our site</div><p>story {i}</p></body>"
    rows = [(i, f"http://Host.example/{i}", page(i)) for i in range(5)] + [(8, "https://other.example/", page(8)), (9, None, None), (10, "x", ""), (None, "http://host.example/z", page(11))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in templates.main_texts(df).collect()}
    assert got[0] == ("story 0", 7) and got[8] == ("Welcome to our site\n\nstory 8", 28) and got[9] == got[10] == ("", 0)
    assert got[None] == ("Welcome to our site\n\nstory 11", 29)
    assert templates.main_texts(df.limit(0)).count() == 0


def test_sample_holds_each_document_once(spark):
    """A doc_id that stands in many rows is one document of the sample, with its smallest text."""
    rows = [(1, f"text {k:04d}") for k in range(300)] + [(i, f"own {i}") for i in range(2, 60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 60)], LABELS)
    chosen, counts = quality.sample_ids(docs(spark, rows), labels, "quality", F.lit(True), (40, 40), "doc_id")
    assert counts == {0: 29, 1: 30}
    got = [tuple(r) for r in quality.sample_texts(docs(spark, rows), chosen, "doc_id", "text").collect()]
    assert sorted((i, m, bytes(t)) for i, m, t in got) == [(1, 1, b"text 0000")] + [(i, i % 2, f"own {i}".encode()) for i in range(2, 60)]
    few, counts = quality.sample_ids(docs(spark, rows), labels, "quality", F.lit(True), (5, 6), "doc_id")
    assert counts == {0: 29, 1: 30} and few.count() == few.distinct().count() == 11
    model = quality.train(docs(spark, rows), labels, "quality", F.lit(True), sample=20)
    again = quality.train(docs(spark, rows).repartition(7), labels, "quality", F.lit(True), sample=20)
    assert (model.weights == again.weights).all() and model.bias == again.bias


def test_prose_is_no_assignment(spark):
    texts = {1: "Author: Smith2021", 2: "max tokens: 512k", 3: "authors = 3rd", 4: "authority: ISO9001", 5: "the secret: 4chan", 6: "authentication: oauth2", 7: "password:\n\nChapter7",
             8: "clientSecret = a1b2", 9: "client_secret: a1b2", 10: "auth2 = a1b2", 11: "tokenizer = bpe32k", 12: "the secret = a1b2"}
    found = secret_scan.candidates(docs(spark, list(texts.items())))
    labels = {r.doc_id: (r.value, r.label) for r in found.withColumn("label", secret_scan.distant_labels(found)).collect()}
    assert labels == {5: ("4chan", 0.0), 8: ("a1b2", 1.0), 9: ("a1b2", 1.0), 10: ("a1b2", 1.0), 12: ("a1b2", 1.0)}


def test_lists_of_numbers_stay(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"{rng.randrange(1000, 10000)}" for _ in range(12))) for i in range(300)]
    rows += [(500, "2015 2016 2017 2018 2019 2020 2021 2022"), (501, "ticket +1 2345 6789 10"), (502, "1234567812345670"), (503, "1111 1111 1111 1117")]
    cards = "4111 1111 1111 1111 5500 0000 0000 0004 4012 8888 8888 1881"
    got = {r.doc_id: r for r in pseudonyms.pseudonymised(docs(spark, [*rows, (600, cards), (601, "4111111111111111 " * 5), (602, "+1 415 555 0133 and +14155550133")]), "key").collect()}
    assert sum(got[i].text != t for i, t in rows) == 0
    assert got[600].n_card == 3 and got[601].n_card == 5 and got[602].n_phone == 2


@pytest.mark.parametrize("own, linked", [(0.04, True), (0.12, False)])
def test_pages_of_one_template_do_not_all_meet(spark, own, linked):
    """A family below the threshold makes few pairs for the full check, one above it a single component."""
    rng = random.Random(int(own * 100))
    template = [f"t{i}" for i in range(300)]
    rows = []
    for i in range(120):
        words = template + [f"p{i}x{k}" for k in range(int(300 * own / (1 - own)))]
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, f"{rows[0][1]} end{i}") for i in range(3)]
    rng.shuffle(rows)
    df = docs(spark, rows)
    keys, sets = spark.createDataFrame([(i, len(set(zip(*[t.split()[k:] for k in range(5)]))), 1) for i, t in rows], "id long, n long, key long"), near_dedup._full_sets(df, df.select(F.col("doc_id").alias("id")), "doc_id", "text")
    pairs = near_dedup._rest(keys, sets, None, 85)
    links = near_dedup.linked(pairs, sets, 85).count()
    assert links == (123 * 122 // 2 if linked else 6) and pairs.count() <= max(links, 20)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert len(set(got.values())) == (1 if linked else 120)


@pytest.mark.parametrize("pages", [5, 50])
def test_unnamed_notices_inside_articles_go_at_every_size(spark, pages):
    """What most distinct articles of a host share goes; paragraphs that copies of one article share stay."""
    page = lambda i, k: (f"<body><article><header><h1>Title {i}</h1></header><div><p>Read our terms.</p></div><h2 class='section-header'>Part {i}</h2>"  # noqa: E731
                         f"<div class='related-work'>Work {i}</div><p>the long true paragraph of story {i} that its copies share</p><p>edit {k}</p>"
                         f"<div class='share-box'>share {k}</div><article class='comment'>nice {k}</article></article><article class='comment'>bad {k}</article></body>")
    want = lambda i, k: f"Title {i}\n\nPart {i}\n\nWork {i}\n\nthe long true paragraph of story {i} that its copies share\n\nedit {k}"
    rows = [(k, "http://host.example/", page(k if k < pages else 0, k)) for k in range(pages + 2 * pages)]
    rows += [(9000, "http://small.example/", page(1, 1)), (9001, "http://small.example/", page(2, 2)), (1, "http://host.example/", page(1, 1))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, Hash string").repartition(4)
    got = {(r.page_id, r.text) for r in templates.main_texts(df).collect()}
    less = lambda i, k: want(i, k).replace(f"\n\nPart {i}", f"\n\nRead our terms.\n\nPart {i}")
    assert got == {(k, want(k if k < pages else 0, k)) for k in range(3 * pages)} | {(9000, less(1, 1)), (9001, less(2, 2))}
    assert templates.main_texts(df).count() == len(rows)


def test_very_long_page(spark):
    html = "<body><article>" + "<p>some words here</p>" * 60_000 + "</article></body>"
    df = spark.createDataFrame([(1, "http://a/", html), (2, "http://a/", "<div>" * 3000 + "deep")], "page_id long, url string, html string")
    got = {r.page_id: r.n_chars for r in templates.main_texts(df).collect()}
    assert got == {1: 60_000 * 15 + 59_999 * 2, 2: 4}
