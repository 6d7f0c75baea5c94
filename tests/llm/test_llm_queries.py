"""The queries without SQL on the provided tables, and the pipeline's stages."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, label, least", [("op3_quality_classifier", "quality", 0.95), ("op7_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries()[name](spark, SF_LARGER)
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet")
    held = rows.where("held_out").join(labels, "doc_id").select((F.col("predicted") == F.col(label)).cast("int").alias("right")).collect()
    assert sum(r.right for r in held) / len(held) >= least
    assert rows.count() == 1000 and rows.where("score < 0 or score > 1 or score is null").count() == 0


def test_extraction_gives_the_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    import html as entities

    for r in queries()["op10_html_extraction"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:h\d|p)\b[^>]*>", article)
        want = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in want if b) and r.n_chars == len(r.text)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test")
        after = docs.count()
        assert 0 < after <= before and docs.columns[: len(columns)] == columns
        before = after
    assert docs.columns == [*columns, "n_tokens", "copies"]
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.select(*columns).limit(0), SF).count() == 0


def test_pipeline_links_from_similarity_80_on(spark):
    import corpus_pipeline
    from test_small_parts import plain_sets

    words = [f"w{i}" for i in range(120)]
    changed = lambda *places: [f"x{i}" if i in places else w for i, w in enumerate(words)]
    texts = {1: words, 2: changed(60, 106), 3: changed(40, 80, 100)}
    sets = {i: plain_sets(" ".join(t)) for i, t in texts.items()}
    similar = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert 0.80 <= similar(1, 2) < 0.85 and similar(1, 3) < 0.80 and similar(2, 3) < 0.80
    rows = [(i, " ".join(t), "en", "s1", 1) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.by_near_duplicates(spark, docs, SF).collect()} == {1, 3}
