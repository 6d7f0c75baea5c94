"""The operators of this package over the provided tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import clustering, decontaminate, line_dedup, mixing, near_dedup, outliers, packing, pseudonyms, quality, secret_scan, spelling, templates, toxicity
from flowloom.llm.common import small_batches
from flowloom.session import configure, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Fixed values of the mixing query and of the pipeline's last stage.
MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
MIX_PERCENT = 90
MIX_SEED = "flowloom"


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            small_batches(configure(spark))
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words_sql(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def _lower_sql(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


LINES_SQL = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM parts),
keyed AS (SELECT *, {_lower_sql(f"trim(line, {_BLANKS})")} AS key FROM lines),
owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.doc_id, k.line, k.pos, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone FROM keyed k LEFT JOIN owners o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op1_line_dedup", LINES_SQL)
def op1(table):
    """Every line repeated across documents kept in the first one only."""
    done = line_dedup.dedup_lines(table("documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_GRAMS = """list_transform(range(1, greatest(len(w) - least({n}, len(w)) + 2, 1)), lambda i: array_to_string(w[i:i + least({n}, len(w)) - 1], ' '))"""

CONTAIN_SQL = f"""
WITH items AS (SELECT item_id, {_words_sql(_lower_sql("text"))} AS w FROM benchmark),
item_grams AS (SELECT DISTINCT item_id, least(5, len(w)) AS width, unnest({_GRAMS.format(n=5)}) AS gram FROM items WHERE len(w) > 0),
sizes AS (SELECT item_id, count(*) AS n_item_shingles FROM item_grams GROUP BY item_id),
docs AS (SELECT doc_id, {_words_sql(_lower_sql("text"))} AS w FROM documents),
widths AS (SELECT DISTINCT width FROM item_grams),
doc_grams AS (SELECT DISTINCT doc_id, width, unnest({_GRAMS.format(n="width")}) AS gram FROM docs, widths WHERE len(w) >= width)
SELECT d.doc_id, i.item_id, any_value(s.n_item_shingles) AS n_item_shingles, count(*) AS n_found
FROM item_grams i JOIN doc_grams d ON i.gram = d.gram AND i.width = d.width JOIN sizes s ON s.item_id = i.item_id
GROUP BY d.doc_id, i.item_id HAVING 100 * count(*) >= 80 * any_value(s.n_item_shingles)
"""


@query("op2_benchmark_decontamination", CONTAIN_SQL)
def op2(table):
    """Every benchmark item contained in a document."""
    return decontaminate.contained_items(table("documents"), table("benchmark"))


NEAR_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words_sql(_lower_sql("text"))} AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, unnest({_GRAMS.format(n=5)}) AS gram FROM docs WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
named AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM docs d JOIN named USING (doc_id) LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


@query("op5_near_dedup", NEAR_SQL)
def op5(table):
    """The near-duplicate component of every document."""
    return near_dedup.near_duplicates(table("documents"))


def mix_domain():
    """The domain of a document: sources are dealt to four domains by number."""
    number = F.coalesce(F.regexp_extract("source", "([0-9]{1,9})$", 1).try_cast("int"), F.lit(0))
    return F.concat(F.lit("d"), number % 4)


def _case_sql(level: str) -> str:
    given = MIX_WEIGHTS.get(level)
    return f"CASE {level} {' '.join(f'''WHEN '{k}' THEN {v}''' for k, v in given.items())} ELSE 1 END" if given else "1"


def _level_sql(prefix: str, children: str, up: str, name: str) -> str:
    """CTEs that share the budget over the rows of ``children`` (``up``, ``name``, budget, weight, capacity, tokens)."""
    part = f"PARTITION BY {up}" if up else ""
    both = f"PARTITION BY {up}, filled" if up else "PARTITION BY filled"
    return f"""
{prefix}_a AS (SELECT *, capacity::HUGEINT * sum(weight) OVER ({part} ORDER BY capacity / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  <= (budget - coalesce(sum(capacity) OVER ({part} ORDER BY capacity / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS filled FROM ({children})),
{prefix}_b AS (SELECT *, budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({part}) AS rest,
  sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({part}) AS free FROM {prefix}_a),
{prefix}_c AS (SELECT *, CASE WHEN filled THEN capacity ELSE (rest * weight) // free END AS part FROM {prefix}_b),
{prefix} AS (SELECT * EXCLUDE (part), (part + CASE WHEN NOT filled AND row_number() OVER ({both} ORDER BY {name})
  <= rest - sum(CASE WHEN filled THEN 0 ELSE part END) OVER ({part}) THEN 1 ELSE 0 END)::BIGINT AS target FROM {prefix}_c)"""


MIX_SQL = f"""
WITH tokens AS (SELECT doc_id, 'd' || (coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT), 0) % 4) AS domain,
  coalesce(lang, '') AS lang, coalesce(source, '') AS source, len({_words_sql("text")}) AS n_tokens FROM documents),
kept AS (SELECT * FROM tokens WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, {mixing.MAX_EPOCHS} * sum(n_tokens)::BIGINT AS capacity FROM kept GROUP BY ALL),
{_level_sql("lv1", f'''SELECT domain, sum(capacity)::BIGINT AS capacity, {_case_sql("domain")} AS weight,
  (sum(sum(tokens)) OVER () * {MIX_PERCENT}) // 100 AS budget FROM leaves GROUP BY domain''', "", "domain")},
{_level_sql("lv2", f'''SELECT domain, lang, sum(leaves.capacity)::BIGINT AS capacity, {_case_sql("lang")} AS weight, any_value(target) AS budget
  FROM leaves JOIN lv1 USING (domain) GROUP BY domain, lang''', "domain", "lang")},
{_level_sql("lv3", '''SELECT domain, lang, source, leaves.capacity, 1 AS weight, target AS budget
  FROM leaves JOIN lv2 USING (domain, lang)''', "domain, lang", "source")},
plan AS (SELECT domain, lang, source, lv3.target // tokens AS epochs, lv3.target % tokens AS cut FROM lv3 JOIN leaves USING (domain, lang, source)),
placed AS (SELECT kept.*, epochs, cut, md5('{MIX_SEED}:' || epochs || ':' || doc_id) AS place FROM kept JOIN plan USING (domain, lang, source)),
started AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM placed),
counted AS (SELECT *, (epochs + CASE WHEN start < cut THEN 1 ELSE 0 END)::BIGINT AS copies FROM started)
SELECT doc_id, domain, lang, source, n_tokens, copies FROM counted WHERE copies > 0
"""


@query("op6_mixing", MIX_SQL)
def op6(table):
    """The documents, and how often each, that fill the budgets of domains, languages and sources."""
    return mixing.selection(table("documents"), MIX_WEIGHTS, mix_domain(), percent=MIX_PERCENT, seed=MIX_SEED)


def held_out_scores(docs, labels, module, label: str, modulus: int, fold: int, threshold: float = 0.3) -> DataFrame:
    """Scores of all documents by a model that learns from the rows outside the fold."""
    model = module.train(docs, labels, label, quality.remainder(F.col("doc_id"), modulus) != fold)
    held_out = F.coalesce(quality.remainder(F.col("doc_id"), modulus) == fold, F.lit(True))
    scored = docs.select("doc_id", held_out.alias("held_out"), module.score_column(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query("op3_quality_classifier")
def op3(table):
    """The quality of every document."""
    return held_out_scores(table("documents"), table("labels"), quality, "quality", 5, 0)


@query("op7_toxicity")
def op7(table):
    """The toxicity of every document."""
    return held_out_scores(table("documents"), table("labels"), toxicity, "toxic", 4, 2)


@query("op4_secret_scan")
def op4(table):
    """Every candidate for a secret with the forest's verdict; values as hashes."""
    fit_rows = F.coalesce(quality.remainder(F.col("doc_id"), 5) != 0, F.lit(False))
    found = secret_scan.scan(table("documents"), fit_rows)
    return found.select("doc_id", "start", F.length("value").cast("long").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), (~fit_rows).alias("held_out"), "score", "predicted")


@query("op8_pii_pseudonyms")
def op8(table):
    """Every document with its personal data replaced by pseudonyms."""
    done = pseudonyms.pseudonymised(table("documents").select("doc_id", "text"), key="flowloom")
    return done.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))


@query("op9_quality_rules")
def op9(table):
    """The statistics of every document and whether rules and outlier test keep it."""
    return outliers.judged(table("documents"))


@query("op10_html_extraction")
def op10(table):
    """The main text of every page."""
    return templates.main_texts(table("pages"))


# crc32 by its definition: the table of a byte's eight steps, then a fold over the bytes of the text.
_CRC_SQL = """
crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t)"""
_HASH_SQL = "xor(list_reduce([4294967295::BIGINT] || {bytes}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
# Bytes of UTF-8 for code points below 2048, which is all that a word or a number has.
_BYTES_SQL = """flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [(192 + (unicode(ch) >> 6))::BIGINT, (128 + (unicode(ch) & 63))::BIGINT] END))"""

SPELLING_SQL = f"""
WITH RECURSIVE {_CRC_SQL},
runs AS (SELECT doc_id, unnest(regexp_extract_all({_lower_sql("coalesce(text, '')")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= {spelling.MIN_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, k, {_HASH_SQL.format(bytes=_BYTES_SQL.format(text="coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h FROM per_doc, crc_table),
written AS (SELECT CASE WHEN h % {spelling.TYPO_EVERY} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM written WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(k) >= {spelling.MIN_COUNT}),
cuts AS (SELECT word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS pos FROM words)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near),
known AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= {spelling.FACTOR} * w.n THEN r.near END AS form,
  CASE WHEN r.near_n >= {spelling.FACTOR} * w.n THEN r.near_n END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
ways(word, goal) AS (SELECT word, word FROM known UNION ALL SELECT ways.word, form FROM ways JOIN known k ON k.word = ways.goal WHERE form IS NOT NULL)
SELECT k.word, k.form, goal AS root, k.n, k.n_near, k.form_n FROM known k JOIN ways ON ways.word = k.word JOIN known e ON e.word = goal AND e.form IS NULL
"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11(table):
    """Every frequent word with the words at one error from it."""
    return spelling.variants(table("documents"))


@query("op12_best_fit_packing")
def op12(table):
    """Every piece of every document with its place in a sequence."""
    import public_tokenizers

    return packing.packed_pieces(table("documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _clustering_sql() -> str:
    k, size = clustering.CLUSTERS, clustering.SIZE
    nearest = """a{i} AS MATERIALIZED (SELECT id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM vectors, c{i}) GROUP BY id, v)"""
    parts = "SELECT c, pos, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x FROM (SELECT c, unnest(v) AS x, unnest(range(len(v))) AS pos FROM a{i}) GROUP BY c, pos"
    moved = """c{j} AS MATERIALIZED (SELECT o.c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN (SELECT c, list(x::BIGINT ORDER BY pos) AS m FROM (""" + parts + """) GROUP BY c) n ON n.c = o.c)"""
    rounds = ",\n".join(f"{nearest.format(i=i)},\n{moved.format(i=i, j=i + 1)}" for i in range(clustering.ROUNDS))
    last = clustering.ROUNDS
    return f"""
WITH vectors AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor({clustering.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{clustering.SEED}:' || coalesce(vec_id::VARCHAR, ''))) - 1 AS c, v AS m FROM vectors QUALIFY c < {k}),
{rounds},
{nearest.format(i=last)},
told AS (SELECT c, sha256(array_to_string(m, ',')) AS h FROM c{last}),
sums AS (SELECT c, sum(d) AS s FROM a{last} GROUP BY c)
SELECT vec_id, c::INT AS cluster, d AS distance, s::BIGINT AS cluster_inertia, (SELECT sum(s) FROM sums)::BIGINT AS inertia, h AS centroid_sha256
FROM a{last} JOIN vectors USING (id) JOIN told USING (c) JOIN sums USING (c)
"""


@query("op13_centroid_clustering", _clustering_sql())
def op13(table):
    """The cluster of every vector."""
    return clustering.clustered(table("embeddings"))
