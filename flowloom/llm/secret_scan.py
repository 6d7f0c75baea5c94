"""Secret scans with a random forest that removes false positives, in DataFrame operations only.

Candidates are runs of 16 or more key characters in the whole text, and whatever is assigned to a secret's name, of any length
and characters: all within quotes, or all up to a blank, without the punctuation that ends it. For each the forest sees its length, its character
classes and the changes between them, how likely its letter pairs are in words of the corpus, how much of it words of the
corpus cover, the path (source), and the neighbouring words. It learns from labelled findings. Where no labels exist,
``distant_labels`` marks as secrets what a secret's name is assigned to, and everything else as false positives.

The word list (words of WORD_MIN to WORD_MAX letters that stand at least MIN_COUNT times in all documents) stays a table,
reduced map-side and joined; the pair table has at most 26 x 26 entries. The forest is fitted by Spark on at most SAMPLE
findings of each class, those of smallest hash; all findings are scored.

Defined cases: null and empty texts have no findings. With labels of one class, or none, every score is the smoothed share
of label 1. Repeated rows have repeated findings. Null sources are the path of the empty name.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import staged, words_of

#: A run of key characters, which needs no name.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Names that secrets are assigned to.
SECRET_NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "access_key", "private_key", "auth", "credential")
#: A name is a whole part of a word: ``auth`` and ``client_auth``, also ``clientAuth``, but not ``author``; value and name share a line.
_NAME = rf"(?:(?<![A-Za-z])(?i:{'|'.join(SECRET_NAMES)})|(?<=[a-z])(?:{'|'.join(n.title() for n in SECRET_NAMES)}))(?![A-Za-z])(?:[0-9]|_[A-Za-z0-9]+)*+_?"
ASSIGNMENT = rf"{_NAME}[\"']?[ \t]*[:=]+>?[ \t]*"
#: A name that ends a phrase, with a colon: prose, no assignment.
_PROSE = rf"[A-Za-z]{{2,}} {_NAME}:[ \t]*$"
#: What is assigned: all within quotes, or all up to a blank or the next name of a list; possessive, as Java recurses otherwise.
_QUOTED = r"\"(?:[^\"\\\n]|\\.)++\"|'(?:[^'\\\n]|\\.)++'"
_BARE = r"(?!\"\"|'')(?:(?![&,;][\"']?[A-Za-z_][A-Za-z0-9_.-]*[\"']?\s?[:=])\S)++"
#: A long name may end in a secret's name; a padded run of key characters that holds one by chance is no name.
_NAMED = rf"(?=[A-Za-z0-9+/_=-]{{16}})(?![A-Za-z0-9+/_-]+=+(?:\s|\Z))[A-Za-z0-9_-]*?{ASSIGNMENT}"
FINDING = rf"(?:{ASSIGNMENT}|{_NAMED})(?:{_QUOTED}|{_BARE})|{CANDIDATE}"
#: Ends of a bare value that are punctuation of the text around it.
_TAIL = r"[,;.)\]}>\"'`]*$"
CONTEXT = 64
WORD_MIN, WORD_MAX, MIN_COUNT = 4, 6, 20
SAMPLE = 10_000
TREES, DEPTH, SEED = 30, 7, 5
_HASHED = 12


def _parts(m: Column) -> Column:
    """(before, value, after) of a match of FINDING: an assignment and its quotes are no part of the value."""
    head = F.regexp_extract(m, rf"^(?:{ASSIGNMENT}|{_NAMED})(?=.)", 0)
    rest = F.substr(m, F.length(head) + 1, F.length(m))
    quoted = (head != "") & rest.rlike(rf"^(?:{_QUOTED})$")
    bare = F.when(head != "", F.regexp_replace(rest, _TAIL, "")).otherwise(rest)
    value = F.when(quoted, F.substr(rest, F.lit(2), F.length(rest) - 2)).otherwise(bare)
    before = F.when(quoted, F.concat(head, F.left(rest, F.lit(1)))).otherwise(head)
    after = F.substr(m, F.length(before) + F.length(value) + 1, F.length(m))
    return F.struct(before.alias("before"), value.alias("value"), after.alias("after"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(doc_id, path, start, value, before, after): each candidate, its 0-based place in characters and its surroundings."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all(text, F.lit(FINDING), F.lit(0)).alias("matches"), F.split(text, FINDING).alias("gaps"),
    ).where(F.size("matches") > 0)
    after = F.slice("gaps", F.lit(2), F.size("matches"))
    zipped = F.arrays_zip(
        F.transform("matches", _parts).alias("parts"), F.transform("gaps", lambda g: F.right(g, F.lit(CONTEXT))).alias("before"), F.transform(after, lambda g: F.left(g, F.lit(CONTEXT))).alias("after"),
        F.transform("gaps", F.length).alias("skip"), F.transform("matches", F.length).alias("size"),
    )
    rows = rows.select("doc_id", "path", F.slice(zipped, F.lit(1), F.size("matches")).alias("found"), F.size("matches").alias("n"))
    # Places are running sums of gaps and matches.
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<bigint>)").alias("starts"))
    step = lambda s, f: F.struct((s["at"] + f["skip"] + f["size"]).alias("at"), F.array_append(s["starts"], s["at"] + f["skip"]).alias("starts"))
    rows = rows.withColumn("starts", F.aggregate("found", empty, step)["starts"])
    each = rows.select("doc_id", "path", F.explode(F.arrays_zip("found", "starts")).alias("f"))
    before, own = F.col("f.found.before"), F.col("f.found.parts")
    found = each.select(
        "doc_id", "path", (F.col("f.starts") + F.length(own["before"])).alias("start"), own["value"].alias("value"),
        F.right(F.concat(before, own["before"]), F.lit(CONTEXT)).alias("before"), F.left(F.concat(own["after"], F.col("f.found.after")), F.lit(CONTEXT)).alias("after"),
    )
    return found.where("value <> ''")


def distant_labels(found: DataFrame) -> Column:
    """1 for a value assigned to a secret's name, with letters and digits, and not by a colon in prose; else 0."""
    assigned = F.col("before").rlike(rf"{ASSIGNMENT}[\"']?$") & ~F.col("before").rlike(_PROSE)
    return (assigned & F.col("value").rlike("[0-9]") & F.col("value").rlike(r"\p{L}")).cast("double")


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): the frequent short words of all documents."""
    words = docs.select(F.explode(words_of(F.col(text_col))).alias("word")).select(F.lower("word").alias("word"))
    words = words.where(F.length("word").between(WORD_MIN, WORD_MAX) & F.col("word").rlike("^[a-z]+$"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def _pair_scores(words: DataFrame) -> Column:
    """A map from letter pairs to the logarithm of their smoothed share in the words."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    pairs = words.select(F.explode(F.transform(places, lambda i: F.substr("word", i, F.lit(2)))).alias("pair"), "n")
    rows = pairs.groupBy("pair").agg(F.log(F.sum("n") + 1.0).alias("score")).collect()
    if not rows:
        return F.expr("cast(map() as map<string, double>)")
    return F.create_map(*[F.lit(x) for r in sorted(rows) for x in (r.pair, r.score)])


def with_traits(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with ``traits``, a vector."""
    found = staged(found, "findings")
    values = found.select("value").distinct()
    runs = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit(f"[a-z]{{{WORD_MIN},}}"), F.lit(0))).alias("run"))
    places = F.sequence(F.lit(1), F.length("run") - WORD_MIN + 1)
    parts = runs.select("value", "run", F.explode(places).alias("i"))
    parts = parts.select("value", "run", "i", F.explode(F.array(*[F.substr("run", F.col("i"), F.lit(k)) for k in range(WORD_MIN, WORD_MAX + 1)])).alias("word"))
    covered = parts.join(words.select("word"), "word", "left_semi").select("value", "run", "i").distinct()
    covered = covered.groupBy("value").agg(F.count(F.lit(1)).alias("covered"))
    pairs = _pair_scores(words)
    value = F.col("value")
    size = F.length(value).cast("double")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / size
    lower = F.lower(value)
    # Pairs of neighbours of an array: places of a string would be counted anew each time.
    chars = F.split(lower, "")
    neighbours = F.zip_with(F.slice(chars, F.lit(1), F.length(value) - 1), F.slice(chars, F.lit(2), F.length(value) - 1), lambda x, y: F.concat(x, y))
    likely = F.aggregate(neighbours, F.lit(0.0), lambda s, p: s + F.coalesce(F.try_element_at(pairs, p), F.lit(0.0)))
    distinct = F.size(F.array_distinct(F.split(value, ""))) / size
    near = F.lower(F.regexp_replace("before", r"[^\p{L}]+", " "))
    words_before = F.filter(F.split(near, " "), lambda w: w != "")
    last = F.coalesce(F.try_element_at(words_before, F.lit(-1)), F.lit(""))
    second = F.coalesce(F.try_element_at(words_before, F.lit(-2)), F.lit(""))
    following = F.lower(F.regexp_extract("after", r"(\p{L}+)", 1))
    one_hot = lambda w: [(F.pmod(F.xxhash64(w), F.lit(_HASHED)) == k).cast("double") for k in range(_HASHED)]
    columns = [
        size, share("[0-9]"), share("[A-Z]"), share("[a-z]"), share("[a-fA-F0-9]"), share("(?<=[A-Za-z])[0-9]"), share("(?<=[0-9])[A-Za-z]"),
        share("(?<=[a-z])[A-Z]"), share("[+/_=-]"), distinct, likely / size, F.coalesce("covered", F.lit(0)) / size,
        F.col("before").rlike(r"[:=]\s*[\"']?$").cast("double"), F.col("before").rlike(r"[\"']$").cast("double"), F.col("after").rlike("^[\"']").cast("double"),
        F.pmod(F.xxhash64("path"), F.lit(16)).cast("double"), *one_hot(last), *one_hot(second), *one_hot(following),
    ]
    joined = found.join(covered, "value", "left")
    return joined.select(*found.columns, array_to_vector(F.array(*[c.cast("double") for c in columns])).alias("traits"))


def scored(found: DataFrame, fit_rows: Column, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """``found`` (with traits and label) with ``score`` and ``predicted``, by a forest fitted on ``fit_rows``."""
    known = found.where(fit_rows & F.col("label").isin(0.0, 1.0))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        share = (counts.get(1.0, 0) + 1) / (sum(counts.values()) + 2)
        done = found.drop("traits").withColumn("score", F.lit(float(share)))
    else:
        pick = F.xxhash64("doc_id", "start", F.lit(SEED))
        parts = [known.where(F.col("label") == k).orderBy(pick, "doc_id", "start").limit(sample) for k in (0.0, 1.0)]
        fitted = staged(parts[0].union(parts[1]).select(vector_to_array("traits").alias("x"), "label"), "labelled")
        fitted = fitted.select(array_to_vector("x").alias("traits"), "label")
        forest = RandomForestClassifier(featuresCol="traits", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8).fit(fitted)
        done = forest.transform(found).withColumn("score", vector_to_array("probability")[1])
        done = done.drop("traits", "rawPrediction", "probability", "prediction")
    return done.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def scan(docs: DataFrame, fit_rows: Column, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Findings with score and verdict: (doc_id, path, start, value, before, after, label, score, predicted).

    ``labels`` are labelled findings (doc_id, start, label); without them the distant labels serve.
    """
    found = candidates(docs, id_col, text_col, path_col)
    if labels is None:
        found = found.withColumn("label", distant_labels(found))
    else:
        marks = labels.groupBy("doc_id", "start").agg(F.min("label").cast("double").alias("label"))
        found = found.join(marks, ["doc_id", "start"], "left")
    return scored(with_traits(found, staged(dictionary(docs, text_col), "dictionary")), fit_rows)
