"""Operator 8: secret scans with a random forest, with DataFrame functions only.

A regular expression gives candidates: strings of key-like characters that hold a digit, whatever is
assigned to a credential word, and the password of a URL.  Each is described by its length, its character classes and the transitions between them, how much of it
words of the corpus' own dictionary cover, the path (source) and the words around it.  A random
forest trained on labelled findings says which candidates are secrets; the rest are false positives.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

_KEY = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
#: Six characters or more behind a credential word and an assignment.  Java looks back over a bounded number of
#: places only; the short looks in front spare the long one at most places.
_VALUE = (r"(?<=[:=\s\"'])(?<=[:=]\s{0,2}[\"']?)"
          r"(?<=(?i:pass|passwd|password|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth)[\"']?\s{0,2}[:=]\s{0,2}[\"']?)"
          r"(?![\"'=:])[^\s\"'<>&;,]{6,}+")
_URL = r"(?<=:)(?<=://[^\s/:@]{1,40}:)[^\s/@\"'<>]{3,}+(?=@)"
CANDIDATE = f"{_KEY}|{_VALUE}|{_URL}"
CONTEXT = 40
#: A dictionary word is at least one in so many of all words, and occurs twice or more.
WORD_SHARE = 1_000_000
MAX_TRAINING, TREES, DEPTH, SEED = 20_000, 30, 6, 7
_ASSIGNED = r"(?i)(?:pass(?:word|wd|phrase)?|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth)[a-z_-]*[\"']?\s*[:=]\s*[\"']?$"
_PLAIN = r"(?i)(?:commit|revision|sha\d*|md5|checksum|digest|hash|uuid|build|version|etag|integrity)[a-z_-]*[\"']?\s*[:=]?\s*[\"']?$"
_PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|xxxx|0{8}|1234567"
#: Fixed formats of issued keys, used for labels.
_ISSUED = r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_(?:live|test)_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$"
FEATURES = [
    "length", "digits", "lower", "upper", "signs", "hex", "transitions", "changes_per_char", "distinct", "coverage",
    "assigned", "plain", "placeholder", "quoted", "equals_before", "words_before", "test_path",
]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), begin (characters before it), value, before, behind, path."""
    hit = docs.where(F.col("text").rlike(CANDIDATE)).select("doc_id", F.xxhash64("text").alias("h"), "text", "path").distinct()
    split = hit.select(
        "doc_id", "h", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("gaps"))
    sizes = F.zip_with("found", F.slice("gaps", F.lit(1), F.size("found")), lambda v, g: F.struct(F.length(g).alias("gap"), F.length(v).alias("size")))
    begins = F.aggregate(
        sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins")),
        lambda s, x: F.struct((s["at"] + x["gap"] + x["size"]).alias("at"), F.concat(s["begins"], F.array(s["at"] + x["gap"])).alias("begins")))["begins"]
    gap = lambda i: F.element_at("gaps", i)
    rows = F.transform("found", lambda v, i: F.struct(
        v.alias("value"), i.alias("i"), F.right(gap(i + 1), F.lit(CONTEXT)).alias("before"), F.left(gap(i + 2), F.lit(CONTEXT)).alias("behind")))
    return (
        split.withColumn("begins", begins).select("doc_id", "h", "path", "begins", F.explode(rows).alias("row"))
        .select("doc_id", "h", F.element_at("begins", F.col("row.i") + 1).alias("begin"), "row.value", "row.before", "row.behind", "path"))


def dictionary(docs: DataFrame, share: int = WORD_SHARE) -> DataFrame:
    """(word) of three letters or more, lower case, that occur twice or more and at least once in ``share`` words of
    all documents: what counts as a word does not change with the size of a corpus of the same kind."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"\P{L}+")).alias("word")).where(F.length("word") >= 3)
    counted = cut(words.groupBy("word").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    total = counted.agg(F.sum("times").alias("total"))  # one row
    return counted.join(F.broadcast(total), F.col("times") * share >= F.col("total")).select("word")


def _share(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with FEATURES, each distinct value's coverage looked up once."""
    values = found.select("value").distinct()
    runs = values.select("value", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit(r"\p{L}{3,}"), F.lit(0)))).alias("word"))
    covered = (
        runs.join(words, "word")
        .groupBy("value").agg(F.sum(F.length("word")).alias("covered")))
    value, before = F.col("value"), F.col("before")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]", "\u0001"), "[a-z]", "\u0002"), "[A-Z]", "\u0003"), "[^\u0001-\u0003]", "\u0004")
    changes = F.regexp_count(kinds, F.lit("(?<=\u0001)[\u0002-\u0004]|(?<=\u0002)[\u0001\u0003\u0004]|(?<=\u0003)[\u0001\u0002\u0004]|(?<=\u0004)[\u0001-\u0003]"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return found.join(cut(covered), "value", "left").select(
        *found.columns,
        F.length(value).cast("double").alias("length"), _share(value, "[^0-9]").alias("digits"), _share(value, "[^a-z]").alias("lower"),
        _share(value, "[^A-Z]").alias("upper"), _share(value, "[A-Za-z0-9]").alias("signs"), _share(value, "[^0-9a-fA-F]").alias("hex"),
        changes.cast("double").alias("transitions"), (changes / F.length(value)).alias("changes_per_char"),
        (F.size(F.array_distinct(F.split(value, ""))) / F.length(value)).alias("distinct"),
        (F.coalesce("covered", F.lit(0)) / F.length(value)).alias("coverage"),
        flag(before.rlike(_ASSIGNED)).alias("assigned"), flag(before.rlike(_PLAIN)).alias("plain"), flag(value.rlike(_PLACEHOLDER)).alias("placeholder"),
        flag(before.rlike("[\"'`]$")).alias("quoted"), flag(before.rlike("[:=]\\s*[\"']?$")).alias("equals_before"),
        F.size(F.regexp_extract_all(before, F.lit(r"\p{L}+"), F.lit(0))).cast("double").alias("words_before"),
        flag(F.col("path").rlike("(?i)test|example|sample|fixture|mock|doc")).alias("test_path"))


def held_out(value: str = "value") -> Column:
    """The fold of values that no label is learnt from."""
    return F.crc32(F.col(value).cast("binary")) % 5 == 0


def rule_labels(found: DataFrame) -> DataFrame:
    """value, label for candidates that rules can tell: issued key formats and assignments to a
    credential are secrets (1); numbers, placeholders, checksums, and values that stand in running
    text without quote or assignment are none (0).  Use reviewed findings instead where there are some."""
    value, before = F.col("value"), F.col("before")
    secret = value.rlike(_ISSUED) | (before.rlike(_ASSIGNED) & ~value.rlike(_PLACEHOLDER))
    none = value.rlike("^[0-9]+$") | value.rlike(_PLACEHOLDER) | before.rlike(_PLAIN) | ~before.rlike("[\"'`:=]\\s*$")
    label = F.when(secret, 1).when(none, 0)
    return found.select("value", label.alias("label")).where("label is not null").groupBy("value").agg(F.max("label").alias("label"))


def train(rows: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING):
    """A forest from at most ``max_rows`` labelled candidates outside the held-out fold (those with
    the smallest hash), and the share of secrets among them; no forest if there is but one kind."""
    known = labels.where(~held_out() & F.col("label").isNotNull())
    sample = cut(rows.join(known, "value").select("label", "value", "before", *FEATURES).orderBy(F.xxhash64("value", "before"), "value", "label").limit(max_rows))
    n, secrets = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or not 0 < secrets < n:
        return None, (secrets / n if n else 0.5)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)), secrets / n


def scan(docs: DataFrame, labels: DataFrame | None = None, threshold: float = 0.5, path_col: str = "source") -> DataFrame:
    """doc_id, begin, length (in characters), value_sha256, held_out, score, secret: one row for
    each candidate; those that are no secret are the false positives that the forest removes.

    ``labels`` (value, label 0 or 1): labelled findings; without them rule_labels() of the corpus.
    Null and empty texts have no candidate; rows that repeat doc_id and text are one; a null path
    is no test path; without labels of both kinds every score is the share of secrets (0.5 without any) and nothing
    is marked as a secret; an empty table gives no row; other columns are not read."""
    path = F.col(path_col).cast("string") if path_col in docs.columns else F.lit(None).cast("string")
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), path.alias("path"))
    found = cut(candidates(docs))
    rows = cut(described(found, dictionary(docs)))
    forest, share = train(rows, rule_labels(found) if labels is None else labels)
    if forest is None:
        scored = rows.withColumn("score", F.lit(float(share)))
    else:
        features = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        scored = forest.transform(features).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "doc_id", "begin", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), held_out().alias("held_out"),
        "score", (F.lit(forest is not None) & (F.col("score") >= threshold)).alias("secret"))
