"""Secret scans with a random forest that removes false positives, in DataFrame operations.

Candidates are runs of at least ``LEAST_LENGTH`` letters, digits and ``_ - + / =`` that hold
a digit. Each gets features: its length, shares of character classes, transitions between
classes, share of distinct characters, share covered by words of a dictionary, marks of its
path, and its neighbouring words. A random forest fitted on labelled findings gives the
probability of a secret; findings below ``KEEP_AT`` are false positives. The dictionary
holds the ``DICTIONARY_WORDS`` most frequent words of all documents.

The forest is fitted on at most ``SAMPLE_FINDINGS`` labelled findings, those with the
smallest hash of their place. With one class only, every finding gets that class. Null and
empty texts have no findings; repeated rows repeat theirs; empty tables give none. Whole
texts are read; other columns are not. A null path counts as empty.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.session import stored

LEAST_LENGTH = 16
CANDIDATE = rf"[A-Za-z0-9+/=_\-]{{{LEAST_LENGTH},}}"
KEEP_AT = 0.5
SAMPLE_FINDINGS = 20_000
DICTIONARY_WORDS = 5_000
TREES, DEPTH, SEED = 20, 6, 11

# Words that stand beside secrets, and beside other long strings.
SECRET_WORDS = "token secret password passwd pwd apikey api_key key auth bearer credential credentials private access".split()
OTHER_WORDS = "example sample test dummy fake hash sha sha1 sha256 md5 commit checksum digest uuid guid id ref version isbn".split()
SAMPLE_PATHS = "test|tests|example|examples|sample|mock|fixture|fixtures|doc|docs|demo"

FEATURES = (
    "n_length", "n_digit", "n_upper", "n_lower", "n_other", "n_runs", "n_distinct", "n_hex", "n_dictionary",
    "n_quoted", "n_assigned", "n_secret_word", "n_other_word", "n_line_words", "n_sample_path",
)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, line, word, part, candidate, left, right, path): every candidate and its neighbours."""
    place = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    texts = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", place.alias("path")
    )
    digits = rf"(?=[A-Za-z+/=_\-]*[0-9]){CANDIDATE}"
    lines = texts.filter(F.col("text").rlike(digits)).select(
        "doc_id", "path", F.posexplode_outer(F.split("text", "\n")).alias("line", "line_text")
    )
    lines = lines.filter(F.col("line_text").rlike(digits))
    words = lines.select("doc_id", "path", "line", F.split("line_text", r"\s+").alias("w"))
    words = words.select("doc_id", "path", "line", "w", F.posexplode_outer("w").alias("word", "piece"))
    words = words.filter(F.col("piece").rlike(digits))
    at = F.col("word")
    near = words.select(
        "doc_id", "path", "line", "word", "piece", F.size("w").alias("line_words"),
        F.slice("w", F.greatest(at - 2, F.lit(1)), F.least(at, F.lit(3))).alias("left"),
        F.slice("w", at + 2, 2).alias("right"),
    )
    parts = near.select("*", F.posexplode_outer(F.regexp_extract_all("piece", F.lit(CANDIDATE), F.lit(0))).alias("part", "candidate"))
    return parts.filter(F.col("candidate").rlike("[0-9]"))


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> DataFrame:
    """The most frequent words of four letters or more, by the number of documents."""
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("w"))
    counted = words.filter(F.length("w") >= 4).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "w").limit(size).select("w")


def share(text: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kept}]", "")) / F.length(text)


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns of ``FEATURES``."""
    c = F.col("candidate")
    around = F.transform(F.concat("left", "right"), lambda w: F.lower(F.regexp_replace(w, "[^A-Za-z0-9_]", "")))
    listed = lambda names: F.arrays_overlap(around, F.array(*map(F.lit, names))).cast("double")
    last = F.coalesce(F.element_at(F.when(F.size("left") > 0, F.col("left")), -1), F.lit(""))
    runs = F.regexp_extract_all(c, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+"), F.lit(0))
    key = ["doc_id", "line", "word", "part"]
    # Letters of the candidate that are words of the dictionary (a fixed number of words).
    letters = found.select("candidate").distinct().select(
        "candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{4,}"), F.lit(0))).alias("w")
    )
    covered = letters.join(F.broadcast(words), "w").groupBy("candidate").agg(F.sum(F.length("w")).alias("_covered"))
    return found.join(covered, "candidate", "left").select(
        *key, "candidate", "left", "right", "path",
        F.length(c).cast("double").alias("n_length"),
        share(c, "0-9").alias("n_digit"), share(c, "A-Z").alias("n_upper"), share(c, "a-z").alias("n_lower"),
        share(c, "_+/=\\-").alias("n_other"),
        (F.size(runs) / F.length(c)).alias("n_runs"),
        (F.size(F.array_distinct(F.split(c, ""))) / F.length(c)).alias("n_distinct"),
        c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double").alias("n_hex"),
        (F.coalesce("_covered", F.lit(0)) / F.length(c)).alias("n_dictionary"),
        F.col("piece").rlike("[\"'`]").cast("double").alias("n_quoted"),
        (last.rlike("[=:]>?$") | F.col("piece").rlike("^[A-Za-z_]+[=:]")).cast("double").alias("n_assigned"),
        listed(SECRET_WORDS).alias("n_secret_word"), listed(OTHER_WORDS).alias("n_other_word"),
        F.col("line_words").cast("double").alias("n_line_words"),
        F.lower("path").rlike(rf"(?<![a-z])(?:{SAMPLE_PATHS})(?![a-z])").cast("double").alias("n_sample_path"),
    )


def with_probability(features: DataFrame, labelled: DataFrame, sample: int = SAMPLE_FINDINGS) -> DataFrame:
    """``features`` with ``p_secret``, by a forest fitted on ``labelled`` (features and label 0/1)."""
    chosen = labelled.orderBy(F.xxhash64("doc_id", "line", "word", "part"), "doc_id", "line", "word", "part").limit(sample)
    chosen = stored(chosen.select(*FEATURES, F.col("label").cast("double").alias("label")), "findings")
    seen = [r.label for r in chosen.select("label").distinct().collect()]
    if len(seen) < 2:
        return features.withColumn("p_secret", F.lit(seen[0] if seen else 0.0))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird")
    model = forest.fit(assembler.transform(chosen.coalesce(1)))
    scored = model.transform(assembler.transform(features))
    return scored.withColumn("p_secret", F.round(vector_to_array("probability")[1], 6)).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def rule_label(found: DataFrame) -> DataFrame:
    """Findings with a label by hand-written rule, where no reviewed findings are at hand.

    A secret: hexadecimal or mixed, of 20 characters or more, quoted or assigned, beside a
    word for secrets. Anything else is not.
    """
    kind = (F.col("n_hex") == 1) & (F.col("n_digit") < 1) | (F.col("n_upper") > 0) & (F.col("n_lower") > 0)
    told = (F.col("n_secret_word") == 1) & ((F.col("n_quoted") == 1) | (F.col("n_assigned") == 1))
    return found.withColumn("label", (kind & told & (F.col("n_length") >= 20)).cast("int"))


def findings(docs: DataFrame, labelled_ids: DataFrame) -> DataFrame:
    """(doc_id, line, word, part, candidate, p_secret, secret) of every candidate.

    The forest learns from the findings in the documents of ``labelled_ids`` (doc_id), with
    labels by :func:`rule_label`.
    """
    features = stored(featured(candidates(docs), stored(dictionary(docs), "dictionary")), "features")
    labelled = rule_label(features.join(labelled_ids.select("doc_id").distinct(), "doc_id", "left_semi"))
    return with_probability(features, labelled).select(
        "doc_id", "line", "word", "part", "candidate", "p_secret", (F.col("p_secret") >= KEEP_AT).alias("secret")
    )
