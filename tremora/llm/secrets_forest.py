"""Secret scanning whose false positives a random forest removes.

A wide net of patterns gives candidates: long tokens with a digit, or eight or more
characters behind a credential's name, in one token or in up to three. The forest then decides by a candidate's shape and surroundings:
its length, how often neighbouring characters change class, how much of its letters are
words of the corpus, the path of its document and the words beside it. It is trained
from labelled findings; ``rule_findings`` labels the candidates on which fixed formats
leave no doubt. DataFrame functions and Spark's own forest only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tremora.llm.common import draw, fold, materialise

MAX_FINDINGS = 10_000  # labelled findings of each label that the forest learns from
WORD_SHARE = 20_000  # a dictionary word makes up at least one in so many words, so there are at most as many
THRESHOLD = 0.5

# Names of credentials, public formats of keys, and marks of sample material.
NAMES = r"(?i)(pass(word|wd)?|pwd|secret|token|api_?key|access_?key|auth|credential|private_?key)"
KEY_FORMATS = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^xox[abprs]-[0-9A-Za-z-]{10,}$|^sk_live_[0-9A-Za-z]{16,}$|^AIza[0-9A-Za-z_-]{35}$"
SAMPLE_PATH = r"(?i)(test|example|sample|mock|fixture|doc)"
PLACEHOLDER = r"(?i)(example|placeholder|changeme|your[_-]|xxxx|0000|1234567)"

VALUE = r"([A-Za-z0-9+/_=-]{12,})"
#: a token with a run of value characters that has a digit, a key's beginning, or something behind a name and a sign
CANDIDATE = r"(?=\S*[0-9])\S*[A-Za-z0-9+/_=-]{16,}|(AKIA|ASIA)[A-Z]{16}|(?i)(pass|pwd|secret|token|key|auth|cred)\S*[=:]\S*[A-Za-z0-9+/_=-]{12,}"

#: eight or more characters without the quotes, brackets and stops around them
BODY = r"[^\s\"'`(\[{<]\S{6,}[^\s\"'`)\]}>,;.]"
WIDE = r"(?i)(pass|pwd|secret|token|key|auth|cred)"
SIGN = r"(?:[=:]+>?)"
ENDS = r"[\"'`)\]]*"
#: a name, a sign and a value in one token; a name that ends a token, with a sign and without one; a sign alone
INSIDE = WIDE + r"[^\s=:]*" + SIGN + r"[\"'`(\[{<]*" + BODY
NAME_SIGN = WIDE + r"[^\s=:]*" + SIGN + r"[\"'`(\[{<]*$"
NAME = WIDE + r"[^\s=:]*$"
NAME_BARE = NAMES + "s?" + ENDS + "$"
SIGN_ONLY = f"^{SIGN}$"

FEATURES = (
    "n_chars", "transitions", "digits", "uppers", "lowers", "others", "hex_only", "distinct", "coverage", "longest_letters",
    "quoted", "assigned", "named_inside", "named_before", "sign_before", "letters_before", "letters_after", "first", "last",
    "slashes", "sample_path", "placeholder",
)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, path, at (number of the token in the text), token, value, before, before2, after of every candidate.

    Tokens are what white space separates. A null or empty text has none. ``path`` is the
    column path or source if there is one.
    """
    path = next((F.col(c).cast("string") for c in ("path", "source") if c in docs.columns), F.lit(None).cast("string"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(path, F.lit("")).alias("path"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # a text without a name and a long token has none, and is not split
    words = texts.where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(WIDE)).select("doc_id", "path", F.split("text", r"\s+").alias("w"))
    places = F.filter(F.sequence(F.lit(0), F.size("w") - 1),
                      lambda i: F.get("w", i).rlike(CANDIDATE) | _named(F.get("w", i), F.get("w", i - 1), F.get("w", i - 2)))
    near = lambda step: F.coalesce(F.get("w", F.col("at") + step), F.lit(""))
    found = words.withColumn("at", F.explode(places)).select(
        "doc_id", "path", "at", F.get("w", F.col("at")).alias("token"), near(-1).alias("before"), near(-2).alias("before2"),
        near(1).alias("after"))
    longest = F.reduce(F.regexp_extract_all("token", F.lit(VALUE), 1), F.lit(""),
                       lambda best, v: F.when(F.length(v) > F.length(best), v).otherwise(best))
    tail = F.regexp_extract("token", r"[=:]\W*" + VALUE, 1)  # what stands behind a name, without the name
    inside = F.regexp_extract("token", WIDE + r"[^\s=:]*" + SIGN + r"(\S+)", 2)
    whole = F.regexp_replace(F.when(F.col("token").rlike(INSIDE), inside).otherwise(F.col("token")),
                             r"^[=:>\"'`(\[{<]+|[\"'`)\]}>,;.]+$", "")
    named = F.coalesce(_named(F.col("token"), F.col("before"), F.col("before2")), F.lit(False)) & (F.length(whole) >= 8)
    url = F.col("token").rlike("[?&]")  # other parameters may follow
    return found.withColumn("value", F.when(named & ~url, whole).when(tail != "", tail).when(longest != "", longest)
                            .when(named, whole).otherwise(F.col("token")))


def _named(token: Column, before: Column, before2: Column) -> Column:
    """Whether a value of eight or more characters stands behind a credential's name, with a sign or straight after it."""
    behind = (before.rlike(NAME_SIGN) | before.rlike(NAME_BARE) | (token.rlike("^[=:]") & before.rlike(NAME))
              | (before.rlike(SIGN_ONLY) & before2.rlike(NAME)))
    return token.rlike(INSIDE) | (token.rlike(BODY) & behind)


def dictionary(docs: DataFrame, share: int = WORD_SHARE) -> DataFrame:
    """Lower-case words of three or more letters that make up at least one in ``share`` of all such words."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[a-z]{3,}"), 0)).alias("word"))
    counts = materialise(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") * share >= total).select("word")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("value", pattern, "")) / F.col("n_chars")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with the columns FEATURES; ``words`` is the dictionary. ``found`` must be stored."""
    chunks = found.select("value").distinct().select(
        "value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), 0)).alias("word"))
    covered = chunks.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    runs = F.regexp_replace(kinds, r"(.)\1+", "$1")
    letters = F.reduce(F.regexp_extract_all("value", F.lit("[A-Za-z]+"), 0), F.lit(0), lambda m, w: F.greatest(m, F.length(w)))
    ends = lambda p: F.col("token").rlike(p).cast("double")
    return found.join(covered, "value", "left").withColumn("n_chars", F.length("value").cast("double")).select(
        *found.columns, "n_chars",
        ((F.length(runs) - 1) / F.col("n_chars")).alias("transitions"),
        _share("[^0-9]").alias("digits"), _share("[^A-Z]").alias("uppers"), _share("[^a-z]").alias("lowers"),
        _share("[A-Za-z0-9]").alias("others"), F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex_only"),
        (F.size(F.array_distinct(F.split("value", ""))) / F.col("n_chars")).alias("distinct"),
        (F.coalesce("covered", F.lit(0)) / F.col("n_chars")).alias("coverage"), (letters / F.col("n_chars")).alias("longest_letters"),
        ends("[\"']").alias("quoted"), ends("[=:]").alias("assigned"), ends(NAMES).alias("named_inside"),
        (F.col("before").rlike(NAMES) | F.col("before2").rlike(NAMES)).cast("double").alias("named_before"),
        F.col("before").rlike(r"^[=:]+$|[=:]$").cast("double").alias("sign_before"),
        F.col("before").rlike(r"^\p{L}+$").cast("double").alias("letters_before"),
        F.col("after").rlike(r"^\p{L}+\W*$").cast("double").alias("letters_after"),
        (F.col("at") == 0).cast("double").alias("first"), (F.col("after") == "").cast("double").alias("last"),
        F.length(F.regexp_replace("token", "[^/\\\\]", "")).cast("double").alias("slashes"),
        F.col("path").rlike(SAMPLE_PATH).cast("double").alias("sample_path"),
        F.col("value").rlike(PLACEHOLDER).cast("double").alias("placeholder"),
    )


def rule_findings(featured: DataFrame) -> DataFrame:
    """Candidates on which fixed formats are certain: their columns and ``label``.

    0: digits alone, or placeholder text. 1: else, a key of a public format, or 16 or more
    hexadecimal digits of both kinds behind a credential's name. 0: else, no digit at all and
    no name before it, or words of the dictionary for half of it.
    """
    value, named = F.col("value"), (F.col("named_inside") + F.col("named_before")) > 0
    sure = value.rlike(KEY_FORMATS) | (named & value.rlike("^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$"))
    sample = value.rlike("^[0-9_+/=-]+$") | (F.col("placeholder") > 0)
    label = F.when(sample, 0.0).when(sure, 1.0).when(~value.rlike("[0-9]") & (~named | (F.col("coverage") >= 0.5)), 0.0)
    return featured.withColumn("label", label).where("label is not null")


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD, trees: int = 40,
                 depth: int = 8, seed: int = 17, max_findings: int = MAX_FINDINGS) -> DataFrame:
    """doc_id, at, token, value, held_out, label, score and kept of every candidate in ``docs``.

    ``findings``: labelled findings (doc_id, at, label 0/1); by default those of
    ``rule_findings``. The forest learns from at most ``max_findings`` of each label, of
    documents whose crc32(doc_id as text) mod 4 is not 2 (the others are held out).
    ``kept`` is false for what it takes for a false positive. Without findings of both
    labels it learns nothing: the score is 0.5 and everything is kept. Findings without
    doc_id are not learnt from; other columns of ``docs`` are ignored.
    """
    found = materialise(candidates(docs), "candidates")
    featured = materialise(with_features(found, dictionary(docs)), "features")
    if findings is None:
        labels = rule_findings(featured).select("doc_id", "at", "label")
    else:
        labels = findings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("at").cast("int").alias("at"),
                                 F.col("label").cast("double").alias("label"))
    labels = labels.groupBy("doc_id", "at").agg(F.min("label").alias("label"))
    known = featured.join(labels, ["doc_id", "at"]).where(fold("doc_id", 4) != 2).dropDuplicates(["value", "before", "after", "label"])
    drawn = draw(known.where("label = 1"), max_findings, "doc_id", "at").union(draw(known.where("label = 0"), max_findings, "doc_id", "at"))
    learn = materialise(drawn.repartition(1).sortWithinPartitions("doc_id", "at"), "findings")  # two times max_findings
    out = featured.join(labels, ["doc_id", "at"], "left").withColumn("held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))
    both = {r[0] for r in learn.select("label").distinct().collect()} == {0.0, 1.0}
    if both:
        assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label",
                                        predictionCol="forest_prediction", rawPredictionCol="forest_raw", probabilityCol="forest_probability")
        model = forest.fit(assemble.transform(learn))
        out = model.transform(assemble.transform(out)).withColumn("score", vector_to_array("forest_probability")[1])
    else:
        out = out.withColumn("score", F.lit(0.5))
    return out.select("doc_id", "at", "token", "value", "held_out", F.col("label").cast("int").alias("label"),
                      F.round("score", 6).alias("score"), (F.col("score") >= threshold).alias("kept"))
