"""Secret scans: patterns propose candidates, a random forest removes false positives.

Features are the candidate's length, its changes between kinds of characters, how much of it is made
of letter sequences of common words, the path its document came from and the words beside it. Only
DataFrame functions and the DataFrame machine-learning API are used.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.functions.text import bind
from corpusframe.llm.registry import register, table
from corpusframe.sources.scratch import written

SHORTEST = 12
DICTIONARY = 5_000  # most frequent words, whose letter sequences count as known
GRAM = 3
CONTEXT = 64  # buckets of hashed path and neighbouring words
TRAIN_FINDINGS = 1_500  # labelled findings of each kind, the first by hash
TREES, DEPTH = 40, 8
_SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: A named value: a name, then = or :, then the value.
_NAMED = r"^([A-Za-z_.\-]{2,40})[=:](.+)$"
_BODY = rf"^[A-Za-z0-9+/=_.@:\-]{{{SHORTEST},}}$"
#: A run of the key alphabet inside a word, with the name that stands before it there, quoted or not.
_PIECE = r"(?:([A-Za-z_][A-Za-z0-9_.\-]{0,39})[\x22'`\])]{0,4}[=:][\x22'`(\[]{0,4})?([A-Za-z0-9+/_.@\-][A-Za-z0-9+/=_.@:\-]*)"
_SECRET = r"(?:passw(?:or)?d|passphrase|pwd|secret|token|api[_\-]?key|access[_\-]?key|private[_\-]?key|credential)"
#: The two words before a value, when a secret-like name and = or : end them.
_ANNOUNCED = rf"(?i){_SECRET}[A-Za-z0-9_.\-]*[\x22'`\])]* ?[=:]+>?[\x22'`(\[]*$"
NUMBERS = ["length", "distinct_share", "change_share", "upper_share", "lower_share", "digit_share", "other_share", "known_share"]


def _stripped(word: Column) -> Column:
    """The word without quotes, brackets and stops around it."""
    return F.btrim(word, F.lit("\"'`()[]{}<>,;.!?"))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, path, place, name, value, before, before2, after): words that may be secrets.

    A candidate is a word, or what follows ``name=`` or ``name:`` in it, of at least SHORTEST characters
    from the alphabet of keys, with a digit or all in upper case. ``place`` counts words from 0.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(path).cast("string").alias("path"), F.split(F.btrim(F.col(text), F.lit(" \t\n\r\x0b\x0c")), _SPACE).alias("words"))
    words = slim.select("doc_id", "path", "words", F.posexplode("words").alias("place", "word")).filter(F.length("word") >= SHORTEST)
    bare = words.withColumn("bare", _stripped(F.col("word"))).filter(F.length("bare") >= SHORTEST)
    named = bare.withColumn("name", F.regexp_extract("bare", _NAMED, 1)).withColumn("inner", _stripped(F.regexp_extract("bare", _NAMED, 2)))
    named = named.withColumn("value", F.when((F.col("name") != "") & ~F.startswith("inner", F.lit("//")), F.col("inner")).otherwise(F.col("bare")))
    found = named.filter((F.length("value") >= SHORTEST) & F.col("value").rlike(_BODY) & (F.col("value").rlike("[0-9]") | F.col("value").rlike("^[A-Z]+$")))
    beside = lambda k: F.translate(_stripped(F.coalesce(F.try_element_at("words", F.col("place") + 1 + k), F.lit(""))), _UPPER, _LOWER)
    # element_at counts from 1 and from the end for negative places
    before = F.when(F.col("place") >= 1, beside(-1)).otherwise("")
    before2 = F.when(F.col("place") >= 2, F.try_element_at("words", F.greatest(F.col("place") - 1, F.lit(1)))).otherwise("")
    return found.select("doc_id", "path", "place", F.when(F.col("value") == F.col("bare"), "").otherwise(F.col("name")).alias("name"), "value", before.alias("before"), F.translate(_stripped(before2), _UPPER, _LOWER).alias("before2"), beside(1).alias("after"))


def proposed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """The rows of ``candidates`` and, from words that are none as a whole, every maximal run of the key alphabet.

    A run counts like a word: SHORTEST characters or more, with a digit or all in upper case. After a name
    like those of secrets, in the word or at the end of the words before it, any run with a letter or digit
    counts, however short. The column names are those of ``candidates``; a word may give several rows.
    """
    words = F.split(F.btrim(F.col(text), F.lit(" \t\n\r\x0b\x0c")), _SPACE)
    beside = lambda own, i: F.coalesce(F.get(own, i), F.lit(""))
    each = bind(words, lambda own: F.transform(own, lambda w, i: F.struct(i.alias("place"), w.alias("word"), beside(own, i - 1).alias("before"), beside(own, i - 2).alias("before2"), beside(own, i + 1).alias("after"))))
    likely = lambda x: (F.length(x["word"]) >= SHORTEST) | x["word"].rlike("[=:]") | x["before"].rlike("[=:]")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(path).cast("string").alias("path"), F.explode(F.filter(each, likely)).alias("x")).select("doc_id", "path", "x.*")
    rows = rows.withColumn("bare", _stripped(F.col("word"))).withColumn("_name", F.regexp_extract("bare", _NAMED, 1)).withColumn("_inner", _stripped(F.regexp_extract("bare", _NAMED, 2)))
    rows = rows.withColumn("_value", F.when((F.col("_name") != "") & ~F.startswith("_inner", F.lit("//")), F.col("_inner")).otherwise(F.col("bare")))
    keyed = lambda value: (F.length(value) >= SHORTEST) & (value.rlike("[0-9]") | value.rlike("^[A-Z]+$"))
    whole = keyed(F.col("_value")) & F.col("_value").rlike(_BODY)
    announced = F.concat_ws(" ", "before2", "before").rlike(_ANNOUNCED)

    def piece(found, i):
        name, value = F.regexp_extract(found, _PIECE, 1), F.regexp_extract(found, _PIECE, 2)
        url = F.startswith(value, F.lit("//"))
        name, value = F.when(url, "").otherwise(name), _stripped(F.when(url, found).otherwise(value))
        told = name.rlike(f"(?i){_SECRET}") | ((i == 0) & (name == "") & announced)
        return F.struct(name.alias("name"), value.alias("value"), (keyed(value) | (told & value.rlike("[A-Za-z0-9]"))).alias("kept"))

    one = F.array(F.struct(F.when(F.col("_value") == F.col("bare"), "").otherwise(F.col("_name")).alias("name"), F.col("_value").alias("value"), F.lit(True).alias("kept")))
    runs = F.filter(F.transform(F.regexp_extract_all("word", F.lit(_PIECE), F.lit(0)), piece), lambda x: x["kept"])
    found = rows.withColumn("found", F.explode(F.when(whole, one).otherwise(runs)))
    small = lambda c: F.translate(_stripped(F.col(c)), _UPPER, _LOWER).alias(c)
    return found.select("doc_id", "path", "place", "found.name", "found.value", small("before"), small("before2"), small("after"))


def _grams(letters: Column, size: Column) -> Column:
    def cut(chars):
        each = F.transform(F.sequence(F.lit(0), F.greatest(size - GRAM, F.lit(0))), lambda i: F.concat(*[F.get(chars, i + k) for k in range(GRAM)]))
        return F.when(size >= GRAM, each).otherwise(F.array().cast("array<string>"))

    return bind(F.split(letters, ""), cut)


def common_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """Letter sequences of the DICTIONARY most frequent words of three and more letters in all documents."""
    words = docs.select(F.explode(F.split(F.col(text), r"[^A-Za-z]+")).alias("word")).filter("length(word) between 3 and 40")
    counts = words.groupBy(F.translate("word", _UPPER, _LOWER).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(DICTIONARY)
    return written(top.select(F.explode(_grams(F.col("word"), F.length("word"))).alias("gram")).distinct(), "grams")


def featured(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with the features: the numbers, and ``context`` (path and neighbours as marked words)."""
    value, size = F.col("value"), F.length("value").cast("double")
    kinds = F.regexp_replace(F.translate(value, _UPPER + _LOWER + _DIGITS, "U" * 26 + "l" * 26 + "9" * 10), "[^Ul9]", "-")
    runs = kinds
    for kind in "Ul9-":
        runs = F.regexp_replace(runs, f"{kind}+", kind)
    share = lambda kind: (size - F.length(F.translate(kinds, kind, ""))) / size
    letters = F.translate(F.regexp_replace(value, "[^A-Za-z]+", "\n"), _UPPER, _LOWER)
    rows = found.withColumn("_finding", F.xxhash64("doc_id", "path", "place", "value"))
    grams = rows.select("_finding", F.explode(_grams(letters, F.length(letters))).alias("gram")).filter(~F.contains("gram", F.lit("\n")))
    # at most DICTIONARY words of 40 letters, so the list has a bound
    listed = grams.join(F.broadcast(known.withColumn("_known", F.lit(1))), "gram", "left").groupBy("_finding").agg((F.count("_known") / F.count(F.lit(1))).alias("known_share"))
    words = F.array(
        F.concat(F.lit("p:"), F.coalesce("path", F.lit(""))), F.concat(F.lit("n:"), F.translate("name", _UPPER, _LOWER)), F.concat(F.lit("b:"), "before"), F.concat(F.lit("c:"), "before2"), F.concat(F.lit("a:"), "after")
    )
    shaped = rows.select(
        "*", size.alias("length"), (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct_share"), ((F.length(runs) - 1) / size).alias("change_share"),
        share("U").alias("upper_share"), share("l").alias("lower_share"), share("9").alias("digit_share"), share("-").alias("other_share"), words.alias("context"),
    )
    return shaped.join(listed.distinct(), "_finding", "left").withColumn("known_share", F.coalesce("known_share", F.lit(0.0)))


def _vectors() -> PipelineModel:
    hashed = HashingTF(numFeatures=CONTEXT, binary=True, inputCol="context", outputCol="_context")
    return PipelineModel([hashed, VectorAssembler(inputCols=[*NUMBERS, "_context"], outputCol="_vector")])


def train(findings: DataFrame, label: str = "label", limit: int = TRAIN_FINDINGS, seed: int = 3):
    """A forest fitted on at most ``limit`` featured findings of each label; None if only one label occurs."""
    known = findings.withColumn("_label", F.col(label).cast("double")).filter("_label in (0, 1)")
    parts = [known.filter(F.col("_label") == k).orderBy(F.xxhash64("value", "_finding"), "_finding").limit(limit) for k in (0, 1)]
    sample = written(parts[0].union(parts[1]), "findings")
    if sample.agg(F.count_distinct("_label")).first()[0] < 2:
        return None
    forest = RandomForestClassifier(featuresCol="_vector", labelCol="_label", numTrees=TREES, maxDepth=DEPTH, seed=seed)
    # at most 2 x limit rows, in one order, so that equal seeds grow equal trees
    return forest.fit(_vectors().transform(sample).select("_vector", "_label", "_finding").coalesce(1).sortWithinPartitions("_finding").select("_vector", "_label"))


def judged(findings: DataFrame, forest) -> DataFrame:
    """``findings`` with ``score`` (chance of a secret) and ``secret``; without a forest all candidates stay."""
    if forest is None:
        return findings.withColumn("score", F.lit(1.0)).withColumn("secret", F.lit(True))
    from pyspark.ml.functions import vector_to_array

    forest = forest.copy().setProbabilityCol("_chance").setPredictionCol("_said").setRawPredictionCol("_raw")
    scored = forest.transform(_vectors().transform(findings))
    score = F.round(vector_to_array("_chance")[1], 9)
    return scored.select(*findings.columns, score.alias("score"), (score >= 0.5).alias("secret"))


def labelled_by_format(findings: DataFrame) -> DataFrame:
    """Findings whose format tells them: cloud key ids and values named as secrets are 1; mail addresses,
    network addresses, plain numbers and words in capitals are 0; the others have no label."""
    value, named = F.col("value"), F.lower(F.concat_ws(" ", "name", "before", "before2"))
    secret = value.rlike("^AKIA[0-9A-Z]{16}$") | (named.rlike("(password|passwd|pwd|secret|token|api_?key)") & value.rlike("^[0-9A-Za-z+/_\\-]{16,}$") & value.rlike("[0-9]"))
    harmless = value.rlike("@") | value.rlike("^[0-9.:\\-]+$") | value.rlike("^[A-Z]+$")
    return findings.withColumn("label", F.when(secret, 1).when(harmless, 0))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", labels=labelled_by_format) -> DataFrame:
    """All candidates of all documents with their features, score and verdict.

    ``labels`` adds column ``label`` to featured findings (1 secret, 0 harmless, null unknown). Null and
    empty texts have no candidates; a null path is an empty one; equal findings of repeated rows are told
    apart by nothing and score alike. An empty table gives no rows.
    """
    found = written(featured(written(proposed(docs, doc_id, text, path), "candidates"), common_grams(docs, text)), "featured")
    return judged(found, train(labels(found)))


@register("op10_secret_forest")
def op10_secret_forest(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "place", F.sha2("value", 256).alias("value_sha256"), F.col("length").cast("long").alias("length"), "score", "secret")
