"""Secret scan: high-recall candidates by pattern, false positives removed by a random forest.

Candidates, their features and their scores are SQL functions and Spark's own forest on DataFrames; no row visits Python. The
forest learns from labelled findings: secrets and look-alikes of known label, planted between words of real documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import hashed_sample, row_key
from zoneflow.session import materialize

#: Words that announce a secret, and words that announce something else.
ANNOUNCES = "token|secret|passw|passphrase|pwd|api.?key|access.?key|private.?key|auth|bearer|credential|client.?id"
DENIES = "commit|sha1|sha256|md5|checksum|digest|hash|uuid|guid|build|version|isbn|order|invoice|phone|tel|fax|card|date|page|line|build|issue|pull"
_INSIDE = r"\s\"'`,;<>(){}\[\]\\"
_CORE = rf"[^{_INSIDE}&.:?]"
#: What an announcing word with ``=``, ``:`` or a quote stands before: six characters of any kind, up to a space, quote or bracket.
_ANNOUNCED = (
    rf"(?<=[=:\"'`\s])(?=[^{_INSIDE}]{{6}})(?<=[=:\"'`]\s{{0,4}}[\"'`]?|(?i:bearer)\s)(?!(?i:bearer|basic)\s)"
    rf"(?<=(?i:{ANNOUNCES})[A-Za-z_]{{0,12}}(?:[\"'`]?\s{{0,4}}[=:]\s{{0,4}}[\"'`]?|\s{{0,4}}[\"'`])|(?i:bearer)\s)"
    rf"(?:{_CORE}++|[.:?](?={_CORE})|&(?!\w+=)(?={_CORE}))++")
_RUN = r"(?<![A-Za-z0-9+/_\-])"
#: An announced value, a whole run of key characters with a digit in it, or a long run that goes from small to capital letters twice.
CANDIDATE = (
    rf"{_ANNOUNCED}|{_RUN}(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{{8,}}"
    rf"|{_RUN}(?=(?:[A-Z+/_\-]*+[a-z+/_\-]++[A-Z]){{2}})[A-Za-z+/_\-]{{20,}}")
#: Characters of context on either side.
CONTEXT = 48

#: Words that people write and key generators do not.
DICTIONARY = (
    "example", "sample", "test", "dummy", "placeholder", "changeme", "change", "your", "here", "none", "null", "password",
    "secret", "token", "key", "user", "admin", "name", "mail", "file", "image", "photo", "index", "page", "chapter", "section",
    "version", "release", "beta", "alpha", "final", "draft", "copy", "data", "table", "figure", "report", "default", "demo",
    "foo", "bar", "abc", "xxx", "123", "january", "february", "march", "april", "june", "july", "august", "september",
    "october", "november", "december", "monday", "tuesday", "the", "and", "for", "with", "this", "that", "ing", "tion",
)

FEATURES = (
    "length", "digits", "uppers", "lowers", "marks", "transitions", "changes", "pairs", "distinct", "hex_only", "digits_only", "coverage",
    "in_path", "has_slash", "word_like", "mail_after", "quoted", "assigned", "announced_next", "announced_near", "denied_next",
    "denied_near", "uuid_like", "prefix_known",
)


@dataclass(frozen=True)
class ForestParams:
    """``findings`` bounds the labelled findings; the forest's size does not depend on the data."""

    findings: int = 3000
    trees: int = 30
    depth: int = 8
    threshold: float = 0.5


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (any columns, with ``text``) exploded to ``(..., nth, value, before, after)``, without ``text``."""
    pattern = F.lit(CANDIDATE)
    found = docs.withColumn("__found", F.regexp_extract_all("text", pattern, F.lit(0))).filter(F.size("__found") > 0)
    found = found.withColumn("__between", F.split("text", CANDIDATE, -1))
    found = found.select(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], "__between", F.posexplode("__found").alias("nth", "value"))
    before, after = F.get("__between", F.col("nth")), F.get("__between", F.col("nth") + 1)
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != "text"], "nth", "value",
        F.right(before, F.lit(CONTEXT)).alias("before"), F.left(after, F.lit(CONTEXT)).alias("after"))


def features(found: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES``, all doubles."""
    value, before, after = F.col("value"), F.lower("before"), F.lower("after")
    size = F.length(value)
    count = lambda pattern: F.regexp_count(value, F.lit(pattern))
    flag = lambda test: test.cast("int")
    covered = size - F.length(F.regexp_replace(F.lower(value), "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))
    made = {
        "length": size,
        "digits": count("[0-9]") / size, "uppers": count("[A-Z]") / size, "lowers": count("[a-z]") / size,
        "marks": count(r"[+/_\-]") / size,
        # Character transitions: between digits and letters, between cases, and between equal or neighbouring classes.
        "transitions": (count("[0-9](?=[A-Za-z])") + count("[A-Za-z](?=[0-9])")) / size,
        "changes": (count("[a-z](?=[A-Z])") + count("[A-Z](?=[a-z])")) / size,
        "pairs": count("[aeiouAEIOU](?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])") / size,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
        "hex_only": flag(value.rlike("^[0-9a-fA-F]+$")), "digits_only": flag(value.rlike(r"^[0-9\-]+$")),
        "coverage": covered / size,
        "in_path": flag(before.rlike(r"(://\S*|\S/|www\.\S*|[?&]\w+=)$")), "has_slash": flag(value.contains("/")),
        "word_like": flag(value.rlike("^[A-Za-z]+[-_]?[0-9]{1,4}$")),
        "mail_after": flag(after.rlike(r"^@|^\.[a-z]{2,4}\b")),
        "quoted": flag(before.rlike("[\"'`]$")), "assigned": flag(before.rlike("[=:]\\s*[\"'`]?$")),
        "announced_next": flag(before.rlike(f"({ANNOUNCES})[a-z_]*\\W{{0,4}}$")), "announced_near": flag(before.rlike(ANNOUNCES)),
        "denied_next": flag(before.rlike(f"({DENIES})[a-z_]*\\W{{0,4}}$")), "denied_near": flag(before.rlike(f"\\b({DENIES})\\b")),
        "uuid_like": flag(value.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")),
        "prefix_known": flag(value.rlike("^(AKIA|ASIA|ghp_|gho_|glpat-|xox[abp]-|sk_live_|AIza)")),
    }
    return found.withColumns({name: F.coalesce(made[name].cast("double"), F.lit(0.0)) for name in FEATURES})


def labelled_findings(docs: DataFrame, bound: int) -> DataFrame:
    """``(value, before, after, label, FEATURES)``: findings of known label, at most ``bound``.

    Rows with the smallest hashes lend their words; a secret or a look-alike made from the row's hash is set between them.
    """
    rows = docs.select("text", row_key(F.col("doc_id"), F.col("text")).alias("key")).filter(F.col("text").isNotNull())
    # Up to ``bound`` rows, at least one finding of each kind: few rows lend themselves several times.
    lent = rows.select("key", F.substring("text", 1, 400).alias("words"))
    some = materialize(hashed_sample(lent, F.col("key"), bound), "secret-rows")
    some = some.withColumn("again", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.least(
        F.lit(39), (F.lit(bound) / F.lit(max(1, some.count()))).cast("int") - 1)))))
    seed = F.concat_ws("-", "key", "again")
    made = some.select(
        "key", "again", F.regexp_replace("words", "[0-9]", "").alias("words"),
        F.regexp_extract("words", r"([A-Za-z]{4,})", 1).alias("word"), F.sha1(seed).alias("sha1"), F.sha2(seed, 256).alias("sha2"),
        F.md5(seed).alias("md5"), F.translate(F.base64(F.unhex(F.sha2(seed, 256))), "=", "").alias("base64"),
        F.translate(F.upper(F.sha2(seed, 256)), "0189", "WXYZ").alias("upper"),
        F.translate(F.sha2(seed, 256), "abcdef", "012345").alias("number"))
    made = materialize(made, "secret-makings")
    draw = F.pmod(F.xxhash64(F.lit("kind"), "key", "again"), F.lit(1000))
    word, sha1, sha2, md5, base64, upper, number = map(F.col, ("word", "sha1", "sha2", "md5", "base64", "upper", "number"))
    part = lambda column, start, size: F.substring(column, start, size)
    uuid = F.concat_ws("-", part(md5, 1, 8), part(md5, 9, 4), part(md5, 13, 4), part(md5, 17, 4), part(md5, 21, 12))
    length = lambda low, high: (F.lit(low) + F.pmod(F.xxhash64(F.lit("size"), "key", "again"), F.lit(high - low + 1))).cast("int")
    cut = lambda column, low, high: F.substr(column, F.lit(1), length(low, high))
    letters = F.translate(base64, "0123456789+/", "qWeRtYuIoPaS")
    named = F.initcap(F.translate(part(md5, 1, 7), "0123456789", "ghijklmnop"))
    #: kind: what stands before the value, the value, what stands after it, label
    kinds = [
        ('token = "', sha1, '"', 1), ("password=", cut(sha2, 10, 32), "", 1), ("", F.concat(F.lit("AKIA"), part(upper, 3, 16)), "", 1),
        ("api_key: ", base64, "", 1), ("Authorization: Bearer ", base64, "", 1), ("secret = '", cut(base64, 16, 40), "'", 1),
        ("aws_access_key=", F.concat(F.lit("AKIA"), part(upper, 5, 16)), "", 1), ("", F.concat(F.lit("ghp_"), part(base64, 1, 36)), "", 1),
        ("pwd: ", cut(base64, 10, 20), "", 1), ('"access_token": "', cut(sha2, 24, 64), '"', 1), ("client_secret=", cut(md5, 20, 32), "", 1),
        ("password=", cut(letters, 10, 32), "", 1), ("api_key: ", cut(letters, 16, 40), "", 1), ('"auth_token": "', cut(letters, 16, 40), '"', 1),
        ("password=", F.concat(F.lower(word), named, F.initcap(F.reverse(word))), "", 1), ("", letters, "", 1),
        ("pwd: ", F.concat(part(base64, 1, 4), F.lit("&"), part(base64, 6, 4)), "", 1), ("pwd: ", cut(base64, 6, 9), "", 1),
        ("commit ", sha1, "", 0), ("sha256:", sha2, "", 0), ("md5 checksum ", md5, "", 0), ("id ", uuid, "", 0), ("", uuid, "", 0),
        ("https://host.example.com/posts/", part(number, 1, 8), "", 0), ("/static/img-", cut(sha2, 8, 20), ".png", 0),
        ("", F.concat(F.lower(word), part(number, 1, 5)), "@mail.example.com", 0), ("+", part(number, 1, 11), "", 0),
        ("", part(number, 1, 16), "", 0), ("card ", part(number, 3, 16), "", 0), ("", F.concat_ws("-", part(number, 1, 4), part(number, 5, 4), part(number, 9, 4), part(number, 13, 4)), "", 0),
        ("", F.concat(F.lit("20"), part(number, 1, 2), F.lit("-0"), part(number, 3, 1), F.lit("-1"), part(number, 4, 1)), "", 0),
        ('token = "', F.concat(F.lit("your_token_here_"), part(number, 1, 2)), '"', 0), ("password=", F.concat(F.lit("changeme"), part(number, 1, 3)), "", 0),
        ("api_key: ", F.concat(F.lit("EXAMPLE_KEY_"), part(number, 1, 2)), "", 0), ("secret = '", F.concat(F.lit("dummy-secret-"), part(number, 1, 3)), "'", 0),
        ("version ", F.concat(F.lit("release-"), part(number, 1, 1), F.lit("-"), part(number, 2, 3)), "", 0),
        ("", F.concat(word, F.lit("-"), F.lower(word), part(number, 1, 3)), "", 0), ("", F.concat(F.lit("chapter"), part(number, 1, 2), F.lit("section"), part(number, 3, 1)), "", 0),
        ("Author: ", F.concat(F.initcap(word), F.lit("son")), "", 0), ("password: ", F.concat(F.lower(word), F.lit("ing")), "", 0),
        ("token: ", F.concat(F.lower(word), F.lit("s")), " of", 0), ('secret "', F.concat(F.lower(word), F.lit("ed")), '"', 0),
        ("", F.concat(F.initcap(word), named, F.initcap(F.reverse(word)), F.lit("Controller")), "", 0),
        ("user ", F.concat(F.lower(word), F.lit("_"), part(number, 1, 4)), "", 0), ("", sha1, "", 0), ("page ", F.concat(F.lit("figure_"), part(number, 1, 3)), "", 0),
    ]
    planted = F.array(*[
        F.struct(F.lit(a).alias("a"), v.alias("v"), F.lit(b).alias("b"), F.lit(y).alias("y")) for a, v, b, y in kinds])
    # Half of all findings are secrets.
    positive = sum(k[3] for k in kinds)
    nth = F.when(draw < 500, draw % positive).otherwise(positive + draw % (len(kinds) - positive)).cast("int")
    set_in = made.withColumn("plant", F.get(planted, nth)).withColumn(
        "text", F.concat(F.substring("words", 1, 150), F.lit(" "), F.col("plant.a"), F.col("plant.v"), F.col("plant.b"),
                         F.lit(" "), F.substring("words", 150, 200)))
    set_in = materialize(set_in.select("key", "again", F.col("plant.y").alias("label"), F.col("plant.v").alias("wanted"), "text"), "secret-planted")
    found = candidates(set_in)
    exact = found.filter(F.col("value") == F.col("wanted")).dropDuplicates(["key", "again"])
    return features(exact.select("key", "again", "value", "before", "after", F.col("label").cast("double").alias("label")))


def train(findings: DataFrame, params: ForestParams = ForestParams()) -> PipelineModel | None:
    """A forest from findings with ``label`` and ``FEATURES``; None without findings of both labels."""
    fixed = materialize(findings.select("label", *FEATURES).coalesce(1).sortWithinPartitions(*FEATURES), "secret-findings")
    if fixed.select("label").distinct().count() < 2:
        return None
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="__features")
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="label", numTrees=params.trees, maxDepth=params.depth, seed=17,
        featureSubsetStrategy="sqrt", rawPredictionCol="__raw", probabilityCol="__probability", predictionCol="__prediction")
    model: RandomForestClassificationModel = forest.fit(assembler.transform(fixed))
    return PipelineModel([assembler, model])


def scan_secrets(docs: DataFrame, model: PipelineModel | None, params: ForestParams = ForestParams()) -> DataFrame:
    """``(doc_id, nth, value, score, is_secret)``, a row per candidate of every text, ``nth`` from 0 in text order.

    ``score`` is the forest's share of votes for a secret; without a model it is null and every candidate is kept. A text
    that is null, empty or has no candidate gives no rows; rows with equal ids give the rows of each. Other columns are
    ignored, an empty table gives an empty result.
    """
    found = candidates(docs.select("doc_id", "text"))
    if model is None:
        scored = found.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = model.transform(features(found)).withColumn("score", vector_to_array("__probability")[1])
    kept: Column = F.coalesce(F.col("score") >= params.threshold, F.lit(True))
    return scored.select("doc_id", "nth", "value", F.round("score", 9).alias("score"), kept.alias("is_secret"))


def fit(docs: DataFrame, params: ForestParams = ForestParams()) -> PipelineModel | None:
    return train(labelled_findings(docs, params.findings), params)
