"""URL filter: path rules first, then a weighted vocabulary that one Aho-Corasick automaton counts in one pass."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import LOWER, UPPER

#: (host, path, verdict); a rule fits its host and all subdomains if the url's path starts with the rule's.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: One strict term blocks a url.
STRICT = (
    "casino", "porn", "xxx", "viagra", "spam", "malware", "phishing", "warez", "escort", "gambling", "hentai", "botnet",
)
#: Soft terms have a weight; distinct ones add up. Two light ones are common in harmless urls, a heavy one with any other is not.
SOFT = {
    "ads": 2, "ad": 1, "track": 1, "tracker": 1, "banner": 1, "popup": 1, "affiliate": 2, "click": 1, "promo": 1, "bet": 1,
    "poker": 2, "slots": 2, "jackpot": 2, "win": 1, "bonus": 1, "sex": 2, "adult": 1, "dating": 1, "loan": 1, "pills": 2,
    "crack": 1, "keygen": 2, "torrent": 1, "farm": 1, "cheap": 1, "replica": 2,
}
#: Weight from which distinct soft terms block a url; at least two of them must be present.
SOFT_LIMIT = 3
MIN_SOFT_TERMS = 2


@dataclass(frozen=True)
class UrlVocabulary:
    strict: tuple[str, ...] = STRICT
    soft: tuple[tuple[str, int], ...] = tuple(SOFT.items())
    soft_limit: int = SOFT_LIMIT
    min_soft_terms: int = MIN_SOFT_TERMS


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``; null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def vocabulary_hits(vocabulary: UrlVocabulary):
    """Arrow UDF: a lower-cased url to ``(strict, soft_terms, soft_weight)``, distinct terms between boundaries.

    A boundary is an end of the url or a character other than a-z and 0-9.
    """
    terms = {**{t: (0, 0) for t in vocabulary.strict}, **{t: (1, w) for t, w in vocabulary.soft}}

    @F.pandas_udf("strict int, soft_terms int, soft_weight int")
    def hits(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for term in terms:
            automaton.add_word(term, term)
        automaton.make_automaton()
        for some in urls:
            rows = []
            for url in some:
                found = {
                    term for end, term in automaton.iter(url)
                    if _boundary(url, end + 1) and _boundary(url, end - len(term))
                }
                soft = [terms[t][1] for t in found if terms[t][0]]
                rows.append((len(found) - len(soft), len(soft), sum(soft)))
            yield pd.DataFrame(rows, columns=["strict", "soft_terms", "soft_weight"], dtype="int32")

    return hits


def _boundary(url: str, at: int) -> bool:
    return at < 0 or at >= len(url) or not ("a" <= url[at] <= "z" or "0" <= url[at] <= "9")


def judge_urls(
    pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, vocabulary: UrlVocabulary = UrlVocabulary()
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, strict_hits, soft_hits, soft_weight)``, one row per input row.

    ``verdict`` is that of the longest fitting rule, else ``block`` for a url with a strict term or with several soft terms
    that weigh enough, else ``allow``. A url that is null or has no ``://`` has an empty host and path and fits no rule; a
    null url has no terms, so it is allowed. Other columns are ignored, repeated rows stay repeated.
    """
    lowered = F.translate(F.coalesce("url", F.lit("")), UPPER, LOWER)
    judged = pages.select("page_id", "url").select(
        "page_id", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"), vocabulary_hits(vocabulary)(lowered).alias("hits"))
    blocked = (F.col("hits.strict") > 0) | (
        (F.col("hits.soft_terms") >= vocabulary.min_soft_terms) & (F.col("hits.soft_weight") >= vocabulary.soft_limit))
    return judged.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.col("hits.strict").alias("strict_hits"), F.col("hits.soft_terms").alias("soft_hits"),
        F.col("hits.soft_weight").alias("soft_weight"),
    )
