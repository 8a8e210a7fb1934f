from __future__ import annotations

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from zoneflow.llm.oracle import ORACLE
from zoneflow.llm.url_filter import SOFT, UrlVocabulary, judge_urls

URLS = [
    None, "", "no scheme/net/", "http://", "http://EXAMPLE.net/en/1", "http://a.example.net/en/1?x=/de/", "http://a.example.net/fr/",
    "https://b.example.com/de/x", "https://b.example.com/det", "https://x.org/fr/", "https://org/fr/1", "https://forg/fr/", "http://net",
    "http://net/", "http://x.net?a://b.org/fr/", "ftp://H.COM/casino", "http://casinos.com/", "http://a-casino-b.com/", "http://m.com/?q=CASINO",
    "http://ads-track.com/", "http://ads.com/ads/ads", "http://x.com/bet/win", "http://badset.com/adset", "http://a.com#porn",
    "http://É.com/xxxé", "x://y://z/net/", "http://u@h.org:80/fr/a#b?c", "http://keygen.com/", "http://poker.com/slots", "http://" + "a/" * 5000 + "spam",
]


def test_equals_sql(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, "http://"), (None, "http://x.net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit(1)).withColumn("host", F.lit("h"))
    got = judge_urls(pages)
    columns = sorted(got.columns)
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": pa.array([r[0] for r in rows], pa.int64()), "url": pa.array([r[1] for r in rows])}))
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE['op3_url_filter']})").fetchall()
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want))


def test_verdicts(spark):
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")).collect()}
    by_url = {u: got[i] for i, u in enumerate(URLS)}
    assert (by_url["http://EXAMPLE.net/en/1"].host, by_url["http://EXAMPLE.net/en/1"].rule) == ("example.net", "example.net/en/")
    assert by_url["http://a.example.net/fr/"].rule == "net/"
    assert (by_url["http://net"].rule, by_url["http://net"].path) == (None, "")
    assert by_url["https://forg/fr/"].rule is None
    assert by_url["http://casinos.com/"].verdict == "allow"
    assert by_url["http://a-casino-b.com/"].verdict == "block"
    assert by_url["http://ads.com/ads/ads"].verdict == "allow"
    assert by_url["http://ads-track.com/"].verdict == "block"
    assert by_url["https://x.org/fr/"].verdict == "allow"
    assert (by_url[None].host, by_url[None].path, by_url[None].verdict) == ("", "", "allow")
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_every_weight_decides(spark):
    """Beside one light term a heavy one blocks and a light one does not; three light ones do, and repeats count once."""
    light = [t for t, w in SOFT.items() if w == 1]
    other = lambda t: light[0] if t != light[0] else light[1]
    pairs = [(f"http://x.com/{t}/{other(t)}/{t}", w) for t, w in SOFT.items()]
    got = judge_urls(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(pairs)], "page_id long, url string")).collect()
    assert {r.page_id: r.verdict for r in got} == {i: "block" if w > 1 else "allow" for i, (_, w) in enumerate(pairs)}
    assert {r.soft_hits for r in got} == {2}
    changed = UrlVocabulary(soft=tuple((t, 3 - w) for t, w in SOFT.items()))
    pages = spark.createDataFrame([(0, f"http://x.com/{'-'.join(light[:2])}"), (1, f"http://x.com/{'-'.join(light[:3])}")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(pages).orderBy("page_id").collect()] == ["allow", "block"]
    assert [r.verdict for r in judge_urls(pages, vocabulary=changed).orderBy("page_id").collect()] == ["block", "block"]
