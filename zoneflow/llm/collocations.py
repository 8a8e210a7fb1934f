"""Phrase collocations by dynamic itemset counting.

The documents are dealt into shards, and the shards are scanned in a cycle. Single words are counted from the first scan on. A
longer phrase becomes active once both phrases that it is made of (without its last word, without its first word) have reached
the threshold, in the middle of a cycle; it is then counted for the next ``shards`` scans, one full cycle, whatever shard that
begins with. So lengths are interleaved: a scan counts words, pairs and triples at once, each where it is active.

Activation needs no list of candidates. A table of fixed size holds, for the hashes of phrases that have reached the threshold,
the scan in which they did; each scan's tasks get it and look up the parts of what they read. Two phrases may share a place in
it: then a phrase becomes active too early and is counted for nothing, but for one whole cycle all the same, since an entry
never changes once it is set. Counts are therefore exact, however full the table is.

Counts so far are a table of the shared folder, merged with each scan's counts by one aggregation. A phrase that has been
counted for a cycle and is still below the threshold is dropped, as it can be no part of any phrase that counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import text_slices
from zoneflow.session import materialize, new_folder
from zoneflow.sources.folders import remove

#: Bytes of text that a task counts at a time.
SLICE = 4 << 20
NEVER = 255
UNKNOWN_LANG = "und"
COUNTS = "lang string, phrase string, n int, a long, since int"
_WORD, _SPACE, _BREAK = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(32))


@dataclass(frozen=True)
class PhraseParams:
    """``min_count``: threshold of words and phrases. ``top``: phrases per language. ``inside_percent``: a phrase goes when a
    longer one around it has this share of its occurrences. ``shards`` (at most 80) make a cycle; ``table_bits``: binary
    logarithm of the activation table's size in bytes, 15 at least."""

    max_words: int = 3
    min_count: int = 10
    top: int = 2000
    inside_percent: int = 50
    shards: int = 2
    table_bits: int = 24


@dataclass
class Slice:
    """The words of some texts: ``words`` are the distinct ones and ``index`` the one at each place, ``lang`` its language;
    ``code`` numbers the distinct (language, word) pairs, and ``joined`` tells whether the next word is in the same piece."""

    langs: pa.Array
    words: pa.Array
    index: np.ndarray
    lang: np.ndarray
    code: np.ndarray
    joined: np.ndarray


def cut(texts: pa.Array, langs: pa.Array) -> Slice:
    """Words of all texts at once: bytes are classed by a table, and a text's first byte starts a new word and piece."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = _KIND[data]
    inside = kind == _WORD
    first = np.zeros(len(data) + 1, bool)  # places where a text starts, and the end
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.nonzero(starts)[0], np.nonzero(ends)[0] + 1
    piece = np.cumsum((kind == _BREAK) | first[:-1])[starts]
    lengths = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(_LOWER[data[inside]])])
    words = words.dictionary_encode()
    langs = pc.fill_null(langs.cast(pa.large_string()), UNKNOWN_LANG).dictionary_encode()
    index = words.indices.to_numpy().astype(np.int64)
    lang = np.repeat(langs.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(starts, offsets)))
    code = numbered(lang * len(words.dictionary) + index, len(langs.dictionary) * len(words.dictionary))
    joined = np.zeros(len(starts), bool)
    joined[:-1] = piece[1:] == piece[:-1]
    return Slice(langs.dictionary, words.dictionary, index, lang, code, joined)


def numbered(codes: np.ndarray, size: int) -> np.ndarray:
    """Codes below ``size`` as numbers from 0 without gaps; by a table of flags where that is not much larger than the codes."""
    if size > 8 * len(codes):
        return pd.factorize(codes)[0]
    used = np.zeros(size, bool)
    used[codes] = True
    return (np.cumsum(used) - 1)[codes]


def extend_hash(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all but its last word and that of the last word."""
    mixed = hashes * _MIX[0] + word
    mixed ^= mixed >> _MIX[2]
    mixed *= _MIX[1]
    return mixed ^ (mixed >> _MIX[2])


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, _seed(lang))


@lru_cache(maxsize=1024)
def _seed(lang: str) -> int:
    return xxhash.xxh32_intdigest(lang)


def places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in a table of ``size`` entries, a power of two."""
    mask = np.uint64(size - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> _MIX[2]) & mask).astype(np.int64)


def count_slice(some: Slice, reached: np.ndarray, scan: int, params: PhraseParams) -> Iterator[pa.RecordBatch]:
    """Counts of what is active in this scan: ``(lang, phrase, n, a, since)`` by length, and of all words as the phrase of no
    words. ``since`` is the first scan that counts the phrase, whether it comes up there or not: entries of the table do not change."""
    if not len(some.code):
        return
    kinds = int(some.code.max()) + 1
    at = np.empty(kinds, np.int64)
    at[some.code[::-1]] = np.arange(len(some.code))[::-1]  # one place of each (language, word)
    names, words = some.langs.to_pylist(), some.words.to_pylist()
    hashed = np.fromiter((word_hash(names[i], words[j]) for i, j in zip(
        some.lang[at].tolist(), some.index[at].tolist(), strict=True)), np.uint64, kinds)

    def found(place: np.ndarray, n: int, a: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        parts = [some.words.take(pa.array(some.index[place + k])) for k in range(n)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if n else pa.array([b""] * len(place), pa.large_binary())
        return pa.RecordBatch.from_arrays([
            some.langs.take(pa.array(some.lang[place])).cast(pa.string()), phrase.cast(pa.binary()).cast(pa.string()),
            pa.array(np.full(len(place), n, np.int32)), pa.array(a.astype(np.int64)), pa.array(first.astype(np.int32))],
            names=["lang", "phrase", "n", "a", "since"])

    if scan < params.shards:
        yield found(at, 1, np.bincount(some.code), np.zeros(kinds))
        lang, total = np.unique(some.lang, return_counts=True)
        yield found(np.array([np.argmax(some.lang == x) for x in lang]), 0, total, np.zeros(len(lang)))
    word = hashed[some.code]
    hashes = word
    one, two = places(hashed, len(reached))
    known = np.maximum(reached[one], reached[two])[some.code]  # scan in which the phrase at each place reached the threshold
    for n in range(2, params.max_words + 1):
        if len(known) < 2:
            return
        since = np.maximum(known[:-1], known[1:])
        fits = (since != NEVER) & some.joined[:len(since)] if n == 2 else since != NEVER
        active = np.nonzero(fits & (since >= scan - params.shards))[0]  # others have been counted for their cycle
        if len(active):
            code = some.code[active]
            for k in range(1, n):
                code, distinct = pd.factorize(code * kinds + some.code[active + k])
            shown = np.empty(len(distinct), np.int64)
            shown[code[::-1]] = active[::-1]
            yield found(shown, n, np.bincount(code, minlength=len(distinct)), since[shown].astype(np.int32) + 1)
        if n < params.max_words:
            place = np.nonzero(fits)[0]
            if not len(place):
                return
            every = np.zeros(len(known) - 1, np.uint64)
            every[place] = extend_hash(hashes[place], word[place + n - 1])
            one, two = places(every[place], len(reached))
            known, hashes = np.full(len(every), NEVER, np.uint8), every
            known[place] = np.maximum(reached[one], reached[two])


def _counts(shard: DataFrame, shared: Broadcast[bytes], scan: int, params: PhraseParams) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for some in text_slices(batches, SLICE):
            yield from count_slice(cut(some.column("text"), some.column("lang")), reached, scan, params)

    return shard.select("lang", "text").mapInArrow(run, COUNTS)


def _new_places(phrases: DataFrame, params: PhraseParams) -> np.ndarray:
    """Places in the activation table of some phrases, as a bitmap of fixed size that Spark puts together."""
    size = 1 << params.table_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [phrase.encode().split(b" ") for phrase in batch.column("phrase").to_pylist()]
            langs, lengths = batch.column("lang").to_pylist(), np.array([len(w) for w in words])
            for n in np.unique(lengths):
                some = np.nonzero(lengths == n)[0]
                each = [np.array([word_hash(langs[i], words[i][k]) for i in some], np.uint64) for k in range(n)]
                hashes = each[0]
                for word in each[1:]:
                    hashes = extend_hash(hashes, word)
                slots = np.unique(np.concatenate(places(hashes, size)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots >> 15, pa.int64()), pa.array(slots & 32767, pa.int64())], names=["block", "bit"])

    blocks = phrases.select("lang", "phrase").mapInArrow(run, "block long, bit long").groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bits")).collect()
    marked = np.zeros(size, bool)
    for row in blocks:
        bits = np.unpackbits(np.frombuffer(bytes(row.bits), np.uint8), bitorder="little")
        marked[row.block << 15:(row.block << 15) + 32768] = bits.astype(bool)[:size - (row.block << 15)]
    return marked


def _write(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def phrase_counts(docs: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """``(lang, phrase, n, a)``: phrases of up to ``max_words`` words with at least ``min_count`` occurrences, and with ``n``
    0 the number of all words, by language. Phrases that have not reached the threshold are left out.

    A null ``lang`` counts as ``und``; null and empty texts have no words; equal rows count as often as they stand. Only
    ``lang``, ``text`` and ``doc_id`` are read. An empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    shards = new_folder(spark, "phrases-shards")
    docs.where(F.length("text") > 0).select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), "text",
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(params.shards)).cast("int").alias("shard"),
    ).write.partitionBy("shard").parquet(shards)
    documents = spark.read.schema("lang string, text string, shard int").parquet(shards)

    reached = np.full(1 << params.table_bits, NEVER, np.uint8)
    counted = spark.createDataFrame([], f"{COUNTS}, reached int, done boolean")
    paths, last_change, scan = [], -1, 0
    # What reached the threshold in one scan activates longer phrases for a cycle; then nothing is left to count.
    while scan < params.shards or scan - last_change <= params.shards:
        shared = spark.sparkContext.broadcast(zlib.compress(reached.tobytes(), 1))  # at most the table's size
        found = _counts(documents.where(F.col("shard") == scan % params.shards), shared, scan, params)
        found = found.select("*", F.lit(None).cast("int").alias("reached"))
        merged = counted.where("NOT done").drop("done").unionByName(found).groupBy("lang", "phrase", "n").agg(
            F.sum("a").alias("a"), F.min("since").alias("since"), F.min("reached").alias("reached"))
        # What has been counted for a cycle is not merged again: it is final, and gone if it is below the threshold.
        done = scan >= F.when(F.col("n") <= 1, params.shards - 1).otherwise(F.col("since") + params.shards - 1)
        merged = merged.withColumn(
            "reached", F.when((F.col("n") > 0) & (F.col("a") >= params.min_count), F.coalesce("reached", F.lit(scan)))
        ).withColumn("done", done).where((F.col("n") == 0) | F.col("reached").isNotNull() | ~F.col("done"))
        counted, path = _write(merged.select(*counted.columns), f"phrases-scan{scan}")
        paths.append(path)
        shared.destroy()  # this scan's counts are written and never made again
        marked = _new_places(counted.where((F.col("reached") == scan) & (F.col("n") < params.max_words)), params)
        marked &= reached == NEVER
        if marked.any():
            reached[marked] = scan
            last_change = scan
        scan += 1
    remove(spark, shards)
    # A phrase that came up late in its cycle is not yet marked in the last table, though its cycle is over too.
    final = spark.read.schema(counted.schema).parquet(*paths).where("done").unionByName(
        counted.where("NOT done AND reached IS NOT NULL"))
    # Readers use it several times, and it is small beside the counts that it is picked from.
    return materialize(final.select("lang", "phrase", "n", "a"), "phrases")


def collocations(docs: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language by score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words of the language; the score is
    ``floor(10^6 a a / (l r))``, worked out with 38 digits. Equal scores are ordered by ``a`` and then by the phrase's bytes. A
    phrase is left out when a longer one, itself left out or not, holds ``inside_percent`` of its occurrences.
    Rows, nulls and empty tables as in ``phrase_counts``.
    """
    counts = phrase_counts(docs, params)
    totals = counts.where("n = 0").select("lang", F.col("a").alias("n"))
    frequent = counts.where("n > 0")
    candidates = frequent.where("n > 1").select("lang", "phrase", F.col("n").alias("size"), "a", F.split("phrase", " ").alias("words"))

    def joined(words: Column, start: Column | int, size: Column) -> Column:
        return F.array_join(F.slice(words, start, size), " ")

    cuts = candidates.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", joined(F.col("words"), 1, F.col("k")).alias("left"),
                       joined(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    part = frequent.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    cuts = cuts.join(part, ["lang", "left"]).join(part.select("lang", F.col("left").alias("right"), F.col("l").alias("r")), ["lang", "right"])
    wide = {name: F.col(name).cast("decimal(20,0)") for name in "alr"}
    scored = cuts.withColumns({"aa": wide["a"] * wide["a"] * F.lit(10**6).cast("decimal(7,0)"), "lr": wide["l"] * wide["r"]})
    weakest = scored.withColumn("score", F.expr("aa div lr")).groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # A candidate inside a longer one: that lies inside every phrase between them too, but counts no more often than it.
    inner = F.explode(F.filter(F.flatten(F.transform(
        F.sequence(F.lit(2), F.greatest(F.lit(2), F.col("size") - 1)),
        lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda at: joined(F.col("words"), at, k)))),
        lambda inside: inside != F.col("phrase"))).alias("phrase")
    around = candidates.where("size > 2").select("lang", F.col("a").alias("around"), inner).groupBy("lang", "phrase").agg(
        F.max("around").alias("around"))
    kept = weakest.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < params.inside_percent * F.col("a")))
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # Two steps: the best of every part of a language, then the best of those, a bounded number.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = flat.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= params.top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= params.top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
