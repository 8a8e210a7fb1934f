from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from zoneflow.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [[w for w in re.split(r"[\x20\x09]+", piece) if w] for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute_force(rows, params):
    counts, totals = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for n in range(1, params.max_words + 1):
                counts.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    frequent = {k: a for k, a in counts.items() if a >= params.min_count}
    found = []
    for (lang, words), a in frequent.items():
        if len(words) == 1 or any(
                100 * b >= params.inside_percent * a for (other, longer), b in frequent.items()
                if other == lang and len(longer) > len(words) and any(
                    longer[i:i + len(words)] == words for i in range(len(longer)))):
            continue
        score, _, left, right = min(
            (10**6 * a * a // (frequent[lang, words[:k]] * frequent[lang, words[k:]]), k, frequent[lang, words[:k]], frequent[lang, words[k:]])
            for k in range(1, len(words)))
        found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    ranked, places = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        places[lang] += 1
        if places[lang] <= params.top:
            ranked.append((lang, places[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(ranked)


def made_documents():
    rng = random.Random(5)
    words = ["New", "York", "city", "ß", "the", "of", "éa", "a b", "日本", "x"]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "!", "\x0b"]) for _ in range(rng.randrange(25)))
        rows.append((rng.choice([i, None, 7]), rng.choice(["en", "de", None, "und"]), text))
    rows += [(1, "en", None), (2, None, ""), (3, "en", " \t.\n"), (4, "fr", "only once here"), (5, "en", "NEW YORK " * 3000), (None, None, "same same")]
    return rows + rows[:60]


@pytest.mark.parametrize("params", [
    C.PhraseParams(min_count=5, shards=3, table_bits=15),
    C.PhraseParams(max_words=5, min_count=4, top=6, inside_percent=80, shards=1, table_bits=15),
])
def test_equals_brute_force(spark, params):
    rows = made_documents()
    docs = spark.createDataFrame([(*row, "z", 1) for row in rows], "doc_id long, lang string, text string, phrase string, a int")
    got = sorted(map(tuple, C.collocations(docs.repartition(5), params).collect()))
    assert got == brute_force(rows, params)
    assert len({row[0] for row in got}) > 1


def test_a_full_table_activates_early_and_counts_right(spark, monkeypatch):
    """With all hashes in one place every phrase is active as soon as one is; counts are the same."""
    rows = made_documents()
    params = C.PhraseParams(min_count=5, shards=2, table_bits=15)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    want = sorted(map(tuple, C.phrase_counts(docs, params).collect()))
    seen = []
    reached, counts = np.full(1 << 15, C.NEVER, np.uint8), Counter()
    shards = [[r for r in rows if hash(r) % 2 == s] for s in (0, 1)]
    for scan in range(6):
        table = pa.table({"text": [r[2] for r in shards[scan % 2]], "lang": [r[1] for r in shards[scan % 2]]}).combine_chunks().to_batches()[0]
        for batch in C.count_slice(C.cut(table.column("text"), table.column("lang")), reached, scan, params):
            for lang, phrase, n, a in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                counts[lang, phrase, n] += a
                seen.append((lang, phrase, n, scan))
        if scan == 0:
            reached[:] = 0
    assert len(seen) == len(set(seen))
    assert sorted((*k, a) for k, a in counts.items() if a >= params.min_count or k[2] == 0) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert C.collocations(docs, C.PhraseParams(shards=2, table_bits=15)).collect() == []


def test_cut_at_borders():
    texts = pa.array(["a", "", "b c", None, "d.e F", "  ", "g"])
    some = C.cut(texts.slice(1), pa.array(["x", "x", None, "y", "x", "x"]))
    words = [some.words[i].as_py().decode() for i in some.index]
    assert words == ["b", "c", "d", "e", "f", "g"]
    assert some.joined.tolist() == [True, False, False, True, False, False]
    assert [some.langs[i].as_py() for i in some.lang] == ["x", "x", "y", "y", "y", "x"]


def test_phrases_counted_for_a_cycle_are_not_coded_again(monkeypatch):
    """Words that reached the threshold in scan 0 of two shards: their pairs are counted in scans 1 and 2, and gone through in 3."""
    params, coded = C.PhraseParams(shards=2, table_bits=15), []
    some = C.cut(pa.array(["a b c a b", "b c"]), pa.array(["x", "y"]))
    assert some.lang.tolist() == [0] * 5 + [1] * 2 and sorted(set(some.code.tolist())) == list(range(5))
    reached = np.full(1 << 15, C.NEVER, np.uint8)
    for lang, word in (("x", b"a"), ("x", b"b"), ("x", b"c"), ("y", b"b"), ("y", b"c")):
        reached[np.concatenate(C.places(np.array([C.word_hash(lang, word)], np.uint64), 1 << 15))] = 0
    factorize = C.pd.factorize
    monkeypatch.setattr(C.pd, "factorize", lambda codes: coded.append(len(codes)) or factorize(codes))
    rows = [[(*r.values(),) for b in C.count_slice(some, reached, scan, params) for r in b.to_pylist()] for scan in (2, 3)]
    assert sorted(rows[0]) == [("x", "a b", 2, 2, 1), ("x", "b c", 2, 1, 1), ("x", "c a", 2, 1, 1), ("y", "b c", 2, 1, 1)]  # since scan 1, seen in 2
    assert rows[1] == [] and coded == [5]


def test_many_languages_and_few_words():
    some = C.cut(pa.array(["a"] * 50), pa.array([f"l{i}" for i in range(50)]))
    assert sorted(some.code.tolist()) == list(range(50))
    codes = np.array([10**6, 5, 10**6])
    assert C.numbered(codes, 10**7).tolist() == [0, 1, 0] and C.numbered(codes, 10**6 + 1).tolist() == [0, 1, 0]
