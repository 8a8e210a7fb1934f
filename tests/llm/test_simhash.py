from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from zoneflow.llm import simhash
from zoneflow.llm.graph import components

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows: list[tuple[int, int]]) -> list[int]:
    """Smallest id reachable, by relaxing all pairs until nothing changes."""
    best = [i for i, _ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (rows[a][1] ^ rows[b][1]).bit_count() <= 3]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(best[a], best[b])
            if (best[a], best[b]) != (low, low):
                best[a] = best[b] = low
                changed = True
    return best


def test_query_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 400]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 5])):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            texts.append("\t ".join(near).upper() if rng.random() < 0.3 else " ".join(near))
    texts += [None, "", " \n", "ÄÖ é", "äÖ é", texts[0], texts[0]]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3).collect()}
    assert len(got) == len(rows)
    rows.sort()
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    assert [got[i].fingerprint for i, _ in rows] == [f"{p:016x}" for _, p in prints]
    assert [got[i].component_id for i, _ in rows] == plain_components(prints)
    assert len({got[i].component_id for i, _ in rows}) < len(rows)


def test_links_lose_nothing_at_any_distance(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(15)]
    prints = set(base)
    for fp in base:
        for size in (1, 2, 3, 3, 4):
            prints.add(fp ^ sum(1 << b for b in rng.sample(range(64), size)))
        for block in range(4):  # all bits in one block, and two of three in one block
            prints.add(fp ^ sum(1 << b for b in rng.sample(range(16 * block, 16 * block + 16), 3)))
            prints.add(fp ^ sum(1 << b for b in rng.sample(range(16 * block, 16 * block + 16), 2)) ^ 1 << (16 * block + 40) % 64)
    nodes = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in nodes], "fp long")
    found = {r.node: r.root for r in components(simhash.links(simhash.variants(frame)), "test").collect()}
    signed = [int(np.uint64(p).astype(np.int64)) for p in nodes]
    want = plain_components(sorted((s, s % (1 << 64)) for s in signed))
    assert [found.get(s, s) for s in sorted(signed)] == want


def test_large_group_is_linked_as_by_all_pairs():
    rng = np.random.default_rng(1)
    outside = np.uint64(0x0123456789AB0000)
    flips = np.r_[np.zeros(1500, np.uint64), np.uint64(1) << rng.integers(16, 64, 1500).astype(np.uint64)]
    fps = np.unique((outside ^ flips) | rng.integers(0, 1 << 16, 3000).astype(np.uint64))
    a, b = simhash._joined(fps, 0)
    assert len(a) < len(fps)
    assert (np.bitwise_count(a ^ b) <= 3).all()
    near = np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3, 1)
    content = fps & np.uint64(0xFFFF)
    both_plain = ((fps ^ outside) >> np.uint64(16) == 0)
    apart = np.bitwise_count(content[:, None] ^ content[None, :])
    guaranteed = near & ((apart <= 1) | (both_plain[:, None] & both_plain[None, :]))
    root = {int(x): int(x) for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)
    for x, y in zip(*np.nonzero(guaranteed), strict=True):
        assert find(int(fps[x])) == find(int(fps[y]))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(5, 5), (None, 7), (300, 299), (299, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(30)} | {299: 299, 300: 299}


def test_empty_table_nulls_and_clashing_columns(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame(
        [(None, "a b c d", 1), (3, "a b c d", 2), (3, "a b c d", 2), (9, None, 3), (None, None, 4), (8, "x y z", 5)],
        "doc_id long, text string, fp int").withColumn("root", F.lit("r"))
    got = sorted((str(r.doc_id), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [("3", 3), ("3", 3), ("8", 8), ("9", 9), ("None", 3), ("None", 9)]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.fp, r.root) for r in kept.collect()) == [
        (3, "a b c d", 2, "r"), (8, "x y z", 5, "r"), (9, None, 3, "r")]


def test_very_long_text():
    text = " ".join(f"v{i * 7919 % 5003}" for i in range(120_000))
    value = simhash.fingerprint(text)
    assert f"{value % (1 << 64):016x}" == f"{plain_fingerprint(text):016x}"
