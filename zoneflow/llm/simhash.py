"""SimHash fingerprints and their near-duplicate classes by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 f`` bits meet half way: each flips ``f`` of its own bits at most and both reach
the same variant. The contract's radius of 3 is odd, so one bit is left over. It is absorbed by masking: the 64 bits are
cut into four blocks, and for every block a fingerprint emits all variants within one flip of its other 48 bits, that
block left out. Flipping two bits on both sides instead needs 2,081 variants; this needs 4 x 49 = 196.

Why no pair is lost. Take two fingerprints whose differing bits number 1 to 3, and leave out
* a block that holds exactly one of the bits, if there is one: the at most two others are split between the two sides, both
  reach one variant, and what they hold in the block differs in one bit;
* otherwise the block that holds them all: both emit the unflipped variant, and their blocks differ in two or three bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import row_key
from zoneflow.llm.graph import components
from zoneflow.session import materialize

MAX_DISTANCE = 3
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
SHINGLE = 3
SEED = 42
#: Shingles hashed and counted at a time; bounds memory for a text of any length.
CHUNK = 1 << 15
#: Groups up to this size compare their members directly; larger ones look differing blocks up.
SMALL_GROUP = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one text; 0 for a null text or one without words."""
    data = (text or "").encode("utf-8", "replace").lower()  # bytes: A-Z only
    words = data.split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, seed=SEED)).astype(np.int64))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        some = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK], strict=True)])
        bits = np.unpackbits(np.frombuffer(some, np.uint8).reshape(-1, 8), axis=1)  # digests are big-endian
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(set_bits).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) as ``(doc_id, key, fp)``: the row's content key and the fingerprint, signed longs."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series([fingerprint(t, shingle) for t in some], dtype="int64")

    return docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), fp("text").alias("fp"))


def variant_masks() -> tuple[np.ndarray, np.ndarray]:
    """For each of the 196 variants the flip, and the bits of the block that is left out."""
    flips, left_out = [], []
    for block in range(BLOCKS):
        hole = ((1 << BLOCK_BITS) - 1) << (block * BLOCK_BITS)
        for flip in [0, *(1 << bit for bit in range(64) if not hole >> bit & 1)]:
            flips.append(flip)
            left_out.append(hole)
    return np.array(flips, np.uint64), np.array(left_out, np.uint64)


def variants(fps: DataFrame) -> DataFrame:
    """``(block, variant, fp)``: all variants of distinct fingerprints, in partitions sorted by variant."""
    flips, left_out = variant_masks()
    block = np.repeat(np.arange(BLOCKS, dtype=np.int8), len(flips) // BLOCKS)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                own = batch["fp"].to_numpy(np.int64)[at:at + 2000].view(np.uint64)
                made = ((own[:, None] ^ flips[None, :]) & ~left_out[None, :]).ravel()
                yield pd.DataFrame({
                    "block": np.tile(block, len(own)), "variant": made.view(np.int64),
                    "fp": np.repeat(own, len(flips)).view(np.int64)})

    emitted = fps.select("fp").mapInPandas(emit, "block byte, variant long, fp long")
    return emitted.repartition(F.xxhash64("block", "variant")).sortWithinPartitions("block", "variant")


def _joined(fps: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the distinct fingerprints of one group, as a forest: at most one per member.

    Every guaranteed pair (see the module's text) ends in one tree; every link is verified.
    """
    n = len(fps)
    if n <= SMALL_GROUP:
        left, right = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= MAX_DISTANCE, 1))
    else:
        left, right = _looked_up(fps, block)
        near = np.bitwise_count(fps[left] ^ fps[right]) <= MAX_DISTANCE
        left, right = left[near], right[near]
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    kept = []
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append(i)
    return fps[left[kept]], fps[right[kept]]


def _looked_up(fps: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of a large group, a number proportional to its members: no pair of a group is formed twice over.

    Members with equal block content are within two flips of each other and are chained; contents one bit apart are linked
    through their first members. Members that agree outside the block altogether are looked up at two and three bits.
    """
    shift = np.uint64(block * BLOCK_BITS)
    content = (fps >> shift) & np.uint64((1 << BLOCK_BITS) - 1)
    order = np.argsort(content, kind="stable")
    ordered = content[order]
    same = np.nonzero(ordered[1:] == ordered[:-1])[0]
    left, right = [order[same]], [order[same + 1]]
    first = np.nonzero(np.r_[True, ordered[1:] != ordered[:-1]])[0]
    values, members = ordered[first], order[first]

    def look(values: np.ndarray, members: np.ndarray, sizes: tuple[int, ...]) -> None:
        for mask in (m for m in range(1, 1 << BLOCK_BITS) if m.bit_count() in sizes):
            wanted = values ^ np.uint64(mask)
            at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
            hit = np.nonzero((values[at] == wanted) & (values < wanted))[0]
            left.append(members[hit])
            right.append(members[at[hit]])

    look(values, members, (1,))
    outside = fps & ~(np.uint64((1 << BLOCK_BITS) - 1) << shift)
    by_outside = np.argsort(outside, kind="stable")
    cuts = np.nonzero(np.r_[True, outside[by_outside][1:] != outside[by_outside][:-1], True])[0]
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        if end - start > 1:
            own = by_outside[start:end]
            own = own[np.argsort(content[own])]
            if len(own) <= 700:
                a, b = np.nonzero(np.triu(np.bitwise_count(content[own][:, None] ^ content[own][None, :]) <= MAX_DISTANCE, 1))
                left.append(own[a])
                right.append(own[b])
            else:
                look(content[own], own, (2, 3))
    return np.concatenate(left), np.concatenate(right)


def links(emitted: DataFrame) -> DataFrame:
    """``(a, b)``: verified links between colliding fingerprints; a group sends at most one link per member."""

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # rows of the group that the last batch ended in
        for batch in batches:
            block, variant, fp = (batch[c].to_numpy() for c in ("block", "variant", "fp"))
            if held is not None:
                block, variant, fp = (np.concatenate([h, x]) for h, x in zip(held, (block, variant, fp), strict=True))
            if not len(fp):
                continue
            new = np.r_[True, (variant[1:] != variant[:-1]) | (block[1:] != block[:-1])]
            cuts = np.nonzero(new)[0]
            held = tuple(x[cuts[-1]:] for x in (block, variant, fp))
            yield _meet(fp, block, cuts)
        if held is not None:
            yield _meet(held[2], held[0], np.array([0, len(held[2])]))

    return emitted.mapInPandas(meet, "a long, b long").distinct()


def _meet(fp: np.ndarray, block: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
    """Links of the groups that ``cuts`` delimit."""
    own = fp.view(np.uint64)
    sizes = np.diff(cuts)
    twos = cuts[:-1][sizes == 2]
    near = twos[np.bitwise_count(own[twos] ^ own[twos + 1]) <= MAX_DISTANCE]
    a, b = [own[near]], [own[near + 1]]
    for start, size in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        left, right = _joined(own[start:start + size], int(block[start]))
        a.append(left)
        b.append(right)
    return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _classes(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, key, fp, root, component_id)``; ``root`` is the smallest fingerprint of the class."""
    prints = materialize(fingerprints(docs.select("doc_id", "text"), shingle), "simhash")
    firsts = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = materialize(components(links(variants(firsts)), "simhash"), "simhash-roots")
    linked = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = materialize(linked.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-components")
    classes = materialize(linked.join(smallest, "root").select("fp", "root", "component_id"), "simhash-classes")
    return prints.join(classes, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    Documents with at most 3 differing fingerprint bits are linked; ``component_id`` is the smallest ``doc_id`` that links
    reach, itself included. Texts that are null or without words share fingerprint zero and are linked like any others.
    Rows with equal fingerprints are one node, so a group of copies of any size is one key. A null ``doc_id`` takes part and
    counts as larger than any other; its component is null only if no other row is in it. Columns beside ``doc_id`` and
    ``text`` are ignored, repeated rows stay repeated, an empty table gives an empty result.
    """
    return _classes(docs, shingle).select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each class, with all columns of ``docs``: the one with the smallest ``doc_id``, a null one last.

    Of rows that repeat that ``doc_id`` within the class one stays.
    """
    found = _classes(docs, shingle)
    stay = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("__key"))
    packed = docs.select(
        row_key(F.col("doc_id"), F.col("text")).alias("__key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))
    kept = packed.join(materialize(stay, "simhash-stay"), "__key", "left_semi").dropDuplicates(["__key"])
    return kept.select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns])
