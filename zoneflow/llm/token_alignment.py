"""Alignment of two tokenizers over the same texts, by as-of joins of their tokens' byte offsets.

Per batch of texts, the tokens of either side are rows with a document and a byte offset. For the start of each token,
``merge_asof`` keyed by document finds the token of the other side that covers it. Two tokens overlap exactly where one starts
inside the other, so the union of both directions is all overlaps; offsets where tokens of both sides end cut groups.

Each document's distinct linked pairs of ids are written once, with the number of their occurrences. How many documents hold a
pair is one aggregation over that table. The counts go back to the documents by two ways that add up: the pairs that most
documents hold, a fixed number at most, as a sorted array that every task gets, and all others by a join. So pairs that stand
in nearly every document never meet in one task, and what is shuffled are rare pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import text_slices
from zoneflow.session import materialize

#: Bytes of text that a task aligns at a time.
SLICE = 1 << 20
#: Characters of chunks that a worker remembers, and what each chunk counts for beside its own.
STORE, ENTRY = 24_000_000, 32
#: A pair of ids is one number: the A id and, in its last bits, the B id.
ID_BITS = 20
#: A chunk is a space and what follows up to the next space behind a sign.
CHUNK = re.compile("[ ][\t-\r\x20\xa0]*[^\t-\r\x20\xa0]*(?:[\t-\r\xa0][\t-\r\x20\xa0]*[^\t-\r\x20\xa0]*)*")
#: Texts of signs that every pattern engine classes alike, without white space at the end.
_SIGNS = "\x21-\x7e\xa1-žΑ-Ρα-ωА-я–—‘-„…€一-龥"
_PLAIN = re.compile(f"[\t-\r\x20\xa0{_SIGNS}]*[{_SIGNS}]")
#: A space behind a sign, where no chunk may be cut if a token has it.
_INNER_SPACE = re.compile("[^\\s▁]▁")
LISTS = [T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))]
COLUMNS = [
    *(T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")),
    T.StructField("groups_sha256", T.StringType()), *LISTS]
SUMS = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), *LISTS]


@dataclass(frozen=True)
class AlignParams:
    """``hot_pairs``: most pairs whose counts are sent to every task, 13 bytes each."""

    hot_pairs: int = 1 << 20


class Sides:
    """Both tokenizers of one worker, and the bytes of each token."""

    def __init__(self, first: bytes, second: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_buffer(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        known = _byte_of_sign()
        self.first_bytes = np.array([
            _decoded(token, known) for token in map(self.first.id_to_token, range(self.first.get_vocab_size()))] + [b""], object)
        self.second_bytes = np.array([
            bytes([int(piece[1:-1], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.second.id_to_piece, range(self.second.get_piece_size())))] + [b""], object)
        self.apart = not any(_INNER_SPACE.search(piece) for piece in map(self.second.id_to_piece, range(self.second.get_piece_size())))
        self.forget()
        self.lengths = [np.array([len(x) for x in side], np.int64) for side in (self.first_bytes, self.second_bytes)]
        # How an id is written where another one of its side follows, and where it is the last one of its group.
        self.written = np.concatenate([
            np.array([b"%d%b" % (i, mark) for i in range(len(side))], object)
            for side, ends in ((self.first_bytes, b",|"), (self.second_bytes, b",;")) for mark in (ends[:1], ends[1:])])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of either side, one text's after the other's, and their number by text; none for a text whose bytes one of the
        sides does not give back.

        No token of either side goes on from a sign into a space, so texts are cut before each space behind a sign, and a
        chunk is encoded once and remembered. Texts with signs that pattern engines may class differently, or with white space
        at the end, are one chunk."""
        cut = [CHUNK.findall(" " + text) if self.apart and _PLAIN.fullmatch(text) else [" " + text] for text in texts]
        if self.held > STORE:
            self.forget()
        new = list(set(chain.from_iterable(cut)).difference(self.chunks))
        if new:
            self.remember(new)
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        rows = np.fromiter(map(self.chunks.__getitem__, chain.from_iterable(cut)), np.int64, counts.sum())
        stops = np.concatenate([[0], np.cumsum(counts)])
        wrong = np.concatenate([[0], np.cumsum(~self.fine[rows])])[stops]
        kept = np.repeat((np.diff(wrong) == 0) & [len(text) > 0 for text in texts], counts)
        found = []
        for ids, starts, sizes in self.known:
            taken = sizes[rows] * kept
            ends = np.concatenate([[0], np.cumsum(taken)])
            found.append((ids[np.arange(ends[-1]) + np.repeat(starts[rows] - ends[:-1], taken)], np.diff(ends[stops])))
        return found

    def remember(self, new: list[str]) -> None:
        """Encode chunks, which start with a space; the second side adds it itself."""
        data, fine = [chunk.encode() for chunk in new], np.ones(len(new), bool)
        by_side = ([x.ids for x in self.first.encode_batch_fast(new, add_special_tokens=False)],
                   self.second.encode([chunk[1:] for chunk in new], num_threads=1))
        for side, lists in enumerate(by_side):
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), np.int64, sizes.sum())
            fine &= self.gives_back(side, ids, sizes, data)
            known = self.known[side]
            starts = len(known[0]) + np.cumsum(sizes) - sizes
            self.known[side] = tuple(np.concatenate(pair) for pair in zip(known, (ids, starts, sizes), strict=True))
        self.chunks.update(zip(new, range(len(self.fine), len(self.fine) + len(new)), strict=True))
        self.fine = np.concatenate([self.fine, fine])
        self.held += sum(map(len, new)) + ENTRY * len(new)

    def forget(self) -> None:
        self.chunks: dict[str, int] = {}
        self.fine, self.held = np.zeros(0, bool), 0
        self.known = [(np.zeros(0, np.int64),) * 3 for _ in range(2)]  # by side: ids of all chunks, and each one's start and number

    def gives_back(self, side: int, ids: np.ndarray, sizes: np.ndarray, data: list[bytes]) -> np.ndarray:
        """For each of ``data`` whether its ids, ``sizes`` of all ``ids`` in a row, are tokens of just these bytes."""
        given = (self.first_bytes, self.second_bytes)[side][ids]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        lengths = np.diff(np.concatenate([[0], np.cumsum(self.lengths[side][ids])])[stops])
        if np.array_equal(lengths, [len(x) for x in data]) and b"".join(given) == b"".join(data):
            return np.ones(len(data), bool)
        return np.array([b"".join(given[i:j]) == x for i, j, x in zip(stops[:-1], stops[1:], data, strict=True)], bool)


def _byte_of_sign() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: itself if it is printable, else those from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def _decoded(token: str, known: dict[str, int]) -> bytes:
    return bytes(known[sign] for sign in token) if all(sign in known for sign in token) else token.encode()


@lru_cache(maxsize=2)
def sides(first: bytes, second: bytes) -> Sides:
    """Both tokenizers, once per worker process."""
    return Sides(first, second)


def tokens_of(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> pd.DataFrame:
    """Tokens of a batch as rows: document, id, start and end. Offsets run on from text to text, so they are in order."""
    ends = np.cumsum(lengths[ids])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(sizes)), sizes), "id": ids, "start": ends - lengths[ids], "end": ends})


def overlaps(first: pd.DataFrame, second: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of ``first`` and ``second`` whose byte ranges overlap, as two arrays of row numbers."""
    first, second = first.assign(a=np.arange(len(first))), second.assign(b=np.arange(len(second)))
    covering = pd.merge_asof(second[["doc", "start", "b"]], first[["doc", "start", "a"]], on="start", by="doc")
    inside = pd.merge_asof(
        first[["doc", "start", "a"]], second.assign(begun=second["start"])[["doc", "start", "begun", "b"]], on="start", by="doc")
    inside = inside[inside["begun"] != inside["start"]]  # equal starts are found from the other side
    return (np.concatenate([covering["a"].to_numpy(np.int64), inside["a"].to_numpy(np.int64)]),
            np.concatenate([covering["b"].to_numpy(np.int64), inside["b"].to_numpy(np.int64)]))


def groups_of(first: pd.DataFrame, second: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Whether each row ends its side's part of a group, its place where both sides are written group by group, and the
    document of each group; as two arrays, for ``first`` and ``second``."""
    ends = [side["end"].to_numpy() for side in (first, second)]
    size = int(ends[0][-1]) + 1 if len(first) else 1
    marks = [np.bincount(end, minlength=size) for end in ends]
    both = (marks[0] > 0) & (marks[1] > 0)
    ended = [np.cumsum(mark) for mark in marks]  # tokens that have ended up to each offset
    cuts = np.concatenate([[0], np.nonzero(both)[0]])
    group = np.cumsum(both)
    before = [group[end - 1] for end in ends]  # groups that ended before the token's own
    place = [np.arange(len(first)) + ended[1][cuts[before[0]]], np.arange(len(second)) + ended[0][cuts[before[1] + 1]]]
    return [both[end] for end in ends], place, first["doc"].to_numpy()[both[ends[0]]]


def align(worker: Sides, texts: list[str | None]) -> pa.RecordBatch:
    """``COLUMNS`` of each text; pairs are distinct and in order, ``times`` counts their occurrences."""
    n = len(texts)
    ids = worker.encode([text or "" for text in texts])
    first, second = (tokens_of(*some, lengths) for some, lengths in zip(ids, worker.lengths, strict=True))
    a, b = overlaps(first, second)
    doc = first["doc"].to_numpy()[a]
    # Document and pair as one number: B ids have fewer than 2^20 values, and a slice has fewer than 2^20 texts.
    linked = np.sort((doc << 2 * ID_BITS) + (first["id"].to_numpy()[a] << ID_BITS) + second["id"].to_numpy()[b])
    new = np.append(linked[1:] != linked[:-1], True)[:len(linked)]
    times = np.diff(np.nonzero(new)[0], prepend=-1).astype(np.int32)
    pairs = linked[new]
    ends = np.concatenate([[0], np.cumsum(np.bincount(pairs >> 2 * ID_BITS, minlength=n))]).astype(np.int32)

    last, place, group_doc = groups_of(first, second)
    n_a, n_b = (np.bincount(side["doc"], minlength=n) for side in (first, second))
    size = len(worker.first_bytes), len(worker.second_bytes)
    sign = np.empty(len(first) + len(second), np.int64)
    sign[place[0]] = first["id"].to_numpy() + size[0] * last[0]
    sign[place[1]] = second["id"].to_numpy() + 2 * size[0] + size[1] * last[1]
    signs, stops = worker.written[sign], np.concatenate([[0], np.cumsum(n_a + n_b)])
    shas = [hashlib.sha256(b"".join(signs[i:j])[:-1]).hexdigest() if j > i else "" for i, j in zip(stops[:-1], stops[1:], strict=True)]
    return pa.RecordBatch.from_arrays([
        pa.array(n_a), pa.array(n_b), pa.array(np.bincount(group_doc, minlength=n)), pa.array(np.bincount(doc, minlength=n)),
        pa.array(shas), pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs & (1 << 2 * ID_BITS) - 1)),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(times))],
        names=[field.name for field in COLUMNS])


def aligned_documents(docs: DataFrame, first: bytes, second: bytes) -> DataFrame:
    """``(row, doc_id, …COLUMNS)``, written once: one row per input row, ``row`` its own number.

    ``first`` is the JSON of a byte-level BPE tokenizer, which encodes a space and the text; ``second`` a sentencepiece model that
    adds the space itself. A null or empty text, and one whose bytes either side does not give back, has no tokens.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((first, second))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = sides(*shared.value)
        for some in text_slices(batches, SLICE):
            found = align(worker, some.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [some.column("row"), some.column("doc_id"), *found.columns], names=["row", "doc_id", *found.schema.names])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = T.StructType([*numbered.select("row", "doc_id").schema.fields, *COLUMNS])
    return materialize(numbered.mapInArrow(run, schema), "alignment-documents")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: in how many documents each pair of ids is linked, and whether no pair of its A id has more."""
    counts = materialize(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "alignment-counts")
    own = F.shiftright("pair", ID_BITS)
    most = counts.groupBy(own.alias("a")).agg(F.max("n").alias("most"))
    return materialize(counts.withColumn("a", own).join(most, "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-pairs")


def _hot_limit(pairs: DataFrame, most: int) -> int:
    """Least count of documents, a power of two, that at most ``most`` pairs reach; some sixty rows tell."""
    sizes = {row.bits: row.pairs for row in pairs.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("pairs")).collect()}
    held, limit = 0, max(sizes, default=0) + 1
    while limit > 1 and held + sizes.get(limit - 1, 0) <= most:
        limit -= 1
        held += sizes.get(limit, 0)
    return 1 << (limit - 1)


def align_tokens(docs: DataFrame, first: bytes, second: bytes, params: AlignParams = AlignParams()) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row, from whole texts.

    ``n_links`` counts pairs of overlapping tokens, ``count_sum`` adds up for each in how many documents (rows) its ids are
    linked, ``n_best`` counts those with as many as any pair of their A id. Texts without tokens (``aligned_documents``) have
    zeros and ''. Repeated rows are documents of their own, null ids stay null, other columns are ignored; an empty table gives
    an empty result.
    """
    aligned = aligned_documents(docs, first, second)
    pairs = pair_counts(aligned)
    limit = _hot_limit(pairs, params.hot_pairs)
    hot = pairs.where(F.col("n") >= limit).toArrow().sort_by("pair")  # at most ``hot_pairs`` rows
    shared = docs.sparkSession.sparkContext.broadcast(
        tuple(hot.column(name).to_numpy() for name in ("pair", "n", "best")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            own = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
            found = known[at] == own if len(known) else np.zeros(len(own), bool)
            at, hit, weight = at[found], owner[found], times[found].astype(np.int64)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], hit, weight * best[at])
            np.add.at(sums[1], hit, weight * n[at])
            rest = np.concatenate([[0], np.cumsum(np.bincount(owner[~found], minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(name) for name in kept), pa.array(sums[0]), pa.array(sums[1]),
                pa.ListArray.from_arrays(pa.array(rest), pa.array(own[~found])),
                pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~found]))],
                names=[*kept, "n_best", "count_sum", "pairs", "times"])

    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = T.StructType([*aligned.select(kept).schema.fields, *SUMS])
    summed = materialize(aligned.mapInArrow(look_up, schema), "alignment-hot")

    # Pairs that few documents hold: as many rows as they have documents.
    rare = summed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.pairs", "link.times")
    rare = rare.join(pairs.where(F.col("n") < limit), F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
    return summed.join(rare, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
