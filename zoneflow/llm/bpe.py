"""Byte-level BPE with DuckDB inside each Spark task.

A task keeps one in-memory DuckDB with the merge table. It cuts texts into pieces, gives the pieces that it has not met yet
to one recursive query, and strings the pieces' ids together; ids are decoded by one ordered aggregation. Spark deals the
texts out, a lost task is simply run again, and a task holds no more than a slice of texts and a bounded store of pieces.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType

#: Characters of text that a task works on at a time.
SLICE = 1 << 20
#: Pieces whose ids a worker remembers; as many older ones are kept until the next time it is full.
STORE = 500_000
#: Pieces per recursive query.
PIECES = 50_000
#: Recursion holds the square of a piece's bytes; longer pieces contract the same pairs in the same order by a heap.
LONG_PIECE = 128

#: ``start`` and ``state`` hold a row for each token of a piece: piece, place, id. A step joins neighbours with the merge
#: table, takes each piece's lowest rank and of those the leftmost, and contracts it; pieces without a pair drop out.
ENCODE = """
WITH RECURSIVE state(step, w, pos, tok) AS (
    SELECT 0, w, pos, tok FROM start
    UNION ALL
    (WITH best AS (
        SELECT one.w, min((merged::BIGINT << 20) | one.pos) AS chosen
        FROM state AS one JOIN state AS two ON one.w = two.w AND two.pos = one.pos + 1
        JOIN merges ON one.tok = merges.first AND two.tok = merges.second GROUP BY one.w)
    SELECT step + 1, w, pos - (pos > chosen & 1048575)::INTEGER,
        CASE WHEN pos = chosen & 1048575 THEN (chosen >> 20)::INTEGER ELSE tok END
    FROM state JOIN best USING (w) WHERE pos <> (chosen & 1048575) + 1)
)
SELECT w, list(tok ORDER BY pos) AS ids
FROM state JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) USING (w, step) GROUP BY w
"""

#: ``encoded`` holds a row for each id of a list: list, place, id. A token's bytes are signs, one for each.
DECODE = "SELECT d, string_agg(signs, '' ORDER BY pos) AS signs FROM encoded JOIN vocabulary USING (id) GROUP BY d"
ZERO = "\u0100"  # the sign of byte 0; any other byte is the sign of its own number


def read_ranks(path: str) -> bytes:
    """The rank file as it is; about a megabyte, read once on the driver and sent along with the tasks."""
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.store: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        first, second, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    first.append(a)
                    second.append(b)
                    merged.append(rank)
        merges = pa.table({k: pa.array(v, pa.int32()) for k, v in (("first", first), ("second", second), ("merged", merged))})
        vocabulary = pa.table({
            "id": pa.array(self.ranks.values(), pa.int32()), "signs": pa.array([token.decode("latin-1").replace("\0", ZERO) for token in self.ranks])})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.con.register("given", rows)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.con.unregister("given")

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of ``pieces`` into the store, as little-endian unsigned 32-bit integers."""
        split = []
        for piece in pieces:
            data = piece.encode("utf-8")
            if (rank := self.ranks.get(data)) is not None:
                self.store[piece] = rank.to_bytes(4, "little")
            elif len(data) > LONG_PIECE:
                self.store[piece] = np.array(self.contract(data), "<u4").tobytes()
            else:
                split.append((piece, data))
        split.sort(key=lambda x: len(x[1]))
        for at in range(0, len(split), PIECES):
            some = split[at:at + PIECES]
            lengths = np.array([len(data) for _, data in some])
            ends = np.cumsum(lengths)
            self.con.register("start", pa.table({
                "w": pa.array(np.repeat(np.arange(len(some), dtype=np.int32), lengths)),
                "pos": pa.array((np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)).astype(np.int32)),
                "tok": pa.array(self.single[np.frombuffer(b"".join(data for _, data in some), np.uint8)])}))
            found = self.con.sql(ENCODE).to_arrow_table()
            self.con.unregister("start")
            ids = found.column("ids").combine_chunks()
            values, offsets = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            for w, start, end in zip(found.column("w").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                self.store[some[w][0]] = values[start:end].tobytes()

    def contract(self, data: bytes) -> list[int]:
        """Ids of one long piece: leftmost pair of minimum rank first, by a heap over linked positions."""
        n = len(data)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n

        def entry(i: int) -> None:
            if i >= 0 and after[i] < n and (rank := self.ranks.get(data[i:end[after[i]]])) is not None:
                heapq.heappush(heap, (rank, i, end[after[i]]))

        heap: list[tuple[int, int, int]] = []
        for i in range(n):
            entry(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or end[after[i]] != stop:
                continue
            gone = after[i]
            alive[gone] = False
            end[i], after[i] = end[gone], after[gone]
            if after[i] < n:
                before[after[i]] = i
            entry(before[i])
            entry(i)
        return [self.ranks[data[i:end[i]]] for i in range(n) if alive[i]]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(text) for text in texts]
        new = {piece for pieces in cut for piece in pieces}.difference(self.store)
        if len(self.store) + len(new) > STORE:
            self.older, self.store = self.store, {}
            new = {piece for pieces in cut for piece in pieces}
        known = new.intersection(self.older)
        self.store.update((piece, self.older[piece]) for piece in known)
        self.learn(new - known)
        return [b"".join(map(self.store.__getitem__, pieces)) for pieces in cut]

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids, by ordered aggregation."""
        ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
        self.con.register("encoded", pa.table({
            "d": pa.array(np.repeat(np.arange(len(encoded), dtype=np.int32), [len(e) // 4 for e in encoded])),
            "pos": pa.array(np.arange(len(ids), dtype=np.int32)), "id": pa.array(ids)}))
        found = dict(self.con.execute(DECODE).fetchall())
        self.con.unregister("encoded")
        return [found.get(d, "").replace(ZERO, "\0").encode("latin-1") for d in range(len(encoded))]


@lru_cache(maxsize=2)
def codec(ranks: bytes, pattern: str) -> Codec:
    """One codec per worker process, kept from task to task."""
    return Codec(ranks, pattern)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of at most ``SLICE`` bytes of text, one row at least."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + SLICE, "right")))
            yield batch.slice(at, end - at)
            at = end


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, decoded: bool = False) -> DataFrame:
    """``docs`` with a column ``ids`` (array of int) in place of ``text``; a null text is encoded as an empty one.

    With ``decoded`` the ids are decoded again, and a column ``decoded`` (binary, replaced if there) holds what they give.

    Every match of ``pattern`` is encoded by itself and no string is special. All other columns stay, whatever their names
    (a column named ``ids`` is replaced); rows stay as they are, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    others = [c for c in docs.columns if c not in ("text", "ids") and not (decoded and c == "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = codec(shared.value, pattern)
        for some in _slices(batches):
            encoded = worker.encode([t or "" for t in some.column("text").to_pylist()])
            ends = np.cumsum([0, *(len(e) // 4 for e in encoded)])
            ids = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)))
            made = {"ids": ids} | ({"decoded": pa.array(worker.decode(encoded), pa.binary())} if decoded else {})
            yield pa.RecordBatch.from_arrays([*(some.column(c) for c in others), *made.values()], names=[*others, *made])

    schema = docs.select(*[f"`{c}`" for c in others]).schema.add("ids", ArrayType(IntegerType()))
    if decoded:
        schema = schema.add("decoded", "binary")
    return docs.select(*[f"`{c}`" for c in others], "text").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``encoded`` with ``data`` (binary) in place of ``ids``; a null list decodes to no bytes."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    others = [c for c in encoded.columns if c not in ("ids", "data")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = codec(shared.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [np.array(x or [], "<u4").tobytes() for x in some.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in others), pa.array(worker.decode(ids), pa.binary())], names=[*others, "data"])

    schema = encoded.select(*[f"`{c}`" for c in others]).schema.add("data", "binary")
    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encodes every text and decodes the ids again, row by row.

    The same codec as in ``encode_documents`` and ``decode_documents``, without carrying ids between two Python stages.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = codec(shared.value, pattern)
        for some in _slices(batches):
            encoded = worker.encode([t or "" for t in some.column("text").to_pylist()])
            decoded = worker.decode(encoded)
            yield pa.RecordBatch.from_arrays([
                some.column("doc_id"), pa.array([len(e) // 4 for e in encoded], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in encoded]),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = docs.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
