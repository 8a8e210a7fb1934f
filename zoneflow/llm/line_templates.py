"""Line dedup by a log-template tree of fixed depth: token count, then the leading tokens, then the template.

A line is parsed as a log message is. Tokens with a digit are variable fields. A leaf of the tree is named by the number of
tokens and the first ``depth`` tokens. Inside a leaf, a token that many documents have at the same place belongs to the
template, any other is a variable field too, as long as enough of the line is constant. A template that recurs across
documents is kept where it comes first and dropped everywhere else.

Beside the templates, lines that recur exactly, digits and all, are kept where they come first: long ones from two documents
on, whatever their script or number of tokens, shorter ones from as many as a template needs.

The tree is never built in one place: nodes are hashes, and counting is a grouped aggregation by leaf, place and token, so a
leaf may hold any share of all lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import row_key
from zoneflow.session import materialize

_DIGIT = re.compile(rb"[0-9]")
FIELD = b"<*>"
#: Size up to which the lists of dropped lines are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class TemplateParams:
    """``min_docs``: documents from which a template recurs. ``min_tokens``: shorter lines are no templates and recur only exactly.
    ``depth``: leading tokens that name a leaf. ``min_constant``: share of a template's tokens that must be constant, and
    again of those behind the leading ones, where fields do not count and ``min_named`` is the least number.
    ``exact_bytes``: a line of so many bytes is long, and ``exact_docs``: documents from which it recurs exactly; other lines, down
    to a single token, recur exactly from ``min_docs`` documents on."""

    min_docs: int = 5
    exact_docs: int = 2
    exact_bytes: int = 48
    min_tokens: int = 4
    depth: int = 3
    min_constant: float = 0.6
    min_named: int = 2


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) - (1 << 63)


def parse_line(line: bytes, params: TemplateParams) -> tuple[int, int, list[bytes]] | None:
    """``(line hash, leaf hash, tokens)`` with variable fields masked; None for a line that is left alone."""
    tokens = line.split()
    if _DIGIT.search(line):
        tokens = [FIELD if _DIGIT.search(t) else t for t in tokens]
    if len(tokens) < params.min_tokens:
        return None
    leaf = b"%d %s" % (len(tokens), b" ".join(tokens[:params.depth]))
    return _hash(b" ".join(tokens)), _hash(leaf), tokens


def is_told(tokens: list[bytes], params: TemplateParams) -> bool:
    """Whether a masked line has enough tokens that are neither fields nor leading ones; below, only exact repeats recur."""
    named = sum(t != FIELD for t in tokens[params.depth:])
    return named >= max(params.min_named, params.min_constant * (len(tokens) - params.depth))


def exact_line(line: bytes, params: TemplateParams) -> tuple[int, bool] | None:
    """``(hash of the unmasked line, whether it is long)``, spaces apart; None for a line without tokens."""
    whole = b" ".join(line.split())
    return (xxhash.xxh64_intdigest(whole, 1) - (1 << 63), len(whole) >= params.exact_bytes) if whole else None


def _parsed(docs: DataFrame, params: TemplateParams) -> DataFrame:
    """``(key, doc_id, exact, long, line, leaf, tokens)``: the distinct lines of each document, tokens as 32-bit hashes.

    ``docs`` has one row per key. ``line``, ``leaf`` and ``tokens`` are null where the document has the masked line already, or the line is no template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("key"), batch.column("text")
            rows, exacts, longs, lines, leaves, tokens = [], [], [], [], [], []
            for row in range(batch.num_rows):
                seen, seen_exact = set(), set()
                for line in (texts[row].as_py() or "").encode().split(b"\n"):
                    whole = exact_line(line, params)
                    if not whole or whole[0] in seen_exact:
                        continue
                    seen_exact.add(whole[0])
                    rows.append(row)
                    exacts.append(whole[0])
                    longs.append(whole[1])
                    found = parse_line(line, params)
                    new = found and found[0] not in seen and is_told(found[2], params)
                    if new:
                        seen.add(found[0])
                    lines.append(found[0] if new else None)
                    leaves.append(found[1] if new else None)
                    tokens.append(np.array([xxhash.xxh32_intdigest(t) if t != FIELD else 0 for t in found[2]], "<u4").tobytes() if new else None)
                if len(rows) >= 20_000 or row == batch.num_rows - 1:
                    at = pa.array(rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        keys.take(at), batch.column("doc_id").take(at), pa.array(exacts, pa.int64()), pa.array(longs, pa.bool_()),
                        pa.array(lines, pa.int64()), pa.array(leaves, pa.int64()), pa.array(tokens, pa.binary())],
                        names=["key", "doc_id", "exact", "long", "line", "leaf", "tokens"])
                    rows, exacts, longs, lines, leaves, tokens = [], [], [], [], [], []

    schema = docs.select("key", "doc_id").schema.add("exact", "long").add("long", "boolean").add(
        "line", "long").add("leaf", "long").add("tokens", "binary")
    return docs.select("key", "doc_id", "text").mapInArrow(run, schema)


def recurring_lines(docs: DataFrame, params: TemplateParams = TemplateParams()) -> DataFrame:
    """``(key, lines)``: for documents (``key``, ``doc_id``, ``text``), the hashes of masked and of exact lines to be dropped."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")
    every = materialize(_parsed(docs, params), "templates-lines")
    # Equal rows are one document, as often as they stand: their lines are alike, so one row of each line stays. Only keys that
    # stand more than once take part, and those are found by a few bytes per document.
    again = materialize(docs.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key"), "templates-again")
    if not again.isEmpty():
        once = every.join(again, "key", "left_anti")
        more = every.join(again, "key", "left_semi").dropDuplicates(["key", "exact"])
        every = materialize(once.unionByName(more.select(*once.columns)), "templates-lines-once")

    # Lines that recur exactly, from two documents on if they are long.
    same = every.groupBy("exact").agg(F.count("*").alias("docs"), F.max("long").alias("long"), first).filter(
        F.col("docs") >= F.when(F.col("long"), params.exact_docs).otherwise(params.min_docs))
    same = materialize(same.select("exact", F.col("first.key").alias("holder"), F.col("first.doc_id").alias("holder_id")), "templates-same")
    repeated = every.select("key", "doc_id", F.col("exact").alias("line"), "exact").join(same, "exact").select(
        "key", "doc_id", "line", "holder", "holder_id")

    lines = every.filter(F.col("line").isNotNull()).select("key", "doc_id", "line", "leaf", "tokens")
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("docs")).filter(F.col("docs") >= params.min_docs).select("leaf")
    candidates = materialize(lines.join(materialize(leaves, "templates-leaves"), "leaf", "left_semi"), "templates-candidates")

    # Lines that recur as they are, but for fields with digits, are templates already.
    own = candidates.groupBy("line").agg(F.count("*").alias("docs"), first).filter(F.col("docs") >= params.min_docs)
    own = materialize(own.select("line", "first.key", "first.doc_id"), "templates-own")

    # The rest: a token is constant where enough documents have it at its place in the leaf.
    rest = materialize(candidates.join(own.select("line"), "line", "left_anti"), "templates-rest")
    size = F.octet_length("tokens") / 4
    token = F.substr(F.col("tokens"), F.col("place") * 4 + 1, F.lit(4))
    places = rest.select("key", "doc_id", "line", "leaf", "tokens", F.explode(F.sequence(F.lit(0), (size - 1).cast("int"))).alias("place"))
    places = places.select("key", "doc_id", "line", "leaf", "place", token.alias("token"))
    constant = places.groupBy("leaf", "place", "token").agg(F.count("*").alias("docs")).filter(F.col("docs") >= params.min_docs)
    constant = materialize(constant.select("leaf", "place", "token"), "templates-constant")
    kept = places.join(constant, ["leaf", "place", "token"]).groupBy("key", "doc_id", "line", "leaf").agg(
        F.sum(F.xxhash64("place", "token").cast("decimal(38,0)")).alias("constants"), F.count("*").alias("n"),
        F.count_if((F.col("place") >= params.depth) & (F.col("token") != F.lit(bytes(4)))).alias("named"))
    sizes = rest.select("key", "line", size.alias("size")).distinct()
    told = F.col("named") >= F.greatest(F.lit(params.min_named), (F.col("size") - params.depth) * params.min_constant)
    shaped = kept.join(sizes, ["key", "line"]).filter((F.col("n") >= F.col("size") * params.min_constant) & told).select(
        "key", "doc_id", "line", F.xxhash64("leaf", "constants", "n").alias("template"))
    shaped = materialize(shaped, "templates-shaped")
    shapes = shaped.groupBy("template").agg(F.count_distinct("key").alias("docs"), first).filter(F.col("docs") >= params.min_docs)
    shapes = materialize(shapes.select("template", F.col("first.key").alias("holder"), F.col("first.doc_id").alias("holder_id")), "templates-shapes")

    exact = candidates.select("key", "doc_id", "line").join(
        own.select("line", F.col("key").alias("holder"), F.col("doc_id").alias("holder_id")), "line")
    general = shaped.join(shapes, "template").select("key", "doc_id", "line", "holder", "holder_id")
    dropped = exact.select("key", "doc_id", "line", "holder", "holder_id").unionByName(general).unionByName(repeated).filter(
        ~(F.col("key").eqNullSafe(F.col("holder")) & F.col("doc_id").eqNullSafe(F.col("holder_id"))))
    return materialize(dropped.groupBy("key").agg(F.collect_set("line").alias("lines")), "templates-dropped")


def drop_recurring_lines(docs: DataFrame, params: TemplateParams = TemplateParams()) -> DataFrame:
    """``docs`` without the lines that recur, exactly or by their template, and first occur in another document.

    The first document is the one with the smallest ``doc_id``, a null id last; equal rows are one holder and all keep their
    lines. A text that loses all its lines is empty; null stays null. ``n_chars``, where there is one, is counted anew. All
    other columns stay, whatever their names; every row stays. An empty table gives an empty result.
    """
    return _dropped(docs, params).select(*[
        F.col("__new.text").alias(c) if c == "text"
        else F.coalesce(F.length("__new.text").cast("long"), F.col("__doc")[c]).alias(c) if c == "n_chars"
        else F.col("__doc")[c].alias(c) for c in docs.columns])


def line_report(docs: DataFrame, params: TemplateParams = TemplateParams()) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, text)``, one row per input row; ``text`` is what stays."""
    return _dropped(docs, params).select(
        F.col("__doc")["doc_id"].alias("doc_id"), "__new.n_lines", "__new.n_dropped", "__new.text")


def _dropped(docs: DataFrame, params: TemplateParams) -> DataFrame:
    packed = docs.select(
        row_key(F.col("doc_id"), F.col("text")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))
    found = recurring_lines(packed.select("key", F.col("__doc")["doc_id"].alias("doc_id"), F.col("__doc")["text"].alias("text")), params)

    @F.arrow_udf("struct<text:string,n_lines:int,n_dropped:int>")
    def without(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        out: list[dict | None] = []
        for text, lines in zip(texts, dropped, strict=True):
            text, gone = text.as_py(), set(lines.as_py() or ())
            if text is None:
                out.append({"text": None, "n_lines": 0, "n_dropped": 0})
                continue
            every = text.encode().split(b"\n")
            stay = [x for x in every if not (gone and (
                (e := exact_line(x, params)) and e[0] in gone or (p := parse_line(x, params)) and p[0] in gone))]
            out.append({"text": b"\n".join(stay).decode(), "n_lines": len(every), "n_dropped": len(every) - len(stay)})
        return pa.array(out, pa.struct([("text", pa.string()), ("n_lines", pa.int32()), ("n_dropped", pa.int32())]))

    # Few documents lose lines: up to a checked size their lists go to every task, and no text is shuffled for them.
    keys, lines = found.agg(F.count("*"), F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()
    if 64 * keys + 16 * lines <= BROADCAST_BYTES:
        found = F.broadcast(found)
    return packed.join(found, "key", "left").select("__doc", without(F.col("__doc")["text"], F.col("lines")).alias("__new"))
