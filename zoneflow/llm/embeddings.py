"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table-lookup distances, exact rerank.

Equal vectors of one label are one class first, so a group of copies of any size is one vector from then on. Every class
belongs to the inverted list of its nearest coarse centroid and visits the lists whose border is near enough. A list is
cut into chunks of members and of visitors; one task compares one chunk with one chunk, so no group grows with the data.

The table-lookup distance of a visitor to a member's code misses its true distance by the member's own coding error at most,
which is stored with the code. A pair that it discards is therefore certainly no link; the others are reranked exactly.
A link between two lists counts at both ends, whichever of the two visited the other's list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import hashed_sample
from zoneflow.llm.graph import components
from zoneflow.session import materialize


@dataclass(frozen=True)
class PqParams:
    """``sample`` bounds the vectors that the index is fitted on (all vectors are indexed) and ``sample_floats`` their size.
    ``list_size`` is the wanted size of a list, ``max_lists`` bounds what every task is sent. ``margin`` is how far behind
    the border to another list a link is looked for; 0.2, the distance at cosine 0.98, would be certain for any data."""

    cosine: float = 0.98
    subspaces: int = 8
    codewords: int = 64
    list_size: int = 400
    max_lists: int = 4096
    margin: float = 0.12
    chunk: int = 4096
    sample: int = 20_000
    sample_floats: int = 8_000_000
    rounds: int = 8


@dataclass(frozen=True)
class PqIndex:
    """``centroids`` (lists x dim) and ``codebooks`` (subspaces x codewords x dim/subspaces): at most a few megabytes."""

    centroids: np.ndarray
    codebooks: np.ndarray
    dim: int


def unit_rows(vectors: list | pd.Series, dim: int) -> np.ndarray:
    """Float64 unit vectors, zeros appended up to ``dim``."""
    out = np.zeros((len(vectors), dim))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _unit_again(sent: pd.Series, kind: str) -> np.ndarray:
    """``unit_rows`` of the vectors whose bytes ``_indexed`` sent, all of one length, without the zeros."""
    out = np.frombuffer(b"".join(sent), kind).reshape(len(sent), -1).astype(np.float64)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _kmeans(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum((points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T, 0)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([
        _distances(points[at:at + 4096], centres).argmin(1) for at in range(0, len(points), 4096)] or [np.zeros(0, int)])


def fit(sample: np.ndarray, lists: int, params: PqParams) -> PqIndex:
    """Coarse centroids and residual codebooks from unit vectors; deterministic for one sample."""
    rng = np.random.default_rng(7)
    dim = sample.shape[1]
    centroids = _kmeans(sample, lists, params.rounds, rng)
    residuals = sample - centroids[_nearest(sample, centroids)]
    width = dim // params.subspaces
    books = []
    for m in range(params.subspaces):
        book = _kmeans(residuals[:, m * width:(m + 1) * width], params.codewords, params.rounds, rng)
        books.append(np.vstack([book, np.repeat(book[:1], params.codewords - len(book), axis=0)]))
    return PqIndex(centroids, np.stack(books), dim)


def encode(points: np.ndarray, index: PqIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """List, codes and coding error of each unit vector."""
    lists = _nearest(points, index.centroids)
    residuals = points - index.centroids[lists]
    subspaces, _, width = index.codebooks.shape
    codes = np.stack([_nearest(residuals[:, m * width:(m + 1) * width], index.codebooks[m]) for m in range(subspaces)], axis=1)
    coded = np.concatenate([index.codebooks[m][codes[:, m]] for m in range(subspaces)], axis=1)
    return lists, codes.astype(np.uint8), np.sqrt(((residuals - coded) ** 2).sum(1))


def visits(points: np.ndarray, index: PqIndex, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, list): a list is visited if its border is at most ``margin`` away; the own list always is."""
    squares = _distances(points, index.centroids)
    own = squares.argmin(1)
    apart = np.sqrt(_distances(index.centroids, index.centroids))[own]
    border = (squares - squares[np.arange(len(points)), own][:, None]) / (2 * np.maximum(apart, 1e-12))
    border[np.arange(len(points)), own] = 0
    return np.nonzero(border <= margin)


def table_distances(visitors: np.ndarray, centroid: np.ndarray, codes: np.ndarray, index: PqIndex) -> np.ndarray:
    """Asymmetric distances (visitors x members), by one table per visitor and subspace."""
    residuals = visitors - centroid
    subspaces, _, width = index.codebooks.shape
    total = np.zeros((len(visitors), len(codes)))
    for m in range(subspaces):
        total += _distances(residuals[:, m * width:(m + 1) * width], index.codebooks[m])[:, codes[:, m]]
    return np.sqrt(total)


def compare(visitors: pd.DataFrame, members: pd.DataFrame, index: PqIndex, params: PqParams, kind: str) -> pd.DataFrame:
    """Links of one chunk of visitors with one chunk of members of a list.

    Rows ``(a, b, n)``: for a visitor ``a`` the number ``n`` of vectors that it links to (``b`` null), and links ``(a, b)``
    that hold the linked classes together, at most one per class and not one per pair. A member that does not visit the visitor's
    own list never meets it there, so the link is counted here for the member too.
    """
    x, y = _unit_again(visitors["vector"], kind), _unit_again(members["vector"], kind)
    zeros = ((0, 0), (0, index.dim - x.shape[1]))
    codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(y), -1)
    x_class, y_class = visitors["cls"].to_numpy(np.int64), members["cls"].to_numpy(np.int64)
    here, lists = int(members["list"].iloc[0]), len(index.centroids)
    home, weight = visitors["home"].to_numpy(np.int64), visitors["n"].to_numpy(np.int64)
    visited = [np.frombuffer(v, np.int32) for v in members["visited"]]
    meets = np.repeat(np.arange(len(y)), [len(v) for v in visited]) * lists + np.concatenate(visited)
    unmet = np.zeros(len(y), np.int64)
    size, reach = members["n"].to_numpy(np.int64), math.sqrt(2 - 2 * params.cosine) + members["error"].to_numpy() + 1e-6
    centroid = index.centroids[here]
    tree = np.arange(len(y))
    rows: list[tuple[int, int | None, int]] = []
    for at in range(0, len(x), 256):
        some = x[at:at + 256]
        near = table_distances(np.pad(some, zeros), centroid, codes, index) <= reach[None, :]
        near &= x_class[at:at + 256, None] != y_class[None, :]
        i, j = np.nonzero(near)
        good = np.concatenate([
            np.einsum("ij,ij->i", some[i[k:k + 65536]], y[j[k:k + 65536]]) >= params.cosine for k in range(0, len(i), 65536)
        ] or [np.zeros(0, bool)])
        i, j = i[good], j[good]
        one_way = (home[at + i] != here) & ~np.isin(j * lists + home[at + i], meets)
        np.add.at(unmet, j[one_way], weight[at + i[one_way]])
        cuts = np.searchsorted(i, np.arange(len(some) + 1))
        for row in np.nonzero(np.diff(cuts))[0].tolist():
            linked = j[cuts[row]:cuts[row + 1]]
            trees, first = np.unique(tree[linked], return_index=True)
            a = int(x_class[at + row])
            rows.append((a, None, int(size[linked].sum())))
            rows.extend((a, int(y_class[linked[k]]), 0) for k in first)
            if len(trees) > 1:
                tree[np.isin(tree, trees)] = trees[0]
    rows.extend((int(y_class[j]), None, int(unmet[j])) for j in np.nonzero(unmet)[0])
    return pd.DataFrame({
        "a": pd.array([r[0] for r in rows], "Int64"), "b": pd.array([r[1] for r in rows], "Int64"),
        "n": pd.array([r[2] for r in rows], "Int64")})


def near_duplicate_vectors(vectors: DataFrame, params: PqParams = PqParams()) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for ``vectors`` (``vec_id``, ``embedding``, ``label``), a row per input row.

    Vectors with equal labels and lengths link from cosine ``params.cosine`` on. A vector that is null, empty, zero or holds
    null or non-finite numbers, and one with a null label, links with nothing: no links, its own component, kept. Copies of
    a vector link with each other and share all links; repeated rows count as copies. A null ``vec_id`` counts as larger than
    any other and is kept only if its whole component has none. Other columns are ignored, an empty table gives no rows.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    numbers = F.coalesce("embedding", F.array().cast("array<float>"))
    usable = (
        F.col("label").isNotNull() & F.exists(numbers, lambda v: v != 0)
        & ~F.exists(numbers, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    )
    rows = rows.withColumn("cls", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", F.size("embedding"), "embedding")))
    classes = materialize(
        rows.filter(F.col("cls").isNotNull()).groupBy("cls").agg(
            F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("label").alias("label"),
            F.first("embedding").alias("embedding")), "pq-classes")
    n, longest = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not n:
        return _result(rows, None)
    dim = -(-longest // params.subspaces) * params.subspaces
    bound = max(1, min(params.sample, params.sample_floats // dim))
    # The bounded sample: classes with the smallest hashes.
    sample = [r[0] for r in hashed_sample(classes.select("embedding", "cls"), F.col("cls"), bound).collect()]
    index = fit(unit_rows(sample, dim), min(params.max_lists, max(1, n // params.list_size)), params)
    shared = vectors.sparkSession.sparkContext.broadcast(index)
    # Numbers travel as they are stored; every task makes unit vectors of them in double precision.
    kind = "float32" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "float64"
    indexed = materialize(_indexed(classes, shared, params, kind), "pq-lists")

    keys = ["label", "size", "list"]
    per_list = indexed.groupBy(*keys).agg(
        F.ceil(F.count(F.when(F.col("member"), 1)) / params.chunk).cast("int").alias("member_chunks"),
        F.ceil(F.count(F.when(~F.col("member"), 1)) / params.chunk).cast("int").alias("visitor_chunks"))
    per_list = materialize(per_list.filter("member_chunks > 0 AND visitor_chunks > 0"), "pq-chunks")
    dealt = indexed.join(per_list, keys)
    own_member = F.pmod(F.xxhash64("cls"), F.col("member_chunks")).cast("int")
    own_visitor = F.pmod(F.xxhash64("cls"), F.col("visitor_chunks")).cast("int")
    every = lambda chunks: F.sequence(F.lit(0), F.col(chunks) - 1)
    dealt = dealt.withColumn("mc", F.explode(F.when(F.col("member"), F.array(own_member)).otherwise(every("member_chunks"))))
    dealt = dealt.withColumn("vc", F.explode(F.when(F.col("member"), every("visitor_chunks")).otherwise(F.array(own_visitor))))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        return compare(group[~group["member"]], group[group["member"]], shared.value, params, kind)

    found = materialize(
        dealt.select(*keys, "mc", "vc", "member", "home", "visited", "cls", "n", "vector", "codes", "error")
        .groupBy(*keys, "mc", "vc").applyInPandas(meet, "a long, b long, n long"), "pq-found")
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("others"))
    roots = materialize(components(found.filter("b IS NOT NULL").select("a", "b"), "pq"), "pq-roots")
    linked = classes.select("cls", "first", "n").join(roots.withColumnRenamed("node", "cls"), "cls", "left").join(
        counts.withColumnRenamed("a", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    linked = materialize(linked.select("cls", "root", "first", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "pq-linked")
    smallest = materialize(linked.groupBy("root").agg(F.min("first").alias("component_id")), "pq-smallest")
    return _result(rows, materialize(linked.join(smallest, "root").select("cls", "n_links", "component_id"), "pq-result"))


def _indexed(classes: DataFrame, shared, params: PqParams, kind: str) -> DataFrame:
    """Each class once as a member of its list, with codes and the lists it visits, and once as a visitor of each of these.

    ``home`` is its own list. A slice is padded to the longest vector's length, so it has fewer rows if that is long.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        step = max(1, min(1024, params.sample_floats // index.dim))
        for batch in batches:
            for at in range(0, len(batch), step):
                some = batch.iloc[at:at + step].reset_index(drop=True)
                points = unit_rows(some["embedding"], index.dim)
                lists, codes, errors = encode(points, index)
                row, visited = visits(points, index, params.margin)
                data = [np.asarray(v, kind).tobytes() for v in some["embedding"]]
                of_row = np.split(visited.astype(np.int32), np.searchsorted(row, np.arange(1, len(points))))
                member = pd.DataFrame({
                    "label": some["label"], "size": some["embedding"].map(len), "list": lists, "home": lists,
                    "visited": [v.tobytes() for v in of_row], "member": True,
                    "cls": some["cls"], "n": some["n"], "vector": data, "codes": [c.tobytes() for c in codes], "error": errors})
                visitor = member.iloc[row].assign(list=visited, member=False, visited=None, codes=None, error=None)
                yield pd.concat([member, visitor.astype({"error": float})])

    label = classes.schema["label"].dataType.simpleString()
    return classes.select("cls", "n", "label", "embedding").mapInPandas(
        run, f"label {label}, size int, list int, home int, visited binary, member boolean, cls long, n long, vector binary, codes binary, error double")


def _result(rows: DataFrame, classes: DataFrame | None) -> DataFrame:
    if classes is None:
        joined = rows.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("vec_id"))
    else:
        joined = rows.join(classes, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
