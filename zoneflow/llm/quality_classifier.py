"""Quality classifier: regularised quadratic discriminant over transformed statistics of whole documents.

Each class has its own mean and covariance of the statistics. A covariance is shrunk towards the one that both classes share and
then towards its own diagonal, so that it has a Cholesky factor even where a class has few rows. The score is the
logistic function of the difference of both classes' log densities, Mahalanobis distances taken with the cached factors.

The statistics of every document are worked out once and written; means and covariances come from all labelled rows by sums of
statistics and of their products, so neither rows nor ids reach the driver, only one matrix per class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from zoneflow.llm.common import text_slices
from zoneflow.session import materialize

#: Bytes of text that a task measures at a time.
SLICE = 4 << 20
STATISTICS = (
    "words", "word length", "word length spread", "capitals", "digits", "symbols", "exclamations", "bars", "punctuation",
    "line breaks", "other bytes", "same word again", "distinct words", "commonest word", "repeated lines", "byte entropy")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.arange(256)
_CLASSES = {
    "capitals": (_BYTES >= ord("A")) & (_BYTES <= ord("Z")),
    "digits": (_BYTES >= ord("0")) & (_BYTES <= ord("9")),
    "symbols": np.isin(_BYTES, [*b"#$%&*+/<=>@[\\]^_`{}~"]),
    "exclamations": _BYTES == ord("!"),
    "bars": _BYTES == ord("|"),
    "punctuation": np.isin(_BYTES, [*b".,;:?\"'()-"]),
    "other bytes": _BYTES >= 128,
}


@dataclass(frozen=True)
class QualityParams:
    """``shared``: weight of the covariance that both classes share. ``diagonal``: weight of a covariance's own diagonal, after
    that. ``floor``: least variance of a statistic. ``limit``: statistics are cut off so many deviations from their mean.
    ``threshold``: score from which label 1 is predicted."""

    shared: float = 0.3
    diagonal: float = 0.02
    floor: float = 1e-3
    limit: float = 5.0
    threshold: float = 0.7


def _distinct(array: pa.Array) -> tuple[np.ndarray, int]:
    coded = array.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def measure(texts: pa.Array) -> np.ndarray:
    """``STATISTICS`` of each text, transformed: counts and shares as logarithms, with all bytes of a slice at once.

    A null text is measured as an empty one."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    histogram = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True

    # Words: runs of other bytes than white space, within one text.
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.nonzero(starts)[0], np.nonzero(ends)[0] + 1
    word_owner, length = owner[starts], (ends - starts).astype(float)
    words = np.bincount(word_owner, minlength=n)
    some = np.maximum(words, 1)
    mean = np.bincount(word_owner, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(word_owner, length**2, n) / some - mean**2, 0))
    codes, kinds = _distinct(_strings(data[inside], np.concatenate([[0], np.cumsum(ends - starts)])))
    again = np.bincount(word_owner[1:][(codes[1:] == codes[:-1]) & (word_owner[1:] == word_owner[:-1])], minlength=n)
    pair, distinct = pd.factorize(word_owner * max(kinds, 1) + codes)
    distinct = distinct // max(kinds, 1)
    commonest = np.zeros(n)
    np.maximum.at(commonest, distinct, np.bincount(pair, minlength=len(distinct)))

    # Lines: between line feeds and ends of texts; those of one byte are empty or nearly so.
    cuts = np.union1d(np.nonzero(data == 0x0A)[0] + 1, offsets)
    repeated = np.zeros(n)
    if len(cuts) > 1:
        line_owner, long = owner[cuts[:-1]], np.diff(cuts) > 1
        lines, kinds = _distinct(_strings(data, cuts))
        own = pd.unique((line_owner * kinds + lines)[long]) // kinds
        repeated = np.bincount(line_owner[long], minlength=n) - np.bincount(own, minlength=n)

    filled = np.maximum(size, 1)
    share = {name: histogram @ chosen / filled for name, chosen in _CLASSES.items()}
    breaks = histogram[:, 0x0A]
    p = histogram / filled[:, None]
    entropy = -(p * np.log(np.where(p > 0, p, 1))).sum(1)

    def log(x: np.ndarray, least: float) -> np.ndarray:
        return np.log(x + least)

    columns = {
        "words": log(words, 1), "word length": log(mean, 1), "word length spread": log(spread, 1),
        "line breaks": log(breaks / some, 0.01), "same word again": log(again / some, 0.01),
        # The number of distinct words grows more slowly than that of words.
        "distinct words": log(np.bincount(distinct, minlength=n) / some**0.8, 0.1),
        "commonest word": log(commonest / some, 0.01), "repeated lines": log(repeated / (breaks + 1), 0.02),
        "byte entropy": entropy} | {name: log(x, 0.002) for name, x in share.items()}
    return np.stack([columns[name] for name in STATISTICS], axis=1)


def measured_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: statistics of every row's whole text, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in text_slices(batches, SLICE):
            found = measure(some.column("text"))
            ends = np.arange(len(found) + 1, dtype=np.int32) * len(STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, docs.select("doc_id").schema.add("x", ArrayType(DoubleType())))


@dataclass
class Discriminant:
    """Log prior, mean and cached Cholesky factor (as its inverse, and the logarithm of its determinant) of both classes."""

    center: np.ndarray
    scale: np.ndarray
    prior: np.ndarray
    means: np.ndarray
    inverse: np.ndarray
    log_det: np.ndarray
    params: QualityParams

    @classmethod
    def fit(cls, counts: np.ndarray, sums: np.ndarray, products: np.ndarray, params: QualityParams) -> Discriminant:
        """From number of rows, sums of statistics and sums of their products, by class; both classes have rows."""
        total = counts.sum()
        center = sums.sum(0) / total
        scale = np.sqrt(np.maximum(np.diag(products.sum(0)) / total - center**2, params.floor))
        means = (sums / counts[:, None] - center) / scale
        own = np.stack([
            (products[k] / counts[k] - np.outer(sums[k], sums[k]) / counts[k]**2) / np.outer(scale, scale) for k in (0, 1)])
        pooled = np.tensordot(counts / total, own, 1)
        factors = []
        for covariance in own:
            covariance = (1 - params.shared) * covariance + params.shared * pooled
            diagonal = np.diag(np.maximum(np.diag(covariance), params.floor))
            factors.append(np.linalg.cholesky((1 - params.diagonal) * covariance + params.diagonal * diagonal + params.floor * np.eye(len(center))))
        return cls(center, scale, np.log(counts / total), means, np.stack([np.linalg.inv(f) for f in factors]),
                   np.array([np.log(np.diag(f)).sum() for f in factors]), params)

    def score(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.center) / self.scale, -self.params.limit, self.params.limit)
        density = [self.prior[k] - self.log_det[k] - 0.5 * (((x - self.means[k]) @ self.inverse[k].T)**2).sum(1) for k in (0, 1)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def is_held_out() -> Column:
    """Rows that are never learned from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(measured: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> Discriminant | float:
    """A model from all labelled rows of ``measured`` (``measured_documents``) that are not held out.

    An id that is labelled both ways, or neither 0 nor 1, is not learned from. With rows of one class only, the model is that
    class as a number, and without any, 0.5.
    """
    known = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & ~is_held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    size = len(STATISTICS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, size)
            quality = batch.column("quality").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = x[quality == k]
                found[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        label, place = np.indices(found.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(label.ravel().astype(np.int32)), pa.array(place.ravel().astype(np.int32)), pa.array(found.ravel())],
            names=["label", "place", "value"])

    rows = measured.join(known.select("doc_id", "quality"), "doc_id").select("quality", "x").mapInArrow(
        sums, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("value")).collect()
    found = np.zeros((2, 1 + size + size * size))  # as many numbers reach the driver, whatever the table
    for row in rows:
        found[row.label, row.place] = row.value
    counts = found[:, 0]
    if not counts.all():
        return float(counts[1] > 0) if counts.any() else 0.5
    return Discriminant.fit(counts, found[:, 1:1 + size], found[:, 1 + size:].reshape(2, size, size), params)


def score_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row, from the whole text alone.

    A null text scores as an empty one, which has statistics like any other. Repeated rows get equal scores, other columns are
    ignored, an empty table gives an empty result; without labels of both classes see ``fit``.
    """
    measured = materialize(measured_documents(docs), "quality-statistics")
    model = fit(measured, labels, params)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for x in batches:
            if isinstance(own, Discriminant):
                yield pd.Series(own.score(np.array(x.to_list()).reshape(len(x), len(STATISTICS))))
            else:
                yield pd.Series(np.full(len(x), own))

    return measured.select("doc_id", is_held_out().alias("held_out"), score("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= params.threshold).cast("int"))
