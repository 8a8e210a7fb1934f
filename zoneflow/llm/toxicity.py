"""Toxicity: a bidirectional gated recurrent network with attention pooling, over all overlapping windows of a text.

Each token has a word input and character inputs. The word input says how much more often documents labelled toxic hold the
word; the character inputs say the same of the token's character n-grams, so that words never seen still count. These weights
come from one part of the labelled sample and the network from the other part, so it learns how far they can be trusted.
The network is trained in numpy on the driver, from a bounded sample; tasks get its few weights and score whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import hashed_sample

_WORD = re.compile(r"[^\W_]+")
BUCKETS = 1 << 20
INPUTS = 6
#: Characters of text that a task scores at a time, and words whose inputs it remembers.
SLICE = 1 << 20
STORE = 100_000
#: Windows that are scored at a time, so that their states stay in a core's cache.
DENSE = 4096
#: Longer runs of letters and digits, as in scripts without spaces, are cut into tokens of so many characters, each of which
#: starts with the last characters of the one before.
LONGEST, SHARED = 64, 16


@dataclass(frozen=True)
class ToxicityParams:
    """``max_toxic`` and ``max_clean`` bound the labelled rows that are learned from, ``max_chars`` the length of each.
    ``stride`` lies between windows that are learned from; a text is always scored by the windows from each word on."""

    window: int = 24
    stride: int = 1
    hidden: int = 6
    max_toxic: int = 1500
    max_clean: int = 3500
    max_chars: int = 20_000
    steps: int = 300
    batch: int = 256
    rate: float = 0.02
    clean_windows: int = 3


def words_of(text: str | None) -> list[str]:
    words = _WORD.findall((text or "").lower())
    if not words or len(max(words, key=len)) <= LONGEST:
        return words
    return [part for word in words for part in (
        [word] if len(word) <= LONGEST else [word[k:k + LONGEST] for k in range(0, len(word) - SHARED, LONGEST - SHARED)])]


def _hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Buckets of words and of their character n-grams, for all words at once.

    Returns the bucket of each word, where each word starts among the bytes of all (``<`` and ``>`` around each), and for
    n = 3, 4, 5 the bucket of the n-gram that starts at each byte, -1 where it would leave the word.
    """
    data = [b"<%b>" % word.encode("utf-8", "replace") for word in words]
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    left = np.repeat(starts + lengths, lengths) - np.arange(len(flat))  # bytes to the word's end
    rolled, factor, grams = flat.copy(), np.uint64(0x9E3779B97F4A7C15), []
    for n in range(2, 6):
        rolled = rolled * factor
        rolled[: len(flat) - n + 1] += flat[n - 1:]
        if n > 2:
            mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            grams.append(np.where(left >= n, (mixed >> np.uint64(44)).astype(np.int64), -1))
    power = np.cumprod(np.full(int(lengths.max()), factor, np.uint64))
    whole = np.add.reduceat(flat * power[np.arange(len(flat)) - np.repeat(starts, lengths)], starts)
    return ((whole ^ (whole >> np.uint64(31))) * factor >> np.uint64(44)).astype(np.int64), starts, grams


class Inputs:
    """Token inputs from log-odds of words and character n-grams."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights
        self.clear()

    def clear(self) -> None:
        self.store: dict[str, int] = {}
        self.matrix = np.empty((0, INPUTS), np.float32)

    @classmethod
    def count(cls, texts: list[str], toxic: np.ndarray) -> Inputs:
        """Log-odds by bucket, over documents that hold it, shrunk where few do."""
        counts = np.zeros((2, BUCKETS))
        for text, label in zip(texts, toxic, strict=True):
            if distinct := set(words_of(text)):
                own, _, grams = _hashes(list(distinct))
                held = np.unique(np.concatenate([own, *grams]))
                counts[int(label), held[held >= 0]] += 1
        total = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
        share = (counts + 0.5) / (total[:, None] + 1)
        seen = counts.sum(0)
        weights = np.log(share[1] / share[0]) * seen / (seen + 4)
        weights[seen == 0] = 0
        return cls(weights.astype(np.float32))

    def of(self, words: list[str]) -> np.ndarray:
        """Row of each word in ``matrix``; words met before are looked up, new ones are appended."""
        if not words:
            return np.zeros(0, np.int64)
        codes, distinct = pd.factorize(np.array(words, dtype=object))
        new = [word for word in distinct if word not in self.store]
        if new:  # the matrix grows once for many words
            self.store.update(zip(new, range(len(self.store), len(self.store) + len(new)), strict=True))
            self.matrix = np.concatenate([self.matrix, self._inputs(new)])
        rows = np.fromiter(map(self.store.__getitem__, distinct), np.int64, len(distinct))
        return rows[codes]

    def _inputs(self, words: list[str]) -> np.ndarray:
        own, starts, grams = _hashes(words)
        padded = np.append(self.weights, np.float32(0))  # bucket -1
        values = [padded[g] for g in grams]
        most = [np.maximum.reduceat(v, starts) for v in values]
        number = np.add.reduceat(sum((g >= 0).astype(np.float32) for g in grams), starts)
        mean = np.add.reduceat(sum(values), starts) / np.maximum(number, 1)
        length = np.minimum(np.fromiter(map(len, words), np.float32, len(words)), 20) / 10 - 0.5
        return np.stack([self.weights[own] / 4, *(m / 4 for m in most), mean, length], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _logistic(x: np.ndarray) -> np.ndarray:
    """In place, the logistic function of -x."""
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    """In place, the hyperbolic tangent of x / -2."""
    _logistic(x)
    x *= 2
    x -= 1
    return x


class Network:
    """Two gated recurrent layers, one per direction, attention over their joint states, one logit per window."""

    def __init__(self, hidden: int, weights: dict[str, np.ndarray] | None = None) -> None:
        self.hidden = hidden
        if weights is None:
            rng = np.random.default_rng(3)
            size = lambda *shape: rng.normal(0, 0.4 / np.sqrt(shape[0]), shape)
            weights = {}
            for way in "fb":
                weights |= {f"W{way}": size(INPUTS, 3 * hidden) * 2, f"U{way}": size(hidden, 3 * hidden), f"c{way}": np.zeros(3 * hidden)}
            weights |= {"A": size(2 * hidden, hidden), "a": np.zeros(hidden), "v": size(hidden), "w": size(2 * hidden), "o": np.zeros(1)}
        self.weights = weights

    def _run(self, way: str, inputs: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States (windows x steps x hidden) of one direction; ``inputs`` are already projected to the three gates."""
        n, steps, _ = inputs.shape
        h, size = np.zeros((n, self.hidden), inputs.dtype), self.hidden
        U = self.weights[f"U{way}"].astype(inputs.dtype)
        states, trace = np.empty((n, steps, size), inputs.dtype), []
        for t in range(steps) if way == "f" else reversed(range(steps)):
            x, m = inputs[:, t], mask[:, t, None]
            u = h @ U
            gates = _sigmoid(x[:, :2 * size] + u[:, :2 * size])
            z, r = gates[:, :size], gates[:, size:]
            new = np.tanh(x[:, 2 * size:] + r * u[:, 2 * size:])
            following = m * (new + z * (h - new)) + (1 - m) * h
            if keep:
                trace.append((t, h, z, r, new, u[:, 2 * size:], m))
            h = following
            states[:, t] = h
        return states, trace

    def project(self, matrix: np.ndarray, way: str) -> np.ndarray:
        return (matrix @ self.weights[f"W{way}"] + self.weights[f"c{way}"]).astype(np.float32)

    def _pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
        w = {k: self.weights[k].astype(states.dtype) for k in "Aavwo"}
        u = np.tanh(states @ w["A"] + w["a"])
        e = np.where(mask > 0, u @ w["v"], -1e9)
        alpha = np.exp(e - e.max(1, keepdims=True))
        alpha /= alpha.sum(1, keepdims=True)
        pooled = (alpha[:, None, :] @ states)[:, 0]
        return pooled @ w["w"] + w["o"], pooled, alpha, u

    def logits(self, projected: tuple[np.ndarray, np.ndarray], mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._run(w, x, mask, False)[0] for w, x in zip("fb", projected, strict=True)], axis=2)
        return self._pool(states, mask)[0]

    def dense_logits(self, projected: tuple[np.ndarray, np.ndarray], window: int) -> np.ndarray:
        """Logits of the windows from every token on, for tokens (projected inputs x tokens): as ``logits``, without copies.

        All windows take their t-th step at once, on a slice of the tokens. Attention is bounded by tanh, so its exponentials
        need no maximum.
        """
        w = {k: v.astype(np.float32) for k, v in self.weights.items()}
        size, n = self.hidden, projected[0].shape[1] - window + 1
        # sigmoid(x) = 1 / (1 + exp(-x)) and tanh(x) = 2 / (1 + exp(-2 x)) - 1: the factors go into the weights
        factor = np.where(np.arange(3 * size) < 2 * size, -1, -2).astype(np.float32)[:, None]
        A, a = np.ascontiguousarray(w["A"].T) * np.float32(-2), w["a"][:, None] * np.float32(-2)
        forward = np.empty((window, size, n), np.float32)
        both = np.empty((2 * size, n), np.float32)
        total, weighted = np.zeros(n, np.float32), np.zeros(n, np.float32)
        with np.errstate(over="ignore"):
            for k, way in enumerate("fb"):
                U, inputs = np.ascontiguousarray(w[f"U{way}"].T) * factor, projected[k] * factor
                h = None
                for t in range(window) if way == "f" else reversed(range(window)):
                    x = inputs[:, t:t + n]
                    if h is None:  # the state before the first step is zero
                        update = _logistic(x[:size].copy())
                        new = _tanh(x[2 * size:].copy())
                        h = np.multiply(update, new, out=update)
                        np.subtract(new, h, out=h)
                    else:
                        u = U @ h
                        gates, new = u[:2 * size], u[2 * size:]
                        gates += x[:2 * size]
                        _logistic(gates)
                        new *= gates[size:]
                        new += x[2 * size:]
                        _tanh(new)
                        h -= new
                        h *= gates[:size]
                        h += new
                    if way == "f":
                        forward[t] = h
                        continue
                    both[:size], both[size:] = forward[t], h
                    e = A @ both
                    e += a
                    e = np.exp(w["v"] @ _tanh(e))
                    total += e
                    weighted += e * (w["w"] @ both)
        return weighted / total + w["o"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted cross-entropy and its gradient, by back-propagation through time."""
        W, size = self.weights, self.hidden
        runs = {w: self._run(w, x @ W[f"W{w}"] + W[f"c{w}"], mask, True) for w in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        logit, pooled, alpha, u = self._pool(states, mask)
        p = _sigmoid(logit)
        total = weight.sum()
        loss = -(weight * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / total
        d = weight * (p - y) / total
        g = {"w": pooled.T @ d, "o": d.sum(keepdims=True)}
        d_pooled = d[:, None] * W["w"]
        d_alpha = (states @ d_pooled[:, :, None])[:, :, 0]
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(1, keepdims=True))
        g["v"] = np.einsum("nt,nth->h", d_e, u)
        d_u = d_e[:, :, None] * W["v"] * (1 - u**2)
        g["A"] = np.einsum("nts,nth->sh", states, d_u)
        g["a"] = d_u.sum((0, 1))
        d_states = alpha[:, :, None] * d_pooled[:, None, :] + d_u @ W["A"].T
        for k, way in enumerate("fb"):
            own = d_states[:, :, k * size:(k + 1) * size]
            g[f"W{way}"], g[f"U{way}"], g[f"c{way}"] = (np.zeros_like(W[f"{n}{way}"]) for n in "WUc")
            d_h = np.zeros((len(x), size))
            for t, h, z, r, new, un, m in reversed(runs[way][1]):
                d_h = d_h + own[:, t]
                d_out = d_h * m
                d_new = d_out * (1 - z) * (1 - new**2)
                d_z = d_out * (h - new) * z * (1 - z)
                d_r = d_new * un * r * (1 - r)
                d_gates = np.concatenate([d_z, d_r, d_new], axis=1)
                d_u_gates = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g[f"W{way}"] += x[:, t].T @ d_gates
                g[f"c{way}"] += d_gates.sum(0)
                g[f"U{way}"] += h.T @ d_u_gates
                d_h = d_h * (1 - m) + d_out * z + d_u_gates @ W[f"U{way}"].T
        return loss, g


def windows(n: int, params: ToxicityParams) -> np.ndarray:
    """Start of every window that is learned from: all ``n`` words are covered, neighbours overlap, the last ends with the text."""
    last = max(0, n - params.window)
    starts = np.arange(0, last + 1, params.stride)
    return starts if starts[-1] == last else np.append(starts, last)


@dataclass
class Classifier:
    inputs: Inputs
    network: Network
    params: ToxicityParams

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Highest window score of each text; a text without words scores 0. Equal texts are scored once."""
        codes, texts = pd.factorize(np.array([text or "" for text in texts], dtype=object))
        scores = np.zeros(len(texts))
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at] or "")
            while end < len(texts) and size + len(texts[end] or "") <= SLICE:
                size += len(texts[end] or "")
                end += 1
            scores[at:end] = self._score([words_of(t) for t in texts[at:end]])
            at = end
        return scores[codes]

    def _score(self, docs: list[list[str]]) -> np.ndarray:
        if len(self.inputs.store) > STORE:
            self.inputs.clear()
        rows = self.inputs.of([w for words in docs for w in words])
        if not len(rows):
            return np.zeros(len(docs))
        tables = [self.network.project(self.inputs.matrix, way) for way in "fb"]
        sizes, span = np.fromiter(map(len, docs), np.int64, len(docs)), self.params.window
        ends, best, step = np.cumsum(sizes), np.full(len(docs), -np.inf), np.arange(span)
        owner = np.nonzero((sizes > 0) & (sizes < span))[0]  # one window, shorter than the others
        for k in range(0, len(owner), 2048):
            some = owner[k:k + 2048]
            mask = (step[None, :] < sizes[some, None]).astype(np.float32)
            tokens = rows[np.minimum((ends - sizes)[some, None] + step[None, :], len(rows) - 1)]
            best[some] = self.network.logits(tuple(t[tokens] for t in tables), mask)
        owner = np.nonzero(sizes >= span)[0]
        if len(owner):
            tokens = rows[np.repeat(sizes >= span, sizes)]
            found = np.append(self._dense(tables, tokens), np.float32(-np.inf))
            # Windows across the border of two texts belong to neither.
            first = np.cumsum(sizes[owner]) - sizes[owner]
            bounds = np.stack([first, first + sizes[owner] - span + 1], axis=1).ravel()
            best[owner] = np.maximum.reduceat(found, bounds)[::2]
        return _sigmoid(best)

    def _dense(self, tables: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
        """Logits of all whole windows of one row of tokens."""
        span = self.params.window
        found = np.empty(max(0, len(tokens) - span + 1), np.float32)
        for k in range(0, len(found), DENSE):
            some = tokens[k:min(k + DENSE, len(found)) + span - 1]
            found[k:k + DENSE] = self.network.dense_logits(tuple(np.ascontiguousarray(t[some].T) for t in tables), span)
        return found


def train(texts: list[str], toxic: np.ndarray, params: ToxicityParams = ToxicityParams()) -> Classifier | None:
    """A classifier from labelled texts; None without both classes. Deterministic for one list of rows."""
    toxic = np.asarray(toxic, int)
    if len(set(toxic.tolist())) < 2:
        return None
    rng = np.random.default_rng(11)
    order = rng.permutation(len(texts))
    counted, learned = (np.concatenate([order[toxic[order] == c][k::2] for c in (0, 1)]) for k in (0, 1))
    if len(set(toxic[learned].tolist())) < 2:
        learned = counted
    inputs = Inputs.count([texts[i] for i in counted], toxic[counted])
    model = Classifier(inputs, Network(params.hidden), params)
    begins, sizes, doc, label = [], [], [], []
    step = np.arange(params.window)
    words = [words_of(texts[i]) for i in learned]
    ends = np.cumsum([0, *map(len, words)])
    rows_of = inputs.of([w for some in words for w in some])
    for k in range(len(learned)):
        if n := len(words[k]):
            starts = windows(n, params)
            begins.append(starts + ends[k])
            sizes.append(np.full(len(starts), min(n, params.window)))
            doc.append(np.full(len(starts), k))
            label.append(np.full(len(starts), toxic[learned[k]]))
    begins, sizes, doc, label = map(np.concatenate, (begins, sizes, doc, label))
    spans = lambda some: rows_of[np.minimum(begins[some, None] + step, len(rows_of) - 1)]
    masks = lambda some: (step < sizes[some, None]).astype(float)
    short, whole = np.nonzero(sizes < params.window)[0], np.nonzero(sizes == params.window)[0]
    matrix = inputs.matrix.astype(float)
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in model.network.weights.items()}
    # A toxic document stands in its most suspicious window; a clean one in its most suspicious and some others.
    top = matrix[:, :3].max(1)[rows_of]
    suspicion = np.full(len(begins), -np.inf)
    for t in range(params.window):
        suspicion = np.maximum(suspicion, np.where(t < sizes, top[np.minimum(begins + t, len(top) - 1)], 0))
    ticks, epoch, looked = 0, 0, 0
    while ticks < params.steps:
        if epoch and ticks >= params.steps * looked // 8:  # look for the windows anew, ever less often
            looked = 2 * looked or 1
            tables = [model.network.project(matrix, way) for way in "fb"]
            for k in range(0, len(short), 4096):
                some = short[k:k + 4096]
                suspicion[some] = model.network.logits(tuple(t[spans(some)] for t in tables), masks(some).astype(np.float32))
            if len(whole):
                suspicion[whole] = model._dense(tables, rows_of)[begins[whole]]
        epoch += 1
        ranked = np.lexsort((-suspicion, doc))
        place = np.arange(len(doc)) - np.searchsorted(doc[ranked], doc[ranked])
        extra = rng.random(len(doc)) * np.maximum(1, np.bincount(doc)[doc]) < params.clean_windows
        chosen = ranked[(place == 0) | ((label[ranked] == 0) & extra)]
        rng.shuffle(chosen)
        for k in range(0, len(chosen), params.batch):
            some = chosen[k:k + params.batch]
            y = label[some].astype(float)
            _, g = model.network.gradients(matrix[spans(some)], masks(some), y, np.where(y == 1, 2.0, 1.0))
            ticks += 1
            for name, grad in g.items():
                first, second = moments[name]
                first += 0.1 * (grad - first)
                second += 0.01 * (grad**2 - second)
                change = first / (1 - 0.9**ticks) / (np.sqrt(second / (1 - 0.99**ticks)) + 1e-8)
                model.network.weights[name] = model.network.weights[name] - params.rate * 0.2 ** (ticks / params.steps) * change
    inputs.clear()
    return model


def is_held_out() -> F.Column:
    """Rows that are never learned from; a null id counts as an empty one, which is held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> Classifier | None:
    """Trains on a bounded sample of labelled rows that are not held out: those with the smallest hashes of their ids."""
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & ~is_held_out())
    hashed = known.withColumn("order", F.xxhash64("doc_id"))
    chosen = [
        hashed_sample(hashed.filter(F.col("toxic") == label), F.col("order"), bound)
        for label, bound in ((1, params.max_toxic), (0, params.max_clean))
    ]
    # At most max_toxic + max_clean ids: bounded, so they may be broadcast.
    ids = chosen[0].unionByName(chosen[1]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("order").alias("order"))
    short = docs.select("doc_id", "text").filter(F.length("text") <= params.max_chars)
    rows = short.join(F.broadcast(ids), "doc_id").orderBy("order", "doc_id", "text").limit(
        params.max_toxic + params.max_clean).select("text", "toxic").collect()
    return train([r.text for r in rows], np.array([r.toxic for r in rows]), params)


def score_toxicity(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row, from the whole text alone.

    A null or empty text, and one without words, scores 0. Without a model (no labelled rows of both classes) all texts
    score 0. Other columns are ignored, repeated rows get equal scores, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series(own.score(texts.tolist()) if own else np.zeros(len(texts)))

    return docs.select("doc_id", "text").select(
        "doc_id", is_held_out().alias("held_out"), score("text").alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
