from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import toxicity as tox

PARAMS = tox.ToxicityParams(steps=120)


def made(n: int, seed: int = 1):
    """Prose, some with made-up insults, spelled in several ways."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioutnsrl") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    rows = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 160))]
        toxic = int(rng.random() < 0.3)
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["vexquib", "grobzak"]) + rng.choice(["", "s", "!", "ing", "ed."]))
        rows.append((" ".join(text).capitalize(), toxic))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = made(500)
    return tox.train([t for t, _ in rows], np.array([y for _, y in rows]), PARAMS)


def test_held_out_accuracy(model):
    rows = made(300, seed=2)
    scores = model.score([t for t, _ in rows])
    assert np.mean((scores >= 0.5) == [y == 1 for _, y in rows]) > 0.97


def test_whole_text_counts_and_slices_do_not(model, monkeypatch):
    clean, toxic = " ".join(t for t, y in made(40, 3) if not y), " you vexquib!"
    long = clean * 30
    texts = [long, long + toxic, toxic + long, long + toxic + long, None, "", "123 ...", "vexquib"]
    scores = model.score(texts)
    assert (scores[:4] >= 0.5).tolist() == [False, True, True, True]
    assert scores[4] == scores[5] == 0 and scores[7] > 0.5
    monkeypatch.setattr(tox, "SLICE", 100)
    monkeypatch.setattr(tox, "STORE", 10)
    assert np.allclose(model.score(texts), scores, atol=1e-6)


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(0)
    net = tox.Network(3)
    x, mask = rng.normal(size=(4, 5, tox.INPUTS)), np.ones((4, 5))
    mask[0, 3:] = 0
    y, weight = np.array([0.0, 1, 1, 0]), np.array([1.0, 2, 1, 1])
    _, grads = net.gradients(x, mask, y, weight)
    for name, grad in grads.items():
        for _ in range(4):
            at = tuple(rng.integers(s) for s in net.weights[name].shape)
            old, values = net.weights[name][at], []
            for step in (1e-5, -1e-5):
                net.weights[name][at] = old + step
                values.append(net.gradients(x, mask, y, weight)[0])
            net.weights[name][at] = old
            assert (values[0] - values[1]) / 2e-5 == pytest.approx(grad[at], rel=1e-3, abs=1e-7)


def test_windows_cover_all_words():
    for n in (1, 23, 24, 25, 40, 41, 1000):
        starts = tox.windows(n, PARAMS)
        covered = {i for s in starts for i in range(s, min(n, s + PARAMS.window))}
        assert covered == set(range(n))
        assert n <= PARAMS.window or (np.diff(starts) < PARAMS.window).all()


def test_fit_learns_from_no_held_out_row(spark):
    """Held-out rows are labelled upside down: it would show if one were learned from."""
    rows = [(i, t, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, (t, y) in enumerate(made(500))]
    docs = spark.createDataFrame([(i, t, y, "en", "s") for i, t, y in rows] + [(None, None, 0, None, None)],
                                 "doc_id long, text string, score int, lang string, source string")
    labels = spark.createDataFrame([(i, y, y) for i, _, y in rows] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    found = tox.score_toxicity(docs, tox.fit(docs, labels, PARAMS)).collect()
    assert len(found) == len(rows) + 1
    got = {r.doc_id: r for r in found}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    wrong = [i for i, _, y in rows if got[i].held_out and got[i].predicted == y]
    assert len(wrong) < 0.05 * sum(got[i].held_out for i, _, _ in rows)
    assert (got[None].score, got[None].predicted) == (0.0, 0)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "text"), (1, "text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tox.fit(docs, none) is None
    assert [r.score for r in tox.score_toxicity(docs, None).collect()] == [0.0, 0.0]
    assert tox.score_toxicity(docs.limit(0), None).collect() == []
    assert tox.score_toxicity(docs.withColumn("predicted", F.lit("x")), None).columns == ["doc_id", "held_out", "score", "predicted"]


def test_long_runs_are_read_to_their_end(model):
    run = "aeioutnsrl" * 30
    tokens = tox.words_of(f"some {run} words")
    assert tokens[0] == "some" and tokens[-1] == "words" and max(map(len, tokens)) <= tox.LONGEST
    assert tokens[1] + "".join(t[tox.SHARED:] for t in tokens[2:-1]) == run
    assert tox.words_of("x" * 64) == ["x" * 64] and len(tox.words_of("x" * 65)) == 2
    early, late, none = model.score(["vexquib" * 3 + run, run + "vexquib" * 3, run])
    assert late > none and late == pytest.approx(early, abs=0.2)


def test_every_window_is_scored(model, monkeypatch):
    """The highest score of all windows, each scored by itself as a text of its own."""
    monkeypatch.setattr(tox, "DENSE", 50)
    texts = [t for t, _ in made(40, 5)]
    want = []
    for text in texts:
        words = tox.words_of(text)
        every = [" ".join(words[k:k + PARAMS.window]) for k in range(max(1, len(words) - PARAMS.window + 1))]
        rows = model.inputs.of([w for part in every for w in part.split()])
        tables = [model.network.project(model.inputs.matrix, way) for way in "fb"]
        size = len(every[0].split())
        logits = model.network.logits(tuple(t[rows.reshape(-1, size)] for t in tables), np.ones((len(every), size), np.float32))
        want.append(1 / (1 + np.exp(-float(logits.max()))))
    assert any(len(tox.words_of(t)) < PARAMS.window for t in texts) and any(len(tox.words_of(t)) > 2 * PARAMS.window for t in texts)
    assert np.allclose(model.score(texts), want, atol=1e-5)
