from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zoneflow.llm import token_alignment as A

FIRST, SECOND = (Path(public_tokenizers.path(n)).read_bytes() for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "hello world", "hello world", "Hello  world\n\n\t tabs", "schön über größer ñandú été", "日本語のテキスト 中文",
    "<|endoftext|> <s> </s> <unk> <0x41>", "x" * 3000, "a▁b", " leading", "trailing ", "don't we'll 12345 67890123456",
    "à 👩‍👩‍👧 ​\xa0z", "ﬁne ① Å", "\x00\x01", "\r\n", " ".join(f"word{i}" for i in range(3000)), "of the and the of the the",
]


def plain_sides():
    """Ids and bytes of either side, worked out by the libraries alone."""
    first, second = Tokenizer.from_buffer(FIRST), sentencepiece.SentencePieceProcessor(model_proto=SECOND)
    first.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in printable}
    signs |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}

    def one(text):
        ids = first.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(signs[c] for c in first.id_to_token(i))) for i in ids]

    def two(text):
        pieces = [(i, second.id_to_piece(i)) for i in second.encode(text)]
        return [(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()) for i, p in pieces]

    return one, two


def brute_force(texts):
    one, two = plain_sides()
    found, counts = [], Counter()
    for text in texts:
        sides = [one(text), two(text)] if text else [[], []]
        if any(b"".join(x for _, x in side) != b" " + (text or "").encode() for side in sides):
            sides = [[], []]
        spans = []
        for side in sides:
            at, own = 0, []
            for i, data in side:
                own.append((i, at, at + len(data)))
                at += len(data)
            spans.append(own)
        links, first = [], 0
        for i, s, e in spans[0]:  # tokens that end before this one are done with
            while first < len(spans[1]) and spans[1][first][2] <= s:
                first += 1
            for j, t, f in spans[1][first:]:
                if t >= e:
                    break
                links.append((i, j))
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = [
            "|".join(",".join(str(i) for i, _, e in side if before < e <= cut) for side in spans) for before, cut in zip([0, *cuts], cuts, strict=False)
        ] if len(cuts) < 200 else None
        found.append((spans, links, len(cuts), groups))
        counts.update(set(links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    return [(
        len(spans[0]), len(spans[1]), cuts, len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links),
        None if groups is None else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for spans, links, cuts, groups in found]


@pytest.mark.parametrize("hot", [0, 40, 1 << 20])
def test_equals_brute_force(spark, hot):
    """With no pair sent to every task, with some and with all."""
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").withColumn("pairs", F.lit("x")).withColumn("row", F.lit(1))
    got = A.align_tokens(docs.repartition(3), FIRST, SECOND, A.AlignParams(hot)).orderBy("doc_id").collect()
    want = brute_force(TEXTS)
    assert [r.doc_id for r in got] == list(range(len(TEXTS)))
    for r, w, text in zip(got, want, TEXTS, strict=True):
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[:6], text
        assert w[6] is None or r.groups_sha256 == w[6], text
    assert sum(r.n_a == 0 for r in got) == 3 and got[9].n_a > 0


def test_hot_limit(spark):
    pairs = spark.createDataFrame([(i, n) for i, n in enumerate([1, 1, 2, 3, 5, 9, 9, 20])], "pair long, n long")
    assert [A._hot_limit(pairs, most) for most in (0, 1, 3, 4, 5, 8)] == [32, 16, 8, 4, 4, 1]


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "hello world"), (1, "hello world"), (1, "hello world"), (2, None)], "doc_id long, text string")
    rows = A.align_tokens(docs, FIRST, SECOND).collect()
    assert sorted((r.doc_id or 0, r.n_links, r.count_sum) for r in rows) == [(0, 3, 9), (1, 3, 9), (1, 3, 9), (2, 0, 0)]
    assert A.align_tokens(docs.limit(0), FIRST, SECOND).collect() == []


def test_chunks_encode_like_whole_texts():
    worker = A.Sides(FIRST, SECOND)
    assert worker.apart
    draw = random.Random(11)
    signs = ["a", "Ab", " ", "  ", "\n", "\r", "\t", "\xa0", ".", ");", "'s", "12", "é", "中", "<s>", "▁", "\u0301", "*/"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    chunked = worker.encode(texts)
    worker.forget()
    worker.apart = False
    whole = worker.encode(texts)
    for side, other in zip(chunked, whole, strict=True):
        assert all((x == y).all() for x, y in zip(side, other, strict=True))
    assert chunked[0][1].astype(bool).sum() > 1000
