from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from zoneflow.llm import line_templates
from zoneflow.llm.line_templates import TemplateParams, drop_recurring_lines, line_report

SCHEMA = "doc_id long, text string"


def masked(line):
    return tuple("<*>" if any(c in "0123456789" for c in t) else t for t in line.split())


def brute_force(docs, params=TemplateParams()):
    """Texts that stay, by comparing whole token lists; equal rows count once, other ids are unique."""
    docs = list(dict(docs).items())
    lines = {i: [masked(x) for x in (t or "").split("\n")] for i, t in docs}
    holds = lambda x: len(x) >= params.min_tokens and sum(t != "<*>" for t in x[params.depth:]) >= max(
        params.min_named, params.min_constant * (len(x) - params.depth))
    docs_of = defaultdict(set)
    for i, own in lines.items():
        for x in filter(holds, own):
            docs_of[x].add(i)
    leaf = lambda x: (len(x), x[: params.depth])
    exact = {x for x, ids in docs_of.items() if len(ids) >= params.min_docs}
    leaves = Counter(leaf(x) for i, own in lines.items() for x in set(filter(holds, own)))
    rest = {(i, x) for x, ids in docs_of.items() if x not in exact and leaves[leaf(x)] >= params.min_docs for i in ids}
    at = Counter((leaf(x), p, t) for i, x in rest for p, t in enumerate(x))
    shape = {}
    for _, x in rest:
        constant = tuple((p, t) for p, t in enumerate(x) if at[leaf(x), p, t] >= params.min_docs)
        named = sum(p >= params.depth and t != "<*>" for p, t in constant)
        if len(constant) >= params.min_constant * len(x) and named >= max(
                params.min_named, params.min_constant * (len(x) - params.depth)):
            shape[x] = (leaf(x), constant)
    shape_docs = defaultdict(set)
    for i, x in rest:
        if x in shape:
            shape_docs[shape[x]].add(i)
    whole = lambda raw: " ".join(raw.split())
    same = defaultdict(set)
    for i, text in docs:
        for raw in (text or "").split("\n"):
            same[whole(raw)].add(i)
    same.pop("", None)
    out = {}
    for i, text in docs:
        if text is None:
            out[i] = None
            continue
        stay = []
        for raw, x in zip(text.split("\n"), lines[i], strict=True):
            ids = docs_of[x] if x in exact else shape_docs[shape[x]] if (i, x) in rest and x in shape else set()
            again = same.get(whole(raw), set())
            least = params.exact_docs if len(whole(raw).encode()) >= params.exact_bytes else params.min_docs
            gone = holds(x) and len(ids) >= params.min_docs and min(ids) != i
            if not gone and not (len(again) >= least and min(again) != i):
                stay.append(raw)
        out[i] = "\n".join(stay)
    return out


def made():
    docs = []
    for i in range(40):
        lines = [f"unique words of document number d{chr(97 + i % 26)}{chr(97 + i // 26)} here {'x' * i}y"]
        if i % 2:
            lines.append("All rights reserved by the authors")
        if i % 3 == 0:
            lines.append(f"Page {i} of {i * 7} printed on day {i}")
        if i % 4 == 0:
            lines += [f"Posted by the user {chr(97 + i % 26)}ob in our forum", "", "Short line"]
        if i in (5, 6):
            lines.append("This line stands in two documents only")
        docs.append((i * 3, "\n".join(lines)))
    return docs + [(900, None), (901, ""), (902, "All rights reserved by the authors"), (903, "\t All  rights reserved by the authors\nAll rights reserved by the authors")]


def test_against_brute_force(spark):
    docs = made()
    want = brute_force(docs)
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("line", F.lit("x")).withColumn("key", F.lit(1)).withColumn("n_chars", F.lit(-1).cast("long"))
    kept = drop_recurring_lines(frame)
    assert kept.columns == frame.columns
    got = {r.doc_id: r for r in kept.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert {i: r.n_chars for i, r in got.items()} == {i: -1 if t is None else len(t) for i, t in want.items()}
    assert got[3].text.endswith("All rights reserved by the authors")  # the first document keeps the line
    assert "rights" not in got[9].text and got[902].text == "" == got[903].text
    assert "Page 9" not in got[27].text and "Page 0" in got[0].text
    assert "user" in got[0].text and "user" not in got[12].text
    assert "two documents" in got[18].text
    report = {r.doc_id: r for r in line_report(frame).collect()}
    assert report[902].n_lines == report[902].n_dropped == 1
    assert report[900].text is None


def test_doubling_every_row_changes_no_verdict(spark):
    """Five of nine tokens constant are too few, and four documents too, however often their rows stand."""
    part = lambda i, k: "".join(chr(97 + (i * 7 + k * 3 + j) % 26) for j in range(4))
    rows = [(i, f"we saw the {part(i, 1)} {part(i, 2)} {part(i, 3)} {part(i, 4)} in spring") for i in range(6)]
    rows += [(10 + i, f"own {part(i, 9)}{i}x\nAll rights reserved.") for i in range(6)]
    rows += [(20 + i, "a line of four documents alone") for i in range(4)]
    want = {i: t for i, t in rows} | {10 + i: f"own {part(i, 9)}{i}x" for i in range(1, 6)}
    for times in (1, 2, 3):
        got = drop_recurring_lines(spark.createDataFrame(rows * times + rows[-1:] * 4, SCHEMA)).collect()
        assert {r.doc_id: r.text for r in got} == want == brute_force(rows)
    docs = made()
    doubled = drop_recurring_lines(spark.createDataFrame(docs * 2, SCHEMA)).collect()
    assert {r.doc_id: r.text for r in doubled} == brute_force(docs) and len(doubled) == 2 * len(docs)


def test_repeated_rows_null_ids_long_texts_and_empty(spark):
    line = "a line that many documents share"
    rows = [(i, line) for i in range(6)] + [(0, line)] * 2 + [(None, line)] * 2 + [(50, " ".join(f"t{chr(97 + i % 26)}" for i in range(30_000)))]
    got = drop_recurring_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r.doc_id, bool(r.text)) for r in got) == Counter(
        {(0, True): 3, (None, False): 2, (50, True): 1} | {(i, False): 1 for i in range(1, 6)})
    nulls = drop_recurring_lines(spark.createDataFrame([(None, f"{line}\n{i}") for i in range(6)], SCHEMA)).collect()
    assert sum(line in r.text for r in nulls) == 1
    assert drop_recurring_lines(spark.createDataFrame([], SCHEMA)).collect() == []
    assert line_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lists_beyond_the_checked_size_are_joined_by_a_shuffle(spark, monkeypatch):
    docs = made()
    frame = spark.createDataFrame(docs, SCHEMA)
    near = drop_recurring_lines(frame)
    monkeypatch.setattr(line_templates, "BROADCAST_BYTES", 0)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        far = drop_recurring_lines(frame)
        assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in far._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, map(tuple, near.collect()))) == sorted(map(str, map(tuple, far.collect())))
    finally:
        spark.conf.set(threshold, before)


def test_a_word_without_end_is_read_in_one_pass(spark):
    got = line_report(spark.createDataFrame([(1, "x" * 1_000_000 + " a b c d"), (2, "9" * 1_000_000)], SCHEMA)).collect()
    assert [r.n_dropped for r in got] == [0, 0]


def test_long_exact_lines_go_from_two_documents_on(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    numbered = "The committee met on 12 May and paid 300 crowns to the builders"
    script = "\u6c34" * 40  # a line of one token
    rows = [(1, f"{passage}\nown one"), (2, f"own two\n{passage}"), (3, numbered), (4, numbered), (5, numbered.replace("300", "900")),
            (6, script), (7, script), (8, script + "\u706b"), (9, "a short shared line"), (10, "a short shared line")]
    got = {r.doc_id: r.text for r in drop_recurring_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == dict(rows) | {2: "own two", 4: "", 7: ""}


def test_lines_that_only_share_fields_or_leading_words_stay(spark):
    word = lambda i: "abcdefgh"[i] * 4
    lines = [
        lambda i: f"{i}1 {i}2 {i}3 {i}4", lambda i: f"Total {i}1 {i}2 {i}3 {i}4 {i}5 {i}6", lambda i: f"The king was {word(i)}",
        lambda i: f"The queen of {word(i)} {word(i + 1)}", lambda i: f"Then came the {word(i)} {i}1 {i}2 with {word(i + 1)}"]
    rows = [(i, "\n".join(line(i) for line in lines)) for i in range(7)]
    same = "11 22 33 44"
    rows += [(20 + i, f"{same}\nSeen on day {i} by the whole town") for i in range(5)]
    got = {r.doc_id: r.text for r in drop_recurring_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {**dict(rows), **{20 + i: "" for i in range(1, 5)}}
