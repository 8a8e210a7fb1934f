from __future__ import annotations

import duckdb
import pyarrow as pa

from zoneflow.llm.oracle import ORACLE
from zoneflow.llm.quality import clean_documents, judge_quality

PROSE = "This is a plain sentence of ordinary words that nobody would object to at all."
OTHER = "Here stands a second one, longer by a few words, so that no window of eight repeats."
ROWS = [
    (0, None), (1, ""), (2, " \n\t"), (3, PROSE), (4, f"{PROSE}\n{OTHER} More."),
    (5, f"{PROSE}\n{OTHER} More.\nHome | News | Sport | Contact\nAll rights reserved.\n"),
    (6, "Home | News | Sport | Contact | " * 10), (7, "word### " * 30), (8, f"{PROSE} more\nBUY!! NOW!! " + "YES!! " * 40),
    (9, "a b c d e f g h " * 6), (10, f"{PROSE} x\n\n{PROSE} x\n" + "one two three four five six seven eight nine ten " * 2),
    (11, "x" * 5000), (12, " ".join(f"w{i}" for i in range(8_000))), (13, " ".join(f"w{i % 3000}" for i in range(8_000))),
    (4, f"{PROSE}\n{OTHER} More."), (None, f"{PROSE} {OTHER}"), (14, "ünï © " * 3 + "    é" * 10), (15, "a\x1cb \x85 c" * 12),
]


def test_equals_sql_on_edge_cases(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = judge_quality(docs).drop("cleaned").collect()
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in ROWS], pa.int64()), "text": pa.array([r[1] for r in ROWS])}))
    rows = con.sql(f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lost_words, kept "
                   f"FROM ({ORACLE['op1_quality_rules']})").fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows))


def test_verdicts_and_cleaned_text(spark):
    docs = spark.createDataFrame([(i, t, "keep", i) for i, t in ROWS], "doc_id long, text string, kept string, n_words long")
    verdict = {r.doc_id: r for r in judge_quality(docs).collect()}
    assert {i for i, r in verdict.items() if r.kept} == {4, 5, 12, None}
    assert verdict[5].cleaned == f"{PROSE}\n{OTHER} More.\n"
    assert verdict[0].cleaned is None
    assert not verdict[6].base_failed or verdict[6].n_repeat_words
    kept = clean_documents(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len([r for r in rows if r.doc_id == 4]) == 2
    assert {r.kept for r in rows} == {"keep"}
    assert next(r.text for r in rows if r.doc_id == 5) == f"{PROSE}\n{OTHER} More.\n"


def test_empty_table_and_plan_without_python(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert judge_quality(docs).collect() == []
    assert clean_documents(docs).collect() == []
    plan = judge_quality(spark.createDataFrame(ROWS, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
