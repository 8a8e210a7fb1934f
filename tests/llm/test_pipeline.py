from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import public_tokenizers
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from zoneflow.llm import bpe
from zoneflow.llm.oracle import ORACLE
from zoneflow.llm.queries import QUERIES
from zoneflow.llm.quality import judge_quality
from zoneflow.llm.simhash import near_duplicates
from zoneflow.session import materialize

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result_as_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, want))


def test_all_eleven_are_registered():
    names = entry_point.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(150)
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(3)).withColumn("kept", F.lit("x")).withColumn("__key", F.lit(1)).cache()
    whole = docs
    for name, stage in corpus_pipeline.STAGES:
        before, columns = docs, docs.columns
        docs = stage(spark, before, SF_DIR).cache()
        if name == "quality_rules":
            assert docs.count() == judge_quality(before).filter("kept").count()
        elif name == "simhash_near_dedup":
            classes = near_duplicates(before)
            assert docs.count() == classes.select("component_id").distinct().count()
        else:
            assert docs.count() == before.count()
        if name != "byte_bpe":
            assert docs.columns == columns
    assert 0 < docs.count() < whole.count()
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    texts = {r.doc_id: bytes(r.data).decode() for r in bpe.decode_documents(docs, ranks, public_tokenizers.PATTERN).collect()}
    assert texts == {r.doc_id: r.text for r in before.collect()}


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.collect() == []


def test_the_rest_imports_without_this_part(tmp_path):
    """Nothing else in the library needs this package."""
    code = ("import sys; sys.modules['zoneflow.llm'] = None; import __spark_entry__ as e; "
            "assert 'pipeline' not in e.queries() and 'zone_board' in e.queries()")
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env=os.environ | {"PYTHONPATH": root})


def test_mixed_order_survives_files_and_ids_decode(spark):
    """Several part files, of which the last ones are the largest: a scan deals them by size."""
    rows = [(i, f"text {i} " * (1 + i // 20), "en", f"s{i % 3}" if i % 7 else "rare", 10) for i in range(200)]
    docs = spark.createDataFrame(rows + [(7, "text 7 ", "en", "rare", 10), (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.source_mixing(spark, docs, SF_DIR)
    want = [(r.doc_id, r.source, (r.text or "").encode()) for r in mixed.collect()]
    read = materialize(mixed.repartition(5, "doc_id"), "test-mixed")
    got = corpus_pipeline.byte_bpe(spark, read, SF_DIR).orderBy("mix_position").collect()
    assert [r.mix_position for r in got] == list(range(len(want)))
    assert [(r.doc_id, r.source, bytes(r.decoded)) for r in got] == want
