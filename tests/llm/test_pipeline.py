"""The stages of the pipeline, each held against what it was given."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from gridsky.llm.common import staged

from .test_decontaminate import brute as leaks
from .test_ngram_join import expected as components

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")


def test_every_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given, results = docs.columns, [], []
    for name, stage in corpus_pipeline.STAGES:
        given.append(docs)
        docs = staged(stage(spark, docs, SF), "stage")
        results.append(docs)
    assert all(r.columns == columns for r in results[:-1])
    rows = [[(r.doc_id, r.text) for r in g.collect()] for g in [*given, results[3]]]

    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {i for i, _ in rows[1]}
    assert all(i in left for i, q in quality.items() if q == 1)
    assert sum(i in left for i, q in quality.items() if q == 0) <= 0.2 * sum(q == 0 for q in quality.values())

    # One document of each component, the one with the least id.
    assert {i for i, _ in rows[2]} == {c for _, _, c in components(rows[1])}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {eval(r)[0] for r in leaks(rows[2], items)}
    assert {i for i, _ in rows[3]} == {i for i, _ in rows[2]} - hit

    assert set(rows[4]) <= set(rows[3]) and len(rows[4]) > 0.5 * len(rows[3])
    shards = results[-1].collect()
    assert sorted(r.doc_id for r in shards) == sorted(i for i, _ in rows[4])


def odd_tables(spark, path, rows):
    """Tables of a run with columns that are named like the operators' own."""
    extra = "hit_t long, hit_id string, gone_t string, gone_id long, root string, id string, t long, label string, score int"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    made = [(i, x, "en", None, None if x is None else len(x), 1, "h", "g", 2, "r", "i", 3, "l", 4) for i, x in rows]
    spark.createDataFrame(made, schema).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return [f.split()[0] for f in schema.split(", ")]


def test_null_ids_repeated_rows_and_clashing_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect()
    good = [(r.doc_id, r.text) for r in docs]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    plain = good[0][1]
    rows = good + [(None, plain + " one more word here"), (None, item), (good[5][0], good[5][1]), (None, None), (7, ""), (None, plain)]
    columns = odd_tables(spark, str(tmp_path), rows)
    frames = [spark.read.parquet(f"{tmp_path}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(staged(stage(spark, frames[-1], str(tmp_path)), "stage"))
    assert all(f.columns == columns for f in frames[:-1])
    texts = [[r.text for r in f.collect()] for f in frames[:-1]]
    # Each stage keeps a part of what it was given; repeated and similar rows become one; the item goes.
    assert all(set(b) <= set(a) for a, b in zip(texts, texts[1:]))
    assert len(texts[2]) == len(set(texts[2])) or texts[2].count(None) + texts[2].count("") > 1
    assert item not in texts[3]
    assert frames[-1].count() == len(texts[-1])


def test_empty_table_runs_through(spark, tmp_path):
    odd_tables(spark, str(tmp_path), [])
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.collect() == [] and "shard" in result.columns


def test_run_is_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5
