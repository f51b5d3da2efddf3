"""The pipeline, stage by stage, against brute force."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline as pipeline  # noqa: E402
from test_llm import brute_components  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "12 34", "en", "src0", 5), (None, "the of and to in is that it was for on", "en", None, 38)], docs.schema)
    docs, named = docs.union(odd), dict(pipeline.STAGES)
    known = named["language"](spark, docs, SF)
    gone = {r[0] for r in docs.select("doc_id").subtract(known.select("doc_id")).collect()}
    assert known.columns == list(pipeline.COLUMNS) and gone == {9001, 9002}
    rows = [(r["doc_id"], r["text"]) for r in known.collect()]
    single = named["near_duplicates"](spark, known, SF)
    want = sorted([k for k, _, c in brute_components(rows) if k is None or k == c], key=str)
    assert sorted([r["doc_id"] for r in single.collect()], key=str) == want
    clean = named["decontaminate"](spark, single, SF)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not [r for r in clean.collect() for t in items if t in r["text"]] and clean.count() > 0.8 * single.count()
    mixed = named["mix"](spark, clean, SF)
    assert mixed.columns == list(pipeline.COLUMNS) and {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in clean.collect()}
    final = named["shard"](spark, mixed, SF)
    assert Counter(r["doc_id"] for r in final.collect()) == Counter(r["doc_id"] for r in mixed.collect())


def test_decontamination_by_row(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if r["text"])
    rows = [(1, "clean words " + "z " * 9), (1, f"before {item} after"), (None, item), (2, item), (2, item), (None, "clean"), (3, None), (4, ""), (5, "w " * 30_000)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, "x") for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, __text string")
    got = pipeline.decontaminate(spark, docs, SF)
    assert got.columns == list(pipeline.COLUMNS)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted((r for r in rows if not (r[1] and item in r[1])), key=str)


def test_run(spark):
    rows = pipeline.run(spark, SF)
    assert rows.count() > 0 and set(pipeline.COLUMNS) <= set(rows.columns)


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


if __name__ == "__main__":
    pytest.main([__file__])
