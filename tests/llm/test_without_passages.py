"""Rows without benchmark passages are found where they are read."""

import contextlib
import io
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from layerlint.llm import decontamination  # noqa: E402

ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "one two three four five six seven eight nine"), (3, "red green blue black white grey pink brown")]


def plan_of(rows) -> str:
    with contextlib.redirect_stdout(out := io.StringIO()):
        rows.explain()
    return out.getvalue()


def test_without_passages(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BATCH_ITEMS", 1)  # three slices
    benchmark = spark.createDataFrame(ITEMS, "item_id int, text string")
    texts = [f"some words {text} more words" for _, text in ITEMS] + ["nothing of the kind", "", None, ITEMS[0][1] + " " + ITEMS[2][1]]
    docs = spark.createDataFrame([(i if i % 2 else None, t, i) for i, t in enumerate(texts * 2)], "doc_id int, text string, n int")
    kept = decontamination.without_passages(docs, benchmark)
    held = {r["n"] for r in decontamination.find_passages(docs, benchmark, keep=("n",)).select("n").collect()}
    assert len(held) == 8 and kept.schema == docs.schema
    assert sorted(r["n"] for r in kept.collect()) == sorted(set(range(len(texts) * 2)) - held)
    plan = plan_of(kept)
    assert "Exchange" not in plan and "Join" not in plan


def test_no_items(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    assert decontamination.without_passages(docs, spark.createDataFrame([], "item_id int, text string")).count() == 1
