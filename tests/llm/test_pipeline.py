"""The pipeline's stages against plain Python, each on its own input."""

from __future__ import annotations

import os
import re
import sys
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from emberlog.llm.common import documents, map_arrow, staged
from tests.llm import brute
from tests.llm.test_operators import packed_ok


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    docs, found = documents(spark, sf_dir), {"documents": documents(spark, sf_dir)}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = docs = staged(stage(spark, docs, sf_dir), name)
    return found


def text_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay(outputs):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert outputs[name].dtypes == outputs["documents"].dtypes


def test_toxic_documents_go(spark):
    sf = "/root/testdata/sf0.01"  # the smallest table with toxic labels to learn from
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    before = documents(spark, sf)
    left = {r["doc_id"] for r in corpus_pipeline.toxicity(spark, before, sf).select("doc_id").collect()}
    gone = {r["doc_id"] for r in before.select("doc_id").collect()} - left
    toxic = {d for d, t in labels.items() if t}
    assert len(gone & toxic) >= 0.6 * len(toxic) and len({d for d, t in labels.items() if not t} & gone) <= 3


def test_lines_are_not_invented(outputs):
    before = text_of(outputs["toxicity"])
    for doc, text in text_of(outputs["line_dedup"]).items():
        assert set((text or "").split("\n")) <= set((before[doc] or "").split("\n"))


def test_passages_go_whatever_their_lines(spark, sf_dir):
    rows, want = [], {}
    for n in (2, 3, 5):
        for group in range(4):
            passage = "\n".join(" ".join(f"g{group}n{n}l{i}w{j}" for j in range(60 // n)) for i in range(n))
            for k in range(100 * n + 10 * group, 100 * n + 10 * group + 3):
                rows.append((k, f"own {k}\n{passage}\nend {k}", None))
                want[k] = rows[-1][1] if k % 10 == 0 else f"own {k}\nend {k}"
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    assert text_of(corpus_pipeline.line_dedup(spark, docs, sf_dir)) == want


def test_one_of_each_group_stays(outputs):
    before = text_of(outputs["line_dedup"])
    want = {d for d, (n, c) in brute.components(before).items() if not n or d == c}
    assert text_of(outputs["near_duplicates"]).keys() == want


def test_contaminated_documents_go(outputs, sf_dir):
    items = dict(duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall())
    before = text_of(outputs["near_duplicates"])
    want = {d for d, r in brute.decontaminate(before, items).items() if not r["contaminated"]}
    assert text_of(outputs["decontamination"]).keys() == want


def test_all_that_is_left_is_packed(outputs):
    packed_ok(outputs["packing"].collect(), text_of(outputs["decontamination"]).items())


def test_empty_tables_and_run(spark, sf_dir, outputs):
    docs = outputs["documents"].where("false")
    for _, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, sf_dir)
        assert done.count() == 0
        docs = done if "text" in done.columns else docs
    assert corpus_pipeline.run(spark, sf_dir).count() == outputs["packing"].count()


def test_workers_give_back_what_a_task_freed(spark):
    def own_mb(pid):
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text()))) >> 10

    def make(batches):
        for _ in batches:
            blocks = [bytearray(1 << 16) for _ in range(4000)]
            sys.stays = bytearray(1 << 16)  # above the blocks, so the heap can't just shrink
            peak = own_mb(os.getpid())
            blocks.clear()
            yield pa.RecordBatch.from_pydict({"pid": pa.array([os.getpid()], pa.int64()), "mb": pa.array([peak], pa.int64())})

    pid, peak = map_arrow(spark.range(0, 1, 1, 1), make, "pid long, mb long").collect()[0]
    assert pid != os.getpid() and own_mb(pid) < peak / 2
