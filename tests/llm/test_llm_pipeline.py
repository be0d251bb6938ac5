"""Every stage of the pipeline on what the stage before it kept."""

import numpy as np
import pytest

import corpus_pipeline
from leadlift.llm import line_crf
from leadlift.sources.staging import stage
from test_llm_models import plain_components, plain_simhash
from test_llm_native import base_spans


@pytest.fixture(scope="module")
def steps(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], medium), name))
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(steps):
    for kept in steps[1:-1]:
        assert kept.dtypes == steps[0].dtypes


def test_quality_drops_what_scores_low(spark, medium, steps):
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    model = line_crf.learn(steps[0], labels)
    before, after = by_id(steps[0]), by_id(steps[1])
    scores = {i: model.scores([r["text"]])[0] for i, r in before.items()}
    assert {i for i, s in scores.items() if s >= line_crf.THRESHOLD} == set(after)
    marked = {r["doc_id"]: r["quality"] for r in labels.collect()}
    kept = [i in after for i in before if marked.get(i) == 1]
    dropped = [i not in after for i in before if marked.get(i) == 0]
    assert np.mean(kept) > 0.98 and np.mean(dropped) > 0.9


def test_one_document_of_each_group(steps):
    before, after = by_id(steps[1]), by_id(steps[2])
    components = plain_components({i: plain_simhash(r["text"]) for i, r in before.items()})
    assert set(after) == set(components.values())
    assert all(after[i] == before[i] for i in after)


def test_personal_data_is_gone(steps):
    before, after = by_id(steps[2]), by_id(steps[3])
    assert set(before) == set(after)
    for i, row in after.items():
        if base_spans(before[i]["text"]):
            assert not base_spans(row["text"]) and row["n_chars"] == len(row["text"])
        else:
            assert row == before[i]


def test_everything_is_packed(steps):
    pieces = steps[4].collect()
    assert {p["doc_id"] for p in pieces} == set(by_id(steps[3]))
    used = {}
    for p in pieces:
        used[p["sequence_id"]] = used.get(p["sequence_id"], 0) + p["length"]
    assert max(used.values()) <= 2048
    assert len(used) <= -(-sum(used.values()) // 2048) * 1.02 + 1


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0


def test_run_on_empty_tables(spark, tmp_path, small):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
