"""The pipeline's stages on their own inputs, and the registered queries."""

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from retort.llm import toxicity
from retort.llm.common import materialize

from .test_dedup import brute_components, pairs
from .test_scans import brute_secrets

NAMES = ["op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_"]


def test_every_operator_has_one_query():
    names = list(entry.queries())
    assert all(sum(n.startswith(p) for n in names) == 1 for p in NAMES) and "pipeline" in names


def test_stages_do_what_they_say(spark, documents, sf_dir):
    docs, seen = documents, {}
    for name, stage in pipeline.STAGES:
        out = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        seen[name] = docs, out
        if name != "packing":
            assert out.columns == documents.columns
        docs = out
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = seen["toxicity"]
    model = toxicity.learn(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(after) == {r.doc_id for r in toxicity.score(before, model).collect() if not r.predicted}
    before, after = seen["near_dups"]
    assert ids(after) == {c for _, _, c in brute_components(pairs(before))}
    before, after = seen["leaks"]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaky = {d for d, t in pairs(before) if any(x in t for x in items)}
    assert not ids(after) & leaky and len(ids(before) - ids(after)) <= len(leaky) + 2
    before, after = seen["secrets"]
    assert ids(after) == ids(before) and not any(brute_secrets(t) for _, t in pairs(after))
    before, after = seen["packing"]
    assert ids(after) == ids(before)
    assert entry.queries()["pipeline"](spark, sf_dir).count() == after.count()


def test_stages_take_awkward_rows(spark, awkward, sf_dir):
    docs = awkward
    for _, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "test-awkward")
    assert docs.count() > 0
    empty = awkward.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
