"""Per-label MLlib pipelines on hashed word tokens."""

import math

from pyspark.sql import functions as F

from retort.plans import q_learn


def test_multilabel_scores_shape_and_fit(spark, sf_dir):
    df = q_learn.labelled_documents(spark, sf_dir)
    n = df.count()
    s = q_learn.multilabel_scores(spark, sf_dir)
    rows = s.collect()
    assert len(rows) == n * len(q_learn.LABELS)
    assert {r.label for r in rows} == set(q_learn.LABELS)
    assert len({(r.doc_id, r.label) for r in rows}) == len(rows)
    for r in rows:
        assert 0.0 <= r.p <= 1.0
        assert abs(r.p - 1 / (1 + math.exp(-r.z))) < 1e-9
        assert r.prediction == int(r.p > 0.5)
    # on the training rows the model beats always predicting the majority
    train = s.where(F.col("split") == "train")
    for label in q_learn.LABELS:
        t = train.where(F.col("label") == label)
        acc = t.where(F.col("prediction") == F.col("y").cast("int")).count() / t.count()
        pos = t.where(F.col("y") == 1).count() / t.count()
        assert acc >= max(pos, 1 - pos)


def test_losses_of_every_split(spark, sf_dir):
    scores = q_learn.multilabel_scores(spark, sf_dir).collect()
    rows = q_learn.q_multilabel_losses(spark, sf_dir).collect()
    assert {(r.split, r.label) for r in rows} == {(r.split, r.label) for r in scores}
    for r in rows:
        mine = [x for x in scores if (x.split, x.label) == (r.split, r.label)]
        bce = sum(max(x.z, 0) - x.z * x.y + math.log1p(math.exp(-abs(x.z))) for x in mine) / len(mine)
        assert r.n == len(mine) and abs(r.bce - bce) < 1e-3
        assert abs(r.accuracy - sum(x.prediction == x.y for x in mine) / len(mine)) < 1e-3
        assert r.learned is (True if r.split == "train" else None)


def test_scores_after_an_observation(spark, sf_dir):
    """A session that observed something can't be sent to tasks; a fitted model must not carry it there."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    assert {r.label for r in q_learn.q_multilabel_loss(spark, sf_dir).collect()} == {"quality", "toxic"}
