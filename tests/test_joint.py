"""I2 for all labels in one optimiser; D7's wide form."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from retort.operators import clean as C
from retort.operators import learn as ML

FEATURES, LABELS = 40, 12


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(3)
    x = rng.random((600, FEATURES)) < 0.2
    y = rng.random((600, LABELS)) < 1 / (1 + np.exp(-(x @ rng.normal(0, 2, (FEATURES, LABELS)) - 1)))
    rows = [(np.flatnonzero(a).tolist(), np.flatnonzero(b).tolist()) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "terms array<int>, hot array<int>").repartition(5).checkpoint()


def test_joint_fit_equals_the_fit_of_each_label(spark, made):
    weights, passes = ML.train_joint(made, FEATURES, LABELS, tolerance=1e-7)
    assert weights.shape == (FEATURES + 1, LABELS) and passes < 60
    pairs = [(Vectors.sparse(FEATURES, r.terms, [1.0] * len(r.terms)), [float(i in r.hot) for i in range(LABELS)]) for r in made.collect()]
    for i in (0, 5, 11):
        one = spark.createDataFrame([(v, y[i]) for v, y in pairs], ["features", "label"])
        model = LogisticRegression(regParam=ML.REG_PARAM, standardization=False, maxIter=300, tol=1e-12).fit(one)
        assert np.abs(np.r_[model.coefficients.toArray(), model.intercept] - weights[:, i]).max() < 1e-4


def test_labels_take_as_many_passes_as_one(made, monkeypatch):
    _, alone = ML.train_joint(made, FEATURES, 1)
    whole, together = ML.train_joint(made, FEATURES, LABELS)
    assert together <= 2 * alone
    monkeypatch.setattr(ML, "JOINT_WEIGHTS", 5 * (FEATURES + 1))  # three groups
    monkeypatch.setattr(ML, "SEGMENT", 7)
    assert np.abs(ML.train_joint(made, FEATURES, LABELS)[0] - whole).max() < 1e-6
    losses = {r.label_id: r for r in ML.joint_losses(made, whole).collect()}
    assert len(losses) == LABELS and all(r.n == 600 and r.bce < r.base for r in losses.values())


def test_awkward_rows(spark):
    rows = [(None, None), ([], [0]), ([1], [0, 1]), ([0, 1], None), ([], [])]
    df = spark.createDataFrame(rows, "terms array<int>, hot array<int>")
    weights, _ = ML.train_joint(df, 3, 4)
    assert np.isfinite(weights).all()
    assert [(r.positives, r.n) for r in ML.joint_losses(df, weights).orderBy("label_id").collect()] == [(2, 5), (1, 5), (0, 5), (0, 5)]
    none, passes = ML.train_joint(df.limit(0), 3, 4)
    assert not none.any() and none.shape == (4, 4) and passes == 0


def test_wide_form_holds_the_bits_of_the_long_form(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["e", "d", "c", "a"]), (4, ["b"])], "row_id long, applications array<string>")
    classes = C.label_classes(df)
    bits = sorted(set(map(tuple, C.multi_hot(df, classes).collect())))
    for width in (1 << 20, 2, 1):
        wide = C.multi_hot_rows(df, classes, width=width).collect()
        assert sorted((r.row_id, r.segment * width + p) for r in wide for p in r.hot) == bits
        assert {r.row_id for r in wide if r.segment == 0} == {1, 2, 3, 4}
        assert all(r.hot == sorted(r.hot) for r in wide)
