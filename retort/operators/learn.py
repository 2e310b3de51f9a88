"""Multi-label classification as distributed MLlib jobs (I2, re-aimed).

The reference trains one network that emits a score per label. Here each
label gets its own binary ``LogisticRegression`` on hashed term features
of the row's token array (hashed once for all labels): hashing keeps the
feature space fixed (no vocabulary pass, no driver-side dictionary), and
MLlib's optimiser runs
treeAggregate over the partitions, so the training set never reaches one
task. The driver loops over labels only (a handful), never over rows.

``train_joint`` fits hundreds of labels in as many passes over the rows as one label takes: a pass
computes every label's gradient at its own trial point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.operators.clean import union_sources
from retort.session import ensure_checkpoint_dir, scratch_path

NUM_FEATURES = 1 << 18
MAX_ITER = 20
REG_PARAM = 0.01


def featurize(df: DataFrame, tokens: str, num_features: int = NUM_FEATURES) -> DataFrame:
    """Hashed binary term features of a token array, computed once for all
    labels and checkpointed to the shared folder: every label's optimiser
    passes and the scoring pass read it instead of re-deriving the tokens."""
    ensure_checkpoint_dir(df.sparkSession)
    tf = HashingTF(inputCol=tokens, outputCol="features", numFeatures=num_features, binary=True)
    return tf.transform(df).drop(tokens).checkpoint(eager=True)


def train_multilabel(feats: DataFrame, labels, split: str = "split", train_value: str = "train",
                     max_iter: int = MAX_ITER, reg_param: float = REG_PARAM):
    """One fitted binary model per label column, trained on the ``train``
    rows of a featurised frame.

    A fitted model holds its training summary and through that the session, which tasks can't be sent once
    something in it was observed; models are therefore saved and loaded, which leaves the summary behind."""
    train = feats.where(F.col(split) == train_value)
    models = {}
    for label in labels:
        lr = LogisticRegression(featuresCol="features", labelCol="_y", predictionCol="_pred",
                                probabilityCol="_prob", rawPredictionCol="_raw",
                                maxIter=max_iter, regParam=reg_param)
        path = scratch_path(feats.sparkSession, "model")
        lr.fit(train.withColumn("_y", F.col(label).cast("double"))).write().save(path)
        models[label] = LogisticRegressionModel.load(path)
    return models


def score_multilabel(feats: DataFrame, models, key: str, split: str = "split") -> DataFrame:
    """Long form ``(key, split, label, y, z, p, prediction)``: one row per
    (row, label); ``z`` is the logit, ``p`` its sigmoid."""
    parts = []
    for label, model in models.items():
        scored = model.transform(feats.withColumn("_y", F.col(label).cast("double")))
        parts.append(scored.select(
            key, split, F.lit(label).alias("label"), F.col("_y").alias("y"),
            vector_to_array("_raw")[1].alias("z"), vector_to_array("_prob")[1].alias("p"),
            F.col("_pred").cast("int").alias("prediction")))
    return union_sources(parts)


#: Weights (features by labels) that one joint fit holds; labels beyond it are fitted in further groups.
JOINT_WEIGHTS = 1 << 20
#: Numbers of a gradient in one row of a partial sum.
SEGMENT = 1 << 14
HISTORY = 10


def hashed_terms(tokens, num_features: int) -> F.Column:
    """The ascending places of a token array's terms among ``num_features`` hashed ones."""
    places = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(num_features)).cast("int"))
    return F.array_sort(F.array_distinct(F.coalesce(places, F.array().cast("array<int>"))))


def _rows_of(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of an Arrow list column; a null list holds nothing."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lengths)), lengths), pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """out[at] += rows, with repeated places."""
    if len(at):
        order = np.argsort(at, kind="stable")
        head = np.flatnonzero(np.r_[True, np.diff(at[order]) != 0])
        out[at[order][head]] += np.add.reduceat(rows[order], head, axis=0)


def joint_gradient(rows: DataFrame, weights: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(losses, gradients) summed over ``rows`` (``terms``, ``hot``) of the logistic models of the labels from
    ``first`` on: one pass for all of them. ``weights`` is features and an intercept by labels. Each
    partition adds up its rows in blocks; the partial sums are added in segments by Spark."""
    features, labels = weights.shape[0] - 1, weights.shape[1]

    def run(batches):
        loss, gradient = np.zeros(labels), np.zeros(weights.shape)
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy(zero_copy_only=False)
            block = np.cumsum((lengths + 2) * labels) // (1 << 22)  # numbers that a block of rows needs
            for begin in np.flatnonzero(np.r_[True, np.diff(block) != 0]) if batch.num_rows else ():
                part = batch.slice(begin, int(np.searchsorted(block, block[begin], side="right")) - begin)
                row, term = _rows_of(part.column("terms"))
                z = np.repeat(weights[-1:], part.num_rows, axis=0)
                _add_rows(z, row, weights[term])
                owner, label = _rows_of(part.column("hot"))
                mine = (label >= first) & (label < first + labels)
                y = np.zeros(z.shape)
                y[owner[mine], label[mine] - first] = 1
                loss += (np.logaddexp(0, z) - y * z).sum(axis=0)
                residual = 1 / (1 + np.exp(-np.clip(z, -700, 700))) - y
                _add_rows(gradient, term, residual[row])
                gradient[features] += residual.sum(axis=0)
        flat = np.concatenate([loss, gradient.ravel()])
        parts = np.split(flat, np.arange(SEGMENT, len(flat), SEGMENT))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.float64()))], names=["segment", "part"])

    sums = (rows.select("terms", "hot").mapInArrow(run, "segment int, part array<double>")
            .groupBy("segment").agg(Summarizer.sum(array_to_vector("part")).alias("total")))
    total = np.concatenate([r.total.toArray() for r in sorted(sums.collect(), key=lambda r: r.segment)] or [np.zeros(labels + weights.size)])
    return total[:labels], total[labels:].reshape(weights.shape)


def _lbfgs_direction(gradient: np.ndarray, steps: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """The limited-memory BFGS direction of every column at once; unused history is zero."""
    curve = (steps * changes).sum(axis=1)
    rho = np.where(curve > 0, 1 / np.where(curve > 0, curve, 1), 0)
    q, alphas = gradient.copy(), [None] * len(steps)
    for i in reversed(range(len(steps))):
        alphas[i] = rho[i] * (steps[i] * q).sum(axis=0)
        q -= alphas[i] * changes[i]
    length = (changes[-1] ** 2).sum(axis=0)
    q *= np.where(length > 0, curve[-1] / np.where(length > 0, length, 1), 1 / np.maximum(1, np.sqrt((gradient**2).sum(axis=0))))
    for i in range(len(steps)):
        q += steps[i] * (alphas[i] - rho[i] * (changes[i] * q).sum(axis=0))
    return -q


def train_joint(rows: DataFrame, num_features: int, num_labels: int, max_passes: int = 60, reg_param: float = REG_PARAM,
                tolerance: float = 1e-5) -> tuple[np.ndarray, int]:
    """(weights, passes): a logistic model for each of ``num_labels`` labels, all in one optimiser.

    ``rows`` has ``terms`` (places of ones among the features) and ``hot`` (places of ones among the
    labels), as ``hashed_terms`` and ``multi_hot_rows`` give them, and is read once a pass, so it should be
    checkpointed. The objective of a label is the mean log loss plus ``reg_param / 2`` times the squared
    weights without the intercept. Each label has its own limited-memory BFGS steps; a pass looks at the trial
    point of every label that is not within ``tolerance`` (largest gradient), and a label whose loss doesn't
    fall halves its step. Labels beyond ``JOINT_WEIGHTS`` weights come in further groups. A label starts at
    its base rate and its objective never rises, so at any number of passes its loss is not above
    guessing that rate; one that all or no rows have keeps a large intercept."""
    ensure_checkpoint_dir(rows.sparkSession)
    n, out, most = rows.count(), [], 0
    group = max(1, JOINT_WEIGHTS // (num_features + 1))
    penalty = np.full((num_features + 1, 1), reg_param)
    penalty[-1] = 0
    for first in range(0, num_labels if n else 0, group):
        labels = min(group, num_labels - first)
        counts = {r.place: r.n for r in rows.select(F.explode("hot").alias("place")).where(F.col("place").between(first, first + labels - 1))
                  .groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a label of the group
        rate = np.clip(np.array([counts.get(first + i, 0) for i in range(labels)]) / n, 0.5 / (n + 1), 1 - 0.5 / (n + 1))
        weights = np.zeros((num_features + 1, labels))
        weights[-1] = np.log(rate / (1 - rate))

        def look(at, own):
            """Losses and gradients of the labels ``own`` at ``at``: the labels between the first and the last."""
            low, high = int(own[0]), int(own[-1]) + 1
            wide = weights[:, low:high].copy()
            wide[:, own - low] = at
            loss, gradient = joint_gradient(rows, wide, first + low)
            return (loss[own - low] / n + (penalty * at**2).sum(axis=0) / 2, gradient[:, own - low] / n + penalty * at)

        every = np.arange(labels)
        loss, gradient = look(weights, every)
        steps, changes = np.zeros((2, HISTORY, *weights.shape))
        direction, size, passes = _lbfgs_direction(gradient, steps, changes), np.ones(labels), 1
        open_ = np.abs(gradient).max(axis=0) > tolerance
        while open_.any() and passes < max_passes:
            own = every[open_]
            trial = weights[:, own] + size[own] * direction[:, own]
            new_loss, new_gradient = look(trial, own)
            passes += 1
            falls = new_loss <= loss[own] + 1e-4 * size[own] * (gradient[:, own] * direction[:, own]).sum(axis=0)
            size[own[~falls]] /= 2
            go = own[falls]
            step, change = trial[:, falls] - weights[:, go], new_gradient[:, falls] - gradient[:, go]
            steps[:-1, :, go], changes[:-1, :, go] = steps[1:, :, go], changes[1:, :, go]
            steps[-1][:, go], changes[-1][:, go] = step, change
            weights[:, go], loss[go], gradient[:, go] = trial[:, falls], new_loss[falls], new_gradient[:, falls]
            direction[:, go], size[go] = _lbfgs_direction(gradient[:, go], steps[:, :, go], changes[:, :, go]), 1
            open_ = (np.abs(gradient).max(axis=0) > tolerance) & (size > 1e-12)
        out.append(weights)
        most = max(most, passes)
    return (np.concatenate(out, axis=1) if out else np.zeros((num_features + 1, num_labels))), most


def joint_losses(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """(label_id, n, positives, bce, base) of the models of ``train_joint`` on ``rows``: mean loss and that of
    guessing the label's rate among these rows."""
    n, group, out = rows.count(), max(1, JOINT_WEIGHTS // weights.shape[0]), []
    for first in range(0, weights.shape[1], group):
        out += joint_gradient(rows, weights[:, first : first + group], first)[0].tolist()
    spark = rows.sparkSession
    losses = spark.createDataFrame([(i, x / max(1, n)) for i, x in enumerate(out)], "label_id long, bce double")
    positives = rows.select(F.explode(F.col("hot").cast("array<long>")).alias("label_id")).groupBy("label_id").agg(F.count(F.lit(1)).alias("positives"))
    p = F.col("positives") / F.col("n")
    base = F.when((p > 0) & (p < 1), -p * F.log(p) - (1 - p) * F.log(1 - p)).otherwise(0.0)
    return (losses.join(positives, "label_id", "left").select("label_id", F.lit(n).cast("long").alias("n"), F.coalesce("positives", F.lit(0)).alias("positives"), "bce")
            .withColumn("base", base))
