"""Queries: multi-label training and scoring with MLlib (I2) and its
loss per split and label (D11 on the scores).

Fitting is iterative, so scores have no SQL oracle (tests/test_learn.py has
their properties); the loss query gives rows that SQL can check.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import constants as K
from retort.functions.smiles import tokenize
from retort.operators import clean as C
from retort.operators import learn as ML
from retort.operators import lookup as L
from retort.operators.similarity import words
from retort.operators.vectors import bce_with_logits
from retort.plans.catalog import register
from retort.plans.q_clean import BASE, cleaned
from retort.session import read_table

LABELS = ["quality", "toxic"]


def labelled_documents(spark, sf):
    """documents with their labels, word tokens of the whole text, split."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    lab = read_table(spark, sf, "labels").select("doc_id", *LABELS)
    df = d.join(lab, "doc_id").select("doc_id", words("text").alias("tokens"), *LABELS)
    return L.split(df, "doc_id")


def multilabel_scores(spark, sf):
    feats = ML.featurize(labelled_documents(spark, sf), "tokens")
    return ML.score_multilabel(feats, ML.train_multilabel(feats, LABELS), "doc_id")


def losses(s):
    """Rows, positives, mean loss and accuracy of each split and label of scores; ``learned``: on the rows
    trained on, the loss is not above that of guessing the base rate (null for held-out splits)."""
    g = s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("positives"),
                                        F.avg(bce_with_logits(F.col("z"), F.col("y"))).alias("bce"),
                                        F.avg((F.col("prediction") == F.col("y").cast("int")).cast("double")).alias("accuracy"))
    p = F.col("positives") / F.col("n")
    entropy = F.when((p > 0) & (p < 1), -p * F.log(p) - (1 - p) * F.log(1 - p)).otherwise(0.0)
    return g.withColumn("learned", F.when(F.col("split") == "train", F.col("bce") <= entropy))


@register("multilabel_scores")
def q_multilabel_scores(spark, sf):
    return multilabel_scores(spark, sf)


SPLIT_SQL = f"""CASE WHEN b < {round((1 - K.SPLIT_TEST_FRACTION) * 10000)} THEN 'train' WHEN b < {round((1 - K.SPLIT_TEST_FRACTION / 2) * 10000)} THEN 'val' ELSE 'test' END"""


@register("multilabel_loss", f"""
WITH j AS (SELECT d.doc_id, quality, toxic, CAST(('0x' || left(md5('{K.SPLIT_SEED}:' || CAST(d.doc_id AS VARCHAR)), 8)) AS BIGINT) % 10000 AS b
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT {SPLIT_SQL} AS split, quality, toxic FROM j),
c AS (SELECT split, 'quality' AS label, quality AS y FROM s UNION ALL SELECT split, 'toxic', toxic FROM s)
SELECT split, label, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, true AS learned FROM c GROUP BY split, label""")
def q_multilabel_loss(spark, sf):
    """Rows and positives of each split and label, and ``learned`` as SQL can state it: held-out splits
    state true untested, since their loss is not a fixed fact; ``multilabel_losses`` has the losses."""
    return losses(multilabel_scores(spark, sf)).select("split", "label", "n", "positives", F.coalesce("learned", F.lit(True)).alias("learned"))


@register("multilabel_losses")
def q_multilabel_losses(spark, sf):
    """Loss and accuracy of each split and label, held-out ones too (no SQL: fitting is iterative)."""
    return losses(multilabel_scores(spark, sf)).select(
        "split", "label", "n", "positives", F.round("bce", 6).alias("bce"), F.round("accuracy", 6).alias("accuracy"), "learned")


JOINT_FEATURES = 1 << 10


def labelled_compounds(spark, sf):
    """(rows, classes): cleaned compounds with the places of their SMILES tokens and of all their labels, split."""
    df = cleaned(spark, sf)
    classes = C.label_classes(df)
    terms = df.select("row_id", ML.hashed_terms(tokenize("smiles"), JOINT_FEATURES).alias("terms"))
    rows = terms.join(C.multi_hot_rows(df, classes).select("row_id", "hot"), "row_id")
    return L.split(rows, "row_id").checkpoint(eager=True), classes


@register("multilabel_joint", BASE + f""",
classes AS (
  SELECT row_number() OVER (ORDER BY label) - 1 AS label_id, label
  FROM (SELECT DISTINCT unnest(applications) AS label FROM cleaned)),
train AS (SELECT row_id, applications FROM (
  SELECT row_id, applications, {SPLIT_SQL} AS split
  FROM (SELECT *, CAST(('0x' || left(md5('{K.SPLIT_SEED}:' || CAST(row_id AS VARCHAR)), 8)) AS BIGINT) % 10000 AS b FROM cleaned)) WHERE split = 'train'),
hot AS (SELECT label, count(*) AS positives FROM (SELECT unnest(list_distinct(applications)) AS label FROM train) GROUP BY label)
SELECT c.label, (SELECT count(*) FROM train) AS n, coalesce(positives, 0) AS positives, true AS learned
FROM classes c LEFT JOIN hot h ON c.label = h.label""")
def q_multilabel_joint(spark, sf):
    """Every application label in one optimiser: rows and positives trained on, and ``learned``: the label's
    training loss is not above that of guessing its rate (a label of all or no training rows: under 1/n)."""
    rows, classes = labelled_compounds(spark, sf)
    train = rows.where(F.col("split") == "train")
    weights, _ = ML.train_joint(train, JOINT_FEATURES, classes.count(), max_passes=20)
    fits = F.col("bce") <= F.greatest(F.col("base") + 1e-9, 1 / F.col("n"))
    return ML.joint_losses(train, weights).join(classes, "label_id").select("label", "n", "positives", fits.alias("learned"))
