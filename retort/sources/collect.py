"""Inline samples and multi-source collection."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort import constants as K
from retort.operators.clean import union_sources

log = logging.getLogger("retort.sources")

_SAMPLES = {
    "industrial": (K.INDUSTRIAL_SAMPLES, K.INDUSTRIAL_SOURCE, K.INDUSTRIAL_ID_FORMAT),
    "pharma": (K.PHARMA_SAMPLES, K.PHARMA_SOURCE, K.PHARMA_ID_FORMAT),
}


def sample_compounds(spark: SparkSession, which: str, n: int, seen: DataFrame | None = None) -> DataFrame:
    """The inline sample table cycled ``i % len`` up to ``n`` rows;
    SMILES already ``seen`` are skipped and each SMILES is kept once (the
    first ``i``), so at most len(samples) rows come out however large n is:
    those of the first cycle, for later ones repeat them.
    """
    rows, source, fmt = _SAMPLES[which]
    df = spark.createDataFrame([(i, s, name, list(apps)) for i, (s, name, apps) in enumerate(rows[:n])],
                               "i BIGINT, smiles STRING, name STRING, applications ARRAY<STRING>")
    if seen is not None:
        df = df.join(seen.select("smiles").distinct(), "smiles", "left_anti")
    first = df.groupBy("smiles").agg(F.min(F.struct("i", "name", "applications")).alias("f"))
    return first.select("smiles", F.col("f.applications").alias("applications"), F.lit(source).alias("source"),
                        F.format_string(fmt, F.col("f.i")).alias("compound_id"), F.col("f.name").alias("name"))


def collect_sources(plan, order: str = "ordinal", landing: str | None = None) -> DataFrame:
    """``plan`` is an ordered list of (name, build, cap) where ``build``
    returns a DataFrame. A source that fails to build or to be analysed is
    skipped with a message; each is capped to its first ``cap`` rows by
    ``order`` (a column every capped source must have) and tagged with its
    plan rank; the results are concatenated in plan order. With ``landing``
    each source is first written below that folder and read back, so one
    that fails on any of its rows is skipped too."""
    frames = []
    for rank, (name, build, cap) in enumerate(plan):
        try:
            df = build()
            if cap is not None:
                df = df.orderBy(order).limit(cap)
            df.columns  # analysed here, so a source that is not there is isolated
            if landing is not None:
                path = f"{landing.rstrip('/')}/{rank}"
                df.write.parquet(path)
                df = df.sparkSession.read.schema(df.schema).parquet(path)
        except Exception as e:
            log.error("error collecting from %s: %s", name, e)
            continue
        frames.append(df.withColumn("source_rank", F.lit(rank)).withColumn("plan_source", F.lit(name)))
    if not frames:
        raise ValueError("no source could be collected")
    return union_sources(frames)
