"""Incremental collection as a Structured Streaming job.

Landed molecule pages (JSON, one page per line) stream in from a folder;
each molecule with a SMILES that passes the structural check is appended
to a Parquet sink once: ``dropDuplicates(["smiles"])`` keeps the seen-set
as checkpointed, shuffle-partitioned state, so a rerun (or a restarted
executor) continues where the last one stopped. ``collect_recent`` bounds
that state by the pages' event time and keeps late rows apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from retort.functions.smiles import valid_smiles
from retort.sources.files import BAD_PAGE, MOLECULE_PAGE, explode_molecule_pages

LANDED_PAGE = T.StructType([*MOLECULE_PAGE.fields, T.StructField("landed", T.TimestampType())])


def molecule_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None, landed: bool = False) -> DataFrame:
    """Valid molecules of the pages that land; with ``landed`` also their page's event time."""
    reader = spark.readStream.schema(LANDED_PAGE if landed else MOLECULE_PAGE).option("columnNameOfCorruptRecord", BAD_PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.json(landing)
    keep = ["landed"] if landed else []
    mols = explode_molecule_pages(pages, keep).select("smiles", "compound_id", "name", *keep)
    return mols.where(F.col("smiles").isNotNull() & (F.length("smiles") > 0) & valid_smiles(F.col("smiles")))


def collect_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str) -> None:
    """Run the stream over everything landed so far (AvailableNow) and stop."""
    q = (molecule_stream(spark, landing).dropDuplicates(["smiles"])
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start(sink))
    q.awaitTermination()


def collect_recent(spark: SparkSession, landing: str, sink: str, late: str, checkpoint: str, delay: str = "1 day",
                   max_files_per_trigger: int | None = None) -> list[dict]:
    """The stream with bounded state: a SMILES is appended once within ``delay`` of event time
    (``dropDuplicatesWithinWatermark``), and its state goes when the watermark, the newest event time less the
    delay, has passed. Rows that come behind the watermark are not judged; they are appended to ``late``, none
    is lost. Rows without an event time are late ones too.

    Both tables are written by batch, ``batch=<id>``, and overwritten if a batch runs again, so a restart
    neither repeats nor loses rows. Runs over everything landed so far and returns the batches' progress."""
    rows = molecule_stream(spark, landing, max_files_per_trigger, landed=True).withWatermark("landed", delay)
    kept = rows.where("landed is not null").dropDuplicatesWithinWatermark(["smiles"]).withColumn("kept", F.lit(True))
    both = kept.unionByName(rows.withColumn("kept", F.lit(False)))
    newest = f"{checkpoint}/newest"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        session = batch.sparkSession
        came = batch.where("not kept").drop("kept")
        came.agg(F.max("landed").alias("landed")).write.mode("overwrite").parquet(f"{newest}/batch={batch_id}")
        # rows are judged by the watermark that the batch before this one ran with
        before = session.read.schema("landed timestamp, batch long").parquet(newest).where(F.col("batch") < batch_id - 1)
        passed = before.agg((F.max("landed") - F.expr(f"interval {delay}")).alias("passed")).first().passed  # one row a batch
        behind = F.col("landed").isNull() if passed is None else F.col("landed").isNull() | (F.col("landed") <= F.lit(passed))
        came.where(behind).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        batch.where("kept").drop("kept").write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        batch.unpersist()

    q = (both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return [p if isinstance(p, dict) else p.json for p in q.recentProgress]
