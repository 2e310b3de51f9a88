"""Stage counters observed on the job that writes the clean table."""

from pyspark.sql import functions as F

from retort.operators import clean as C

SCHEMA = "smiles string, source_rank int, ordinal int, name string, _rows string, _first array<string>"


def frame(spark, n):
    """Null, empty, invalid and repeated keys; one key holds a third of all rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "CCO").when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 11 == 0, "")
        .when(F.col("id") % 13 == 0, "C1CC").otherwise(F.repeat(F.lit("C"), (F.col("id") % 50 + 1).cast("int"))).alias("smiles"),
        (F.col("id") % 4).cast("int").alias("source_rank"), F.col("id").cast("int").alias("ordinal"),
        F.concat(F.lit("n"), "id").alias("name"), F.concat(F.lit("r"), "id").alias("_rows"), F.array(F.col("id").cast("string")).alias("_first"))


def test_counts_and_rows(spark, tmp_path):
    df = frame(spark, 5000)
    got = C.write_profiled(df, f"{tmp_path}/out")
    assert got.collect() == C.profile_stages(df).collect()
    rows = spark.read.parquet(f"{tmp_path}/out")
    wanted = C.dedupe_first(C.drop_missing(df, ["smiles"])).where("smiles != 'C1CC'")
    assert rows.columns == df.columns
    assert sorted(rows.collect()) == sorted(wanted.collect())
    assert rows.count() == got.first().final


def test_no_scan_beside_the_write(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = frame(spark, 900).mapInArrow(count, SCHEMA)
    C.write_profiled(df, f"{tmp_path}/out").collect()
    assert read.value == 900


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in C.write_profiled(df, f"{tmp_path}/none").collect()] == [(0, 0, 0, 0, 0)]
    assert spark.read.parquet(f"{tmp_path}/none").count() == 0
    df = spark.createDataFrame([(None, 0, 0, "a", "b", []), ("", 0, 1, "c", "d", [])], SCHEMA)
    assert [tuple(r) for r in C.write_profiled(df, f"{tmp_path}/blank").collect()] == [(2, 0, 0, 0, 0)]


def test_empty_by_plan(spark, tmp_path):
    df = frame(spark, 10).where("false")
    assert [tuple(r) for r in C.write_profiled(df, f"{tmp_path}/false").collect()] == [(0, 0, 0, 0, 0)]
