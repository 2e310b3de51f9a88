import pytest

#: Names that the operators use inside; a document table may have them too.
CLASHING = ("fp", "queue", "run", "rank", "label", "spans", "score", "minimiser", "text_key", "row_key", "_row_key", "key", "hash", "row", "component_id", "n", "base")


def awkward_rows():
    """Nulls in any column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(60000))
    rows = [(None, None, None), (None, "a text without id", "s1"), (1, "", "s0"), (2, " \n\t ", None), (3, long, "s0"),
            (4, "the same words are here twice over", "s1"), (5, "the same words are here twice over", "s1"),
            (5, "the same words are here twice over", "s1"), (6, "Éa ñ \U0001f600 password = hunter22 x@y.org", "s2"),
            (7, "idiot " * 20, "s0"), (8, "x", "s0"), (-9, long + " tail", None)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, *[f"{i}"] * len(CLASHING)) for i, r in enumerate(awkward_rows())]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


def pairs(df):
    """(doc_id, text) rows with null texts empty."""
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
