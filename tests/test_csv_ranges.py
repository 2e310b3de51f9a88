"""CSV records put together from byte ranges, against Spark's one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from retort.sources import csv_ranges as R
from retort.sources import files as SF


#: Bytes of a range: so few that many records meet a range's end.
SMALL = 1500


def one_task(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def value(rng):
    kind = rng.random()
    text = "".join(rng.choice(["ab", "é", ",", "\n", '"', "\r\n", " ", "x" * 30, "\n\n", '",', ',"', '"\n"']) for _ in range(rng.randint(0, 12)))
    if kind < 0.3:
        return "".join(c for c in text if c not in ',\n\r"') + "z"
    if kind < 0.4:  # a quote that opens nothing
        return "5" + "".join(c for c in text if c not in ",\n\r")
    return '"' + text.replace('"', '""') + '"'


@pytest.mark.parametrize("seed,newline", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_equals_the_one_task_reader(spark, tmp_path, seed, newline):
    rng = random.Random(seed)
    for name in ("a.csv", "b.csv"):
        lines = ["name,smiles,note"] + [",".join([*(value(rng) for _ in range(2)), str(i)]) for i in range(700)]
        (tmp_path / name).write_bytes((newline.join(lines) + newline).encode())
    got = R.read_csv(spark, str(tmp_path), range_bytes=SMALL)
    assert got.columns == ["name", "smiles", "note"]
    want = rows(one_task(spark, str(tmp_path)))
    assert rows(got) == want and len(want) == 1400


def test_one_value_over_many_ranges(spark, tmp_path):
    long = "\n".join(f"line {i}, with \"\"quotes\"\" and commas" for i in range(2000))
    (tmp_path / "x.csv").write_text(f'\n\nsmiles,"app\nlications",note\nC,"{long}",1\n\nN,b,2\nO,"x\n",3')
    got = R.read_csv(spark, str(tmp_path), range_bytes=SMALL)
    assert got.columns == ["smiles", "app\nlications", "note"]
    assert rows(got) == rows(one_task(spark, str(tmp_path))) and got.count() == 3


def test_untidy_files(spark, tmp_path):
    for name, text in {"short.csv": "a,b,c\n1\n1,2,3,4\n\n,,\n", "head.csv": "a,b\n", "quotes.csv": 'a,b\n"",""""\n"x""",\n'}.items():
        path = tmp_path / name
        path.write_text(text)
        assert rows(R.read_csv(spark, str(path), range_bytes=SMALL)) == rows(one_task(spark, str(path))), name
    never_closed = tmp_path / "open.csv"
    never_closed.write_text('a,b\n1,"never closed\n2,x\n')
    assert rows(R.read_csv(spark, str(never_closed), range_bytes=6)) == [("1", "never closed\n2,x")]  # the file's last line feed ends it
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    for bad in (str(empty), str(tmp_path / "absent.csv")):
        with pytest.raises(Exception):
            R.read_csv(spark, bad)
    assert SF.read_compound_csvs(spark, [str(empty), str(tmp_path / "absent.csv")]).count() == 0


def test_a_file_is_read_in_many_ranges(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n" + "1,2\n" * 5000 + '"x\ny",3\n')
    lines = spark.read.text(str(tmp_path)).select(F.lit("f").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value")
    effects = R._effects(lines.coalesce(1), ",").collect()
    assert [(r.end0, r.end1) for r in effects] == [(False, False)]  # the last value closes, whatever came before
    got = R.csv_records(spark, str(tmp_path), range_bytes=SMALL)
    assert got.count() == 5001 and got.where(F.col("record").contains("\n")).count() == 1
    assert len(got.inputFiles()) > 5  # a file of records for each task


def test_states_compose_over_ranges(spark):
    """Every chain of effects: keep, turn, always out, always in."""
    rng = random.Random(2)
    effects, want = [], {}
    for f in range(60):
        state, opened = False, None
        for r in range(12):
            want[f"{f}", r] = (state, opened if state else None)
            e = rng.choice([(False, True), (True, False), (False, False), (True, True)])
            began = (e[0], e[1] and rng.random() < 0.5)
            effects.append((f"{f}", r, *e, *began, f % 2 == 0))
            if began[state]:
                opened = r
            state = e[state]
    got = R._states(spark.createDataFrame(effects, R.EFFECTS)).collect()
    assert {(r.file, r.range): (r.inside, r.from_range if r.inside else None) for r in got} == {k: v for k, v in want.items() if k[1] > 0}
    assert all(r.crlf == (int(r.file) % 2 == 0) for r in got)


def test_line_breaks_are_written_and_read_by_many_tasks(spark, sf_dir, tmp_path):
    """No task of csv_line_breaks holds the whole table: as many files as the scan has tasks."""
    from pathlib import Path

    from retort.plans import q_sources as Q
    from retort.session import scratch_root

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    before = set(Path(scratch_root(spark)).glob("csv-*/texts"))
    got = Q.q_csv_line_breaks(spark, str(tmp_path))
    (path,) = set(Path(scratch_root(spark)).glob("csv-*/texts")) - before
    assert len(list(path.glob("part-*"))) > 1
    want = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "source", F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
