"""Readers on untidy input, structural SMILES checks on golden molecules, the join forms."""

import json
import time

import pytest
from pyspark.sql import functions as F

from conftest import one
from retort import constants as K
from retort.functions import smiles as S
from retort.functions import text as T
from retort.operators import molgraph as M
from retort.operators import patents as P
from retort.operators import tags as G
from retort.operators import tokens as TK
from retort.sources import files as SF


def write(tmp_path, name, text):
    (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


GOOD = ["CCO", "C(C)C", "C1CC1", "C1CC11CC1", "C12CC1CC2", "C%10CC%10", "[13CH4]", "[NH4+]", "[Fe+2]", "[C@@H](N)(C)O", "c1ccc2ccccc2c1", "*C", "C1(CC1)C", "C1.C1"]
BAD = ["C()C", "C11", "C1C1", "C1(C1)", "C((C))", "[??]", "[]", "C12C1CC2", "[Na+99999999999]", "C%1010", "C(C", "C=", "1CC1", ""]


def test_structural_check(spark):
    rows = spark.createDataFrame([(s,) for s in GOOD + BAD] + [(None,)], "x string")
    got = {r.x: r.ok for r in rows.select("x", S.valid_smiles("x").alias("ok")).collect()}
    assert [s for s in GOOD if not got[s]] == [] and [s for s in BAD if got[s]] == [] and got[None] is False


@pytest.mark.parametrize("smiles,weight,hydrogens", [("CC(=O)Oc1ccccc1C(=O)O", 180.159, 8), ("Cn1cnc2c1c(=O)n(C)c(=O)n2C", 194.194, 10), ("CCO", 46.069, 6), ("[Fe+2]", 55.845, 0)])
def test_golden_molecules(spark, smiles, weight, hydrogens):
    atoms, _ = M.graph(spark.createDataFrame([(1, smiles)], "mol_id int, smiles string"))
    assert M.molecule_stats(atoms).first().molecular_weight == pytest.approx(weight, abs=2e-3)
    assert atoms.agg(F.sum("total_h")).first()[0] == hydrogens


def test_csv_keeps_quotes_and_skips_bad_literals(spark, tmp_path):
    tags = ["parkinson's drug", 'a "quoted" tag', "back\\slash", "two\nlines"]
    df = spark.createDataFrame([("CCO", tags), ("C", [])], "smiles string, applications array<string>")
    assert SF.write_compounds(df, str(tmp_path / "out"), "csv")
    got = {r.smiles: r for r in SF.read_compound_csvs(spark, str(tmp_path / "out")).collect()}
    assert got["CCO"].applications == tags and got["CCO"].parse_ok and got["C"].applications == []
    assert one(spark, T.parse_list("x"), value="['a', \"it's\"]") == ["a", "it's"]


def test_csv_keeps_rows_with_line_breaks_in_any_column(spark, tmp_path):
    rows = [("two\nlines", "CCO", ["a", "x\ny"], "some\r\n\"quoted\" words, a, b"), ("plain", "C", ["b"], "c"), ("\n", "CC", ["c"], "ends\n")]
    df = spark.createDataFrame(rows, "name string, smiles string, applications array<string>, description string")
    assert SF.write_compounds(df, str(tmp_path / "out"), "csv")
    other = write(tmp_path, "other.csv", 'name,smiles,applications,note\n"first\nsecond","N","[\'d\']","a\nC,O,P"\nx,O,not a list,y\n')
    got = sorted((r.smiles, r.applications, r.parse_ok) for r in SF.read_compound_csvs(spark, [str(tmp_path / "out"), other]).collect())
    assert got == [("C", ["b"], True), ("CC", ["c"], True), ("CCO", ["a", "x\ny"], True), ("N", ["d"], True), ("O", None, False)]


PAGE = {"molecules": [{"molecule_structures": {"canonical_smiles": "CCO"}, "molecule_chembl_id": "X1", "pref_name": None}, {"molecule_structures": None}]}


def test_pages_without_number_pretty_and_broken(spark, tmp_path):
    path = write(tmp_path, "a.json", json.dumps(PAGE) + "\n{not json\n" + json.dumps({"page": 3, "molecules": []}) + "\n" + json.dumps({**PAGE, "page": 7}) + "\n")
    rows = SF.read_molecule_pages(spark, path).collect()
    assert sorted((r.page, r.offset, r.smiles, r.compound_id) for r in rows if r.smiles) == [(0, 0, "CCO", "X1"), (7, 0, "CCO", "X1")]
    assert len(rows) == 4 and {r.compound_id for r in rows if not r.smiles} == {"CHEMBL_UNKNOWN_0_0", "CHEMBL_UNKNOWN_7_700"}
    assert [r.text for r in SF.bad_pages(spark, path).collect()] == ["{not json"]
    pretty = tmp_path / "pretty"
    pretty.mkdir()
    (pretty / "p.json").write_text(json.dumps({**PAGE, "page": 2}, indent=2))
    assert [r.smiles for r in SF.read_molecule_pages(spark, str(pretty), pretty=True).collect()] == ["CCO", None]


def test_sdf_with_either_line_end_repeats_and_long_values(spark, tmp_path):
    long = "\n".join(f"synonym {i}" for i in range(20000))
    mol = "name\n  x\n\n  0  0\nM  END\n"
    records = [mol + "> <ID>\nA1\n\n> <SYNONYMS>\n" + long + "\n\n> <ID>\nA2\n\n", "broken\n> <ID>\nB\n\n", mol + ">  <ID> (7)\nC\nsecond\n\n> <EMPTY>\n\n"]
    for eol in ("\n", "\r\n"):
        folder = tmp_path / f"s{len(eol)}"
        folder.mkdir()
        (folder / "f.sdf").write_bytes(("$$$$\n".join(records) + "$$$$\n").replace("\n", eol).encode())
        rows = sorted(SF.read_sdf(spark, str(folder)).collect(), key=lambda r: r.mol_idx)
        assert [r.mol_idx for r in rows] == [0, 2]
        assert rows[0].props == {"ID": "A2", "SYNONYMS": long} and rows[1].props == {"ID": "C\nsecond", "EMPTY": ""}
        assert SF.read_sdf(spark, str(folder), cap=1).count() == 1
        assert [r.ok for r in SF.read_sdf(spark, str(folder), keep_broken=True).orderBy("mol_idx").collect()] == [True, False, True]


def test_categories_by_join(spark):
    dim = spark.createDataFrame([(1, "b", "Dye"), (0, "a", "drug"), (2, "c", "x" * 80), (3, "d", "")], "cat_rank int, category string, keyword string")
    df = spark.createDataFrame([(1, "the dye thing"), (2, "DRUGDYE"), (3, "y" + "X" * 80), (4, None), (5, "none")], "k int, hint string")
    got = {r.k: (r.first_category, r.categories) for r in G.categories_by_join(df, "k", "hint", dim).collect()}
    assert got == {1: ("b", ["b"]), 2: ("a", ["a", "b"]), 3: ("c", ["c"]), 4: ("unknown", []), 5: ("unknown", [])}


def test_encode_and_decode_by_join(spark):
    df = spark.createDataFrame([(1, "CCO"), (2, ""), (3, "C[Xx]")], "row_id int, smiles string")
    vocab = TK.build_vocab(df.where("row_id = 1"))
    enc = TK.encode_tokens(df, vocab)
    ids = {r.row_id: r.ids for r in enc.collect()}
    assert ids[2] == [K.BOS_ID, K.EOS_ID] and ids[3][2] == K.UNK_ID and len(ids[1]) == 5
    assert {r.row_id: r.decoded for r in TK.decode_tokens(enc, vocab).collect()} == {1: "CCO", 2: "", 3: "C"}


def test_candidates_of_long_runs(spark):
    text = "word " * 20000
    df = spark.createDataFrame([(text,), (text + "12",), ("Compound name 7 and more 8x",)], "t string")
    start = time.time()
    df.select(P.candidates("t")).collect()
    assert time.time() - start < 15
    import re
    for (t,) in [("Compound name 7 and more 8x 9",), ("éa bc 12 d 3",), ("A 1 b  22c x 5",)]:
        p = r"\b[A-Z][a-z]*(?:\s+[a-z]+)*\s+\d+\b"
        assert one(spark, P.pattern_matches(F.col("x"), p), value=t) == re.findall(p, t, re.I)


def test_candidates_match_python_re_on_all_documents(spark, sf_dir):
    import re

    from retort.plans import adapters as A
    text = lambda r: " ".join(x for x in (r.title, r.abstract) if x)
    rows = A.patents(spark, sf_dir).select("title", "abstract", P.candidates(T.join_text("title", "abstract"), n=1000).alias("c")).collect()
    for r in rows:
        t, want = text(r), []
        for p in K.CHEMICAL_PATTERNS:
            want += [x.strip() for x in (m[0] for m in re.finditer(p, t, re.I)) if 3 < len(x.strip()) < 50]
        for p in K.CHEMICAL_INDICATORS:
            want += [m[1].strip() for m in re.finditer(p, t, re.I) if m[1].strip()]
        assert r.c == list(dict.fromkeys(want))[:1000]


def test_similar_sets_keep_copies_together(spark):
    from retort.operators import similarity as SIM
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(i, base) for i in range(40)] + [(100, base + " end"), (101, "other words that are nowhere else"), (102, ""), (103, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    members, pairs = SIM.similar_sets(df)
    assert pairs.count() == 1 and members.select("set").distinct().count() == 3
    assert SIM.similar(df).count() == 40 * 39 // 2 + 40 == SIM.similar_lsh(df).count()
    refs = spark.createDataFrame([(7, base)], "doc_id long, text string")
    assert [(r.ref_id, r.doc_id) for r in SIM.similar(df, refs=refs, n=2).orderBy("doc_id").collect()] == [(7, 0), (7, 1)]


def test_annotate_takes_the_landed_status(spark):
    df = spark.createDataFrame([(1, "CCO", "ethanol"), (2, "C", "x"), (3, "N", "y")], "row_id int, smiles string, name string")
    landed = spark.createDataFrame([(1, "solvent, fuel", "ok"), (2, "solvent, fuel", "error")], "key int, raw_text string, landed string")
    got = {r.row_id: r for r in G.annotate(df, landed, landed_status="landed").collect()}
    assert (got[1].status, got[2].status, got[3].status) == ("ok", "error", "missing")
    assert "solvent" in got[1].tags and "solvent" not in got[2].tags


def test_a_source_that_breaks_late_is_skipped(spark, tmp_path):
    from retort.sources.collect import collect_sources
    bad = lambda: spark.range(100).select(F.col("id").alias("ordinal"), F.when(F.col("id") == 99, F.raise_error(F.lit("late"))).otherwise(F.lit("C")).alias("smiles"))
    good = lambda: spark.range(5).select(F.col("id").alias("ordinal"), F.lit("CC").alias("smiles"))
    got = collect_sources([("bad", bad, None), ("good", good, 3)], landing=str(tmp_path / "l")).collect()
    assert [(r.plan_source, r.ordinal) for r in sorted(got, key=lambda r: r.ordinal)] == [("good", 0), ("good", 1), ("good", 2)]


def test_scratch_is_the_applications_own(spark):
    from retort.session import scratch_path, scratch_root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(scratch_root(spark)) and spark.sparkContext.applicationId in a


def test_lsh_finds_the_pairs_of_any_threshold(spark):
    from retort.operators import similarity as SIM
    assert SIM.banding(90) == (12, 4) and SIM.banding(100) == (1, 4)
    for t in range(1, 100):
        bands, rows = SIM.banding(t)
        assert (1 - (t / 100) ** rows) ** bands <= SIM.MISS_RATE
    with pytest.raises(ValueError):
        SIM.banding(0)
    # pairs of 40 and 40 words with 30 in common: Jaccard 0.6 of single words
    texts = [(2 * i + s, " ".join([f"a{i}x{j}" for j in range(30)] + [f"b{i}x{s}x{j}" for j in range(10)])) for i in range(60) for s in (0, 1)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    pairs = lambda d: sorted((r.ref_id, r.doc_id, r.jaccard) for r in d.collect())
    assert pairs(SIM.similar_lsh(df, threshold=50, k=1)) == pairs(SIM.similar(df, threshold=50, k=1)) == [(2 * i, 2 * i + 1, 0.6) for i in range(60)]
    assert len(pairs(SIM.similar_lsh(df, threshold=50, k=1, bands=12, rows=4))) < 60


@pytest.mark.parametrize("n", [0, 3, 10, 25, 10**12])
def test_samples_cycle_without_making_every_row(spark, n):
    from retort.sources import collect as SC

    first = {}
    for i in range(min(n, 100)):
        s, name, apps = K.PHARMA_SAMPLES[i % len(K.PHARMA_SAMPLES)]
        first.setdefault(s, (K.PHARMA_ID_FORMAT % i, name, list(apps)))
    seen = spark.createDataFrame([(K.PHARMA_SAMPLES[1][0],)], "smiles string")
    got = {r.smiles: (r.compound_id, r.name, r.applications) for r in SC.sample_compounds(spark, "pharma", n, seen).collect()}
    assert got == {k: v for k, v in first.items() if k != K.PHARMA_SAMPLES[1][0]}


def test_a_name_is_lowered_once(spark):
    """The categories of a name test one bound value, not the name's expression again for each keyword."""
    from retort.operators import tags as G
    df = spark.createDataFrame([(["Drug", "ink"],), (None,), ([],)], "tags array<string>").select(G.name_categories(F.array_join("tags", " ")).alias("c"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1
    assert [r.c for r in df.collect()][1:] == [[], []]


def test_patterns_run_on_texts_that_hold_what_they_need(spark):
    """Letters that match an ASCII letter only when case is ignored count as held; others' texts skip the pattern."""
    from retort.operators import patents as P
    import retort.constants as K
    assert set(P._NEEDS) <= set(K.CHEMICAL_PATTERNS + K.CHEMICAL_INDICATORS)
    texts = ["ſyntheſıs of glue", "The DRUG Xylo", "ethanİne İs", "preparatıon of ink", "therapeutİc agent x", "plain words", "benzoic acid was", "aKne", ""]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for p in K.CHEMICAL_PATTERNS + K.CHEMICAL_INDICATORS:
        g = 0 if p in K.CHEMICAL_PATTERNS else 1
        x = F.col("x")
        for r in df.select("x", P.pattern_matches(x, p, g).alias("want"), P._matches(x, P.folded(x), p, g).alias("got")).collect():
            assert r.got == r.want, (p, r.x)
