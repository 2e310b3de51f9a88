"""Golden values for the column functions, reasoned from the reference's
semantics (list literals, tag cleaning, answer parsing, SMILES tokens)."""

from pyspark.sql import functions as F

from conftest import one
from retort import constants as K
from retort.functions import smiles as S
from retort.functions import text as T


def test_parse_list_literals(spark):
    assert one(spark, T.parse_list("x"), value="['a', 'b']") == ["a", "b"]
    assert one(spark, T.parse_list("x"), value='["it\'s", \'x\']') == ["it's", "x"]
    assert one(spark, T.parse_list("x"), value="[]") == []
    assert one(spark, T.parse_list("x"), value="['a', ") is None


def test_clean_tags_list_and_string(spark):
    df = spark.createDataFrame([([" B ", "a", "", "a", "  "],)], "x array<string>")
    assert df.select(T.clean_tags("x")).first()[0] == ["a", "b"]
    assert one(spark, T.clean_tags_from_string("x"), value="x, Y ,, x") == ["x", "y"]
    assert one(spark, T.clean_tags_from_string("x"), value=None) == []
    # Python strip() removes every Unicode blank, not only U+0020
    assert one(spark, T.clean_tags_from_string("x"), value=" Tag\t") == ["tag"]


def test_parse_tags_json(spark):
    text = 'Answer: ["Solvent", 3, " ", "ab", "Fuel additive"] and [ "later" ]'
    assert one(spark, T.parse_tags_json("x"), value=text) == ["solvent", "fuel_additive"]
    # an array with no usable strings gives the unknown tag, not the comma path
    assert one(spark, T.parse_tags_json("x"), value="[1, 2], a, b") == [K.UNKNOWN_APPLICATION]
    # broken JSON with a comma: comma fallback, quotes stripped, length 3..50
    assert one(spark, T.parse_tags_json("x"), value='[oops, "Dye", ab, "Heat transfer"') == \
        ["[oops", "dye", "heat_transfer"]
    assert one(spark, T.parse_tags_json("x"), value="no list here") == [K.UNKNOWN_APPLICATION]
    six = ", ".join(f'"tag{i}"' for i in range(6))
    assert one(spark, T.parse_tags_json("x"), value=f"[{six}]") == [f"tag{i}" for i in range(5)]


def test_parse_answer(spark):
    assert one(spark, T.parse_answer("x"), value=" Solvent, , Fuel ") == ["solvent", "fuel"]
    assert one(spark, T.parse_answer("x"), value="Unknown_Application") == ["unknown_from_gemini"]
    assert one(spark, T.parse_answer("x"), value="   ") == ["unknown_from_gemini"]


def test_keyword_flags_in_rule_order(spark):
    assert one(spark, T.keyword_flags("x"), value="A new DRUG coating process") == \
        ["pharmaceutical_compound", "industrial_chemical", "material_component"]
    assert one(spark, T.keyword_flags("x"), value="nothing relevant") == ["general_chemical_compound"]


def test_strip_paren_and_url(spark):
    assert one(spark, T.strip_paren("x"), value="Aspirin (USP)") == "Aspirin"
    assert one(spark, T.strip_paren("x"), value="(only)") == "(only)"
    assert one(spark, T.url_term("x"), value="a b/c*~") == "a%20b/c%2A~"


def test_first_assignee(spark):
    df = spark.createDataFrame([([("",), (None,), ("Acme",)],), ([],)], "x array<struct<name:string>>")
    assert [r[0] for r in df.select(T.first_assignee("x")).collect()] == ["Acme", "Unknown"]


def test_one_hot_unknown_slot(spark):
    cats = ["A", "B", "Unknown"]
    assert one(spark, T.one_hot("x", cats), value="B") == [0.0, 1.0, 0.0]
    assert one(spark, T.one_hot("x", cats), value="Z") == [0.0, 0.0, 1.0]


def test_tokenize_reference_pattern(spark):
    assert one(spark, S.tokenize("x"), value="CC(=O)O") == ["C", "C", "(", "=", "O", ")", "O"]
    assert one(spark, S.tokenize("x"), value="[NH4+].[Cl-]Br") == ["[NH4+]", ".", "[Cl-]", "Br"]
    # the published pattern wants two backslashes: a single one vanishes
    assert one(spark, S.tokenize("x"), value="F/C=C\\F") == ["F", "/", "C", "=", "C", "F"]
    assert one(spark, S.tokenize("x", K.SMILES_PATTERN_FIXED), value="F/C=C\\F") == \
        ["F", "/", "C", "=", "C", "\\", "F"]
    assert one(spark, S.tokenize("x"), value="C%12CC%12") == ["C", "%12", "C", "C", "%12"]


def test_encode_specials(spark):
    df = spark.createDataFrame([([5, 6],)], "x array<int>")
    assert df.select(S.encode("x")).first()[0] == [K.BOS_ID, 5, 6, K.EOS_ID]
    assert df.select(S.encode("x", special=False)).first()[0] == [5, 6]


def test_valid_smiles(spark):
    good = ["CCO", "c1ccccc1", "CC(=O)Oc1ccccc1C(=O)O", "[Na+].[Cl-]", "F/C=C\\F", "C%10CC%10"]
    bad = ["", "C(C", "C)C(", "c1cccc", "C=", "C(=)C", "Xx", "1CC1"]
    df = spark.createDataFrame([(s,) for s in good + bad] + [(None,)], "x string")
    got = dict(df.select("x", S.valid_smiles("x").alias("v")).collect())
    assert all(got[s] for s in good)
    assert not any(got[s] for s in bad)
    assert not got[None]
