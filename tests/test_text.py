"""Record transforms against row-level cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from florispark.functions import text as T


def one(spark, column, **values):
    """A column over one row of the given values."""
    rows = spark.range(1)
    for k, v in values.items():
        rows = rows.withColumn(k, F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v))
    return rows.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "raw,numbers,generic,leftover",
    [
        (" 90106-38-0 / 8000-34-8", ["90106-38-0", "8000-34-8"], False, None),
        ("100209- 50-5", ["100209-50-5"], False, None),
        ("999999-99-4 (Generic); 56-81-5", ["56-81-5"], True, None),
        ("56-81-5, 56-81-5", ["56-81-5"], False, None),
        ("n/a", [], False, "n a"),
        ("", [], False, None),
        (None, [], False, None),
    ],
)
def test_split_cas(spark, raw, numbers, generic, leftover):
    got = one(spark, T.split_cas(F.col("v").cast("string")), v=raw)
    assert (got.numbers, got.is_generic, got.leftover) == (numbers, generic, leftover)
    assert got.primary == (numbers[0] if numbers else None)


@pytest.mark.parametrize(
    "raw,cited,cmr",
    [
        ("CMR1B II/656", [("II", "656")], "1B"),
        ("V/54 III/65", [("V", "54"), ("III", "65")], None),
        ("annex III/264", [("III", "264")], None),
        ("VI/4a", [("VI", "4a")], None),
        ("viii / 3", [("VIII", "3")], None),
        ("Suspected carcinogen based on ECHA", [], None),
    ],
)
def test_citations(spark, raw, cited, cmr):
    assert [tuple(x) for x in one(spark, T.citations(F.col("v")), v=raw)] == cited
    assert one(spark, T.cmr_class(F.col("v")), v=raw) == cmr


@pytest.mark.parametrize(
    "name,norm,two,words",
    [
        ("Rosa × damascena", "rosa damascena", "rosa damascena", 2),
        ("Rosa x damascena", "rosa damascena", "rosa damascena", 2),
        ("Ficus sarmentosa var. thunbergii", "ficus sarmentosa thunbergii", "ficus sarmentosa", 3),
        ("Xanthium", "xanthium", "xanthium", 1),
        ("", "", "", 0),
    ],
)
def test_norm_name(spark, name, norm, two, words):
    n = T.norm_name(F.col("v"))
    assert one(spark, n, v=name) == norm
    assert one(spark, T.first_words(n, 2), v=name) == two
    assert one(spark, T.word_count(n), v=name) == words


def test_tokens_and_binomial(spark):
    words = T.tokens(F.col("v"), ["HYDROLYZED"])
    assert one(spark, words, v="Hydrolyzed Rosa Damascena/Flower, Oil.") == ["ROSA", "DAMASCENA", "FLOWER", "OIL"]
    b = one(spark, T.binomial(T.tokens(F.col("v")), ["OIL"], ["OIL"]), v="UVA-URSI SEED OIL")
    assert (b.genus.lower(), b.epithet) == ("uva-ursi", "seed")
    assert one(spark, T.binomial(T.tokens(F.col("v")), ["OIL"], ["OIL"]), v="OIL SEED") is None
    assert one(spark, T.binomial(T.tokens(F.col("v"))), v="GLYCERIN") is None


def test_description_candidates(spark):
    text = "Extract of the seed of Pinus pinaster (syn. Pinus maritima), see Abies alba, Pinaceae."
    got = one(spark, T.description_candidates(F.col("v"), noise=["Extract"]), v=text)
    assert got.family == "Pinaceae" and [tuple(x) for x in got.candidates] == [("Pinus", "pinaster"), ("Abies", "alba")]
    pick = lambda genus: tuple(one(spark, T.pick_candidate(T.description_candidates(F.col("v"))["candidates"], F.lit(genus)), v=text))
    assert pick("Pinus") == ("Pinus", "pinaster") and pick("Pynus") == ("Pinus", "pinaster") and pick("Rosa") == ("Abies", "alba")
    assert one(spark, T.description_candidates(F.col("v")), v="glycerin").family is None
    for name in T.CONSERVED_FAMILIES:
        got = one(spark, T.description_candidates(F.col("v")), v=f"Seeds of Ammi visnaga, Apiaceae, once {name}, see Bunium persicum")
        assert got.family == name and [tuple(x) for x in got.candidates] == [("Seeds", "of"), ("Ammi", "visnaga")]


@pytest.mark.parametrize(
    "a,b,kind",
    [
        (("Pinus", "pinaster"), ("Pinus", "pinaster"), "agree"),
        (("Phyllanthus", "emblica"), ("Phyllanthus", "niruri"), "species_mismatch"),
        (("Arctostaphylos", "uva"), ("Arctostaphylos", "uva-ursi"), "inci_truncated"),
        (("Oenocarpus", "bataua"), ("Oenocarpus", "bacaba"), "species_mismatch"),
        (("Rosa", "canina"), ("Rosa", "canine"), "spelling_variant"),
        (("Rosa", "canina"), ("Malus", "domestica"), "genus_mismatch"),
        (("Rosa", "canina"), ("Rosa", None), "desc_unparsed"),
        (("Rosa", "spp"), ("Rosa", "canina"), "genus_level_entry"),
        ((None, None), ("Rosa", "canina"), "inci_not_binomial"),
        (("Rosa", "canina"), ("Rosa", "x"), "hybrid"),
    ],
)
def test_disagreement(spark, a, b, kind):
    got = one(spark, T.disagreement(*(F.col(c).cast("string") for c in ("p", "q", "r", "s"))), p=a[0], q=a[1], r=b[0], s=b[1])
    assert got == kind


def test_small_ones(spark):
    assert one(spark, T.split_list(F.col("v")), v=" a ,, b ,") == ["a", "b"]
    assert one(spark, T.id_list(F.col("v")), v="12| x|7 |") == ["12", "7"]
    assert one(spark, T.join_list(F.array(F.lit("a"), F.lit(None), F.lit(""), F.lit("b")))) == "a | b"
    assert one(spark, T.to_date_dmy(F.col("v")), v="03/02/2020") == datetime.date(2020, 2, 3)
    assert one(spark, T.to_date_dmy(F.col("v")), v=" ") is None and one(spark, T.to_date_dmy(F.col("v")), v="x") is None
    p = one(spark, T.regulation_parts(F.col("v")), v="II/1254")
    assert (p.annex, p.entry) == ("II (Prohibited)", "1254")
    assert one(spark, T.regulation_parts(F.col("v")), v="a much longer / sentence").annex is None
    assert one(spark, T.restriction_prefix(F.col("v")), v="III/1") == "III" and one(spark, T.restriction_prefix(F.col("v")), v="x") == "other"
    assert one(spark, T.minify_markup(F.col("v")), v='<?xml v?> <a class="x" id=\'y\'>\n b <!-- c\n --> </a>') == "<a> b </a>"
    assert one(spark, T.chunk_key(F.col("v")), v="É") == "__" and one(spark, T.chunk_key(F.col("v")), v="Rosa") == "ro"
    word, log = T.apply_rules(F.col("v"), [("a", "b", None), ("b", "c", "s")], F.lit("s"))
    assert (one(spark, word, v="a"), one(spark, log, v="a")) == ("c", "a->b; b->c")
    assert one(spark, T.is_systematic(F.col("v")), v="2,3-dimethyl") and not one(spark, T.is_systematic(F.col("v")), v="linalool")
    assert one(spark, T.map_tokens(F.split("v", " "), {"SEED": "seed", "NUT": "seed", "OIL": "oil"}), v="NUT X SEED OIL") == ["seed", "oil"]
    assert one(spark, T.preferred_names(F.col("v"), F.lit("Rosa canina"), 3), v=["Dog rose", "dog ROSE", "Rosa canina", "Rosa x", "briar"]) == ["Dog rose", "briar"]
