import random

import pytest
from pyspark.sql import functions as F

from targetlens.functions import flags, text
from targetlens.operators.shape import sanitize_columns


def values(spark, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "name, key",
    [
        ("Gene stable ID", "gene_stable_id"),
        ("CDS end (within cDNA)", "cds_end_within_cdna"),
        ("% identity", "identity"),
        ("a.b#c$d/e[f]", "a_b_c_d_e_f"),
        ("__x__", "x"),
        ("tab\tand  blank", "tab_and_blank"),
        ("no\u00a0break", "no_break"),
    ],
)
def test_sanitize(spark, name, key):
    assert text.sanitize_name(name) == key
    assert values(spark, [name], text.sanitize_text) == [key]


def test_sanitize_columns_refuses_clash(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `A.b` int")
    with pytest.raises(ValueError, match="a_b"):
        sanitize_columns(df)


def test_keyword_and_pattern(spark):
    items = ["Larval LETHAL", "viable", None]
    assert values(spark, items, lambda c: text.keyword_match(c, "lethal")) == [True, False, False]
    assert values(spark, items, lambda c: text.pattern_match(c, "lethal")) == [False, False, False]


def test_gpcr_pattern(spark):
    items = [
        "IPR1 - GPCR kinase", "IPR1 - GPCR, rhodopsin-like", "IPR1 - GPCR",
        "IPR1 - G-protein coupled receptor kinase",
    ]
    pattern = "G-protein coupled receptor|GPCR.[^k]"
    found = values(spark, items, lambda c: text.pattern_match(c, pattern))
    assert found == [False, True, False, True]


def test_tokens(spark):
    items = ["A; B,C D", "AB", ";A", None, ""]
    assert values(spark, items, lambda c: text.has_token(c, ["B", "D"])) == [
        True, False, False, False, False,
    ]
    assert values(spark, items, lambda c: text.has_token(c, [])) == [False] * 5
    assert values(spark, [";A"], text.cell_tokens) == [["", "A"]]


def test_has_text(spark):
    assert values(spark, ["x", " \t\n", "", None, " "], text.has_text) == [
        True, False, False, False, False,
    ]


def test_slug_and_uri(spark):
    items = [
        "Wuchereria bancrofti (PRJNA275548)", "Trichuris muris (PRJEB126)", "Ascaris suum",
        "\tLoa loa(PRJNA37757) extra", None,
    ]
    assert values(spark, items, text.species_slug) == [
        "Wuchereria_bancrofti_prjna275548", None, None, "Loa_loa_prjna37757", None,
    ]
    both = values(spark, items, lambda c: text.species_slug(c, ["PRJNA", "PRJEB"]))
    assert both[1] == "Trichuris_muris_prjeb126"
    uris = values(spark, items, lambda c: text.gene_uri(c, F.lit("g1"), "http://h"))
    assert uris[0] == "http://h/Wuchereria_bancrofti_prjna275548/Gene/Summary?g=g1"
    assert uris[1] is None
    spelled = values(
        spark, items, lambda c: text.gene_uri(c, F.lit("g1"), "http://h", missing_slug="None")
    )
    assert spelled[1] == "http://h/None/Gene/Summary?g=g1"
    assert spelled[4] is None


def test_exact_column_names(spark):
    df = spark.createDataFrame([(1,)], "`Genome name` int")
    assert flags.has_column(df, "Genome name")
    assert not flags.has_column(df, "Genome Name")


def test_number_text_equals_the_usual_spelling(spark):
    picks = random.Random(4)
    numbers = [0.0, 1.0, 45.5, 100.0, 0.001, 0.0001, 0.00025, 1e7, 12345678.9, 9.5e15, -0.0005]
    numbers += [round(picks.uniform(0, 100), picks.randrange(1, 8)) for _ in range(300)]
    numbers += [round(picks.uniform(0, 0.002), 6) + 0.0001 for _ in range(100)]
    numbers = [number for number in numbers if number == 0 or abs(number) >= 1e-4]
    df = spark.createDataFrame(list(enumerate(numbers)), "i int, n double")
    got = [r[0] for r in df.orderBy("i").select(text.number_text(F.col("n"))).collect()]
    assert got == [str(number) for number in numbers]
