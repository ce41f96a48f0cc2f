import random
from collections import Counter

import pytest

from targetlens import fixed_values as fixed
from targetlens.operators import criteria
from targetlens.operators.closure import descendants


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(
        [(1, "x", 1.0), (2, None, 1.0), (3, "x", float("nan")), (4, None, None)],
        "i int, a string, b double",
    )


@pytest.mark.parametrize(
    "columns, null_is_true, expected",
    [
        (["a", "b"], False, [True, False, False, False]),
        (["a", "b"], True, [False, True, True, True]),
        (["a", "gone"], False, [False, True, False, True]),
        (["a", "gone"], True, [False, True, False, True]),
        (["gone"], False, [False] * 4),
        (["gone"], True, [False] * 4),
        (["A"], False, [False] * 4),
    ],
)
def test_assigned_strict(gaps, columns, null_is_true, expected):
    flagged = criteria.assigned_strict(gaps, columns, "f", null_is_true)
    assert [r["f"] for r in flagged.orderBy("i").collect()] == expected


@pytest.mark.parametrize(
    "columns, null_is_true, expected",
    [
        (["a", "b"], False, [True, False, False, False]),
        (["a", "gone"], False, [True, False, True, False]),
        (["a", "gone"], True, [False, True, False, True]),
    ],
)
def test_assigned_lenient(gaps, columns, null_is_true, expected):
    flagged = criteria.assigned_lenient(gaps, columns, "f", null_is_true)
    assert [r["f"] for r in flagged.orderBy("i").collect()] == expected


def test_nothing_to_judge_adds_no_column(gaps):
    assert criteria.assigned_lenient(gaps, ["gone"], "f", False).columns == gaps.columns
    assert criteria.token_match(gaps, ["gone"], "f", ["x"]).columns == gaps.columns


def test_token_match(spark):
    df = spark.createDataFrame(
        [(1, "A; B,C D", None), (2, None, 5.0), (3, "AB", float("nan")), (4, "x", None)],
        "i int, terms string, n double",
    )
    flagged = criteria.token_match(df, ["terms", "n", "gone"], "f", ["B", "5.0", "NaN"])
    assert [r["f"] for r in flagged.orderBy("i").collect()] == [True, True, False, False]


CONSERVED = [
    (1, 50.0, "s1"), (2, 50.0, "s2"), (3, 50.0, "other"), (4, 60.0, "s1"), (5, 60.0, "s1"),
    (6, 60.0, "other"), (7, 70.0, "s1"), (8, 70.0, "s2"), (9, 70.0, "s3"), (10, None, "s1"),
    (11, float("nan"), "s1"), (12, float("nan"), "s2"), (13, 50.0, None), (14, None, None),
]


def test_conserved_value(spark):
    df = spark.createDataFrame(CONSERVED, "i int, pct double, genome string")
    flagged = criteria.conserved_value(df, "pct", "genome", ["s1", "s2", "s3"], 2)
    got = {r["i"]: r["similar_identity_species"] for r in flagged.collect()}
    assert {i: s for i, s in got.items() if s} == {
        1: ["s1", "s2"], 2: ["s1", "s2"], 3: ["s1", "s2"],
        7: ["s1", "s2", "s3"], 8: ["s1", "s2", "s3"], 9: ["s1", "s2", "s3"],
    }
    assert len(got) == 14
    for r in flagged.collect():
        assert r["has_similar_identity"] == (r["similar_identity_species"] is not None)
    three = criteria.conserved_value(df, "pct", "genome", ["s1", "s2", "s3"], 3)
    assert three.where("has_similar_identity").count() == 3
    absent = criteria.conserved_value(df, "pct", "Genome", ["s1"], 1)
    assert absent.where("has_similar_identity").count() == 0
    with pytest.raises(ValueError):
        criteria.conserved_value(df, "pct", "genome", ["s1"], 0)


def test_conserved_value_with_a_hot_value(spark, no_broadcast, every_key_hot):
    picks = random.Random(3)
    data = [(i, 1.0 if i % 3 else float(picks.randrange(40)), f"s{picks.randrange(4)}")
            for i in range(600)]
    df = spark.createDataFrame(data, "i int, pct double, genome string").repartition(5)
    wanted = ["s0", "s1"]
    species = {}
    for _, value, genome in data:
        if genome in wanted:
            species.setdefault(value, set()).add(genome)
    flagged = criteria.conserved_value(df, "pct", "genome", wanted, 2)
    got = {r["i"]: r["has_similar_identity"] for r in flagged.collect()}
    assert got == {i: len(species.get(value, ())) >= 2 for i, value, _ in data}


def test_protein_or_enzyme(spark):
    columns = ["Biotype", "WormPep", "Protein Domain", "UniProt", "Gene Ontology Association"]
    data = [
        ("Protein_Coding gene", None, None, None, None),
        ("ncRNA", "CE1", "Kinase-like", None, None),
        ("ncRNA", "  ", None, "P1", "CATALYTIC activity"),
        ("ncRNA", None, "zinc finger", "\t", "binding"),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, ", ".join(f"`{name}` string" for name in columns))
    flagged = criteria.protein_or_enzyme(df)
    assert [(r["Is_Protein"], r["Is_Enzyme"]) for r in flagged.collect()] == [
        (True, False), (True, True), (True, True), (False, False), (False, False),
    ]


def test_human_orthologue(spark):
    df = spark.createDataFrame(
        [
            ("g1", "H1", "AAA", 45.5), ("g1", "H2", "BBB", 12.0), ("g2", None, None, None),
            ("g3", "H3", None, 39.9), ("g4", "H4", "DDD", 40.0), ("g5", "H5", "EEE", 0.5),
            (None, "H6", "FFF", 99.0),
        ],
        f"`{fixed.GENE}` string, `{fixed.HUMAN_GENE}` string, `{fixed.HUMAN_GENE_NAME}` string, "
        f"`{fixed.IDENTITY}` double",
    )
    got = {r[0]: tuple(r)[4:] for r in criteria.human_orthologue(df).collect()}
    none = "No human orthologue listed in WormBase ParaSite"
    has = "Has human orthologue(s) in WormBase ParaSite, the most similar is: "
    above = "Best human orthologue found in WormBase Parasite has >= 40% identity: "
    below = "Best human orthologue in WormBase ParaSite has < 40% identity: "
    assert got == {
        "g1": (False, has + "AAA", False, above + "AAA 45.5%"),
        "g2": (True, none, True, none),
        "g3": (False, None, True, None),
        "g4": (False, has + "DDD", False, above + "DDD 40.0%"),
        "g5": (False, has + "EEE", True, below + "EEE 0.5%"),
    }


def test_family_rollup(spark):
    df = spark.createDataFrame(
        [(True, None, True), (False, None, False), (None, True, False)],
        "a boolean, b boolean, c boolean",
    )
    rolled = criteria.family_rollup(df, ["a", "b", "c"], "any")
    assert [tuple(r)[3:] for r in rolled.collect()] == [
        (True, "Meets the following criteria: a, c"),
        (False, "Does not meet the following criteria:  'a', 'b', 'c'"),
        (True, "Meets the following criteria: b"),
    ]


# ------------------------------------------------------------------------------- ontology

EDGES = [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d"), ("e", "a"), ("z", "y")]


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(EDGES, "child string, parent string")


def test_descendants(spark, edges):
    terms = spark.createDataFrame([(t,) for t in "abcdeyz"], "go_id string")
    pairs = rows(descendants(edges, ["a", "d", "e", "y"], terms))
    assert pairs == [
        *[("a", t) for t in "abcde"], ("d", "d"), ("d", "e"), ("e", "e"), ("y", "y"), ("y", "z"),
    ]
    with pytest.raises(ValueError, match="q"):
        descendants(edges, ["a", "q"], terms)


def test_descendants_of_an_alternate_id(spark, edges):
    terms = spark.createDataFrame([(t,) for t in "abcde"], "go_id string")
    alternates = spark.createDataFrame([("b9", "b")], "alt_id string, go_id string")
    pairs = rows(descendants(edges, ["b9", "b"], terms, alternates))
    assert pairs == [
        ("b", "b"), ("b", "d"), ("b", "e"), ("b9", "b9"), ("b9", "d"), ("b9", "e"),
    ]


def test_descendants_of_repeated_roots_and_in_a_loop(spark):
    loop = [("b", "a"), ("c", "b"), ("a", "c"), ("d", "c")]
    edges = spark.createDataFrame(loop, "child string, parent string")
    pairs = rows(descendants(edges, ["a", "c", "a"]))
    assert pairs == [(root, term) for root in "ac" for term in "abcd"]


def closure_by_hand(edges, root):
    below = {}
    for child, parent in edges:
        below.setdefault(parent, set()).add(child)
    seen, todo = {root}, [root]
    while todo:
        for child in below.get(todo.pop(), ()):
            if child not in seen:
                seen.add(child)
                todo.append(child)
    return seen


def test_descendants_with_a_hub_and_no_broadcast(spark, no_broadcast, monkeypatch):
    from targetlens.operators import closure, joins

    find = joins.find_hot_keys
    monkeypatch.setattr(closure, "find_hot_keys", lambda df, on: find(df, on, 2))
    picks = random.Random(5)
    data = [(f"n{i}", "n1") for i in range(2, 150)]
    data += [(f"n{i}", f"n{picks.randrange(i)}") for i in range(1, 300)]
    edges = spark.createDataFrame(data, "child string, parent string").repartition(4)
    got = Counter(r["root"] for r in descendants(edges, ["n0", "n1", "n7"]).collect())
    assert got == {root: len(closure_by_hand(data, root)) for root in ("n0", "n1", "n7")}


ANNOTATIONS = [
    ("g1", "IPR1", "one"), ("g1", "IPR1", "one"), ("g1", "IPR2", "two"), ("g1", "IPR3", "GPCR, x"),
    ("g2", "IPR2", None), ("g2", None, "two"), ("g3", "IPR9", "absent"), ("g4", None, None),
    ("g5", "IPR4", "GPCR kinase"), ("g6", "IPR3", "GPCR, x"), ("g6", "IPR3", "GPCR, x"),
    ("g7", "IPR5", "unrelated term"),
]
DOMAIN_TERMS = [("IPR1", "d"), ("IPR1", "x"), ("IPR2", "c"), ("IPR4", "y"), ("IPR5", "y")]


def domain_inputs(spark, edges):
    annotations = spark.createDataFrame(
        ANNOTATIONS,
        f"`{fixed.GENE}` string, `{fixed.DOMAIN}` string, `{fixed.DOMAIN_DESCRIPTION}` string",
    )
    terms = spark.createDataFrame(DOMAIN_TERMS, f"`{fixed.DOMAIN}` string, go_id string")
    return annotations, terms, descendants(edges, ["a", "c", "d"])


def check_domain_criteria(spark, edges):
    annotations, terms, below = domain_inputs(spark, edges)
    roots = {"under_a": "a", "under_d": "d"}
    patterns = {"gpcr": "G-protein coupled receptor|GPCR.[^k]"}
    table = criteria.domain_criteria(annotations, roots, patterns, terms, below)
    got = {r[fixed.GENE]: r.asDict() for r in table.collect()}
    assert {g: (r["under_a"], r["under_d"], r["gpcr"]) for g, r in got.items()} == {
        "g1": (True, True, True), "g2": (False, False, False), "g3": (False, False, False),
        "g4": (False, False, False), "g5": (False, False, False), "g6": (False, False, True),
        "g7": (False, False, False),
    }
    related = "Encodes protein with InterPro domain(s)  that are related to "
    assert got["g1"]["under_a_evidence"] == f"{related}a: IPR1 - one, IPR2 - two"
    assert got["g1"]["under_d_evidence"] == f"{related}d: IPR1 - one"
    assert got["g2"]["under_a_evidence"] == "Does not have InterPro domains related to a"
    found = "Encodes protein with InterPro domain(s): IPR3 - GPCR, x"
    assert got["g1"]["gpcr_evidence"] == found
    assert got["g6"]["gpcr_evidence"] == f"{found}, IPR3 - GPCR, x"
    assert got["g5"]["gpcr_evidence"] == "Encodes protein that lacks InterPro GPCR domains"
    evidence = rows(criteria.evidence_rows(annotations, roots, patterns, terms, below))
    assert evidence == [
        ("g1", "gpcr", "IPR3 - GPCR, x", 1), ("g1", "under_a", "IPR1 - one", 2),
        ("g1", "under_a", "IPR2 - two", 1), ("g1", "under_d", "IPR1 - one", 2),
        ("g6", "gpcr", "IPR3 - GPCR, x", 2),
    ]


def test_domain_criteria(spark, edges):
    check_domain_criteria(spark, edges)


def test_domain_criteria_with_a_large_lookup_and_hot_domains(
    spark, edges, no_broadcast, every_key_hot
):
    check_domain_criteria(spark, edges)


def test_single_criterion_equals_its_column_of_many(spark, edges):
    annotations, terms, below = domain_inputs(spark, edges)
    one = criteria.ontology_criterion(annotations, "c", "under_c", terms, below)
    both = criteria.domain_criteria(
        annotations, {"under_a": "a", "under_c": "c"}, None, terms, below
    )
    assert rows(one) == rows(both.select(*one.columns))
    named = criteria.pattern_criterion(annotations, "absent", "named", no_pattern_text="none")
    assert {r[0]: r[1] for r in named.collect()}["g1"] == "none"
    assert named.where("named").count() == 1


def test_descendants_of_a_deep_chain_take_few_rounds(spark, monkeypatch):
    from targetlens.operators import closure

    labels, write = [], closure.written
    monkeypatch.setattr(
        closure, "written", lambda df, label: labels.append(label) or write(df, label)
    )
    chain = [(f"n{i + 1}", f"n{i}") for i in range(1_000)]
    edges = spark.createDataFrame(chain, "child string, parent string")
    got = Counter(row["root"] for row in descendants(edges, ["n0", "n400", "n1000"]).collect())
    assert got == {"n0": 1_001, "n400": 601, "n1000": 1}
    assert labels.count("jumps") <= 11


def test_descendants_of_more_roots_than_a_number_has_bits(spark):
    picks = random.Random(9)
    data = [(f"n{i}", f"n{picks.randrange(max(0, i - 9), i)}") for i in range(1, 200)]
    data += [("n3", "n150"), ("n7", None), (None, "n7"), ("n8", "n8")]
    edges = spark.createDataFrame(data, "child string, parent string")
    roots = [f"n{i}" for i in range(0, 200, 2)] + ["elsewhere"]
    got = {}
    for row in descendants(edges, roots).collect():
        got.setdefault(row["root"], []).append(row["term"])
    known = [(child, parent) for child, parent in data if child and parent]
    assert set(got) == set(roots)
    for root in roots:
        assert sorted(got[root]) == sorted(closure_by_hand(known, root))
