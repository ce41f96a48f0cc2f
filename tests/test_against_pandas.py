"""Random small tables: every operator against the same rule written with pandas or plain Python."""

import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from targetlens import fixed_values as fixed
from targetlens.operators import criteria, reduce
from targetlens.plans.gene_list import principal_transcripts
from targetlens.sources import delimited

SEEDS = [1, 2, 3]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def maybe(picks, value, share=0.2):
    return None if picks.random() < share else value


@pytest.mark.parametrize("seed", SEEDS)
def test_argmax_takes_the_first_of_equals(spark, seed):
    picks = random.Random(seed)
    data = [
        (maybe(picks, f"g{picks.randrange(12)}", 0.1), f"h{i}",
         maybe(picks, float(picks.randrange(4))), i)
        for i in range(120)
    ]
    frame = pd.DataFrame(data, columns=["gene", "human", "pct", "line"])
    frame["pct"] = frame["pct"].fillna(0)
    best = frame.loc[frame.groupby("gene")["pct"].idxmax()]
    df = spark.createDataFrame(data, "gene string, human string, pct double, line int")
    got = reduce.argmax_row(df.repartition(5), "gene", "pct", tie_breakers=["line"])
    assert rows(got) == sorted(map(tuple, best.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("seed", SEEDS)
def test_stacked_files_keep_the_first_row_per_gene(spark, tmp_path, seed):
    picks = random.Random(seed)
    paths, frames = [], []
    for number in range(3):
        columns = ["Gene stable ID", *picks.sample(["a", "b", "c"], 2)]
        picks.shuffle(columns)
        frame = pd.DataFrame(
            [[maybe(picks, f"{name[0]}{picks.randrange(15)}", 0.15) for name in columns]
             for _ in range(40)],
            columns=columns,
        )
        path = tmp_path / f"{9 - number}.tsv"
        frame.to_csv(path, sep="\t", index=False)
        paths.append(str(path))
        frames.append(pd.read_csv(path, sep="\t"))
    wanted = pd.concat(frames, ignore_index=True).drop_duplicates(subset=["Gene stable ID"])
    stacked = delimited.read_stacked(spark, paths)
    kept = reduce.keep_first(stacked, fixed.GENE, delimited.ORDER_COLUMNS)
    columns = list(wanted.columns)
    expected = wanted.astype(object).where(wanted.notna(), None)
    assert rows(kept.select(*columns)) == sorted(
        map(tuple, expected.itertuples(index=False)), key=repr
    )


@pytest.mark.parametrize("seed", SEEDS)
def test_principal_transcripts(spark, seed):
    picks = random.Random(seed)
    genes = [f"g{i}" for i in range(10)]
    transcripts = [(picks.choice(genes), f"t{i}", maybe(picks, f"d{i}")) for i in range(60)]
    cds = [
        (f"t{picks.randrange(70)}", maybe(picks, picks.randrange(20))) for _ in range(150)
    ]
    longest = {}
    for name, end in cds:
        if end is not None:
            longest[name] = max(end, longest.get(name, end))
    wanted = {}
    for gene, name, note in transcripts:
        end = longest.get(name)
        place = (end is None, -(end or 0), name)
        if gene not in wanted or place < wanted[gene][0]:
            wanted[gene] = (place, (name, gene, note, end))
    got = principal_transcripts(
        spark.createDataFrame(transcripts, "g string, t string, note string"),
        spark.createDataFrame(cds, "t string, e int"),
        "g", "t", "e",
    )
    assert rows(got.select("t", "g", "note", "CDS_max")) == sorted(
        (row for _, row in wanted.values()), key=repr
    )


@pytest.mark.parametrize("seed", SEEDS)
def test_token_match(spark, seed):
    picks = random.Random(seed)
    words = ["GO:1", "GO:2", "GO:12", "GO:21", ""]
    marks = [";", ",", " ", "; ", ", ;", "|"]

    def cell():
        return maybe(picks, "".join(
            picks.choice(words) + picks.choice(marks) for _ in range(picks.randrange(5))
        ))

    data = [(i, cell(), cell()) for i in range(200)]
    wanted_tokens = {"GO:1", "GO:21"}
    wanted = {
        i: any(
            value is not None and any(t in wanted_tokens for t in re.split(r"[;, ]+", value))
            for value in cells
        )
        for i, *cells in data
    }
    df = spark.createDataFrame(data, "i int, a string, b string")
    got = criteria.token_match(df, ["a", "b"], "f", sorted(wanted_tokens))
    assert {r["i"]: r["f"] for r in got.collect()} == wanted


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("null_is_true", [True, False])
@pytest.mark.parametrize("columns", [["a"], ["a", "b"], ["a", "x"], ["x"], ["b", "x", "a"]])
def test_assigned(spark, strict, null_is_true, columns):
    picks = random.Random(len(columns))
    data = [(i, maybe(picks, "v", 0.4), maybe(picks, 1.0, 0.4)) for i in range(30)]
    df = spark.createDataFrame(data, "i int, a string, b double")
    present = [c for c in columns if c in ("a", "b")]
    gap = {r[0]: any(r["_ab".index(c)] is None for c in present) for r in data}
    if strict:
        value = null_is_true or len(present) < len(columns)
        wanted = {i: value if gap[i] else not value for i in gap}
        got = criteria.assigned_strict(df, columns, "f", null_is_true)
    else:
        got = criteria.assigned_lenient(df, columns, "f", null_is_true)
        if not present:
            assert "f" not in got.columns
            return
        wanted = {i: gap[i] == null_is_true for i in gap}
    assert {r["i"]: r["f"] for r in got.collect()} == wanted


@pytest.mark.parametrize("seed", SEEDS)
def test_domain_criteria(spark, seed):
    picks = random.Random(seed)
    domains = [f"IPR{i}" for i in range(8)]
    data = [
        (maybe(picks, f"g{picks.randrange(12)}", 0.05), maybe(picks, picks.choice(domains), 0.1),
         maybe(picks, picks.choice(["GPCR, x", "kinase", "GPCR kinase"]), 0.2))
        for _ in range(150)
    ]
    mapping = [(picks.choice(domains), f"t{picks.randrange(9)}") for _ in range(12)]
    below = [("r1", f"t{i}") for i in range(3)] + [("r2", f"t{i}") for i in range(2, 7)]
    pattern = "GPCR.[^k]"
    terms = {}
    for domain, term in mapping:
        terms.setdefault(domain, set()).add(term)
    wanted = {}
    for gene in {row[0] for row in data}:
        own = [row[1:] for row in data if row[0] == gene]
        notes = {}
        for root in ("r1", "r2"):
            targets = {term for r, term in below if r == root}
            notes[root] = sorted(
                f"{d} - {text}" for d, text in set(own)
                if d and text and terms.get(d, set()) & targets
            )
        notes["gpcr"] = sorted(
            f"{d} - {text}" for d, text in own if d and text
            and re.search(pattern, f"{d} - {text}")
        )
        wanted[gene] = {name: ", ".join(found) for name, found in notes.items()}
    annotations = spark.createDataFrame(data, "gene string, domain string, text string")
    table = criteria.domain_criteria(
        annotations.repartition(4),
        {"r1": "r1", "r2": "r2"},
        {"gpcr": pattern},
        spark.createDataFrame(mapping, "domain string, go_id string"),
        spark.createDataFrame(below, "root string, term string"),
        gene="gene", domain="domain", description="text",
    )
    got = {r["gene"]: r for r in table.collect()}
    assert set(got) == set(wanted)
    for gene, notes in wanted.items():
        for name, note in notes.items():
            assert got[gene][name] == (note != "")
            if note:
                assert got[gene][f"{name}_evidence"].endswith(f": {note}")


@pytest.mark.parametrize("seed", SEEDS)
def test_joined_texts(spark, seed):
    picks = random.Random(seed)
    data = [(f"k{picks.randrange(6)}", maybe(picks, f"v{picks.randrange(4)}")) for _ in range(80)]
    wanted = sorted(
        (key, "|".join(sorted(v for k, v in data if k == key and v)))
        for key in {k for k, _ in data}
    )
    df = spark.createDataFrame(data, "k string, v string").repartition(4)
    assert rows(reduce.joined_texts(df, "k", {"all": F.col("v")}, "|")) == wanted
