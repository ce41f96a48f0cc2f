"""The composite tables end to end, from small landed files."""

import json
from pathlib import Path

import pytest

from targetlens import fixed_values as fixed
from targetlens.plans import gene_list, keyword_extract, manual_table, mart_table, target_table
from targetlens.sources import ontology
from targetlens.sources.delimited import ORDER_COLUMNS, read_delimited
from targetlens.sources.mart import mart_query

GENOMES = "trtricprjeb535,wubancprjna275548"


def records(folder):
    parts = sorted(Path(folder).glob("part-*"))
    return [json.loads(line) for part in parts for line in part.read_text().splitlines()]


@pytest.fixture
def mart(spark):
    coding = ("protein_coding",)
    t, w, other = ("trtricprjeb535", "wubancprjna275548", "loaloaprjna37757")
    transcripts = [
        (t, *coding, "Trichuris trichiura", "t1", "t1.1", "protein_coding", "first gene"),
        (t, *coding, "Trichuris trichiura", "t1", "t1.2", "protein_coding", "first gene"),
        (t, *coding, "Trichuris trichiura", "t2", "t2.1", "protein_coding", None),
        (w, *coding, "Wuchereria bancrofti", "w1", "w1.2", "nontranslating", "tied"),
        (w, *coding, "Wuchereria bancrofti", "w1", "w1.1", "protein_coding", "tied"),
        (w, "ncRNA", "Wuchereria bancrofti", "w2", "w2.1", "ncRNA", "no protein"),
        (other, *coding, "Loa loa", "l1", "l1.1", "protein_coding", "other genome"),
    ]
    cds = [
        (genome, *coding, "any", name[:2], name, 1, end)
        for genome, name, end in [
            (t, "t1.1", 300), (t, "t1.1", 900), (t, "t1.2", 899), (t, "t2.1", None),
            (w, "w1.1", 50), (w, "w1.2", 50), (other, "l1.1", 5),
        ]
    ]
    orthologues = [
        (t, *coding, "t1", "ENSG1", "ONE", "ortholog_one2many", 30.5, 1.0),
        (t, *coding, "t1", "ENSG2", "TWO", "ortholog_one2many", 61.0, 2.0),
        (t, *coding, "t2", None, None, None, None, None),
        (w, *coding, "w1", "ENSG3", "THREE", "ortholog_one2one", 12.25, 3.0),
    ]
    domains = [
        (t, *coding, "t1", "IPR000001", "Kinase"), (t, *coding, "t1", "IPR000001", "Kinase"),
        (t, *coding, "t1", "IPR000002", "GPCR, family 1"),
        (t, *coding, "t2", None, None),
        (w, *coding, "w1", "IPR000003", "Channel"), (w, *coding, "w1", "IPR000004", "GPCR kinase"),
        (other, *coding, "l1", "IPR000001", "Kinase"),
    ]
    base = "species_id_1010 string, biotype string, "
    schemas = {
        "transcripts": "display_name_1010 string, wbps_gene_id string, wbps_transcript_id string, "
        "transcript_biotype string, description string",
        "cds": "display_name_1010 string, wbps_gene_id string, wbps_transcript_id string, "
        "cds_start bigint, cds_end bigint",
        "orthologues": "wbps_gene_id string, hsapiens_gene string, hsapiens_gene_name string, "
        "hsapiens_orthology_type string, hsapiens_homolog_perc_id double, "
        "hsapiens_homolog_perc_id_r1 double",
        "domains": "wbps_gene_id string, interpro_id string, interpro_description string",
    }
    data = {"transcripts": transcripts, "cds": cds, "orthologues": orthologues, "domains": domains}
    return {
        name: spark.createDataFrame(data[name], base + schema) for name, schema in schemas.items()
    }


OBO = "\n\n".join(
    ["format-version: 1.2"]
    + [
        f"[Term]\nid: {term}\nname: x" + "".join(f"\nis_a: {parent} ! y" for parent in parents)
        for term, parents in {
            "GO:0003824": [],
            "GO:0016301": ["GO:0003824"],
            "GO:0004672": ["GO:0016301"],
            "GO:0004674": ["GO:0004672"],
            "GO:0015267": [],
            "GO:0005216": ["GO:0015267"],
            "GO:0004879": [],
        }.items()
    ]
)
MAPPING = (
    "!comment\n"
    "InterPro:IPR000001 Kinase > GO:protein serine kinase ; GO:0004674\n"
    "InterPro:IPR000003 Channel > GO:ion channel ; GO:0005216\n"
    "InterPro:IPR000003 Channel > GO:membrane ; GO:0016020\n"
    "InterPro:IPR000004 GPCR kinase > GO:kinase ; GO:0016301\n"
)


def test_gene_list(mart):
    genes = gene_list.gene_list(
        *[mart_query(mart[name], name, GENOMES) for name in ("transcripts", "cds")]
    )
    assert [tuple(r) for r in genes.select(
        fixed.GENOME, fixed.GENE, fixed.TRANSCRIPT, fixed.CDS_MAX).collect()] == [
        ("Trichuris trichiura", "t1", "t1.1", 900),
        ("Trichuris trichiura", "t2", "t2.1", None),
        ("Wuchereria bancrofti", "w1", "w1.1", 50),
    ]


def test_full_run(spark, mart, tmp_path):
    (tmp_path / "go.obo").write_text(OBO)
    (tmp_path / "interpro2go").write_text(MAPPING)
    stanzas = ontology.read_stanzas(spark, str(tmp_path / "go.obo"))
    lines = ontology.read_mapping_lines(spark, str(tmp_path / "interpro2go"))
    with pytest.raises(AssertionError, match="at least 10000 rows"):
        target_table.tables_from_mart(mart, GENOMES, stanzas, lines)
    tables = target_table.tables_from_mart(mart, GENOMES, stanzas, lines, least_genes=3)
    out = tmp_path / "out"
    target_table.write_tables(tables, str(out))
    export = {r[fixed.GENE]: r for r in records(out / "export_json")}
    assert all(list(r) == fixed.EXPORT_COLUMNS for r in export.values())
    flags = {
        gene: [flag for flag in fixed.FAMILY_FLAGS if r[flag]] for gene, r in export.items()
    }
    assert flags == {
        "t1": ["is_enzyme", "is_kinase", "is_gpcr"],
        "t2": [],
        "w1": ["is_enzyme", "is_ion_channel"],
    }
    related = "Encodes protein with InterPro domain(s)  that are related to "
    assert export["t1"]["is_kinase_evidence"] == f"{related}GO:0004672: IPR000001 - Kinase"
    assert export["w1"]["is_enzyme_evidence"] == f"{related}GO:0003824: IPR000004 - GPCR kinase"
    assert export["t2"]["lacks_WBP_human_orthologue"] is True
    assert export["t1"]["best_WBP_human_orthologue_lt_40pct_identity_evidence"] == (
        "Best human orthologue found in WormBase Parasite has >= 40% identity: TWO 61.0%"
    )
    assert export["w1"]["is_privileged_target_family_evidence"] == (
        "Meets the following criteria: is_enzyme, is_ion_channel"
    )
    assert export["t2"]["is_privileged_target_family"] is False
    assert export["t2"]["Gene description"] is None
    counts = {r["measure"]: r["count"] for r in tables["counts"].collect()}
    assert counts == {
        "rows": 3, "lacks_WBP_human_orthologue": 1,
        "best_WBP_human_orthologue_lt_40pct_identity": 2, "is_enzyme": 2, "is_kinase": 1,
        "is_ion_channel": 1, "is_gpcr": 1, "is_nuclear_receptor": 0,
    }
    assert [r[fixed.GENE] for r in records(out / "export_json")] == ["t1", "t2", "w1"]
    written_names = {p.name for p in out.iterdir()}
    assert {"geneList_csv", "overall_csv", "is_gpcr_csv", "export_csv"} <= written_names


def test_manual_table(spark, tmp_path):
    first, second = tmp_path / "mart_export.tsv", tmp_path / "paralogue.tsv"
    first.write_text(
        "Gene stable ID\tGenome name\tGene biotype\tHuman protein stable ID\tGO term accession\t"
        "% identity\n"
        "g1\tTrichuris trichiura (PRJEB535)\tprotein_coding\tENSP1\tGO:0002119;GO:1\t45.5\n"
        "g1\tTrichuris trichiura (PRJEB535)\tprotein_coding\t\t\t1.0\n"
        "g2\tTrichuris suis (PRJNA179528)\tprotein_coding\tNA\tGO:00021190\t45.5\n"
        "g3\tWuchereria bancrofti (PRJNA275548)\tprotein_coding\tENSP3\t\t45.5\n"
        "g4\t\tprotein_coding\tENSP4\t\t45.5\n"
    )
    second.write_text(
        "Gene stable ID\tGenome name\tGene biotype\tParalogue gene stable ID\n"
        "g1\tTrichuris trichiura (PRJEB535)\tprotein_coding\tp1\n"
        "g5\tTrichuris muris (PRJEB126)\tprotein_coding\tp5\n"
    )
    out = tmp_path / "out"
    manual_table.write_manual_table(spark, [str(first), str(second)], str(out))
    got = {r["gene_stable_id"]: r for r in records(out)}
    assert set(got) == {"g1", "g2", "g3", "g5"}
    assert {g: (
        r["similar_protein_in_humans"], r["has_gene_ontology_functional_annotation"],
        r["has_paralogue_id"], r["linked_to_larval_development"], r["has_similar_identity"],
    ) for g, r in got.items()} == {
        "g1": (True, True, False, True, True),
        "g2": (False, True, False, False, True),
        "g3": (True, False, False, False, True),
        "g5": (False, False, True, False, False),
    }
    assert "has_known_protein_domain" not in got["g1"]
    assert got["g1"]["similar_identity_species"] == [
        "Trichuris suis (PRJNA179528)", "Trichuris trichiura (PRJEB535)",
    ]
    assert got["g5"]["similar_identity_species"] == "NaN"
    assert got["g1"]["identity"] == 45.5 and got["g5"]["identity"] == "NaN"
    assert got["g2"]["URI"] == (
        "https://parasite.wormbase.org/Trichuris_suis_prjna179528/Gene/Summary?g=g2"
    )
    assert got["g1"]["URI"] == "NaN"
    assert list(got["g1"])[0] == "id" and len({r["id"] for r in got.values()}) == 4
    chunks = tmp_path / "chunks"
    manual_table.write_manual_table(spark, [str(first), str(second)], str(chunks), chunk_size=3)
    arrays = [
        json.loads(next((chunks / f"chunk={i}").glob("part-*")).read_text()) for i in (1, 2)
    ]
    assert [[r["gene_stable_id"] for r in array] for array in arrays] == [
        ["g1", "g2", "g3"], ["g5"],
    ]
    assert arrays[0] + arrays[1] == [got[g] for g in ("g1", "g2", "g3", "g5")]
    assert list(arrays[0][0]) == list(got["g1"])


def test_mart_table(spark, tmp_path):
    rows = spark.createDataFrame(
        [("w", "g1", "p1", 50.0), ("w", "g2", None, None), ("w", "g1", "p1", 50.0)],
        "`Genome project` string, `Gene stable ID` string, `Paralogue gene stable ID` string, "
        "`% identity` double",
    )
    mart_table.write_mart_table(rows, str(tmp_path / "out"))
    got = records(tmp_path / "out")
    assert len(got) == 3 and all("id" not in r for r in got)
    by_gene = {r["gene_stable_id"]: r for r in got}
    assert by_gene["g1"]["has_gene_ontology_functional_annotation"] is True
    assert by_gene["g2"]["has_gene_ontology_functional_annotation"] is False
    assert by_gene["g2"]["paralogue_gene_stable_id"] == by_gene["g2"]["identity"] == "NaN"
    assert not any(r["similar_protein_in_humans"] for r in got)
    assert not any(r["has_known_protein_domain"] for r in got)


def test_mart_table_in_chunks(spark, tmp_path):
    file = tmp_path / "mart.tsv"
    header = "Gene stable ID\tParalogue gene stable ID\t% identity"
    file.write_text(header + "\n" + "".join(f"g{i}\tp\t{i}.5\n" for i in range(25)))
    rows = read_delimited(spark, str(file), {"% identity": "double"}, file_number=0)
    mart_table.write_mart_table(rows, str(tmp_path / "out"), order=ORDER_COLUMNS, chunk_size=10)
    found = [
        json.loads(next((tmp_path / "out" / f"chunk={i}").glob("part-*")).read_text())
        for i in (1, 2, 3)
    ]
    assert [len(records_) for records_ in found] == [10, 10, 5]
    flat = [r for records_ in found for r in records_]
    assert [r["gene_stable_id"] for r in flat] == [f"g{i}" for i in range(25)]
    assert flat[3] == {
        "gene_stable_id": "g3", "paralogue_gene_stable_id": "p", "identity": 3.5,
        "similar_protein_in_humans": False, "has_known_protein_domain": False,
        "has_gene_ontology_functional_annotation": True,
    }


def test_keyword_extract(spark, tmp_path):
    file = tmp_path / "simplemine.tsv"
    file.write_text(
        "Gene\tBiotype\tWormPep\tProtein Domain\tUniProt\tGene Ontology Association\t"
        "RNAi Phenotype Observed\n"
        "a\tprotein_coding\t\tProtein kinase\t\t\tLarval Lethal\n"
        "b\tncRNA\t\t\t\thydrolase activity\tembryonic lethal\n"
        "c\tprotein_coding\tCE1\t\t\t\tdisease\n"
        "d\tncRNA\t\t\tP1\t\tN/A\n"
    )
    keyword_extract.write_keyword_extract(spark, str(file), str(tmp_path / "out"))
    got = {r["Gene"]: (r["Is_Protein"], r["Is_Enzyme"]) for r in records(tmp_path / "out")}
    assert got == {"a": (True, True), "b": (False, True)}
    keyword_extract.write_keyword_extract(spark, str(file), str(tmp_path / "ase"), "ase")
    assert [r["Gene"] for r in records(tmp_path / "ase")] == ["c"]
