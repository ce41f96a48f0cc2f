import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from targetlens import fixed_values as fixed
from targetlens.operators.chunks import chunk_numbers
from targetlens.operators.reduce import keep_first
from targetlens.sinks import tables as sinks
from targetlens.sources import delimited, mart, ontology, records, schemas


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def lines(folder):
    parts = sorted(Path(folder).rglob("part-*"))
    return [line for part in parts for line in part.read_text().splitlines()]


def test_read_delimited(spark, tmp_path):
    file = tmp_path / "in.tsv"
    file.write_text(
        f"{fixed.GENE}\t{fixed.IDENTITY}\tnote\n"
        'g1\t45.5\t"a ""quoted"" text"\ng2\tNA\tnull\ng3\tbad\tplain\ng4\tNaN\t\n'
    )
    df = delimited.read_delimited(spark, str(file), schemas.HUMAN_ORTHOLOGUE)
    assert df.dtypes == [(fixed.GENE, "string"), (fixed.IDENTITY, "double"), ("note", "string")]
    assert rows(df) == [
        ("g1", 45.5, 'a "quoted" text'), ("g2", None, None), ("g3", None, "plain"),
        ("g4", None, None),
    ]


def test_read_csv_and_missing_file(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text("a,b\n1,x\n")
    assert rows(delimited.read_csv(spark, str(file), {"a": "int"})) == [(1, "x")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        delimited.read_stacked(spark, [str(file), str(tmp_path / "gone.tsv")])


def test_read_stacked_keeps_file_order(spark, tmp_path):
    (tmp_path / "b.tsv").write_text(f"{fixed.GENE}\tx\ng2\tb1\ng1\tb2\ng1\tb3\n")
    (tmp_path / "a.tsv").write_text(f"y\t{fixed.GENE}\n7\tg1\n8\tg3\n9\t\n10\t\n")
    stacked = delimited.read_stacked(
        spark, [str(tmp_path / "b.tsv"), str(tmp_path / "a.tsv")], {"y": "int"}
    )
    kept = keep_first(stacked, fixed.GENE, delimited.ORDER_COLUMNS)
    assert rows(kept.select(fixed.GENE, "x", "y")) == rows(
        spark.createDataFrame(
            [("g1", "b2", None), ("g2", "b1", None), ("g3", None, 8), (None, None, 9)],
            "g string, x string, y int",
        )
    )


def test_file_order_holds_across_splits(spark, tmp_path):
    big = tmp_path / "big.tsv"
    big.write_text("k\tv\n" + "".join(f"k{i % 50}\t{i}\n" for i in range(20_000)))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "16k")
    try:
        stacked = delimited.read_stacked(spark, [str(big)], {"v": "int"})
        assert stacked.rdd.getNumPartitions() > 3
        kept = keep_first(stacked, "k", delimited.ORDER_COLUMNS)
        assert sorted(r["v"] for r in kept.collect()) == list(range(50))
    finally:
        spark.conf.set(setting, before)


def test_file_order_in_a_folder_is_by_file_then_row(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part-0.tsv").write_text("k\tv\na\t1\nb\t2\n")
    (folder / "part-1.tsv").write_text("k\tv\n" + "".join(f"k{i}\t{i}\n" for i in range(500)))
    (folder / "part-2.tsv").write_text("k\tv\nb\t9\nk3\t9\na\t9\n")
    stacked = delimited.read_stacked(spark, [str(folder)], {"v": "int"})
    kept = keep_first(stacked, "k", delimited.ORDER_COLUMNS)
    got = {r["k"]: r["v"] for r in kept.collect()}
    assert got == {"a": 1, "b": 2, **{f"k{i}": i for i in range(500)}}


def test_write_csv(spark, tmp_path):
    df = spark.createDataFrame(
        [("a, b", True, None), ('q"q', False, 2), ("", None, 3)],
        "t string, flag boolean, n int",
    ).coalesce(1)
    sinks.write_csv(df, str(tmp_path / "out"))
    assert lines(tmp_path / "out") == ["t,flag,n", '"a, b",True,', '"q""q",False,2', ",,3"]


def test_existing_results_are_replaced_only_when_asked(spark, tmp_path):
    df = spark.range(3)
    for write, args in [
        (sinks.write_csv, []), (sinks.write_json, []), (sinks.write_bounded, [2]),
        (sinks.write_chunks, [["id"], 2]), (sinks.write_array_chunks, [["id"], 2]),
    ]:
        path = str(tmp_path / write.__name__)
        write(df, path, *args)
        with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
            write(df, path, *args)
        write(df, path, *args, mode="overwrite")
        assert "0" in "".join(lines(path))


def test_write_json_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "t string, n int")
    sinks.write_json(df, str(tmp_path / "out"))
    assert [json.loads(line) for line in lines(tmp_path / "out")] == [{"t": "a", "n": None}]


def test_clean_json_keeps_types(spark, tmp_path):
    df = spark.createDataFrame(
        [
            ("ID-1", "Wuchereria bancrofti (PRJNA275548)", "g1", 45.5, ["s2", "s1"], True),
            ("ID-2", "Trichuris muris (PRJEB126)", "g2", float("nan"), None, False),
            ("ID-3", None, "g3", None, ["s1", None], True),
            ("ID-4", "Wuchereria bancrofti (PRJNA275548)", None, 1.0, [], None),
        ],
        f"id string, `{fixed.GENOME}` string, `{fixed.GENE}` string, `{fixed.IDENTITY}` double, "
        "species array<string>, flag boolean",
    )
    sinks.write_clean_json(df, str(tmp_path / "out"), keep_id=True, with_uri=True, base_url="h")
    got = {r["id"]: r for r in map(json.loads, lines(tmp_path / "out"))}
    assert list(got["id-1"]) == [
        "id", "genome_name", "gene_stable_id", "identity", "species", "flag", "URI",
    ]
    genome = "Wuchereria bancrofti (PRJNA275548)"
    assert got["id-1"] == {
        "id": "id-1", "genome_name": genome, "gene_stable_id": "g1", "identity": 45.5,
        "species": ["s2", "s1"], "flag": True,
        "URI": "h/Wuchereria_bancrofti_prjna275548/Gene/Summary?g=g1",
    }
    assert got["id-2"]["identity"] == got["id-2"]["species"] == got["id-2"]["URI"] == "NaN"
    assert got["id-2"]["flag"] is False
    assert got["id-3"]["species"] == got["id-3"]["genome_name"] == got["id-3"]["URI"] == "NaN"
    assert got["id-4"]["species"] == []
    assert got["id-4"]["flag"] == got["id-4"]["gene_stable_id"] == got["id-4"]["URI"] == "NaN"
    dropped = sinks.clean_records(df, keep_id=False)
    assert dropped.columns == ["genome_name", "gene_stable_id", "identity", "species", "flag"]


@pytest.mark.parametrize("count", [0, 3, 4, 8, 9])
def test_chunked_files(spark, tmp_path, count):
    df = spark.range(count).selectExpr("id", "nullif(id, 2) AS v").repartition(3)
    sinks.write_chunks(df, str(tmp_path / "lines"), ["id"], 4)
    sinks.write_array_chunks(df, str(tmp_path / "arrays"), ["id"], 4)
    chunks = -(-count // 4)
    for name in ("lines", "arrays"):
        found = sorted((tmp_path / name).glob("chunk=*"))
        assert [f.name for f in found] == [f"chunk={i + 1}" for i in range(chunks)]
        assert all(len(list(f.glob("part-*"))) == 1 for f in found)
        for i, folder in enumerate(found):
            text = next(folder.glob("part-*")).read_text()
            records_ = json.loads(text) if name == "arrays" else list(
                map(json.loads, text.splitlines())
            )
            ids = range(4 * i, min(4 * i + 4, count))
            assert records_ == [{"id": j, "v": None if j == 2 else j} for j in ids]


def test_write_bounded(spark, tmp_path):
    sinks.write_bounded(spark.range(25).coalesce(1), str(tmp_path / "out"), 10)
    sizes = [len(p.read_text().splitlines()) for p in sorted((tmp_path / "out").glob("part-*"))]
    assert sizes == [10, 10, 5]


RECORDS = [
    {"a": i, "b": None if i % 5 == 0 else f"x }},\n    }},\n y] {i}", "c": ["p", "q"]}
    for i in range(300)
]


@pytest.mark.parametrize("indent", [None, 2, 4])
@pytest.mark.parametrize("count", [0, 1, 300])
def test_json_array(spark, tmp_path, indent, count):
    file = tmp_path / "records.json"
    file.write_text(json.dumps(RECORDS[:count], indent=indent))
    df = records.read_json_array(spark, str(file), "a bigint, b string, c array<string>", indent)
    got = [r.asDict() for r in df.orderBy("a").collect()]
    assert got == RECORDS[:count]


def test_json_array_is_cut_into_many_tasks(spark, tmp_path):
    file = tmp_path / "records.json"
    file.write_text(json.dumps(RECORDS, indent=4))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4k")
    try:
        df = records.read_json_array(spark, str(file), "a bigint, b string", 4)
        assert df.rdd.getNumPartitions() > 3
        assert sorted(r["a"] for r in df.collect()) == list(range(300))
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("indent", [None, 4])
@pytest.mark.parametrize("root", [{"a": 1}, {"rows": [{"a": 1}]}, 5, "text"])
def test_other_json_root_fails(spark, tmp_path, indent, root):
    file = tmp_path / "records.json"
    file.write_text(json.dumps(root, indent=indent))
    with pytest.raises(Exception, match="no JSON array at the root"):
        records.read_json_array(spark, str(file), "a bigint", indent).collect()


def test_mart_select(spark):
    df = spark.createDataFrame(
        [("s1", "protein_coding", "g1", "d"), ("s2", "protein_coding", "g2", "d"),
         ("s1", "ncRNA", "g3", "d"), ("s3", "protein_coding", "g4", "d"),
         ("s1", "protein_coding", "g1", "d")],
        "species_id_1010 string, biotype string, wbps_gene_id string, description string",
    )
    wanted = {"species_id_1010": "s1, s2", "biotype": "protein_coding"}
    got = mart.mart_select(df, wanted, ["wbps_gene_id", "description"])
    assert got.columns == [fixed.GENE, fixed.GENE_DESCRIPTION]
    assert rows(got) == [("g1", "d"), ("g1", "d"), ("g2", "d")]
    unique = mart.mart_select(df, wanted, ["wbps_gene_id"], unique_rows=True)
    assert rows(unique) == [("g1",), ("g2",)]
    with pytest.raises(ValueError, match="nope"):
        mart.mart_select(df, {"nope": 1}, ["wbps_gene_id"])


OBO = """format-version: 1.2
ontology: go

[Term]
id: GO:0000001
name: one thing
namespace: x
alt_id: GO:0000091
alt_id: GO:0000092

[Term]
id: GO:0000002
name: two
is_a: GO:0000001 ! one thing
relationship: part_of GO:0000009 ! other

[Term]
id: GO:0000003
name: old
is_a: GO:0000001 ! one thing
is_obsolete: true

[Term]
id: GO:0000004
name: four
is_a: GO:0000091 ! by another id
is_a: GO:0000002

[Typedef]
id: part_of
name: part of
is_a: GO:0000001
"""


def test_ontology_file(spark, tmp_path):
    (tmp_path / "go.obo").write_text(OBO)
    stanzas = ontology.read_stanzas(spark, str(tmp_path / "go.obo"))
    assert rows(ontology.ontology_terms(stanzas)) == [
        ("GO:0000001", "one thing"), ("GO:0000002", "two"), ("GO:0000004", "four"),
    ]
    assert rows(ontology.ontology_alternates(stanzas)) == [
        ("GO:0000091", "GO:0000001"), ("GO:0000092", "GO:0000001"),
    ]
    assert rows(ontology.ontology_edges(stanzas)) == [
        ("GO:0000002", "GO:0000001"), ("GO:0000004", "GO:0000001"), ("GO:0000004", "GO:0000002"),
    ]


MAPPING = """!date: 2024
InterPro:IPR000003 Retinoid X receptor/HNF4 > GO:DNA binding ; GO:0003677
InterPro:IPR000003 Retinoid X receptor/HNF4 > GO:nucleus ; GO:0005634
InterPro:IPR000004 A > B > GO:odd ; GO:0000001
InterPro:IPR000005 two > GO:a ; GO:0000002 and GO:0000003 GO:0000002
InterPro:IPR000006 nothing > GO:none
InterPro:XYZ no id > GO:a ; GO:0000004
 InterPro:IPR000007 indented > GO:a ; GO:0000005
InterPro:IPR000003 again > GO:DNA binding ; GO:0003677
"""


def test_mapping_file(spark, tmp_path):
    (tmp_path / "interpro2go").write_text(MAPPING)
    read = ontology.read_mapping_lines(spark, str(tmp_path / "interpro2go"))
    assert rows(ontology.domain_terms(read)) == [
        ("IPR000003", "GO:0003677"), ("IPR000003", "GO:0005634"),
        ("IPR000005", "GO:0000002"), ("IPR000005", "GO:0000003"),
    ]


def test_pushdown(spark, tmp_path):
    spark.range(10).select(
        F.col("id").alias("species_id_1010"), F.lit("x").alias("biotype"), F.lit(1).alias("other"),
        F.col("id").cast("string").alias("wbps_gene_id"),
    ).write.parquet(str(tmp_path / "mart"))
    df = spark.read.parquet(str(tmp_path / "mart"))
    got = mart.mart_select(df, {"species_id_1010": [1, 2]}, ["wbps_gene_id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "In(species_id_1010, [1,2])" in plan
    assert "other" not in plan


@pytest.mark.parametrize("name", sorted(fixed.MART_QUERIES))
def test_named_mart_queries(spark, name):
    attributes = fixed.MART_QUERIES[name]
    columns = ["species_id_1010", "biotype", *attributes]
    data = [
        (genome, biotype, *[f"{genome}{i}" for i in range(len(attributes))])
        for genome in ("s1", "s2", "s3")
        for biotype in ("protein_coding", "ncRNA")
    ]
    df = spark.createDataFrame(data, columns)
    got = mart.mart_query(df, name, "s1, s3")
    assert got.columns == [fixed.MART_HEADERS.get(a, a) for a in attributes]
    each = 1 if name in fixed.PROTEIN_CODING_QUERIES else 2
    assert sorted(r[0] for r in got.collect()) == ["s10"] * each + ["s30"] * each


def test_landed_mart_reads_only_the_wanted_genomes(spark, tmp_path):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 's0' ELSE concat('s', id % 7) END AS species_id_1010",
        "CAST(id AS STRING) AS wbps_gene_id",
    )
    landed = mart.land_mart(df, str(tmp_path / "mart"))
    got = mart.mart_select(landed, {"species_id_1010": "s1,s2"}, ["wbps_gene_id"])
    wanted = df.where("species_id_1010 IN ('s1', 's2')").select("wbps_gene_id")
    assert rows(got) == rows(wanted)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [species_id_1010" in plan
    files = list((tmp_path / "mart").glob("*/*.parquet"))
    assert len(files) == len({file.parent for file in files}) == 7


def _text_file(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_quoted_line_breaks(spark, tmp_path):
    path = _text_file(tmp_path, "breaks.tsv", 'a\tb\n1\t"two\nlines"\n2\ty\n')
    rows = delimited.read_delimited(spark, path, multi_line=True).collect()
    assert [tuple(row) for row in rows] == [("1", "two\nlines"), ("2", "y")]
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_delimited(spark, path).select("a").collect()


def test_files_of_one_scan_must_share_their_header(spark, tmp_path):
    paths = [
        _text_file(tmp_path, "one.tsv", "a\tb\nx\t1\n"),
        _text_file(tmp_path, "two.tsv", "b\ta\n3\tz\n"),
    ]
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_delimited(spark, paths).collect()
    stacked = delimited.read_stacked(spark, paths).select("a", "b").collect()
    assert sorted(map(tuple, stacked)) == [("x", "1"), ("z", "3")]


@pytest.mark.parametrize("indent", [0, 2, 4])
def test_json_arrays_are_split_by_default(spark, tmp_path, indent):
    records_in = [{"a": i, "b": "x}, {y" * 20} for i in range(3_000)]
    path = _text_file(tmp_path, "array.json", json.dumps(records_in, indent=indent or None))
    if not indent:
        lines = ",\n".join(json.dumps(r) for r in records_in)
        path = _text_file(tmp_path, "lines.json", f"[\n{lines}\n]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = records.read_json_array(spark, path, "a int, b string")
        assert found.rdd.getNumPartitions() > 1
        assert sorted(row.a for row in found.collect()) == list(range(3_000))
        assert {row.b for row in found.collect()} == {records_in[0]["b"]}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = records.read_json_array(spark, path, "a int, b string", whole_file=True)
    assert whole.count() == 3_000


def test_chunk_numbers_compute_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(500).mapInArrow(counted, "id long")
    assert chunk_numbers(df, ["id"], 100).select("chunk").distinct().count() == 5
    assert seen.value == 500


PRETTY = json.dumps([{"a": i, "b": f"x }},\n{{ {i}"} for i in range(3)], indent=4)
STYLES = {
    "crlf": PRETTY.replace("\n", "\r\n"),
    "crlf lines": '[\r\n{"a": 0},\r\n{"a": 1},\r\n{"a": 2}\r\n]\r\n',
    "brace on one line": PRETTY.replace("},\n    {", "}, {"),
    "some on one line": PRETTY.replace("},\n    {", "}, {", 1),
    "tabs": PRETTY.replace("    ", "\t"),
    "comma first": PRETTY.replace("},\n", "}\n,"),
    "several on a line": '[\n{"a": 0}, {"a": 1},\n{"a": 2}\n]',
    "no lines": json.dumps([{"a": 0}, {"a": 1}, {"a": 2}]),
    "nested": json.dumps([{"a": i, "c": [{"x": 1}, {"x": [{"y": 2}]}]} for i in range(3)], indent=2),
    "nested lines": '[\n{"a": 0, "c": [{"x": 1}]},\n{"a": 1, "c": [{"x": 2}]},\n{"a": 2, "c": []}\n]',
}


@pytest.mark.parametrize("style", STYLES)
def test_json_array_records_are_all_read_however_separated(spark, tmp_path, style):
    path = tmp_path / "array.json"
    path.write_bytes(STYLES[style].encode())
    for options in ({}, {"whole_file": True}, {"indent": 4}, {"indent": 0}):
        found = records.read_json_array(spark, str(path), "a int", **options)
        assert sorted(row.a for row in found.collect()) == [0, 1, 2], options


@pytest.mark.parametrize("most_bytes", [1 << 20, 64])
def test_json_array_files_of_unlike_styles(spark, tmp_path, most_bytes):
    lines = ",\n".join(json.dumps({"a": i}) for i in range(200))
    texts = [
        f"[\n{lines}\n]", "[]", PRETTY, STYLES["crlf"], STYLES["no lines"],
        json.dumps([{"a": i} for i in range(200)], indent=0),
    ]
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(most_bytes))
    try:
        for turn in range(len(texts)):
            folder = tmp_path / str(turn)
            folder.mkdir()
            for number, text in enumerate(texts[turn:] + texts[:turn]):
                # The first file is the largest, so it is the one whose lines are looked at.
                space = " " * 5_000 * (len(texts) - number)
                (folder / f"{number}.json").write_bytes((text + space).encode())
            found = records.read_json_array(spark, str(folder), "a int").collect()
            assert sorted(row.a for row in found) == sorted([*range(200), *[0, 1, 2] * 3, *range(200)])
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("text", [
    PRETTY + PRETTY, PRETTY + "{}", PRETTY + "]", PRETTY.replace("},\n    {", "} x,\n    {", 1),
    PRETTY[:-1] + "}", '[\n{"a": 0}\n{"a": 1}\n]', '{"a": 0}\n{"a": 1}', PRETTY[:-6],
])
@pytest.mark.parametrize("whole_file", [False, True])
def test_text_that_is_no_record_of_the_array_fails(spark, tmp_path, text, whole_file):
    path = _text_file(tmp_path, "array.json", text)
    with pytest.raises(Exception):
        records.read_json_array(spark, path, "a int", whole_file=whole_file).collect()


def test_json_array_with_crlf_is_split(spark, tmp_path):
    path = tmp_path / "array.json"
    text = json.dumps([{"a": i, "b": "y" * 30} for i in range(3_000)], indent=2)
    path.write_bytes(text.replace("\n", "\r\n").encode())
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4001")
    try:
        found = records.read_json_array(spark, str(path), "a int")
        assert found.rdd.getNumPartitions() > 10
        rows = found.selectExpr("a", "spark_partition_id() AS task").collect()
        assert sorted(row.a for row in rows) == list(range(3_000))
        assert len({row.task for row in rows}) > 10
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("count", [1, 20, 25])
def test_chunk_files_with_names_of_their_own(spark, tmp_path, count):
    df = spark.range(count).selectExpr("id", "nullif(id % 3, 0) AS v").repartition(3)
    out = tmp_path / "out"
    sinks.write_array_chunks(df, str(out), ["id"], 10, names="output_{}.json")
    found = {p.name: json.loads(p.read_text()) for p in out.iterdir() if p.name[0] != "."}
    wanted = [{"id": i, "v": i % 3 or None} for i in range(count)]
    assert found == {
        f"output_{n + 1}.json": wanted[10 * n : 10 * n + 10] for n in range(-(-count // 10))
    }
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    with pytest.raises(ValueError, match="exists"):
        sinks.write_array_chunks(df, str(out), ["id"], 10, names="output_{}.json")
    sinks.write_array_chunks(df, str(out), ["id"], 50, names="x{}", mode="overwrite")
    assert [p.name for p in out.iterdir() if p.name[0] != "."] == ["x1"]


def test_a_failed_run_leaves_no_named_chunks(spark, tmp_path):
    df = spark.range(30).selectExpr("id", "IF(id = 25, raise_error('broken'), 'x') AS v")
    with pytest.raises(Exception, match="broken"):
        sinks.write_array_chunks(df, str(tmp_path / "out"), ["id"], 10, names="output_{}.json")
    assert not (tmp_path / "out").exists()


def scanned_rows(df):
    """Rows that the scans of a query gave out, by their own metric."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    leaves = plan.collectLeaves()
    for place in range(leaves.size()):
        total += leaves.apply(place).metrics().apply("numOutputRows").value()
    return total


def test_landed_ids_skip_row_groups(spark, tmp_path):
    rows = spark.range(60_000).selectExpr(
        "CAST(id % 2 AS STRING) AS genome", "concat('g', id div 3) AS gene",
        "concat('IPR', (id * 7919) % 30000 * 2) AS domain", "repeat(uuid(), 3) AS text",
    ).coalesce(1)
    landed = mart.land_mart(rows, str(tmp_path / "mart"), "genome", ["gene", "domain"], 200_000)
    whole = landed.where("genome = '1'").count()
    by_gene = mart.mart_select(landed, {"genome": "1", "gene": "g777"}, ["gene", "domain"], headers={})
    assert by_gene.count() > 0 and scanned_rows(by_gene) < whole / 5
    some = landed.where("genome = '1'").first().domain
    by_domain = mart.mart_select(landed, {"genome": "1", "domain": some}, ["gene"], headers={})
    assert by_domain.count() > 0 and scanned_rows(by_domain) < whole / 2
    # Within the bounds of every row group, so only the filters can tell.
    absent = mart.mart_select(landed, {"genome": "1", "domain": "IPR30001"}, ["gene"], headers={})
    assert absent.count() == 0 and scanned_rows(absent) < whole / 2
