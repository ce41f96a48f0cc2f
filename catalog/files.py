"""Sinks and scans: each query writes whole tables to the shared folder and reads them back."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.criteria import DOMAIN_TERMS, GO_ID, _mapping_lines, _stanzas
from catalog.registry import query, table
from catalog.relational import PART_WITH_GAPS, _part_with_gaps
from targetlens.operators.reduce import keep_first
from targetlens.sinks import tables as sinks
from targetlens.sources import delimited, mart, ontology, records
from targetlens.storage import fresh_path

PART_TYPES = {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"}


@query(f"SELECT * FROM {PART_WITH_GAPS}")
def scan_roundtrip_tsv(spark, sf_dir):
    path = fresh_path(spark, "tsv")
    sinks.write_csv(_part_with_gaps(spark, sf_dir), path, separator="\t")
    return delimited.read_delimited(spark, path, PART_TYPES)


@query("""
SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS label, c_acctbal > 0 AS in_credit,
       CASE WHEN c_acctbal > 0 THEN c_acctbal END AS credit FROM customer
""")
def scan_roundtrip_csv(spark, sf_dir):
    path = fresh_path(spark, "csv")
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name || ', \"' || c_mktsegment || '\"' AS label",
        "c_acctbal > 0 AS in_credit", "CASE WHEN c_acctbal > 0 THEN c_acctbal END AS credit",
    )
    sinks.write_csv(rows, path)
    types = {"c_custkey": "bigint", "in_credit": "boolean", "credit": "double"}
    return delimited.read_csv(spark, path, types)


@query("""
SELECT c_custkey, c_name || chr(10) || '"' || c_mktsegment || '",' || chr(10) AS label,
       c_acctbal > 0 AS in_credit FROM customer
""")
def scan_roundtrip_line_breaks(spark, sf_dir):
    path = fresh_path(spark, "breaks")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('",\n')).alias("label"),
        (F.col("c_acctbal") > 0).alias("in_credit"),
    )
    sinks.write_csv(rows, path)
    types = {"c_custkey": "bigint", "in_credit": "boolean"}
    return delimited.read_csv(spark, path, types, multi_line=True)


@query("""
SELECT item, label, balance, file FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY file) AS place FROM (
    SELECT s_suppkey AS item, s_name AS label, s_acctbal AS balance, 0 AS file FROM supplier
    UNION ALL SELECT c_custkey, c_name, NULL, 1 FROM customer))
WHERE place = 1
""")
def scan_roundtrip_stacked(spark, sf_dir):
    first, second = fresh_path(spark, "stack"), fresh_path(spark, "stack")
    sinks.write_csv(
        table(spark, sf_dir, "supplier").selectExpr(
            "s_suppkey AS item", "s_name AS label", "s_acctbal AS balance"
        ),
        first,
        separator="\t",
    )
    sinks.write_csv(
        table(spark, sf_dir, "customer").selectExpr("c_name AS label", "c_custkey AS item"),
        second,
        separator="\t",
    )
    stacked = delimited.read_stacked(
        spark, [first, second], {"item": "bigint", "balance": "double"}
    )
    kept = keep_first(stacked, "item", delimited.ORDER_COLUMNS)
    return kept.select("item", "label", "balance", F.col("_file_number").alias("file"))


@query("""
SELECT item, label, file FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY file) AS place FROM (
    SELECT s_suppkey AS item, s_name || chr(10) || '"' || chr(9) || s_nationkey AS label, 0 AS file
    FROM supplier
    UNION ALL SELECT c_custkey, c_name || chr(13) || chr(10) || c_mktsegment, 1 FROM customer))
WHERE place = 1
""")
def scan_roundtrip_stacked_breaks(spark, sf_dir):
    first, second = fresh_path(spark, "stack"), fresh_path(spark, "stack")
    label = F.concat("s_name", F.lit('\n"\t'), "s_nationkey").alias("label")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("item"), label)
    sinks.write_csv(rows, first, separator="\t")
    label = F.concat("c_name", F.lit("\r\n"), "c_mktsegment").alias("label")
    rows = table(spark, sf_dir, "customer").select(label, F.col("c_custkey").alias("item"))
    sinks.write_csv(rows, second, separator="\t")
    stacked = delimited.read_stacked(spark, [first, second], {"item": "bigint"}, multi_line=True)
    kept = keep_first(stacked, "item", delimited.ORDER_COLUMNS)
    return kept.select("item", "label", F.col("_file_number").alias("file"))


@query(f"SELECT * FROM {PART_WITH_GAPS}")
def scan_roundtrip_json_lines(spark, sf_dir):
    path = fresh_path(spark, "json")
    rows = _part_with_gaps(spark, sf_dir)
    sinks.write_json(rows, path)
    return records.read_json_lines(spark, path, rows.schema)


@query("""
SELECT p_partkey, CASE WHEN p_size = 10 THEN '"NaN"' ELSE p_size::VARCHAR END AS size,
       CASE WHEN p_name = 'red ring' THEN '"NaN"' ELSE '"' || p_name || '"' END AS name,
       p_type = 'PROMO' AS promo
FROM part
""")
def scan_roundtrip_clean_json(spark, sf_dir):
    path = fresh_path(spark, "clean")
    rows = _part_with_gaps(spark, sf_dir).select(
        "p_partkey", F.col("p_size").alias("[Size]"), F.col("p_name").alias("Name."),
        F.col("p_type").isNull().alias("promo"),
    )
    sinks.write_clean_json(rows, path, keep_id=False)
    read = records.read_json_lines(
        spark, path, "p_partkey bigint, size variant, name variant, promo boolean"
    )
    return read.select(
        "p_partkey", F.to_json("size").alias("size"), F.to_json("name").alias("name"), "promo"
    )


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, nullif(o_orderstatus, 'P') AS o_orderstatus,
       (row_number() OVER (ORDER BY o_orderkey) - 1) // 9000 + 1 AS chunk FROM orders
""")
def scan_roundtrip_array_chunks(spark, sf_dir):
    path = fresh_path(spark, "arrays")
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice", "nullif(o_orderstatus, 'P') AS o_orderstatus"
    )
    sinks.write_array_chunks(rows, path, ["o_orderkey"], 9000)
    return records.read_json_array(
        spark, path,
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string",
    ).withColumn("chunk", F.col("chunk").cast("bigint"))


@query("SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, "
       "'output_' || ((row_number() OVER (ORDER BY o_orderkey) - 1) // 9000 + 1) || '.json' AS file "
       "FROM orders")
def scan_roundtrip_named_chunks(spark, sf_dir):
    path = fresh_path(spark, "named")
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "nullif(o_orderstatus, 'P') AS o_orderstatus"
    )
    sinks.write_array_chunks(rows, path, ["o_orderkey"], 9000, names="output_{}.json")
    lines = spark.read.text(path).where("value not in ('[', ']')")
    record = F.from_json(F.regexp_replace("value", ",$", ""), rows.schema, {"mode": "FAILFAST"})
    return lines.select(record.alias("record"), F.col("_metadata.file_name").alias("file")).select(
        "record.*", "file"
    )


def _array_lines():
    """Writes the lines of one JSON array of all records of a task; without records an empty one.

    The function is a local one, so it goes to the tasks itself: their Python need not know this
    repository.
    """

    def lines_of(batches):
        held = None
        for batch in batches:
            lines = []
            for record in batch.column("value").to_pylist():
                lines.append("[" if held is None else f"{held},")
                held = record
            yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
        last = ["["] if held is None else [held]
        yield pa.RecordBatch.from_pydict({"value": [*last, "]"]})

    return lines_of


@query("SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders")
def scan_roundtrip_json_array_split(spark, sf_dir):
    path = fresh_path(spark, "array")
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "nullif(o_orderstatus, 'P') AS o_orderstatus"
    )
    record = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false", "pretty": "true"})
    rows = rows.select(F.regexp_replace(record, "(?m)^", "    ").alias("value"))
    rows.mapInArrow(_array_lines(), "value string").write.text(path)
    return records.read_json_array(
        spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, '}, {"' || l_returnflag || '\\' AS note
FROM lineitem
""")
def scan_roundtrip_json_one_line(spark, sf_dir):
    path = fresh_path(spark, "array")
    note = F.concat(F.lit('}, {"'), "l_returnflag", F.lit("\\")).alias("note")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", note)
    # A file holds the orders of a range of keys, as one line. It is written record by record, a
    # blank behind each, so no row holds a file, whatever number of orders share a range.
    rows = rows.withColumn("part", F.expr("l_orderkey div 20000"))
    place = Window.partitionBy("part").orderBy("l_orderkey", "l_linenumber")
    opens = F.when(F.row_number().over(place) == 1, "[").otherwise(",")
    closes = F.when(F.lead(F.lit(1)).over(place).isNull(), "]").otherwise("")
    record = F.to_json(F.struct("l_orderkey", "l_linenumber", "l_quantity", "note"))
    lines = rows.select("part", F.concat(opens, record, closes).alias("value"))
    lines.write.partitionBy("part").option("lineSep", " ").text(path)
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, note string"
    return records.read_json_array(spark, path, schema).drop("part")


@query("""
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 2500 + 1 AS chunk FROM orders
""")
def scan_roundtrip_chunks(spark, sf_dir):
    path = fresh_path(spark, "chunks")
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    sinks.write_chunks(rows, path, ["o_orderkey"], 2500)
    return records.read_json_lines(spark, path, "o_orderkey bigint, chunk bigint")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def scan_roundtrip_bounded(spark, sf_dir):
    path = fresh_path(spark, "bounded")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    sinks.write_bounded(rows, path, 9000)
    return records.read_json_lines(spark, path, rows.schema)


@query(f"SELECT {GO_ID} AS go_id, p_name AS name FROM part WHERE p_size NOT IN (13, 14)")
def scan_roundtrip_ontology(spark, sf_dir):
    path = fresh_path(spark, "ontology")
    _stanzas(spark, sf_dir).write.option("lineSep", "\n\n").text(path)
    return ontology.ontology_terms(ontology.read_stanzas(spark, path))


@query(f"SELECT {GO_ID} AS go_id, p_name AS name FROM part WHERE p_size NOT IN (13, 14)")
def scan_roundtrip_ontology_crlf(spark, sf_dir):
    path = fresh_path(spark, "ontology")
    text = F.concat(F.replace("value", F.lit("\n"), F.lit("\r\n")), F.lit("\r\n")).alias("value")
    _stanzas(spark, sf_dir).select(text).write.option("lineSep", "\r\n").text(path)
    return ontology.ontology_terms(ontology.read_stanzas(spark, path))


@query(f'SELECT domain AS "InterPro ID", go_id FROM {DOMAIN_TERMS} AS mapped')
def scan_roundtrip_domain_map(spark, sf_dir):
    path = fresh_path(spark, "mapping")
    _mapping_lines(spark, sf_dir).write.text(path)
    return ontology.domain_terms(ontology.read_mapping_lines(spark, path))


@query("""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey = 5
""")
def mart_landed(spark, sf_dir):
    landed = mart.land_mart(
        table(spark, sf_dir, "customer"), fresh_path(spark, "mart"), "c_mktsegment"
    )
    wanted = {"c_mktsegment": "BUILDING,MACHINERY", "c_nationkey": 5}
    return mart.mart_select(landed, wanted, ["c_custkey", "c_name", "c_mktsegment"])


@query("""
SELECT l_returnflag, l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R')
""")
def mart_landed_with_ids(spark, sf_dir):
    columns = ["l_returnflag", "l_orderkey", "l_partkey", "l_quantity"]
    rows, path = table(spark, sf_dir, "lineitem").select(*columns), fresh_path(spark, "mart")
    landed = mart.land_mart(rows, path, "l_returnflag", ["l_orderkey", "l_partkey"])
    return mart.mart_select(landed, {"l_returnflag": "A,R"}, columns)
