"""Filters, projections, unions, reductions, positions and quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query, table
from targetlens.functions.text import gene_uri, sanitize_text, species_slug
from targetlens.operators import filters, quality, shape
from targetlens.operators import reduce as reducers
from targetlens.operators.chunks import chunk_numbers
from targetlens.operators.joins import find_hot_keys, left_join
from targetlens.plans.gene_list import in_gene_order, principal_transcripts
from targetlens.sinks.tables import clean_records
from targetlens.sources.mart import mart_select

PART_ATTRIBUTES = ["p_partkey", "p_name", "p_type", "p_size"]


@query("""
SELECT p_partkey, p_name, p_type, p_size FROM part
WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#23') AND p_type = 'ECONOMY'
""", name="mart_select")
def mart_select_rows(spark, sf_dir):
    wanted = {"p_brand": "Brand#1,Brand#12,Brand#23", "p_type": "ECONOMY"}
    return mart_select(table(spark, sf_dir, "part"), wanted, PART_ATTRIBUTES)


@query("""
SELECT DISTINCT p_name AS "Gene description", p_type FROM part
WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#23')
""")
def mart_select_unique(spark, sf_dir):
    wanted = {"p_brand": ["Brand#1", "Brand#12", "Brand#23"]}
    return mart_select(
        table(spark, sf_dir, "part"),
        wanted,
        ["p_name", "p_type"],
        unique_rows=True,
        headers={"p_name": "Gene description"},
    )


@query("""
SELECT doc_id, lang, n_chars FROM documents WHERE regexp_matches(text, 'ouble|entre', 'i')
""")
def keyword_filter(spark, sf_dir):
    found = filters.keyword_filter(table(spark, sf_dir, "documents"), "text", "ouble|ENTRE")
    return found.select("doc_id", "lang", "n_chars")


def _part_with_gaps(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr("nullif(p_name, 'red ring')").alias("p_name"),
        F.expr("nullif(p_brand, 'Brand#5')").alias("p_brand"),
        F.expr("nullif(p_type, 'PROMO')").alias("p_type"),
        F.expr("nullif(p_size, 10)").alias("p_size"),
        "p_retailprice",
    )


PART_WITH_GAPS = """(
  SELECT p_partkey, nullif(p_name, 'red ring') AS p_name, nullif(p_brand, 'Brand#5') AS p_brand,
         nullif(p_type, 'PROMO') AS p_type, nullif(p_size, 10) AS p_size, p_retailprice
  FROM part) AS gaps"""


@query(f"SELECT * FROM {PART_WITH_GAPS} WHERE p_size IS NULL")
def null_lookup(spark, sf_dir):
    return filters.null_lookup(_part_with_gaps(spark, sf_dir), "p_size")


@query(f"SELECT p_partkey FROM {PART_WITH_GAPS} WHERE p_type IS NULL")
def null_lookup_ids(spark, sf_dir):
    return filters.null_lookup(_part_with_gaps(spark, sf_dir), "p_type", "p_partkey")


@query("""
SELECT c_custkey, 'c_acctbal' AS column_name FROM customer
WHERE CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END > 2500
""", name="threshold_lookup")
def threshold_above(spark, sf_dir):
    kept = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    customers = table(spark, sf_dir, "customer").withColumn("c_acctbal", kept)
    return filters.threshold_lookup(customers, "c_acctbal", 2500, True, ["c_custkey"])


@query("""
SELECT c_custkey, 'c_acctbal' AS column_name FROM customer
WHERE CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END < 2500
""", name="threshold_lookup_below")
def threshold_below(spark, sf_dir):
    kept = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    customers = table(spark, sf_dir, "customer").withColumn("c_acctbal", kept)
    return filters.threshold_lookup(customers, "c_acctbal", 2500, False, ["c_custkey"])


@query(f"SELECT * FROM {PART_WITH_GAPS} WHERE p_name IS NOT NULL AND p_brand IS NOT NULL")
def required_columns(spark, sf_dir):
    return filters.required_columns(_part_with_gaps(spark, sf_dir), ["p_name", "p_brand"])


@query(r"""
SELECT p_partkey, trim(regexp_replace(lower(raw), '[.#$/\[\]\s%()]+', '_', 'g'), '_') AS key
FROM (SELECT p_partkey,
             ' ' || p_name || ' (' || p_type || ') % [' || p_brand || '/' || p_size || '].' AS raw
      FROM part)
""")
def sanitize_values(spark, sf_dir):
    raw = F.concat(
        F.lit(" "), "p_name", F.lit(" ("), "p_type", F.lit(") % ["), "p_brand", F.lit("/"),
        F.col("p_size").cast("string"), F.lit("]."),
    )
    return table(spark, sf_dir, "part").select("p_partkey", sanitize_text(raw).alias("key"))


@query("""
SELECT p_partkey AS gene_stable_id, p_brand AS genome_name,
       p_size AS cds_end_within_cdna, p_retailprice AS identity FROM part
""")
def sanitize_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Gene stable ID"),
        F.col("p_brand").alias("Genome name"),
        F.col("p_size").alias("CDS end (within cDNA)"),
        F.col("p_retailprice").alias("% identity"),
    )
    return shape.sanitize_columns(part)


@query("""
SELECT p_partkey AS item, p_name AS label, p_size AS size FROM part
UNION ALL BY NAME SELECT s_suppkey AS item, s_name AS label, s_acctbal AS balance FROM supplier
UNION ALL BY NAME SELECT c_custkey AS item, c_mktsegment AS segment FROM customer
""")
def union_by_name(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS item", "p_name AS label", "p_size AS size"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS item", "s_name AS label", "s_acctbal AS balance"
    )
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS item", "c_mktsegment AS segment"
    )
    return shape.stack_by_name([part, supplier, customer])


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def union_vertical(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    return shape.stack_tables(
        [mart_select(customers, {"c_mktsegment": segment}, columns) for segment in segments]
    )


@query("""
SELECT owner, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (
      PARTITION BY owner ORDER BY o_orderdate NULLS LAST, o_orderkey NULLS LAST) AS place
  FROM (SELECT nullif(o_custkey, 10) AS owner, o_orderkey, o_orderdate, o_totalprice FROM orders))
WHERE place = 1
""")
def dedup_keep_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "nullif(o_custkey, 10) AS owner", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return reducers.keep_first(orders, "owner", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""
SELECT count(*)::BIGINT AS before, (count(DISTINCT o_custkey))::BIGINT AS after,
       (count(*) - count(DISTINCT o_custkey))::BIGINT AS removed FROM orders
""")
def dedup_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return quality.count_removed(orders, reducers.keep_first(orders, "o_custkey", ["o_orderkey"]))


@query("SELECT DISTINCT p_name, p_type FROM part")
def distinct_rows(spark, sf_dir):
    return reducers.distinct_rows(table(spark, sf_dir, "part").select("p_name", "p_type"))


@query("""
SELECT l_orderkey, max(CASE WHEN l_linenumber <> 1 THEN l_extendedprice END) AS "CDS_max"
FROM lineitem GROUP BY l_orderkey
""")
def max_per_key(spark, sf_dir):
    coding = F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice")).alias("end")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", coding)
    return reducers.max_per_key(lines, "l_orderkey", "end", "CDS_max")


@query("""
WITH longest AS (
  SELECT l_orderkey AS transcript, max(l_extendedprice) AS "CDS_max" FROM lineitem GROUP BY 1),
ranked AS (
  SELECT c_mktsegment AS genome, o_custkey AS gene, o_orderkey AS transcript, o_orderstatus,
         "CDS_max", row_number() OVER (PARTITION BY o_custkey ORDER BY "CDS_max" DESC NULLS LAST,
           c_mktsegment NULLS LAST, o_orderkey NULLS LAST, o_orderstatus NULLS LAST) AS place
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN longest ON longest.transcript = o_orderkey)
SELECT genome, gene, transcript, o_orderstatus, "CDS_max" FROM ranked WHERE place = 1
""")
def principal_isoform(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS gene", "c_mktsegment AS genome"
    )
    transcripts = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS gene", "o_orderkey AS transcript", "o_orderstatus"
    )
    cds = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS transcript", "l_extendedprice AS end"
    )
    chosen = principal_transcripts(transcripts, cds, "gene", "transcript", "end")
    return in_gene_order(chosen.join(customers, "gene"), "genome", "gene")


@query("""
SELECT l_partkey, l_quantity, l_suppkey, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC NULLS LAST,
    l_suppkey NULLS LAST, l_orderkey NULLS LAST, l_linenumber NULLS LAST) AS place
  FROM (SELECT nullif(l_partkey, 3) AS l_partkey, coalesce(nullif(l_quantity, 50), 0) AS l_quantity,
               l_suppkey, l_orderkey, l_linenumber FROM lineitem)
  WHERE l_partkey IS NOT NULL)
WHERE place = 1
""")
def argmax_per_group(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "nullif(l_partkey, 3) AS l_partkey", "nullif(l_quantity, 50) AS l_quantity",
        "l_suppkey", "l_orderkey", "l_linenumber",
    )
    return reducers.argmax_row(lines, "l_partkey", "l_quantity")


@query("""
SELECT p_brand, coalesce(string_agg(p_name, ', ' ORDER BY p_name), '') AS names
FROM (SELECT DISTINCT p_brand, nullif(p_name, 'red ring') AS p_name FROM part) GROUP BY p_brand
""")
def string_join(spark, sf_dir):
    names = table(spark, sf_dir, "part").selectExpr(
        "p_brand", "nullif(p_name, 'red ring') AS p_name"
    )
    return reducers.joined_texts(
        reducers.distinct_rows(names), "p_brand", {"names": F.col("p_name")}
    )


@query("""
SELECT l_orderkey,
       coalesce(string_agg(status, ', ' ORDER BY status), '') AS statuses,
       coalesce(string_agg(flag, ', ' ORDER BY flag), '') AS flags
FROM (SELECT l_orderkey, l_linestatus AS status, nullif(l_returnflag, 'R') AS flag FROM lineitem)
GROUP BY l_orderkey
""")
def string_join_repeats(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linestatus", "nullif(l_returnflag, 'R') AS l_returnflag"
    )
    texts = {"statuses": F.col("l_linestatus"), "flags": F.col("l_returnflag")}
    return reducers.joined_texts(lines, "l_orderkey", texts)


@query("""
SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_linenumber)), ', ') AS line_numbers
FROM lineitem GROUP BY l_suppkey
""")
def value_map(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber")
    mapped = reducers.value_map(lines, "l_suppkey", "l_linenumber", "line_numbers")
    return mapped.withColumn(
        "line_numbers", F.array_join(F.col("line_numbers").cast("array<string>"), ", ")
    )


@query("SELECT p_partkey, p_name, sha256(p_partkey::VARCHAR || chr(31) || p_name) AS id FROM part")
def row_id(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return shape.with_row_id(part, ["p_partkey", "p_name"])


GENOME_NAMES = """CASE WHEN p_type = 'PROMO' THEN p_name
       WHEN p_type = 'SMALL' THEN p_name || ' (PRJEB' || p_partkey || ')'
       ELSE p_name || '  ' || p_type || ' (PRJNA' || p_partkey || ') ' || p_brand END"""


@query(rf"""
SELECT p_partkey, genome, CASE WHEN regexp_matches(genome, '^.+?\s*\(PRJNA\d+\)')
  THEN replace(trim(regexp_extract(genome, '^(.+?)\s*\((PRJNA\d+)\)', 1)), ' ', '_') || '_'
       || lower(regexp_extract(genome, '^(.+?)\s*\((PRJNA\d+)\)', 2)) END AS slug
FROM (SELECT p_partkey, {GENOME_NAMES} AS genome FROM part)
""", name="species_slug")
def species_slugs(spark, sf_dir):
    named = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{GENOME_NAMES} AS genome")
    return named.withColumn("slug", species_slug(F.col("genome")))


@query(f"""
SELECT p_partkey,
  CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN
    'https://genes.example.org/' || replace(p_name || '  ' || p_type, ' ', '_') || '_prjna'
    || p_partkey || '/Gene/Summary?g=' || p_partkey
  WHEN p_type = 'SMALL' THEN
    'https://genes.example.org/' || replace(p_name, ' ', '_') || '_prjeb'
    || p_partkey || '/Gene/Summary?g=' || p_partkey END AS uri,
  CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN
    'https://genes.example.org/' || replace(p_name || '  ' || p_type, ' ', '_') || '_prjna'
    || p_partkey || '/Gene/Summary?g=' || p_partkey
  ELSE 'https://genes.example.org/None/Gene/Summary?g=' || p_partkey END AS uri_or_none
FROM part
""", name="gene_uri")
def gene_uris(spark, sf_dir):
    named = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{GENOME_NAMES} AS genome")
    genome, gene = F.col("genome"), F.col("p_partkey").cast("string")
    base = "https://genes.example.org"
    return named.select(
        "p_partkey",
        gene_uri(genome, gene, base, project_prefixes=["PRJNA", "PRJEB"]).alias("uri"),
        gene_uri(genome, gene, base, missing_slug="None").alias("uri_or_none"),
    )


@query(f"""
SELECT lower(p_partkey::VARCHAR) AS id, coalesce(p_name, 'NaN') AS gene_description,
       coalesce(p_size::VARCHAR, 'NaN') AS cds_end_within_cdna,
       p_retailprice::VARCHAR AS identity, coalesce(p_brand, 'NaN') AS genome_name,
       p_partkey::VARCHAR AS gene_stable_id,
       coalesce('https://genes.example.org/' || replace(p_name, ' ', '_') || '_prjna'
         || p_partkey || '/Gene/Summary?g=' || p_partkey, 'NaN') AS "URI"
FROM (SELECT * REPLACE (p_name || ' (PRJNA' || p_partkey || ')' AS p_brand) FROM {PART_WITH_GAPS})
""", name="clean_export_rows")
def clean_export_keep_id(spark, sf_dir):
    part = _part_with_gaps(spark, sf_dir).select(
        F.col("p_name").alias("Gene description"),
        F.col("p_size").alias("CDS end (within cDNA)"),
        F.col("p_retailprice").alias("% identity"),
        F.expr("p_name || ' (PRJNA' || p_partkey || ')'").alias("Genome name"),
        F.col("p_partkey").cast("string").alias("Gene stable ID"),
        F.col("p_partkey").cast("string").alias("id"),
    )
    return clean_records(part, keep_id=True, with_uri=True, base_url="https://genes.example.org")


@query(f"""
SELECT p_partkey::VARCHAR AS gene_stable_id, coalesce(p_name, 'NaN') AS gene_description,
       coalesce(p_size::VARCHAR, 'NaN') AS size, p_size IS NULL AS lacks_size
FROM {PART_WITH_GAPS}
""")
def clean_export_drop_id(spark, sf_dir):
    part = _part_with_gaps(spark, sf_dir).select(
        F.lit("unused").alias("id"),
        F.col("p_partkey").alias("Gene stable ID"),
        F.col("p_name").alias("Gene description"),
        F.col("p_size").alias("[size]"),
        F.col("p_size").isNull().alias("lacks size"),
    )
    return clean_records(part, keep_id=False)


@query("""
SELECT o_orderkey, place AS position, place // 9000 + 1 AS chunk
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders)
""", name="chunk_numbers")
def chunk_rows(spark, sf_dir):
    return chunk_numbers(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 9000)


@query("""
SELECT chunk, count(*) AS records, min(event_id) AS first_id, max(event_id) AS last_id
FROM (SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 700 + 1 AS chunk
      FROM events)
GROUP BY chunk
""")
def chunk_sizes(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_id")
    return (
        chunk_numbers(events, ["ts", "event_id"], 700)
        .groupBy("chunk")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"),
        )
    )


@query("""
SELECT 'orders' AS source, 'unique o_orderkey' AS "check", count(*) AS observed,
       count(*) = 0 AS passed
FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'at least 10000 rows', count(*), count(*) >= 10000 FROM orders
UNION ALL
SELECT 'lineitem', 'unique l_orderkey', count(*), count(*) = 0
FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'at least 10000 rows', count(*), count(*) >= 10000 FROM lineitem
""")
def quality_report(spark, sf_dir):
    reports = [
        quality.quality_report(table(spark, sf_dir, name), key, 10_000).select(
            F.lit(name).alias("source"), "*"
        )
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"))
    ]
    return reduce(DataFrame.unionByName, reports)


@query("""
SELECT l_orderkey, l_linenumber, s_name FROM lineitem
LEFT JOIN supplier ON s_suppkey = CASE WHEN l_orderkey % 3 <> 0 THEN l_suppkey END
""")
def hot_key_join(spark, sf_dir):
    """A third of the lines lack the key, and keys count as hot from a hundred rows on."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE WHEN l_orderkey % 3 <> 0 THEN l_suppkey END AS s_suppkey",
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    hot = find_hot_keys(lines, "s_suppkey", fewest_rows=100)
    joined = left_join(lines, suppliers, "s_suppkey", hot)
    return joined.select("l_orderkey", "l_linenumber", "s_name")
