"""Ontology, row criteria and per-gene criteria."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import listed, numbered, numbered_sql, query, table
from catalog.relational import PART_WITH_GAPS, _part_with_gaps
from targetlens import fixed_values as fixed
from targetlens.operators import closure, criteria, quality
from targetlens.operators.joins import fold_left, inner_join, left_join
from targetlens.operators.reduce import value_map
from targetlens.operators.shape import stack_by_name
from targetlens.sources import ontology
from targetlens.storage import bucketed

# ---------------------------------------------------------------- ontology made from part keys
# Term k lies below terms k/2 and k/3. Some stanzas are obsolete, some are no terms.


def _stanzas(spark, sf_dir):
    key = F.col("p_partkey")
    lines = [
        F.when(F.col("p_size") == 14, "[Typedef]").otherwise("[Term]"),
        numbered("id: GO:", key, 7),
        F.concat(F.lit("name: "), "p_name"),
        numbered("alt_id: GO:9", key, 9),
        F.when(key > 0, F.concat(numbered("is_a: GO:", F.expr("p_partkey div 2"), 7),
                                 F.lit(" ! one parent"))),
        F.when(key > 2, numbered("is_a: GO:", F.expr("p_partkey div 3"), 7)),
        F.when(F.col("p_size") == 13, "is_obsolete: true"),
    ]
    return table(spark, sf_dir, "part").select(F.concat_ws("\n", *lines).alias("value"))


GO_ID = numbered_sql("GO:", "p_partkey", 7)


@query(f"SELECT {GO_ID} AS go_id, p_name AS name FROM part WHERE p_size NOT IN (13, 14)")
def obo_terms(spark, sf_dir):
    return ontology.ontology_terms(_stanzas(spark, sf_dir))


@query(f"""
SELECT {numbered_sql('GO:9', 'p_partkey', 9)} AS alt_id, {GO_ID} AS go_id
FROM part WHERE p_size NOT IN (13, 14)
""")
def obo_alternates(spark, sf_dir):
    return ontology.ontology_alternates(_stanzas(spark, sf_dir))


@query(f"""
SELECT {GO_ID} AS child, {numbered_sql('GO:', 'p_partkey // 2', 7)} AS parent
FROM part WHERE p_partkey > 0 AND p_size NOT IN (13, 14)
UNION ALL
SELECT {GO_ID}, {numbered_sql('GO:', 'p_partkey // 3', 7)}
FROM part WHERE p_partkey > 2 AND p_size NOT IN (13, 14)
""")
def obo_edges(spark, sf_dir):
    return ontology.ontology_edges(_stanzas(spark, sf_dir))


def _mapping_lines(spark, sf_dir):
    text = F.concat(
        F.when(F.col("p_size") == 6, "!").otherwise(""),
        F.lit("InterPro:"),
        F.when(F.col("p_size") == 7, "unknown")
        .otherwise(numbered("IPR", F.col("p_partkey"), 6)),
        F.lit(" "), "p_name",
        F.when(F.col("p_size") == 5, " > part").otherwise(""),
        F.lit(" > GO:"), F.lower("p_type"),
        numbered(" ; GO:", F.expr("p_partkey div 7"), 7),
        F.when(F.col("p_size") < 25, numbered(" ; GO:", F.col("p_size"), 7)).otherwise(""),
    )
    return table(spark, sf_dir, "part").select(text.alias("value"))


DOMAIN_TERMS = f"""(
  SELECT {numbered_sql('IPR', 'p_partkey', 6)} AS domain,
         {numbered_sql('GO:', 'p_partkey // 7', 7)} AS go_id
  FROM part WHERE p_size NOT IN (5, 6, 7)
  UNION
  SELECT {numbered_sql('IPR', 'p_partkey', 6)}, {numbered_sql('GO:', 'p_size', 7)}
  FROM part WHERE p_size NOT IN (5, 6, 7) AND p_size < 25)"""


@query(f'SELECT domain AS "InterPro ID", go_id FROM {DOMAIN_TERMS} AS mapped')
def domain_go_map(spark, sf_dir):
    return ontology.domain_terms(_mapping_lines(spark, sf_dir))


@query(f"""
SELECT domain AS "InterPro ID", string_agg(go_id, ', ' ORDER BY go_id) AS terms
FROM {DOMAIN_TERMS} AS mapped GROUP BY domain
""")
def domain_go_sets(spark, sf_dir):
    pairs = ontology.domain_terms(_mapping_lines(spark, sf_dir))
    sets = value_map(pairs, fixed.DOMAIN, "go_id", "terms")
    return sets.withColumn("terms", listed(F.col("terms")))


ROOTS = ["GO:0000002", "GO:0000005", "GO:0000007", "GO:0000011"]


def _below_sql(roots, key, source, divisors=(2, 3)):
    """Pairs of root and descendant as common table expressions, for keys of one table."""
    steps = " UNION ".join(
        f"SELECT {key}, {key} // {by} FROM {source} WHERE {key} >= {by}"
        for by in divisors
    )
    starts = ", ".join(f"('{root}', {int(root[3:])})" for root in roots)
    return f"""
RECURSIVE steps(child, parent) AS ({steps}),
reached(root, term) AS (
  SELECT * FROM (VALUES {starts}) AS starts(root, term)
  UNION SELECT root, child FROM reached JOIN steps ON parent = term),
below AS (SELECT root, {numbered_sql('GO:', 'term', 7)} AS term FROM reached)"""


def _steps(spark, sf_dir, name, key, divisors=(2, 3)):
    """Terms for the numbers of a table; above each are its quotients."""
    number = F.col(key)
    parents = F.array_distinct(F.array(
        *[F.when(number >= by, F.expr(f"{key} div {by}")) for by in divisors]
    ))
    edges = table(spark, sf_dir, name).select(
        number.alias("number"), F.explode(F.array_compact(parents)).alias("above")
    )
    return edges.select(
        numbered("GO:", F.col("number"), 7).alias("child"),
        numbered("GO:", F.col("above"), 7).alias("parent"),
    )


@query(f"WITH {_below_sql(ROOTS, 'p_partkey', 'part')} SELECT root, term FROM below")
def descendants(spark, sf_dir):
    return closure.descendants(_steps(spark, sf_dir, "part", "p_partkey"), ROOTS)


# ------------------------------------------------- annotations: orders as genes, parts as domains


def _annotations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS gene", "l_partkey AS part")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"),
        numbered("IPR", F.col("p_partkey"), 6).alias("domain"),
        F.expr("nullif(p_name, 'red ring')").alias("description"),
    )
    return inner_join(lines, parts, "part").select("gene", "domain", "description")


ANNOTATIONS = f"""
SELECT l_orderkey AS gene, {numbered_sql('IPR', 'p_partkey', 6)} AS domain,
       nullif(p_name, 'red ring') AS description
FROM lineitem JOIN part ON l_partkey = p_partkey"""

COLUMNS = {"gene": "gene", "domain": "domain", "description": "description"}


@query(f"""
WITH {_below_sql(['GO:0000005'], 'p_partkey', 'part')},
hits AS (SELECT DISTINCT domain FROM {DOMAIN_TERMS} AS mapped JOIN below ON go_id = term),
annotated AS (SELECT DISTINCT * FROM ({ANNOTATIONS})),
evidence AS (
  SELECT gene, coalesce(string_agg(domain || ' - ' || description, ', '
           ORDER BY domain || ' - ' || description) FILTER (hits.domain IS NOT NULL), '') AS found
  FROM annotated LEFT JOIN hits USING (domain) GROUP BY gene)
SELECT gene, CASE WHEN found = '' THEN 'Does not have InterPro domains related to GO:0000005'
         ELSE 'Encodes protein with InterPro domain(s)  that are related to GO:0000005: ' || found
       END AS is_fifth_evidence, found <> '' AS is_fifth
FROM evidence
""")
def ontology_criterion(spark, sf_dir):
    root = "GO:0000005"
    terms = ontology.domain_terms(_mapping_lines(spark, sf_dir), domain="domain")
    below = closure.descendants(_steps(spark, sf_dir, "part", "p_partkey"), [root])
    return criteria.ontology_criterion(
        _annotations(spark, sf_dir), root, "is_fifth", terms, below, **COLUMNS
    )


ANNOTATION_PATTERN = "gizmo$|IPR0.[13]0.*[^w] (bolt|gear)"


@query(f"""
WITH evidence AS (
  SELECT gene, coalesce(string_agg(note, ', ' ORDER BY note)
           FILTER (regexp_matches(note, '{ANNOTATION_PATTERN}')), '') AS found
  FROM (SELECT gene, domain || ' - ' || description AS note FROM ({ANNOTATIONS})) GROUP BY gene)
SELECT gene, CASE WHEN found = '' THEN 'No such domain'
         ELSE 'Encodes protein with InterPro domain(s): ' || found END AS is_named_evidence,
       found <> '' AS is_named
FROM evidence
""")
def annotation_regex(spark, sf_dir):
    return criteria.pattern_criterion(
        _annotations(spark, sf_dir), ANNOTATION_PATTERN, "is_named",
        no_pattern_text="No such domain", **COLUMNS,
    )


@query(f"""
WITH {_below_sql(['GO:0000005'], 'p_partkey', 'part')},
hits AS (SELECT DISTINCT domain FROM {DOMAIN_TERMS} AS mapped JOIN below ON go_id = term),
counted AS (
  SELECT gene, domain, domain || ' - ' || description AS annotation, count(*) AS copies
  FROM ({ANNOTATIONS}) WHERE description IS NOT NULL GROUP BY ALL)
SELECT gene, 'is_fifth' AS criterion, annotation, copies
FROM counted JOIN hits USING (domain)
UNION ALL SELECT gene, 'is_named', annotation, copies FROM counted
WHERE regexp_matches(annotation, '{ANNOTATION_PATTERN}')
""")
def evidence_rows(spark, sf_dir):
    root = "GO:0000005"
    terms = ontology.domain_terms(_mapping_lines(spark, sf_dir), domain="domain")
    below = closure.descendants(_steps(spark, sf_dir, "part", "p_partkey"), [root])
    return criteria.evidence_rows(
        _annotations(spark, sf_dir), {"is_fifth": root}, {"is_named": ANNOTATION_PATTERN},
        terms, below, **COLUMNS,
    )


# ----------------------------------------------------------------------------- row criteria


@query(f"""
SELECT p_partkey,
       NOT (p_size IS NULL OR p_type IS NULL) AS both_filled,
       p_size IS NULL AS size_open,
       p_size IS NULL AS some_absent,
       FALSE AS all_absent
FROM {PART_WITH_GAPS}
""")
def assigned_strict(spark, sf_dir):
    df = _part_with_gaps(spark, sf_dir)
    df = criteria.assigned_strict(df, ["p_size", "p_type"], "both_filled", False)
    df = criteria.assigned_strict(df, ["p_size"], "size_open", True)
    df = criteria.assigned_strict(df, ["p_size", "p_colour"], "some_absent", False)
    df = criteria.assigned_strict(df, ["p_colour"], "all_absent", False)
    return df.select("p_partkey", "both_filled", "size_open", "some_absent", "all_absent")


@query(f"""
SELECT p_partkey,
       NOT (p_size IS NULL OR p_type IS NULL) AS both_filled,
       p_size IS NULL AS size_open,
       p_size IS NOT NULL AS some_absent
FROM {PART_WITH_GAPS}
""")
def assigned_lenient(spark, sf_dir):
    df = _part_with_gaps(spark, sf_dir).select("p_partkey", "p_size", "p_type")
    df = criteria.assigned_lenient(df, ["p_size", "p_type"], "both_filled", False)
    df = criteria.assigned_lenient(df, ["p_size"], "size_open", True)
    df = criteria.assigned_lenient(df, ["p_size", "p_colour"], "some_absent", False)
    return criteria.assigned_lenient(df, ["p_colour"], "all_absent", False).drop(
        "p_size", "p_type"
    )


@query(f"""
SELECT p_partkey, cell,
  coalesce(list_has_any(regexp_split_to_array(cell, '[;, ]+'), ['ring', 'gear', 'SMALL']), FALSE)
  OR coalesce(list_has_any(regexp_split_to_array(p_brand, '[;, ]+'),
                           ['ring', 'gear', 'SMALL']), FALSE) AS linked
FROM (SELECT p_partkey, p_brand, p_name || '; ' || p_type || ',,' || p_size AS cell
      FROM {PART_WITH_GAPS})
""")
def token_match(spark, sf_dir):
    df = _part_with_gaps(spark, sf_dir).selectExpr(
        "p_partkey", "p_brand", "p_name || '; ' || p_type || ',,' || p_size AS cell"
    )
    wanted = ["ring", "gear", "SMALL"]
    linked = criteria.token_match(df, ["cell", "p_brand", "p_colour"], "linked", wanted)
    return linked.drop("p_brand")


@query("""
WITH valued AS (
  SELECT p_partkey, nullif(p_retailprice, 950.5) AS price, nullif(p_brand, 'Brand#5') AS brand
  FROM part),
shared AS (
  SELECT price, array_to_string(list_sort(list(DISTINCT brand)), ', ') AS brands
  FROM valued WHERE price IS NOT NULL AND brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4')
  GROUP BY price HAVING count(DISTINCT brand) >= 2)
SELECT p_partkey, valued.price, brand,
       brand IS NOT NULL AND brands IS NOT NULL AS has_similar_identity,
       CASE WHEN brand IS NOT NULL THEN brands END AS similar_identity_species
FROM valued LEFT JOIN shared ON valued.price = shared.price
""")
def conserved_value(spark, sf_dir):
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "nullif(p_retailprice, 950.5) AS price", "nullif(p_brand, 'Brand#5') AS brand"
    )
    groups = ["Brand#1", "Brand#2", "Brand#3", "Brand#4"]
    flagged = criteria.conserved_value(parts, "price", "brand", groups, 2)
    return flagged.withColumn("similar_identity_species", listed(F.col("similar_identity_species")))


def _over_part(spark, sf_dir, text):
    return spark.sql(text.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))


CLASSIFIED = """
SELECT p_partkey,
       CASE WHEN p_type = 'PROMO' THEN 'Protein_CODING gene' WHEN p_type = 'SMALL' THEN NULL
            ELSE p_type END AS biotype,
       CASE WHEN p_size < 10 THEN ' ' WHEN p_size < 15 THEN 'CE' || p_size END AS wormpep,
       CASE WHEN p_brand = 'Brand#3' THEN '' WHEN p_brand = 'Brand#4' THEN p_brand END AS uniprot,
       nullif(replace(p_name, 'gear', 'Kinase-like'), 'red ring') AS domain,
       replace(replace(p_name, 'widget', 'HYDROLASE activity'), 'hot', 'catalytic') AS terms
FROM part"""


@query(f"""
SELECT p_partkey,
  coalesce(contains(lower(biotype), 'protein_coding'), FALSE)
    OR coalesce(trim(wormpep) <> '', FALSE) OR coalesce(trim(uniprot) <> '', FALSE)
    AS "Is_Protein",
  coalesce(regexp_matches(lower(domain), 'kinase|protease|oxidase|phosphatase'), FALSE)
    OR coalesce(regexp_matches(lower(terms), 'catalytic|enzyme|oxidoreductase|hydrolase'), FALSE)
    AS "Is_Enzyme"
FROM ({CLASSIFIED})
""")
def classify_two_flags(spark, sf_dir):
    rows = _over_part(spark, sf_dir, CLASSIFIED)
    flagged = criteria.protein_or_enzyme(rows, "biotype", "wormpep", "uniprot", "domain", "terms")
    return flagged.select("p_partkey", "Is_Protein", "Is_Enzyme")


FAMILY_INPUT = """
SELECT p_partkey, p_type = 'PROMO' AS is_enzyme, p_size > 40 AS is_kinase,
       CASE WHEN p_brand <> 'Brand#5' THEN p_name = 'red ring' END AS is_ion_channel,
       p_type = 'SMALL' AS is_gpcr, p_size < 5 AS is_nuclear_receptor
FROM part"""


@query(f"""
SELECT * EXCLUDE (any_met), any_met AS is_privileged_target_family,
  CASE WHEN any_met THEN 'Meets the following criteria: ' || concat_ws(', ',
    CASE WHEN is_enzyme THEN 'is_enzyme' END, CASE WHEN is_kinase THEN 'is_kinase' END,
    CASE WHEN is_ion_channel THEN 'is_ion_channel' END, CASE WHEN is_gpcr THEN 'is_gpcr' END,
    CASE WHEN is_nuclear_receptor THEN 'is_nuclear_receptor' END)
  ELSE 'Does not meet the following criteria:  ''is_enzyme'', ''is_kinase'', '
    || '''is_ion_channel'', ''is_gpcr'', ''is_nuclear_receptor''' END
  AS is_privileged_target_family_evidence
FROM (SELECT *, is_enzyme OR is_kinase OR coalesce(is_ion_channel, FALSE) OR is_gpcr
        OR is_nuclear_receptor AS any_met FROM ({FAMILY_INPUT}))
""")
def family_rollup(spark, sf_dir):
    return criteria.family_rollup(_over_part(spark, sf_dir, FAMILY_INPUT))


CRITERIA_FOLD = """
SELECT c_custkey, c_name, orders, best_price, in_asia, balance
FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) AS n
  ON n.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS best_price FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1) AS best ON best.o_custkey = c_custkey
LEFT JOIN (SELECT c_custkey AS k, TRUE AS in_asia FROM customer
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           WHERE r_name = 'ASIA') AS asia ON k = c_custkey
LEFT JOIN (SELECT c_custkey AS b, c_acctbal AS balance FROM customer WHERE c_acctbal > 0) AS rich
  ON b = c_custkey
"""


def _fold_inputs(spark, sf_dir):
    customers, orders, nation, region = (
        table(spark, sf_dir, name) for name in ("customer", "orders", "nation", "region")
    )
    owned = orders.withColumnRenamed("o_custkey", "c_custkey")
    counts = owned.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("orders"))
    best = (
        owned.where("o_orderstatus = 'F'")
        .groupBy("c_custkey")
        .agg(F.max("o_totalprice").alias("best_price"))
    )
    asia = (
        customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.lit(True).alias("in_asia"))
    )
    rich = customers.where("c_acctbal > 0").selectExpr("c_custkey", "c_acctbal AS balance")
    base = customers.select("c_custkey", "c_name")
    return base, [counts, best, asia, rich]


@query(CRITERIA_FOLD)
def criteria_fold(spark, sf_dir):
    return fold_left(*_fold_inputs(spark, sf_dir), "c_custkey")


@query(CRITERIA_FOLD)
def criteria_fold_bucketed(spark, sf_dir):
    """Tables written once in buckets of their key, as a later run finds them."""
    base, sides = _fold_inputs(spark, sf_dir)
    base, *sides = [bucketed(df, "criterion", "c_custkey").table for df in (base, *sides)]
    return fold_left(base, sides, "c_custkey", check=sides[:1])


@query(f"""
SELECT unnest(['rows', 'is_enzyme', 'is_kinase', 'is_ion_channel']) AS measure,
       unnest([count(*), count(*) FILTER (is_enzyme), count(*) FILTER (is_kinase),
               count(*) FILTER (is_ion_channel)]) AS "count"
FROM ({FAMILY_INPUT})
""")
def criteria_counts(spark, sf_dir):
    flags = ["is_enzyme", "is_kinase", "is_ion_channel"]
    return quality.summary_counts(_over_part(spark, sf_dir, FAMILY_INPUT), flags)


@query(f"SELECT count(*) AS \"count\" FROM ({FAMILY_INPUT}) WHERE is_ion_channel")
def true_count(spark, sf_dir):
    return quality.count_true(_over_part(spark, sf_dir, FAMILY_INPUT), "is_ion_channel")


# ------------------------------------------------------------------------------ orthologues


def orthologue_rows(spark, sf_dir):
    """Parts as genes; each line's supplier as a human orthologue, some without id or name.

    Every part also has a bare row, so that a part without lines is a gene without orthologue.
    """
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey", "l_suppkey AS s_suppkey", "l_quantity"
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    known = left_join(lines, suppliers, "s_suppkey").select(
        F.col("l_partkey").cast("string").alias(fixed.GENE),
        F.when(F.col("s_nationkey") > 3, numbered("ENSG", F.col("s_suppkey"), 9))
        .alias(fixed.HUMAN_GENE),
        F.expr("nullif(s_name, 'Supplier#000000007')").alias(fixed.HUMAN_GENE_NAME),
        F.expr("nullif(l_quantity, 50)").alias(fixed.IDENTITY),
    )
    bare = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias(fixed.GENE)
    )
    return stack_by_name([known, bare])


ORTHOLOGUES = f"""
SELECT gene AS "Gene stable ID", human AS "Human gene stable ID", name AS "Human gene name",
       pct AS "% identity",
       human IS NULL AS "lacks_WBP_human_orthologue",
       CASE WHEN human IS NULL THEN 'No human orthologue listed in WormBase ParaSite'
         ELSE 'Has human orthologue(s) in WormBase ParaSite, the most similar is: ' || name
       END AS "lacks_WBP_human_orthologue_evidence",
       pct < 40 AS "best_WBP_human_orthologue_lt_40pct_identity",
       CASE WHEN human IS NULL THEN 'No human orthologue listed in WormBase ParaSite'
         WHEN pct < 40 THEN 'Best human orthologue in WormBase ParaSite has < 40% identity: '
           || name || ' ' || pct || '%'
         ELSE 'Best human orthologue found in WormBase Parasite has >= 40% identity: '
           || name || ' ' || pct || '%'
       END AS "best_WBP_human_orthologue_lt_40pct_identity_evidence"
FROM (
  SELECT *, row_number() OVER (PARTITION BY gene ORDER BY pct DESC NULLS LAST,
           human NULLS LAST, name NULLS LAST) AS place
  FROM (SELECT p_partkey::VARCHAR AS gene,
               CASE WHEN s_nationkey > 3 THEN {numbered_sql('ENSG', 'l_suppkey', 9)} END AS human,
               nullif(s_name, 'Supplier#000000007') AS name,
               coalesce(nullif(l_quantity, 50), 0) AS pct
        FROM part LEFT JOIN lineitem ON l_partkey = p_partkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey))
WHERE place = 1"""


@query(ORTHOLOGUES)
def human_orthologue(spark, sf_dir):
    return criteria.human_orthologue(orthologue_rows(spark, sf_dir))
