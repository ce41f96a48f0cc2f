"""The composite tables, built from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.criteria import ORTHOLOGUES, _below_sql, _over_part, _steps, orthologue_rows
from catalog.registry import numbered, numbered_sql, query, table
from targetlens import fixed_values as fixed
from targetlens.operators.closure import descendants
from targetlens.operators.criteria import domain_criteria, domain_flags_only, human_orthologue
from targetlens.operators.joins import fold_left, inner_join
from targetlens.operators.shape import stack_by_name
from targetlens.plans.gene_list import principal_transcripts
from targetlens.plans.keyword_extract import keyword_extract as keyword_extract_plan
from targetlens.plans.manual_table import manual_table as manual_table_plan
from targetlens.plans.mart_table import mart_table as mart_table_plan
from targetlens.plans.target_table import (
    export_table,
    target_table,
)
from targetlens.plans.target_table import target_counts as target_counts_plan
from targetlens.sinks.tables import clean_records
from targetlens.sources.mart import mart_select
from targetlens.sources.ontology import domain_terms

# ------------------------------------------- parts as genes, lines as transcripts and domains


def _genes(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias(fixed.GENE),
        F.col("p_brand").alias(fixed.GENOME),
        F.col("p_name").alias(fixed.GENE_DESCRIPTION),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias(fixed.GENE),
        F.concat_ws(".", "l_partkey", "l_orderkey").alias(fixed.TRANSCRIPT),
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias(fixed.CDS_END),
    )
    spliced = lines.select(fixed.GENE, fixed.TRANSCRIPT)
    transcripts = stack_by_name([spliced, part.select(fixed.GENE)])
    chosen = principal_transcripts(transcripts, lines.select(fixed.TRANSCRIPT, fixed.CDS_END))
    return fold_left(part, [chosen], fixed.GENE)


GENES = """
SELECT gene, genome, description, transcript FROM (
  SELECT *, row_number() OVER (PARTITION BY gene ORDER BY cds_max DESC NULLS LAST,
           transcript NULLS LAST) AS place
  FROM (SELECT p_partkey::VARCHAR AS gene, p_brand AS genome, p_name AS description, transcript,
               cds_max
        FROM part LEFT JOIN (
          SELECT l_partkey, l_partkey || '.' || l_orderkey AS transcript,
                 max(CASE WHEN l_linenumber <> 7 THEN l_extendedprice END) AS cds_max
          FROM lineitem GROUP BY l_partkey, l_orderkey) AS t ON l_partkey = p_partkey))
WHERE place = 1"""


def _family_inputs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_partkey", "l_suppkey AS s_suppkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    annotations = inner_join(lines, suppliers, "s_suppkey").select(
        F.col("l_partkey").cast("string").alias(fixed.GENE),
        numbered("IPR", F.col("s_suppkey"), 6).alias(fixed.DOMAIN),
        F.expr(DESCRIPTION).alias(fixed.DOMAIN_DESCRIPTION),
    )
    return {
        "annotations": annotations,
        "domain_terms": domain_terms(supplier_lines(suppliers)),
        "below": descendants(
            _steps(spark, sf_dir, "supplier", "s_suppkey", (10,)), list(FAMILY_ROOTS.values())
        ),
        "roots": FAMILY_ROOTS,
        "patterns": {"is_gpcr": GPCR},
    }


MALFORMED = "s_suppkey % 50 IN (11, 27, 42)"


def supplier_lines(suppliers):
    """A mapping line for every supplier; six in a hundred are malformed, in three ways."""
    bad, turn = F.expr(MALFORMED), F.col("s_suppkey") % 3
    text = F.concat(
        F.when(bad & (turn == 0), "!").otherwise(""),
        F.lit("InterPro:"),
        F.when(bad & (turn == 1), "unknown").otherwise(numbered("IPR", F.col("s_suppkey"), 6)),
        F.lit(" name"),
        F.when(bad & (turn == 2), " > part").otherwise(""),
        F.lit(" > GO:term"), numbered(" ; GO:", F.col("s_suppkey"), 7),
    )
    return suppliers.select(text.alias("value"))


def _families(spark, sf_dir):
    return domain_criteria(**_family_inputs(spark, sf_dir))


# Each has about a ninth of the suppliers' numbers below it, so some genes meet it and some do not at
# every scale; the domains whose number ends in 9 have no description.
FAMILY_ROOTS = {
    "is_enzyme": "GO:0000004",
    "is_kinase": "GO:0000005",
    "is_ion_channel": "GO:0000007",
    "is_nuclear_receptor": "GO:0000006",
}
GPCR = "Supplier#[0-9]*3$"


def _evidence_sql(name, found, match, no_match):
    return f"""CASE WHEN {found} = '' THEN '{no_match}' ELSE '{match}' || {found} END
         AS {name}_evidence, {found} <> '' AS {name}"""


def families_sql(shown, description, pattern):
    """The criteria of all families as common table expressions; ``shown`` spells their roots."""
    hits = ", ".join(
        f"bool_or(root = '{root}') AS hit_{name}" for name, root in FAMILY_ROOTS.items()
    )
    found = ", ".join(
        f"coalesce(string_agg(note, ', ' ORDER BY note) FILTER (hit_{name}), '') AS found_{name}"
        for name in FAMILY_ROOTS
    )
    flags = ", ".join(
        _evidence_sql(
            name,
            f"found_{name}",
            f"Encodes protein with InterPro domain(s)  that are related to {shown[name]}: ",
            f"Does not have InterPro domains related to {shown[name]}",
        )
        for name in FAMILY_ROOTS
    )
    return f"""
{_below_sql(list(FAMILY_ROOTS.values()), 's_suppkey', 'supplier', (10,))},
hits AS (SELECT s_suppkey, {hits}
         FROM supplier JOIN below ON term = {numbered_sql('GO:', 's_suppkey', 7)}
         WHERE NOT ({MALFORMED}) GROUP BY s_suppkey),
rows AS (SELECT l_partkey::VARCHAR AS gene, s_suppkey, {numbered_sql('IPR', 's_suppkey', 6)}
           || ' - ' || {description} AS note
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
by_term AS (SELECT gene, {found}
            FROM (SELECT DISTINCT * FROM rows) LEFT JOIN hits USING (s_suppkey) GROUP BY gene),
by_name AS (SELECT gene, coalesce(string_agg(note, ', ' ORDER BY note)
                     FILTER (regexp_matches(note, '{pattern}')), '') AS found_is_gpcr
            FROM rows GROUP BY gene),
families AS (SELECT gene, {flags}, {_evidence_sql(
    'is_gpcr', 'found_is_gpcr', 'Encodes protein with InterPro domain(s): ',
    'Encodes protein that lacks InterPro GPCR domains')}
             FROM by_term JOIN by_name USING (gene))"""


DESCRIPTION = "CASE WHEN s_suppkey % 10 <> 9 THEN s_name END"
FAMILIES = families_sql(FAMILY_ROOTS, DESCRIPTION, GPCR)

FAMILY_COLUMNS = [
    "is_enzyme_evidence", "is_enzyme", "is_kinase_evidence", "is_kinase",
    "is_ion_channel_evidence", "is_ion_channel",
    "is_nuclear_receptor_evidence", "is_nuclear_receptor", "is_gpcr_evidence", "is_gpcr",
]


@query(f"""
WITH {FAMILIES} SELECT gene AS "Gene stable ID", {', '.join(FAMILY_COLUMNS)} FROM families
""")
def family_criteria_table(spark, sf_dir):
    return _families(spark, sf_dir)


@query(f"""
WITH {FAMILIES}
SELECT gene AS "Gene stable ID", {', '.join([*FAMILY_ROOTS, 'is_gpcr'])} FROM families
""")
def family_flags(spark, sf_dir):
    return domain_flags_only(**_family_inputs(spark, sf_dir))


_NAMES = ", ".join(f"CASE WHEN {flag} THEN '{flag}' END" for flag in fixed.FAMILY_FLAGS)
_ANY = " OR ".join(f"coalesce({flag}, FALSE)" for flag in fixed.FAMILY_FLAGS)


@query(f"""
WITH {FAMILIES}, genes AS ({GENES}), orthologues AS ({ORTHOLOGUES})
SELECT genes.gene AS "Gene stable ID", genome AS "Genome name",
  transcript AS "Transcript stable ID", description AS "Gene description",
  "lacks_WBP_human_orthologue", "lacks_WBP_human_orthologue_evidence",
  "best_WBP_human_orthologue_lt_40pct_identity",
  "best_WBP_human_orthologue_lt_40pct_identity_evidence",
  {', '.join(FAMILY_COLUMNS)},
  {_ANY} AS is_privileged_target_family,
  CASE WHEN {_ANY} THEN 'Meets the following criteria: ' || concat_ws(', ', {_NAMES})
  ELSE 'Does not meet the following criteria:  ''is_enzyme'', ''is_kinase'', '
    || '''is_ion_channel'', ''is_gpcr'', ''is_nuclear_receptor''' END
  AS is_privileged_target_family_evidence
FROM genes LEFT JOIN orthologues ON genes.gene = orthologues."Gene stable ID"
LEFT JOIN families ON families.gene = genes.gene
""")
def full_target_table(spark, sf_dir):
    overall = target_table(
        _genes(spark, sf_dir), orthologue_rows(spark, sf_dir), _families(spark, sf_dir)
    )
    return export_table(overall)


@query(f"""
WITH {FAMILIES}, orthologues AS ({ORTHOLOGUES})
SELECT 'rows' AS measure, count(*) AS "count" FROM part
UNION ALL SELECT 'lacks_WBP_human_orthologue', count(*) FILTER ("lacks_WBP_human_orthologue")
FROM orthologues
UNION ALL SELECT 'best_WBP_human_orthologue_lt_40pct_identity',
  count(*) FILTER ("best_WBP_human_orthologue_lt_40pct_identity") FROM orthologues
""" + "".join(
    f"UNION ALL SELECT '{flag}', count(*) FILTER ({flag}) FROM families\n"
    for flag in fixed.FAMILY_FLAGS
))
def target_counts(spark, sf_dir):
    return target_counts_plan(
        _genes(spark, sf_dir),
        human_orthologue(orthologue_rows(spark, sf_dir)),
        _families(spark, sf_dir),
    )


# ----------------------------------------------------- parts and customers as stacked files

SPECIES = """CASE p_type WHEN 'PROMO' THEN 'Trichuris trichiura (PRJEB535)'
         WHEN 'SMALL' THEN 'Trichuris muris (PRJEB126)'
         WHEN 'LARGE' THEN 'Trichuris suis (PRJNA179528)'
         WHEN 'MEDIUM' THEN 'Wuchereria bancrofti (PRJNA275548)' END"""

FIRST_FILE = f"""
SELECT CAST(p_partkey AS VARCHAR(20)) AS gene, {SPECIES} AS genome,
       nullif(p_brand, 'Brand#5') AS biotype, nullif(p_name, 'red ring') AS protein,
       CASE WHEN p_size < 20 THEN 'GO:0002119; GO:0000001' WHEN p_size < 40 THEN 'GO:0002119x'
       END AS terms,
       p_retailprice AS pct, p_partkey AS line
FROM part"""


def _stacked(spark, sf_dir):
    first = _over_part(spark, sf_dir, FIRST_FILE).select(
        F.col("gene").cast("string").alias(fixed.GENE),
        F.col("genome").alias(fixed.GENOME),
        F.col("biotype").alias("Gene biotype"),
        F.col("protein").alias("Human protein stable ID"),
        F.col("terms").alias("GO term accession"),
        F.col("pct").alias(fixed.IDENTITY),
        F.lit(0).alias("_file_number"),
        F.lit("parts").alias("_file"),
        F.lit(0).alias("_block"),
        F.col("line").alias("_row"),
    )
    second = table(spark, sf_dir, "customer").select(
        F.expr("CAST(nullif(c_custkey, 7) * 3 AS STRING)").alias(fixed.GENE),
        F.lit("Trichuris muris (PRJEB126)").alias(fixed.GENOME),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("Gene biotype"),
        F.col("c_name").alias("Paralogue gene stable ID"),
        (F.lit(900.0) + F.col("c_nationkey") / 10).alias(fixed.IDENTITY),
        F.lit(1).alias("_file_number"),
        F.lit("customers").alias("_file"),
        F.lit(0).alias("_block"),
        F.col("c_custkey").alias("_row"),
    )
    return stack_by_name([first, second])


@query(f"""
WITH stacked AS (
  SELECT gene, genome, biotype, protein, terms, pct, NULL AS paralogue, 0 AS file, line
  FROM ({FIRST_FILE})
  UNION ALL
  SELECT (nullif(c_custkey, 7) * 3)::VARCHAR, 'Trichuris muris (PRJEB126)',
         nullif(c_mktsegment, 'BUILDING'), NULL, NULL, 900.0::DOUBLE + c_nationkey / 10,
         c_name, 1, c_custkey FROM customer),
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY file, line) AS place
                 FROM stacked)
  WHERE place = 1 AND genome IS NOT NULL AND biotype IS NOT NULL),
shared AS (
  SELECT pct, list_sort(list(DISTINCT genome)) AS species FROM kept
  WHERE genome IN ('Trichuris trichiura (PRJEB535)', 'Trichuris muris (PRJEB126)',
                   'Trichuris suis (PRJNA179528)')
  GROUP BY pct HAVING count(DISTINCT genome) >= 2)
SELECT sha256(coalesce(gene, chr(0))) AS id, coalesce(gene, 'NaN') AS gene_stable_id,
  genome AS genome_name, biotype AS gene_biotype,
  coalesce(protein, 'NaN') AS human_protein_stable_id,
  coalesce(terms, 'NaN') AS go_term_accession, kept.pct::VARCHAR AS identity,
  coalesce(paralogue, 'NaN') AS paralogue_gene_stable_id,
  protein IS NOT NULL AS similar_protein_in_humans,
  terms IS NOT NULL AS has_gene_ontology_functional_annotation,
  paralogue IS NOT NULL AS has_paralogue_id,
  coalesce(terms = 'GO:0002119; GO:0000001', FALSE) AS linked_to_larval_development,
  shared.pct IS NOT NULL AS has_similar_identity,
  coalesce('["' || array_to_string(species, '","') || '"]', 'NaN') AS similar_identity_species,
  CASE WHEN gene IS NULL THEN 'NaN'
    WHEN genome = 'Trichuris suis (PRJNA179528)' THEN
      'https://genes.example.org/Trichuris_suis_prjna179528/Gene/Summary?g=' || gene
    WHEN genome = 'Wuchereria bancrofti (PRJNA275548)' THEN
      'https://genes.example.org/Wuchereria_bancrofti_prjna275548/Gene/Summary?g=' || gene
    ELSE 'NaN' END AS "URI"
FROM kept LEFT JOIN shared ON kept.pct = shared.pct
""")
def manual_table(spark, sf_dir):
    flagged = manual_table_plan(_stacked(spark, sf_dir))
    return clean_records(
        flagged, keep_id=True, with_uri=True, base_url="https://genes.example.org"
    )


@query("""
SELECT p_brand AS genome, p_partkey::VARCHAR AS gene_stable_id,
  coalesce(name, 'NaN') AS interpro_id,
  coalesce(kind, 'NaN') AS paralogue_gene_stable_id,
  FALSE AS similar_protein_in_humans,
  name IS NOT NULL AS has_known_protein_domain,
  kind IS NOT NULL AS has_gene_ontology_functional_annotation
FROM (SELECT p_brand, p_partkey, nullif(p_name, 'red ring') AS name, nullif(p_type, 'PROMO') AS kind
      FROM part WHERE p_brand IN ('Brand#7', 'Brand#8', 'Brand#9'))
""")
def mart_table(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumns(
        {
            "p_name": F.expr("nullif(p_name, 'red ring')"),
            "p_type": F.expr("nullif(p_type, 'PROMO')"),
        }
    )
    rows = mart_select(
        part,
        {"p_brand": "Brand#7,Brand#8,Brand#9"},
        ["p_brand", "p_partkey", "p_name", "p_type"],
        headers={
            "p_brand": "genome",
            "p_partkey": fixed.GENE,
            "p_name": fixed.DOMAIN,
            "p_type": "Paralogue gene stable ID",
        },
    )
    return clean_records(mart_table_plan(rows), keep_id=False)


@query("""
SELECT doc_id, n_chars,
  lang = 'en' OR trim(source) <> '' AND source <> 'src3' AS "Is_Protein",
  regexp_matches(lower(text), 'euxque|ndwhst')
    OR regexp_matches(lower(text), 'ingeser|auxment') AS "Is_Enzyme"
FROM documents WHERE regexp_matches(text, 'ouble|oui', 'i')
""")
def keyword_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "n_chars", "text",
        "CASE WHEN lang = 'en' THEN 'Protein_Coding' END AS biotype",
        "nullif(source, 'src3') AS entry", "CAST(NULL AS STRING) AS pep",
    )
    found = keyword_extract_plan(
        rows, "ouble|oui", "text", biotype="biotype", protein_id="pep", protein_entry="entry",
        domain="text", terms="text", domain_words=["euxque", "ndwhst"],
        term_words=["ingeser", "auxment"],
    )
    return found.select("doc_id", "n_chars", "Is_Protein", "Is_Enzyme")
