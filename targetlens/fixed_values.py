"""Published formats, headers, word lists and output wording.

Nothing here is logic. Each value must stay exactly as it is for results to agree with tables
made elsewhere, so every operator takes these as defaults or parameters.
"""

# Cells that a delimited scan reads as missing (the public pandas ``read_csv`` default list).
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Column headers of the annotation tables.
GENE = "Gene stable ID"
GENOME = "Genome name"
TRANSCRIPT = "Transcript stable ID"
GENE_DESCRIPTION = "Gene description"
CDS_END = "CDS end (within cDNA)"
CDS_MAX = "CDS_max"
HUMAN_GENE = "Human gene stable ID"
HUMAN_GENE_NAME = "Human gene name"
IDENTITY = "% identity"
DOMAIN = "InterPro ID"
DOMAIN_DESCRIPTION = "InterPro description"

# Mart attribute name -> header of the column it returns.
MART_HEADERS = {
    "display_name_1010": GENOME,
    "wbps_gene_id": GENE,
    "wbps_transcript_id": TRANSCRIPT,
    "description": GENE_DESCRIPTION,
    "cds_end": CDS_END,
    "hsapiens_gene": HUMAN_GENE,
    "hsapiens_gene_name": HUMAN_GENE_NAME,
    "interpro_id": DOMAIN,
    "interpro_description": DOMAIN_DESCRIPTION,
}

# Mart filter names.
SPECIES_FILTER = "species_id_1010"
BIOTYPE_FILTER = "biotype"
PROTEIN_CODING = "protein_coding"

# Attributes of the mart queries in use. The first four are for protein-coding genes only.
PROTEIN_CODING_QUERIES = ["transcripts", "cds", "orthologues", "domains"]
MART_QUERIES = {
    "transcripts": [
        "display_name_1010", "wbps_gene_id", "wbps_transcript_id", "transcript_biotype",
        "description",
    ],
    "cds": [
        "display_name_1010", "wbps_gene_id", "wbps_transcript_id", "cds_start", "cds_end",
    ],
    "orthologues": [
        "wbps_gene_id", "hsapiens_gene", "hsapiens_gene_name", "hsapiens_orthology_type",
        "hsapiens_homolog_perc_id", "hsapiens_homolog_perc_id_r1",
    ],
    "domains": ["wbps_gene_id", "interpro_id", "interpro_description"],
    "paralogues": [
        "production_name_1010", "wbps_gene_id", "wbps_paralog_gene",
        "wbps_gene__paralog__dm_perc_id_4015", "wbps_gene__paralog__dm_perc_id_4015_r1",
    ],
    "homologues": [
        "production_name_1010", "wbps_gene_id", "hsapiens_gene", "hsapiens_gene_name",
        "hsapiens_homolog_ensembl_peptide", "hsapiens_orthology_type",
        "hsapiens_homolog_perc_id", "hsapiens_homolog_perc_id_r1",
    ],
    "primary": [
        "production_name_1010", "hsapiens_gene", "hsapiens_gene_name",
        "hsapiens_homolog_ensembl_peptide", "hsapiens_orthology_type",
        "hsapiens_homolog_perc_id", "hsapiens_homolog_perc_id_r1", "gene_biotype",
        "wbps_gene_id", "interpro_id", "interpro_description", "go_accession", "go_name_1006",
        "go_linkage_type", "wbps_paralog_gene", "wbps_gene__paralog__dm_perc_id_4015",
        "wbps_gene__paralog__dm_perc_id_4015_r1",
    ],
}

# Characters that may not stand in an exported key; a run of them becomes one underscore.
KEY_BREAKS = r"[.#$/\[\]\s%()]+"

# Separators between several values held in one cell.
CELL_SEPARATORS = "[;, ]+"

# Gene page address: base, and the accepted project accessions of a genome name.
GENE_PAGE_BASE = "https://parasite.wormbase.org"
PROJECT_PREFIXES = ("PRJNA",)

# Text written for a missing value on export.
MISSING_TEXT = "NaN"

# Domain-to-term mapping lines: "InterPro:IPR000003 Some domain > GO:some term ; GO:0003677"
MAPPING_LINE_START = "InterPro:"
MAPPING_DOMAIN = r"InterPro:(IPR\d+)"
MAPPING_TERM = r"GO:\d{7}"

# Ontology roots and the pattern behind the privileged target families, in report order.
FAMILY_ROOTS = {
    "is_enzyme": "GO:0003824",
    "is_kinase": "GO:0004672",
    "is_ion_channel": "GO:0015267",
    "is_nuclear_receptor": "GO:0004879",
}
GPCR_FLAG = "is_gpcr"
GPCR_PATTERN = "G-protein coupled receptor|GPCR.[^k]"
FAMILY_FLAGS = ["is_enzyme", "is_kinase", "is_ion_channel", "is_gpcr", "is_nuclear_receptor"]
FAMILY_ROLLUP = "is_privileged_target_family"

# Larval development terms for the token criterion.
LARVAL_TERMS = ["GO:0002168", "GO:0002119", "GO:0061062", "GO:0007275"]

# Genomes compared by the conserved-value criterion.
COMPARED_GENOMES = [
    "Trichuris trichiura (PRJEB535)",
    "Trichuris muris (PRJEB126)",
    "Trichuris suis (PRJNA179528)",
]

# Words of the protein / enzyme classifier.
PROTEIN_BIOTYPE = "protein_coding"
ENZYME_DOMAIN_WORDS = ["kinase", "protease", "oxidase", "phosphatase"]
ENZYME_TERM_WORDS = ["catalytic", "enzyme", "oxidoreductase", "hydrolase"]

# Orthologue criterion: flags, limit and wording.
LACKS_ORTHOLOGUE = "lacks_WBP_human_orthologue"
LOW_IDENTITY = "best_WBP_human_orthologue_lt_40pct_identity"
IDENTITY_LIMIT = 40
NO_ORTHOLOGUE_TEXT = "No human orthologue listed in WormBase ParaSite"
HAS_ORTHOLOGUE_TEXT = "Has human orthologue(s) in WormBase ParaSite, the most similar is: "
BELOW_LIMIT_TEXT = "Best human orthologue in WormBase ParaSite has < 40% identity: "
ABOVE_LIMIT_TEXT = "Best human orthologue found in WormBase Parasite has >= 40% identity: "

# Domain criteria wording (the double spaces belong to it).
TERM_MATCH_TEXT = "Encodes protein with InterPro domain(s)  that are related to "
TERM_NO_MATCH_TEXT = "Does not have InterPro domains related to "
PATTERN_MATCH_TEXT = "Encodes protein with InterPro domain(s): "
PATTERN_NO_MATCH_TEXT = "Encodes protein that lacks InterPro GPCR domains"

# Roll-up wording.
ROLLUP_MATCH_TEXT = "Meets the following criteria: "
ROLLUP_NO_MATCH_TEXT = "Does not meet the following criteria:  "

# Least number of genes a complete gene list holds, and records per exported chunk.
LEAST_GENES = 10_000
CHUNK_RECORDS = 9_000

# Columns of the final export, in order.
EXPORT_COLUMNS = [
    "Gene stable ID",
    "Genome name",
    "Transcript stable ID",
    "Gene description",
    "lacks_WBP_human_orthologue",
    "lacks_WBP_human_orthologue_evidence",
    "best_WBP_human_orthologue_lt_40pct_identity",
    "best_WBP_human_orthologue_lt_40pct_identity_evidence",
    "is_enzyme",
    "is_enzyme_evidence",
    "is_kinase",
    "is_kinase_evidence",
    "is_ion_channel",
    "is_ion_channel_evidence",
    "is_gpcr",
    "is_gpcr_evidence",
    "is_nuclear_receptor",
    "is_nuclear_receptor_evidence",
    "is_privileged_target_family",
    "is_privileged_target_family_evidence",
]

# "Is assigned" criteria of the stacked export files: flag -> columns that must be filled.
ASSIGNED_CRITERIA = {
    "similar_protein_in_humans": ["Human protein stable ID"],
    "has_known_protein_domain": ["InterPro ID"],
    "has_gene_ontology_functional_annotation": [
        "GO term accession", "GO term name", "GO term evidence code",
    ],
    "has_paralogue_id": ["Paralogue gene stable ID"],
}

# The same for the mart table; there the paralogue check goes out under the annotation flag.
MART_CRITERIA = {
    "similar_protein_in_humans": ["Human protein stable ID"],
    "has_known_protein_domain": ["InterPro ID"],
    "has_gene_ontology_functional_annotation": ["Paralogue gene stable ID"],
}
