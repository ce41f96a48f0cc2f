"""The operators with production parameters over the given tables, next to their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens.llm import kneser_ney, language, merkle
from targetlens.llm import toxicity as toxic_texts
from targetlens.llm.common import fold
from targetlens.llm.decontaminate import WINDOW, contamination, is_contaminated
from targetlens.llm.lexical import ranked_documents
from targetlens.llm.lines import kept_lines, kept_text, n_dropped
from targetlens.llm.minhash import near_duplicates
from targetlens.llm.packing import packed
from targetlens.llm.secrets import BASE_RULES, RULES, Rule, joined_spans, secret_spans
from targetlens.llm.tokens import token_counts
from targetlens.llm.topk import exact_top_k
from targetlens.llm.warc import archived

WORD_VOCABULARY = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its name, with its SQL counterpart where there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER_SQL = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

NEAR_DUPLICATES_SQL = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    END) AS s FROM split
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach(x, y) AS (
    SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), lowest AS (
    SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
    least(d.doc_id, coalesce(y, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(y, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest ON x = d.doc_id
"""


@query(NEAR_DUPLICATES_SQL)
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates on four words, by min-max hashing."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def _rule_sql(rule: Rule, place: int) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
    SELECT r, '{rule.kind}' AS kind, {place} AS place, {rule.least} AS least,
        string_split_regex(x, {pattern}) AS g, regexp_extract_all(x, {pattern}, 0) AS f,
        regexp_extract_all(x, {pattern}, {rule.group}) AS v
    FROM t WHERE regexp_matches(x, {pattern})"""


SECRETS_SQL = rf"""
WITH t AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS x FROM documents
), m AS ({" UNION ALL ".join(_rule_sql(rule, place) for place, rule in enumerate(RULES))}
), z AS (
    SELECT r, kind, place, least, unnest(list_transform(range(1, len(f) + 1), lambda i: {{
        'e': list_sum(list_transform(g[1:i], lambda y: length(y)))
            + list_sum(list_transform(f[1:i], lambda y: length(y))),
        'l': length(f[i]), 'v': length(v[i])}})) AS a FROM m
), s AS (
    SELECT r, kind, place, (a.e - a.l)::BIGINT AS b, a.e::BIGINT AS e FROM z WHERE a.v >= least
), d AS (
    SELECT r, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, place) AS spans,
        string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, place)
            FILTER (WHERE place < 3) AS base,
        count(*) FILTER (WHERE place = 0) AS n_assign,
        count(*) FILTER (WHERE place = 1) AS n_access,
        count(*) FILTER (WHERE place = 2) AS n_hex
    FROM s GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM t LEFT JOIN d ON d.r = t.r
"""


@query(SECRETS_SQL)
def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of the base rules and of the further ones."""
    found = secret_spans(table(spark, sf_dir, "documents"))

    def number(place: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["place"] == place)).cast("long")

    base = joined_spans(F.filter("spans", lambda x: x["place"] < len(BASE_RULES)))
    return found.select(
        "doc_id",
        *[number(place).alias(f"n_{rule.kind}") for place, rule in enumerate(BASE_RULES)],
        F.sha2(base, 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


DECONTAMINATION_SQL = rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
        {LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(
        {LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, unnest(list_transform(
        range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1),
        lambda i: array_to_string(w[i:i + {WINDOW} - 1], ' '))) AS x
    FROM b WHERE len(w) > 0
), lengths AS (
    SELECT DISTINCT n FROM windows
), places AS (
    SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, lengths WHERE len(w) >= n
), hits AS (
    SELECT r, i, p.n, item_id FROM places p
    JOIN windows v ON v.n = p.n AND v.x = array_to_string(w[i:i + p.n - 1], ' ')
), words AS (
    SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits)
    GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words ON words.r = d.r LEFT JOIN items ON items.r = d.r
"""


@query(DECONTAMINATION_SQL)
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in each document, and whether it is contaminated."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = contamination(docs.select("doc_id", "text"), benchmark)
    hits = F.col("_hits")
    return found.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


@query()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in sequences of 4096 tokens, one row per piece."""
    path = public_tokenizers.path(WORD_VOCABULARY)
    found = packed(table(spark, sf_dir, "documents"), path)
    return found.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each document."""
    path = public_tokenizers.path(WORD_VOCABULARY)
    return token_counts(table(spark, sf_dir, "documents"), path)


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learnt from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = language.fit(docs, ~held_out)
    found = language.identified(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, learnt from the labels of three quarters of them."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxic_texts.fit(docs, labels, fold(F.col("id"), 4) != 2)
    held_out = fold(F.col("doc_id"), 4) == 2
    found = toxic_texts.toxicity(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


ARCHIVES_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), k AS (
    SELECT html, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY html
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
    CASE WHEN page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k ON k.html = p.html AND n >= 1000
"""


@query(ARCHIVES_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives, normalised and read back."""
    return archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(
        embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query(TOP_K_SQL)
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@query()
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document, learnt from six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    found = kneser_ney.scored(docs, kneser_ney.fit(docs, ~held_out))
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


MANIFEST_SQL = """
WITH RECURSIVE leaf AS (
    SELECT *, sha256(concat(
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
        coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
        coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
        coalesce(strlen(text) || ':' || text, '-'))) AS h,
        replace(text, chr(10), '') AS told,
        list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''),
            lambda c: ascii(c)::BIGINT)), lambda crc, c: list_reduce(
            list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) % 2 = 1 AS even
    FROM documents
), candidate AS (
    SELECT *, CASE WHEN even THEN sha256(concat(
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
        coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
        coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
        coalesce(strlen(told) || ':' || told, '-'))) ELSE h END AS c FROM leaf
), placed AS (
    SELECT doc_id, source, h, c,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
        count(*) OVER (PARTITION BY source) AS n FROM candidate
), low(source, level, i, n, h) AS (
    SELECT source, 0, i, n, h FROM placed
    UNION ALL
    SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM low
    WHERE n > 1 GROUP BY source, level, i // 3, n
), subroot AS (
    SELECT source, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS i,
        count(*) OVER () AS n FROM low WHERE n = 1
), high(level, i, n, h) AS (
    SELECT 0, i, n, h FROM subroot
    UNION ALL
    SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM high
    WHERE n > 1 GROUP BY level, i // 3, n
), lower_runs AS (
    SELECT source, level, i,
        coalesce(string_agg(h, '') OVER (PARTITION BY source, level, i // 3 ORDER BY i
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
        coalesce(string_agg(h, '') OVER (PARTITION BY source, level, i // 3 ORDER BY i
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM low WHERE n > 1
), upper_runs AS (
    SELECT level, i,
        coalesce(string_agg(h, '') OVER (PARTITION BY level, i // 3 ORDER BY i
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
        coalesce(string_agg(h, '') OVER (PARTITION BY level, i // 3 ORDER BY i
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM high WHERE n > 1
), climb(source, leaf_i, level, i, proof, f) AS (
    SELECT source, i, 0, i, '', c FROM placed
    UNION ALL
    SELECT p.source, leaf_i, p.level + 1, p.i // 3, proof || b || a, sha256(b || f || a)
    FROM climb p JOIN lower_runs r
        ON r.source IS NOT DISTINCT FROM p.source AND r.level = p.level AND r.i = p.i
), under AS (
    SELECT source, leaf_i, arg_max(proof, level) AS proof, arg_max(f, level) AS f
    FROM climb GROUP BY source, leaf_i
), top_climb(source, leaf_i, level, i, proof, f) AS (
    SELECT u.source, leaf_i, 0, s.i, proof, f
    FROM under u JOIN subroot s ON s.source IS NOT DISTINCT FROM u.source
    UNION ALL
    SELECT p.source, leaf_i, p.level + 1, p.i // 3, proof || b || a, sha256(b || f || a)
    FROM top_climb p JOIN upper_runs r ON r.level = p.level AND r.i = p.i
), over AS (
    SELECT source, leaf_i, arg_max(proof, level) AS proof, arg_max(f, level) AS f
    FROM top_climb GROUP BY source, leaf_i
)
SELECT p.doc_id, p.h AS leaf, s.h AS subroot, t.h AS root, sha256(o.proof) AS proof_sha256,
    o.f AS folded_root, o.f = t.h AS verified
FROM placed p JOIN subroot s ON s.source IS NOT DISTINCT FROM p.source
JOIN over o ON o.source IS NOT DISTINCT FROM p.source AND o.leaf_i = p.i
CROSS JOIN (SELECT h FROM high WHERE n = 1) t
"""


@query(MANIFEST_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's leaf with its proof, tried on a text that may have lost its line ends."""
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    told = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c)
            for c in merkle.COLUMNS]
    found = merkle.proofs(
        merkle.manifest(docs, carry={"candidate": F.when(changed, merkle.leaf_digest(told))})
    )
    candidate = F.coalesce("row.candidate", "leaf")
    found = found.withColumn("folded", merkle.folded(candidate, F.col("proof")))
    return found.select(
        F.col("row.id").alias("doc_id"),
        *[merkle.spelled(F.col(name)).alias(name) for name in ("leaf", "subroot", "root")],
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        merkle.spelled(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


RANKED_DOCUMENTS_SQL = rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
        {LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
    SELECT item_id, row_number() OVER () AS k, unnest(list_distinct(regexp_extract_all(
        {LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t FROM benchmark
), totals AS (
    SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0
), counts AS (
    SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t
), weights AS (
    SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
    FROM counts, totals GROUP BY t, n_docs
), scores AS (
    SELECT k, item_id, c.r, sum(weight * ((1000000000 * tf)
        // (1000 * tf + 8 * (10 + (90 * len(w) * n_docs) // n_terms))))::BIGINT AS score
    FROM i JOIN counts c ON c.t = i.t JOIN weights v ON v.t = i.t JOIN d ON d.r = c.r, totals
    GROUP BY k, item_id, c.r
), ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (
        PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM scores JOIN d ON d.r = scores.r WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query(RANKED_DOCUMENTS_SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return ranked_documents(docs, items)


LINES_SQL = rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS l
    FROM documents
), lines AS (
    SELECT r, doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM d
), keys AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
    SELECT key, max(doc_id) AS last FROM keys WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
    count(*) FILTER (WHERE last <> doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
        FILTER (WHERE last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM keys LEFT JOIN common ON common.key = keys.key GROUP BY r
"""


@query(LINES_SQL)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, and what is left without those that repeat across documents."""
    found = kept_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "document.doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        n_dropped().alias("n_dropped"),
        F.sha2(kept_text(), 256).alias("kept_sha256"),
    )
