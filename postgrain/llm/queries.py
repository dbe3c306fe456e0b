"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgrain.llm import chat, decontaminate, divergence, jaccard_join, language, lm, mixing, mtree, neighbours, repeats, spelling, token_files, url_rules

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int):
    """Remainder of the CRC-32 of the doc_id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


SITE_RULES = [
    url_rules.SiteRule("org", "/", "allow"),
    url_rules.SiteRule("example.org", "/es/", "block"),
    url_rules.SiteRule("example.org", "/en/1", "block"),
    url_rules.SiteRule("com", "/fr/", "allow"),
    url_rules.SiteRule("com", "/de/", "block"),
]
# Pages that carry no prose of their own, whatever their host.
PATTERNS = [
    url_rules.Pattern(p, "block")
    for p in ("/cgi-bin/", "/wp-login.", "/wp-admin/", "/cart/", "/checkout/", "^sessionid=", "^jsessionid=", "||ads.*/", "||tracker.*/")
]


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_documents(table(spark, sf_dir, "documents"), fold(7) != 2, fold(7) == 3)
    held_out = F.coalesce(fold(7) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.spans_by_document(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.component_of(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages"), [*SITE_RULES, *PATTERNS])
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start", "distance", "n_windows")


def op8_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = token_files.token_index(table(spark, sf_dir, "documents"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "position")


def op9_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learned = language.learn_dictionaries(documents, fold(4) != 2)
    found = language.identify(documents.select("doc_id", "text"), learned)
    return found.select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "language.lang_pred", "language.score", "language.rejected"
    )


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    hard = spark.createDataFrame([(-1, 0, "user", planted), (-1, 1, "assistant", planted)], rows.schema)
    return chat.read_windows(chat.format_windows(rows.unionByName(hard)))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), planted=spelling.PLANTED)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_deleted_interpolation, op2_repeated_passages, op3_pivotal_mix, op4_graph_neighbours, op5_jaccard_join, op6_url_filter, op7_benchmark_leaks, op8_wavelet_tokens, op9_compression_language, op10_chat_windows,
        op11_spelling_variants, op12_source_divergence, op13_mtree_top_k,
    )
}

_HOST = r"translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '')"
_REST = r"coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)(.*)$', 3, 's'), '')"


def _site_rule_sql() -> str:
    rules = sorted(SITE_RULES, key=lambda r: -r.weight)
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.name}:{r.verdict}'" for r in rules) + " END"


ORACLE_SQL: dict[str, str] = {
    "op6_url_filter": f"""
    WITH parts AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path, {_REST} AS rest FROM pages),
    ruled AS (SELECT *, {_site_rule_sql()} AS hit FROM parts),
    patterns AS (SELECT *, CASE
      WHEN contains(host || path || rest, '/wp-admin/') THEN '/wp-admin/' END AS p0, host || path || rest AS t FROM ruled),
    longest AS (SELECT *, CASE
      WHEN regexp_matches(t, '(?:[^A-Za-z0-9_.%-]|$)jsessionid=') THEN '^jsessionid='
      WHEN regexp_matches(t, '^(?:[^/?#]*\\.)?tracker\\..*/', 's') THEN '||tracker.*/'
      WHEN regexp_matches(t, '(?:[^A-Za-z0-9_.%-]|$)sessionid=') THEN '^sessionid='
      WHEN p0 IS NOT NULL THEN p0
      WHEN contains(t, '/wp-login.') THEN '/wp-login.'
      WHEN contains(t, '/checkout/') THEN '/checkout/'
      WHEN contains(t, '/cgi-bin/') THEN '/cgi-bin/'
      WHEN regexp_matches(t, '^(?:[^/?#]*\\.)?ads\\..*/', 's') THEN '||ads.*/'
      WHEN contains(t, '/cart/') THEN '/cart/' END AS pattern FROM patterns)
    SELECT page_id, host, path, split_part(hit, ':', 1) AS rule,
      CASE WHEN hit IS NOT NULL THEN split_part(hit, ':', 2) WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
      CASE WHEN hit IS NULL THEN pattern END AS pattern
    FROM longest""",
    "op12_source_divergence": r"""
    WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    terms AS (SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
    kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
    langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
    shares AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
      1 + 1000000000 * (coalesce(c.n, 0) + 5) // (t.total + 5 * l.v) AS p,
      1 + 1000000000 * (k.n + 5) // (l.total + 5 * l.v) AS q
      FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(x.p - y.p)) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
      LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
    every AS (SELECT lang, source, part, item, coalesce(value, 0)::BIGINT AS value FROM pairs
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM every)
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op13_mtree_top_k": """
    WITH fine AS (SELECT vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    whole AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM fine),
    scored AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM whole a JOIN whole b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
