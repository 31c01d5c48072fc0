"""One query per operator, over the whole tables with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sharemill.llm.bm25_decontamination import contaminated
from sharemill.llm.compression_toxicity import toxicity
from sharemill.llm.crf_language import languages
from sharemill.llm.filter_audit import filter_audit
from sharemill.llm.hidden_markov import language_scores
from sharemill.llm.histogram_topk import top_k
from sharemill.llm.html_extraction import main_texts
from sharemill.llm.label_sharding import shard_documents
from sharemill.llm.minmax_dedup import Settings, near_duplicates
from sharemill.llm.pii_surrogates import replace_entities
from sharemill.llm.poisson_mix import poisson_mix
from sharemill.llm.source_divergence import divergence
from sharemill.llm.tables import table
from sharemill.llm.token_counts import token_counts

TOKEN_LIMIT = 2048


def op1_pii_surrogates(spark: SparkSession, sf_dir: str, key: str = "surrogates") -> DataFrame:
    """All documents with surrogates in their texts. A key given here is no secret: use your own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, key).select("doc_id", "text", "n_entities")


def op2_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated to weights of the square root of each source's size, in shuffled order."""
    return poisson_mix(table(spark, sf_dir, "documents"))


def op3_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_label_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op5_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op6_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Settings(words=3, percent=85, rows=6))


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


def op8_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    counts = token_counts(table(spark, sf_dir, "documents"), tokenizer)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_poisson_mix": op2_poisson_mix,
    "op3_compression_toxicity": op3_compression_toxicity,
    "op4_label_sharding": op4_label_sharding,
    "op5_histogram_topk": op5_histogram_topk,
    "op6_minmax_dedup": op6_minmax_dedup,
    "op7_hidden_markov": op7_hidden_markov,
    "op8_bm25_decontamination": op8_bm25_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_crf_language": op10_crf_language,
    "op11_source_divergence": op11_source_divergence,
    "op12_filter_audit": op12_filter_audit,
    "op13_html_extraction": op13_html_extraction,
}

#: 52 bits of the MD5 as a value in [0, 1), as in ``poisson_mix.uniform``.
_UNIFORM = "(('0x' || substr(md5({text}), 1, 13))::bigint)::double / 4503599627370496.0"

ORACLE: dict[str, str] = {
    "op6_minmax_dedup": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
        ), sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM split
        ), shingles AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reach(node, root) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.root FROM reach r JOIN links l ON l.b = r.node WHERE r.root < l.a
        ), roots AS (
            SELECT node, min(root) AS component_id FROM reach GROUP BY node
        )
        SELECT doc_id, len(s)::bigint AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN roots ON doc_id = node
    """,
    "op2_poisson_mix": f"""
        WITH RECURSIVE sizes AS (
            SELECT source, count(*) AS n_docs, pow(count(*)::double, 0.5) AS weight FROM documents GROUP BY source
        ), rates AS (
            SELECT source, (weight / (SELECT sum(weight) FROM sizes)) * (SELECT sum(n_docs) FROM sizes)::double / n_docs AS rate FROM sizes
        ), parts AS (
            SELECT source, rate, greatest(ceil(rate / 64.0), 1)::int AS parts FROM rates
        ), terms(source, k, last, mean, p, cumulative) AS (
            SELECT source, 0, ceil(rate / parts + 12 * sqrt(rate / parts) + 20)::int, rate / parts, exp(-rate / parts), exp(-rate / parts) FROM parts
            UNION ALL
            SELECT source, k + 1, last, mean, p * mean / (k + 1), cumulative + p * mean / (k + 1) FROM terms WHERE k < last
        ), distributions AS (
            SELECT source, list(cumulative ORDER BY k) AS cumulative FROM terms GROUP BY source
        ), counted AS (
            SELECT d.*, rate, list_sum(list_transform(range(1, parts + 1), lambda part:
                len(list_filter(cumulative, lambda c: c <= {_UNIFORM.format(text="'mix0:' || part || ':' || coalesce(doc_id::varchar, 'null')")}))
            ))::bigint AS copies
            FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
            JOIN distributions s ON d.source IS NOT DISTINCT FROM s.source
        )
        SELECT * EXCLUDE (copies), {_UNIFORM.format(text="'order0:' || copy || ':' || coalesce(doc_id::varchar, 'null')")} AS shuffle_key
        FROM (SELECT *, unnest(range(1, copies + 1))::int AS copy FROM counted)
    """,
    "op5_histogram_topk": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, e.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, e.v), lambda z: z[1] * z[2]))::bigint AS score
            FROM vectors q JOIN vectors e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v) WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_source_divergence": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
        ), words AS (
            SELECT row_no, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
        ), kept AS (
            SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT row_no) >= 30
        ), counts AS (
            SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
        ), langs AS (
            SELECT lang, sum(lang_n) + 5 * count(*) AS lang_size, 5 * count(*) AS added FROM kept GROUP BY lang
        ), groups AS (
            SELECT g.lang, g.source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM texts) g
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source
        ), shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.n + l.added)::hugeint AS p,
                1 + (1000000000::hugeint * (k.lang_n + 5)) // l.lang_size::hugeint AS q
            FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), distances AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
        ), terms AS (
            SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT lang, source, part, item, value::bigint AS value, rank::int AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
    "op12_filter_audit": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
        ), marks AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ), flags AS (
            SELECT part, (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
                + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::int
                + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::int AS fails,
                coalesce(good, false)::int AS good, coalesce(toxic, false)::int AS toxic
            FROM texts LEFT JOIN marks USING (doc_id)
        ), sizes AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY part, fails
        ), letters(l) AS (
            VALUES ('A'), ('B'), ('C'), ('D'), ('E')
        ), orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a JOIN letters b ON a.l <> b.l
            JOIN letters c ON c.l NOT IN (a.l, b.l) JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
        ), steps AS (
            SELECT filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS own,
                list_sum([1 << (ascii(substr(filter_order, s, 1)) - 65) for s in range(1, step)] || [0])::int AS earlier
            FROM orders, (SELECT unnest(range(1, 6))::int AS step)
        ), found AS (
            SELECT part, filter_order, step, own, sum(n) FILTER (fails & (earlier | own) = 0) AS kept,
                sum(n) FILTER (fails & own <> 0 AND fails & earlier = 0) AS removed, sum(n) FILTER (fails & own <> 0 AND fails & earlier <> 0) AS redundant,
                sum(n) FILTER (fails = own) AS unique_fails, sum(good) FILTER (fails & own <> 0 AND fails & earlier = 0) AS good_lost,
                sum(toxic) FILTER (fails & own <> 0 AND fails & earlier = 0) AS toxic_lost
            FROM sizes, steps GROUP BY part, filter_order, step, own
        )
        SELECT part, filter_order, step, coalesce(kept, 0)::bigint AS kept, coalesce(removed, 0)::bigint AS removed,
            coalesce(redundant, 0)::bigint AS redundant, coalesce(unique_fails, 0)::bigint AS unique_fails, coalesce(good_lost, 0)::bigint AS good_lost,
            coalesce(toxic_lost, 0)::bigint AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::bigint AS shapley FROM found
    """,
}
