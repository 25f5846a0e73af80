"""Every corpus operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm import decontaminate, divergence, jaccard, language, lexical, line_dedup, packing, pii, pivot_search, quality, suffix_tree, token_codes, warc
from tallycast.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_codes")
def _(spark, sf_dir):
    """Encode all documents, write them as codes and read them back."""
    path = scratch_path(spark, "codes")
    token_codes.write_codes(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return token_codes.read_documents(spark, path).drop("ids")


@query("op4_best_fit_packing")
def _(spark, sf_dir):
    """Pack all documents into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 0)


@query("op5_language_ppm")
def _(spark, sf_dir):
    """Predict the language of all documents from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.remainder(F.col("doc_id"), 5) == 0)
    model = language.fit(docs.filter("not held_out"))
    return language.predict(docs.select("doc_id", "text", "held_out"), model).drop("text")


@query("op10_quality_gam")
def _(spark, sf_dir):
    """Score all documents, learning from three quarters of the labels."""
    held_out = language.remainder(F.col("doc_id"), 4) == 2
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    model = quality.fit(docs.filter("not held_out"), table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text", "held_out"), model).drop("text")


@query(
    "op6_ngram_jaccard",
    r"""WITH RECURSIVE tokens AS (
         SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x20\x09-\x0D]+') AS w FROM documents
       ), sets AS (
         SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM tokens
       ), entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
       links AS (
         SELECT a.doc_id AS a, b.doc_id AS b FROM entries a JOIN entries b ON b.x = a.x AND b.doc_id <> a.doc_id
         GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
       ), reached AS (
         SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
       ), least AS (SELECT a, min(b) AS b FROM reached GROUP BY 1)
       SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
       FROM sets LEFT JOIN least ON a = doc_id""",
)
def _(spark, sf_dir):
    """Group all documents whose sets of three-word shingles are at least 0.9 alike."""
    return jaccard.groups(table(spark, sf_dir, "documents"), jaccard.Spec(words=3, part=90, whole=100))


@query("op9_benchmark_simhash")
def _(spark, sf_dir):
    """Find all benchmark items in all documents."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_line_runs")
def _(spark, sf_dir):
    """Find the later copies of all repeated runs of lines of at least 50 words."""
    return line_dedup.deleted_runs(table(spark, sf_dir, "documents"))


@query("op3_suffix_tree")
def _(spark, sf_dir):
    """Score all documents under a tree learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").withColumn("learn", language.remainder(F.col("doc_id"), 7) != 2)
    return suffix_tree.score(docs.select("doc_id", "text", "learn"), depth=3)


@query("op11_pii_anchors")
def _(spark, sf_dir):
    """Find personal data in all documents."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id")


@query(
    "op2_pivot_search",
    """WITH usable AS (
         SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
         WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
       ), scored AS (
         SELECT q.vec_id AS query_id, c.vec_id,
                CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
         FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
       )
       SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
       FROM scored QUALIFY rank <= 20""",
)
def _(spark, sf_dir):
    """The 20 best other vectors for every twentieth one."""
    return pivot_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query(
    "op7_merkle_fixity",
    """WITH made AS (
         SELECT page_id, coalesce(regexp_replace(url, '[\r\n]', '', 'g'), '') AS address, coalesce(html, '') AS body FROM pages
       ), named AS (
         SELECT *, md5(concat_ws(' ', CAST(page_id AS VARCHAR), address)) AS m, chr(13) || chr(10) AS nl FROM made
       ), records AS (
         SELECT page_id, 'WARC/1.1' || nl || 'WARC-Type: response' || nl || 'WARC-Target-URI: ' || address || nl
                || 'WARC-Date: 2000-01-01T00:00:00Z' || nl || 'WARC-Record-ID: <urn:uuid:' || substr(m, 1, 8) || '-' || substr(m, 9, 4)
                || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21, 12) || '>' || nl
                || 'Content-Type: text/html' || nl || 'Content-Length: ' || strlen(body) || nl || nl || body || nl || nl AS record
         FROM named
       ), sized AS (SELECT page_id, record, strlen(record) AS length FROM records)
       SELECT page_id, row_number() OVER (ORDER BY page_id NULLS FIRST) - 1 AS ordinal,
              CAST(sum(length) OVER (ORDER BY page_id NULLS FIRST) - length AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
              sha256(record) AS digest,
              CASE page_id % 64 WHEN 7 THEN 'corrupt' WHEN 9 THEN 'missing' ELSE 'ok' END AS status
       FROM sized""",
)
def _(spark, sf_dir):
    """Audit all pages as WARC records against a replica in which every 64th is damaged and every 64th is gone."""
    records = warc.write_records(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    damaged = F.concat(F.lit(b"X"), F.substring(F.col("record"), 2, 1 << 30))
    replica = records.filter(~(F.col("page_id") % 64).eqNullSafe(9))
    replica = replica.withColumn("record", F.when(F.col("page_id") % 64 == 7, damaged).otherwise(F.col("record")))
    return warc.fixity(warc.manifest(records), records, replica)


@query(
    "op13_source_divergence",
    r"""WITH docs AS (
         SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
       ), occurrences AS (
         SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
       ), kept AS (
         SELECT lang, term, count(*) AS c FROM occurrences GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3
       ), langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY 1),
       counts AS (SELECT lang, source, term, count(*) AS c FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
       sources AS (SELECT DISTINCT lang, source FROM docs),
       sizes AS (SELECT s.lang, s.source, sum(coalesce(c, 0)) AS n FROM sources s LEFT JOIN counts USING (lang, source) GROUP BY 1, 2),
       shares AS (
         SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c,
                1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (s.n + l.v) AS p,
                1 + (CAST(1000000000 AS HUGEINT) * (k.c + 1)) // (l.n + l.v) AS q
         FROM sizes s JOIN langs l ON l.lang = s.lang JOIN kept k ON k.lang = s.lang
         LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
       ), gaps AS (
         SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY 1, 2, 3
       ), listed AS (
         SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(g.value, 0) AS value
         FROM sources a JOIN sources b ON b.lang = a.lang AND b.source <> a.source
         LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
         UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE c > 0 AND p > q
       ), ranked AS (
         SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed
       )
       SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
       FROM ranked WHERE part = 'pair' OR rank <= 200""",
)
def _(spark, sf_dir):
    """How far the sources of each language are apart, and by which terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@query(
    "op12_dual_tree_search",
    r"""WITH docs AS (
         SELECT row_number() OVER () AS r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
       ), sized AS (SELECT r, doc_id, terms, len(terms) AS n FROM docs WHERE len(terms) > 0),
       totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM sized),
       items AS (
         SELECT row_number() OVER () AS slot, item_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark
       ), wanted AS (
         SELECT slot, item_id, term, count(*) AS times FROM (SELECT slot, item_id, unnest(terms) AS term FROM items) GROUP BY 1, 2, 3
       ), held AS (
         SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM sized)
         SEMI JOIN wanted USING (term) GROUP BY 1, 2, 3, 4
       ), weights AS (
         SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
         FROM (SELECT term, count(*) AS df FROM held GROUP BY 1) CROSS JOIN totals
       ), scores AS (
         SELECT slot, item_id, r, doc_id,
                CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l)))) AS BIGINT) AS score
         FROM held JOIN weights USING (term) JOIN wanted USING (term) CROSS JOIN totals GROUP BY 1, 2, 3, 4
       )
       SELECT item_id, CAST(row_number() OVER (PARTITION BY slot ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
       FROM scores WHERE score > 0 QUALIFY rank <= 20""",
)
def _(spark, sf_dir):
    """The 20 best documents for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
