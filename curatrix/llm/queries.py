"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .piece_tokens import piece_digests

    return piece_digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit_quality, judge

    docs = documents(spark, sf_dir)
    trees = fit_quality(docs, documents(spark, sf_dir, "labels"))
    return judge(docs, trees).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("score", 6).alias("score"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    done = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", "n_near", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import shared_dir
    from .token_store import read_tokens, write_tokens

    files = write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), shared_dir(spark, "ids"))
    return read_tokens(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import fingerprint_documents

    found = fingerprint_documents(documents(spark, sf_dir))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .archives import read_packages, write_packages
    from .common import shared_dir

    packages = write_packages(documents(spark, sf_dir, "pages"), shared_dir(spark, "packages"))
    return read_packages(spark, [uri for uri, _ in packages]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import materialise, word_count
    from .mixing import mix

    sizes = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count("text").alias("size"))
    return mix(materialise(sizes, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .span_dedup import remove_repeats

    done = remove_repeats(documents(spark, sf_dir))
    removed = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_text

    done = extract_text(documents(spark, sf_dir, "pages"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(documents(spark, sf_dir))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import source_divergence

    return source_divergence(documents(spark, sf_dir))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resample import resample

    return resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


_ALL = (op1_sentencepiece, op2_quality_rules, op3_line_dedup, op4_token_files, op5_fingerprints, op6_simhash, op7_warc, op8_mixing, op9_suffix_dedup, op10_html_text, op11_ngram_jaccard, op12_source_divergence, op13_importance_resampling)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": r"""
        WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
        raw AS (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS raw FROM split),
        all_lines AS (SELECT doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM raw),
        firsts AS (SELECT line, min((doc_id, pos)) AS ord, length(line) AS n FROM all_lines WHERE line <> '' GROUP BY line),
        long AS (SELECT * FROM firsts WHERE n >= 16),
        keys AS (
            SELECT line, ord, n, n AS m, 'p' || n || left(line, n // 2) AS key FROM long
            UNION ALL SELECT line, ord, n, n, 's' || n || right(line, n - n // 2) FROM long
            UNION ALL SELECT line, ord, n, n - 1, 'p' || (n - 1) || left(line, (n - 1) // 2) FROM long
            UNION ALL SELECT line, ord, n, n - 1, 's' || (n - 1) || right(line, n - 1 - (n - 1) // 2) FROM long),
        pairs AS (SELECT DISTINCT a.line AS a, b.line AS b, a.ord AS ord FROM keys a JOIN keys b ON a.key = b.key AND b.ord < a.ord AND abs(a.n - b.n) <= 1),
        cut AS (SELECT *, coalesce(list_position(list_transform(range(1, greatest(length(a), length(b)) + 1), lambda i: substr(a, i, 1) <> substr(b, i, 1)), true), 0) AS spot FROM pairs),
        near AS (SELECT DISTINCT ord FROM cut WHERE substr(a, spot + CAST(length(a) >= length(b) AS INT)) = substr(b, spot + CAST(length(b) >= length(a) AS INT))),
        judged AS (
            SELECT l.doc_id, l.pos, l.raw, l.line = '' OR (f.ord = (l.doc_id, l.pos) AND x.ord IS NULL) AS stays, l.line <> '' AND f.ord = (l.doc_id, l.pos) AND x.ord IS NOT NULL AS is_near
            FROM all_lines l LEFT JOIN firsts f ON l.line = f.line LEFT JOIN near x ON f.ord = x.ord),
        done AS (SELECT doc_id, count(*) AS n_lines, count_if(NOT stays) AS n_removed, count_if(is_near) AS n_near, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (stays), '') AS kept FROM judged GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN d.text IS NOT NULL THEN sha256(kept) END AS kept_sha256
        FROM documents d LEFT JOIN done USING (doc_id)
    """,
    "op7_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        q AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM q)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
        FROM r
    """,
    "op12_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        t AS (SELECT k, lang, source, unnest(terms) AS term FROM d),
        seen AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT k) AS docs FROM t GROUP BY ALL),
        kept AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM seen GROUP BY lang, term HAVING sum(docs) >= 30),
        grid AS (SELECT g.lang, g.source, v.term, coalesce(s.n, 0) AS n, v.n AS of_lang
                 FROM (SELECT DISTINCT lang, source FROM d) g JOIN kept v USING (lang) LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = v.term),
        sums AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(of_lang) OVER (PARTITION BY lang, source) AS lang_total, count(*) OVER (PARTITION BY lang, source) AS terms FROM grid),
        shares AS (SELECT lang, source, term, n, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (total + 5 * terms) AS BIGINT) AS p,
                          CAST(1 + (1000000000 * CAST(of_lang + 5 AS HUGEINT)) // (lang_total + 5 * terms) AS BIGINT) AS q FROM sums),
        pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
                  FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
        parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
}
