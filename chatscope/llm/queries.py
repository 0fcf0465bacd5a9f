"""The operators bound to the tables of a folder, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatscope.llm import (
    bpe, collocations, fim, host_rules, lang_id, masked_lm, packing, quality_crf, simhash, syncmers, token_files,
    url_filter, warc)
from chatscope.llm.common import crc32_mod, table
from chatscope.session import scratch_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.encoder)


def op2_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edit_with_next(table(spark, sf_dir, "documents"))


def op3_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


# The rules of the URL query (host, path, action).
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))
# Host labels whose pages make up the URL query's list.
LISTED_HOSTS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op5_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URLs of all pages whose host has one of ``LISTED_HOSTS`` among its labels."""
    pages = table(spark, sf_dir, "pages")
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS r(host, path, action)")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(rf"(^|\.)({'|'.join(LISTED_HOSTS)})\.")).select("url")
    return url_filter.judge_urls(pages, listed, rules)


def op6_line_field_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = quality_crf.train(docs, table(spark, sf_dir, "labels").where(crc32_mod("doc_id", 5) != 0))
    scored = quality_crf.classify(docs, field)
    return scored.select("doc_id", (crc32_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, f"warc/{uuid.uuid4().hex}"))


def op8_bpe_distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), is_scan=True,
                                 columns=("n_tokens", "ids_sha256", "decoded_sha256"))


def op9_masked_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vocab = masked_lm.vocabulary(docs)
    return masked_lm.score_words(docs, vocab, masked_lm.train(docs, vocab))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lang_id.train(docs.where(crc32_mod("doc_id", 4) != 2))
    return lang_id.classify(docs, model).select(
        "doc_id", (crc32_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.round_trip(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), scratch_path(spark, f"tokens/{uuid.uuid4().hex}"),
                                  bpe.encoder)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing, op2_closed_syncmers, op3_host_quality_rules, op4_simhash_near_dedup,
        op5_bloom_url_filter, op6_line_field_quality, op7_warc_round_trip, op8_bpe_distinct_words,
        op9_masked_lm_scoring, op10_language_id, op11_fill_in_middle,
        op12_token_files, op13_collocations)}

_HOST = "CASE WHEN url LIKE '%://%' THEN lower(regexp_extract(url, '://([^/?#]*)', 1)) ELSE '' END"
_WORDS = r"[^\x20\x09-\x0D]+"

SQL: dict[str, str] = {
    "op13_collocations": r"""
        WITH p AS (
          SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+') AS w, row_number() OVER () AS text_no FROM documents),
        t AS (SELECT lang, text_no, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p),
        s AS (
          SELECT lang, w1, lead(w1) OVER x AS w2, lead(w1, 2) OVER x AS w3
          FROM t WINDOW x AS (PARTITION BY text_no ORDER BY i)),
        e AS (
          SELECT lang, w1, CASE WHEN NOT regexp_matches(w2, '^[.,;:!?\x0A-\x0D]$') THEN w2 END AS w2,
                 CASE WHEN NOT regexp_matches(w2, '^[.,;:!?\x0A-\x0D]$')
                       AND NOT regexp_matches(w3, '^[.,;:!?\x0A-\x0D]$') THEN w3 END AS w3
          FROM s WHERE NOT regexp_matches(w1, '^[.,;:!?\x0A-\x0D]$')),
        g AS (
          SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM e GROUP BY ALL UNION ALL
          SELECT lang, 2, w1 || ' ' || w2, count(*) FROM e WHERE w2 IS NOT NULL GROUP BY ALL UNION ALL
          SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM e WHERE w3 IS NOT NULL GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 10),
        cut AS (
          SELECT c.lang, c.phrase, c.k, a, l.f AS l, r.f AS r, x.j,
                 (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
          FROM c JOIN (SELECT unnest([1, 2]) AS j) x ON x.j < c.k
          JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:x.j], ' ')
          JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(w[x.j + 1:], ' ')),
        best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        inside AS (
          SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3
          UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3),
        most AS (SELECT lang, phrase, max(a) AS longest FROM inside GROUP BY ALL),
        kept AS (
          SELECT best.* FROM best LEFT JOIN most ON most.lang = best.lang AND most.phrase = best.phrase
          WHERE longest IS NULL OR 100 * longest < 50 * a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT ranked.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
               n.n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
    """,
    "op11_fill_in_middle": """
        WITH u AS (
          SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
                 regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
        d AS (
          SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
                 CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                      WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
        c AS (
          SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
                 array_to_string(u[greatest(a, b) + 1:], '') AS s FROM d)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
        FROM c
    """,
    "op3_host_quality_rules": rf"""
        WITH t AS (
          SELECT doc_id, source, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w,
                 list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS l
          FROM documents),
        win AS (
          SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) > 2)),
        again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        rep AS (
          SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
        s AS (
          SELECT t.doc_id, source, len(w)::BIGINT AS n_words,
                 length(array_to_string(w, ''))::BIGINT AS word_chars,
                 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
                 coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
          FROM t LEFT JOIN rep ON rep.doc_id = t.doc_id),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
        h AS (
          SELECT source, count(*) AS n, count(*) FILTER (
            WHERE base_failed OR n_symbols * 100 > n_words * 10 OR n_dup_lines * 100 > n_lines * 30) AS f
          FROM b WHERE source IS NOT NULL GROUP BY source),
        m AS (
          SELECT sum(f) / sum(n) AS raw, greatest(least(sum(f) / sum(n), 1 - 1e-6), 1e-6) AS m, count(*) AS k,
                 sum(n) AS n, sum(f::DOUBLE * f / n) / sum(n) AS sq FROM h),
        p AS (
          SELECT m, greatest(least(CASE WHEN sq - raw * raw - m * (1 - m) * k / n > 0
            THEN m * (1 - m) / (sq - raw * raw - m * (1 - m) * k / n) - 1 ELSE 10000 END, 10000), 2) AS weight FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND coalesce((h.f + p.m * p.weight) / (h.n + p.weight) <= 0.5, true) AS kept
        FROM b LEFT JOIN h ON h.source = b.source, p
    """,
    "op7_warc_round_trip": """
        WITH p AS (
          SELECT page_id, sha1(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS bytes FROM pages),
        w AS (SELECT digest, max(page_id) AS winner FROM p WHERE bytes >= 1000 GROUP BY digest)
        SELECT page_id, bytes::BIGINT AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN winner IS NOT NULL AND page_id IS DISTINCT FROM winner THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM winner THEN winner END AS refers_to
        FROM p LEFT JOIN w ON w.digest = p.digest AND bytes >= 1000
    """,
    "op5_bloom_url_filter": rf"""
        WITH p AS (
          SELECT page_id, url, {_HOST} AS host,
                 CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
                 regexp_extract(url, '://[^?#]*[?]([^#]*)', 1) AS q FROM pages),
        c AS (
          SELECT *, regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '') || coalesce('?' || nullif(
                   array_to_string(list_sort(list_filter(string_split(q, '&'),
                     lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&'), ''), '') AS canon
          FROM p),
        listed AS (
          SELECT DISTINCT canon FROM c
          WHERE regexp_matches(host, '(^|[.])({"|".join(LISTED_HOSTS)})[.]')),
        rules(h, pre, action) AS (VALUES {", ".join(map(str, URL_RULES))}),
        hit AS (
          SELECT url, arg_max(h || pre, length(h || pre)) AS rule, arg_max(action, length(h || pre)) AS action
          FROM (SELECT DISTINCT url, host, path FROM c), rules
          WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, pre) GROUP BY url)
        SELECT page_id, host, path, rule,
               CASE WHEN action IS NOT NULL THEN action WHEN listed.canon IS NOT NULL AND host <> '' THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM c LEFT JOIN hit ON hit.url = c.url LEFT JOIN listed ON listed.canon = c.canon
    """,
}
