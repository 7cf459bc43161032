"""Registered queries of the operators here and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voltlake.llm.alignment import align_documents
from voltlake.llm.common import read_table
from voltlake.llm.decontaminate import contamination
from voltlake.llm.exact_dedup import exact_duplicates
from voltlake.llm.language import identify_languages
from voltlake.llm.lexical_search import search
from voltlake.llm.mixing import mix
from voltlake.llm.pii import find_personal_data, fit_tagger
from voltlake.llm.quality import classify_quality
from voltlake.llm.simhash import simhash_groups
from voltlake.llm.substring_dedup import remove_repeats
from voltlake.llm.token_count import count_tokens
from voltlake.llm.toxicity import classify_toxicity
from voltlake.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of the url query: verdict, host, path (fixed values).
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), near=10)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.7)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return find_personal_data(docs, fit_tagger(docs))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return count_tokens(read_table(spark, sf_dir, "documents"), vocabulary, limit=2048)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.5)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_language_id,
        op3_url_filter,
        op4_simhash,
        op5_exact_dedup,
        op6_decontaminate,
        op7_quality,
        op8_substring_dedup,
        op9_personal_data,
        op10_token_counts,
        op11_lexical_search,
        op12_alignment,
        op13_toxicity,
    )
}

_URL = r"regexp_extract(url, '://([^/?#]*)([^?#]*)', {})"

ORACLE: dict[str, str] = {
    "op3_url_filter": f"""
        WITH parts AS (
          SELECT page_id,
                 translate(coalesce({_URL.format(1)}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 coalesce({_URL.format(2)}, '') AS path
          FROM pages),
        rules(verdict, rhost, rpath) AS (VALUES
          ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
          ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        fits AS (
          SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
                 arg_max(verdict, length(rhost || rpath)) AS verdict
          FROM parts JOIN rules
            ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
          GROUP BY page_id)
        SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM parts p LEFT JOIN fits f USING (page_id)""",
    "op5_exact_dedup": r"""
        WITH texts AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
          FROM documents),
        ranked AS (
          SELECT doc_id, t, row_number() OVER (PARTITION BY t ORDER BY doc_id) AS r,
                 min(doc_id) OVER (PARTITION BY t) AS keep_id,
                 count(*) OVER (PARTITION BY t) AS group_size
          FROM texts)
        SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(t) AS text_sha256
        FROM ranked""",
    "op6_decontaminate": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM documents),
        b AS (
          SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM benchmark),
        windows AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS s
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d),
        cut AS (
          SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS s
          FROM places, (SELECT DISTINCT n FROM windows) WHERE p + n - 1 <= len(w)),
        matches AS (SELECT r, p, n, item_id FROM cut JOIN windows USING (n, s)),
        covered AS (
          SELECT r, count(DISTINCT q) AS n_hit
          FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM matches)) GROUP BY r),
        named AS (
          SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM matches) GROUP BY r),
        tokens AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        terms AS (
          SELECT s, word, min(o) AS o
          FROM (SELECT s, unnest(string_split(s, ' ')) AS word, unnest(range(1, n + 1)) AS o FROM (SELECT DISTINCT s, n FROM windows))
          GROUP BY s, word),
        corpus AS (SELECT word, count(*) AS n FROM tokens GROUP BY word),
        ranked AS (
          SELECT s, word, row_number() OVER (PARTITION BY s ORDER BY n, o) AS k, count(*) OVER (PARTITION BY s) AS present
          FROM terms JOIN corpus USING (word)),
        rarest AS (
          SELECT s, word, k FROM ranked JOIN (SELECT s, count(*) AS total FROM terms GROUP BY s) USING (s)
          WHERE k <= 3 AND present >= least(total, 3)),
        postings AS (SELECT r, word, p FROM tokens WHERE word IN (SELECT word FROM rarest)),
        near AS (
          SELECT DISTINCT a.r, x.s
          FROM rarest x JOIN postings a ON x.k = 1 AND a.word = x.word
          LEFT JOIN rarest y ON y.s = x.s AND y.k = 2
          LEFT JOIN postings b ON b.r = a.r AND b.word = y.word AND abs(a.p - b.p) <= 10
          LEFT JOIN rarest z ON z.s = x.s AND z.k = 3
          LEFT JOIN postings c ON c.r = a.r AND c.word = z.word AND abs(a.p - c.p) <= 10
          WHERE (y.s IS NULL OR b.r IS NOT NULL) AND (z.s IS NULL OR c.r IS NOT NULL)),
        counted AS (SELECT r, count(DISTINCT item_id) AS n_near FROM near JOIN windows USING (s) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
        FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r) LEFT JOIN counted USING (r)""",
    "op8_substring_dedup": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        windows AS (
          SELECT r, p, md5(array_to_string(w[p : p + 34], ' ')) AS s
          FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
        repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
        removed AS (
          SELECT DISTINCT r, unnest(range(p, p + 35)) AS q
          FROM windows WHERE s IN (SELECT s FROM repeated)),
        words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
        kept AS (
          SELECT r, string_agg(word, ' ' ORDER BY q) AS t, count(*) AS n
          FROM words ANTI JOIN removed USING (r, q) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)""",
    "op11_lexical_search": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
          FROM documents),
        b AS (
          SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w
          FROM benchmark),
        asked AS (SELECT q, unnest(w) AS t FROM b),
        totals AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_all FROM d WHERE len(w) > 0),
        tfs AS (
          SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d)
          WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
        weights AS (
          SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
          FROM tfs, totals GROUP BY t, n_docs),
        impacts AS (
          SELECT r, t, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * n_docs) // n_all))) AS impact
          FROM tfs JOIN weights USING (t) JOIN d USING (r), totals),
        scores AS (SELECT q, r, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (t) GROUP BY q, r),
        ranked AS (
          SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
          FROM scores JOIN d USING (r) WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN b USING (q) WHERE rank <= 10""",
}
