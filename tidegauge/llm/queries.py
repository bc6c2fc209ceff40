"""Registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import (
    conversation_trie,
    embedding_dedup,
    exact_dedup,
    filter_audit,
    language,
    line_rules,
    mixing,
    ngram_join,
    packing,
    quality,
    substring_dedup,
    token_files,
    url_filter,
)
from tidegauge.llm.frames import table

TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return register


#: Weights of the domains of `labels` in the mix, poor and toxic below the shares found. The marks are noisy: every text has some
#: part in `toxic`, which held-out good documents of sf0.1 have to 0.104 (and 0.001 in `poor`); much below, clean documents go as well.
TARGETS = {"good": 0.8975, "poor": 0.0025, "toxic": 0.1}
#: Tokens of the mix in shares of those now: enough for most documents without fault to stay in it.
BUDGET = 1.25


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


@query("op1_embedding_dedup")
def _embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op2_substring_dedup")
def _substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"), runs=True)


@query("op3_quality_classifier")
def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = quality.good_labels(table(spark, sf_dir, "labels"))
    return quality.score_quality(table(spark, sf_dir, "documents"), labels)


@query("op4_language_id")
def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(table(spark, sf_dir, "documents"))


@query("op5_best_fit_packing")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op6_token_files")
def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_files.token_digest(spark, table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op7_source_mixing")
def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.document_rates(table(spark, sf_dir, "documents"), domains, TARGETS, budget=BUDGET)


@query(
    "op8_exact_dedup",
    """
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def _exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op9_ngram_join")
def _ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


# The tables' markup holds no canonical or refresh links (tests/llm checks), so there are no aliases
# here; propagation is tested against brute force.
@query(
    "op10_url_filter",
    """
    WITH p AS (
      SELECT page_id,
             CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    h AS (
      SELECT page_id,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM p),
    r(rule, rule_host, rule_path, v) AS (VALUES
      ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
      ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
      ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
    f AS (
      SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
      FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY page_id)
    SELECT h.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN f USING (page_id)
    """,
)
def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.parse_rules(spark, RULES))


@query(
    "op11_quality_rules",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host, md5(coalesce(text, '')) AS text_hash FROM documents),
    w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
    word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
    win AS (
      SELECT doc_id, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    twice AS (SELECT doc_id, i FROM win WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
    repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) s(k) GROUP BY doc_id),
    line AS (
      SELECT doc_id, host, text_hash, l,
             trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ') AS norm,
             len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT doc_id, host, text_hash, unnest(string_split(text, chr(10))) AS l FROM d)),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM line WHERE n > 0 GROUP BY doc_id),
    hosts AS (SELECT host, count(DISTINCT text_hash) AS documents FROM d GROUP BY host),
    frequent AS (
      SELECT host, norm FROM line JOIN hosts USING (host) WHERE n > 0 GROUP BY host, norm, documents
      HAVING count(DISTINCT text_hash) > 20 AND count(DISTINCT text_hash) > 0.05 * documents),
    lost AS (SELECT doc_id, sum(n) AS n FROM line JOIN frequent USING (host, norm) WHERE n > 0 GROUP BY doc_id),
    m AS (
      SELECT d.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
             coalesce(repeated.n, 0) AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_removed_words
      FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND n_words - n_removed_words >= 50 AND n_words - n_removed_words >= 0.5 * n_words AS kept FROM b
    """,
)
def _quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge_lines(table(spark, sf_dir, "documents"))


@query(
    "op12_filter_audit",
    r"""
    WITH RECURSIVE t AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    docs AS (
      SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
             + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * (t.doc_id > min(t.doc_id) OVER (PARTITION BY text))::INT AS mask
      FROM t LEFT JOIN marks USING (doc_id)),
    cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY ALL),
    f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    walk(prefix, letter, bit, applied, step) AS (
      SELECT '', '', 0, 0, 0
      UNION ALL
      SELECT prefix || f.letter, f.letter, f.bit, applied | walk.bit, step + 1 FROM walk JOIN f ON ((applied | walk.bit) & f.bit) = 0),
    sums AS (
      SELECT part, prefix, letter, step,
             coalesce(sum(n) FILTER ((mask & (applied | bit)) = 0), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER ((mask & bit) != 0 AND (mask & applied) = 0), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER ((mask & bit) != 0 AND (mask & applied) != 0), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER ((mask & bit) != 0 AND (mask & applied) = 0), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER ((mask & bit) != 0 AND (mask & applied) = 0), 0)::BIGINT AS toxic_lost
      FROM cells, walk WHERE step > 0 GROUP BY part, prefix, letter, step)
    SELECT part, o.prefix AS filter_order, s.step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, s.letter))::BIGINT AS shapley
    FROM sums s JOIN (SELECT prefix FROM walk WHERE step = 5) o ON starts_with(o.prefix, s.prefix)
    """,
)
def _filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op13_conversation_trie",
    r"""
    WITH turns AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
      SELECT conv_id, conv_id - conv_id % 20 AS base,
             xor(list_reduce(
               list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END), 4294967295) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM turns)),
    parts AS (
      SELECT c.conv_id, 0 AS own, t.p, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.p <= c.h
      UNION ALL
      SELECT c.conv_id, 1, t.p, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h),
    r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS d, role, text FROM parts),
    size AS (SELECT conv_id, count(r.conv_id) AS n FROM convs LEFT JOIN r USING (conv_id) GROUP BY conv_id),
    k AS (
      SELECT conv_id, d, text, array_to_string(list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d), ',') AS key FROM r
      UNION ALL
      SELECT conv_id, 0, '', '' FROM convs),
    nodes AS (
      SELECT key, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends_sha256
      FROM k JOIN size USING (conv_id) GROUP BY key),
    up AS (SELECT a.key AS up, b.key, b.depth, b.saved, a.depth AS up_depth FROM nodes b JOIN k ON k.conv_id = b.conv_id AND k.d <= b.depth JOIN nodes a ON a.key = k.key),
    kids AS (SELECT up AS key, count(*) AS n FROM up WHERE up_depth = depth - 1 GROUP BY up),
    totals AS (
      SELECT up.up AS key, sum(saved) AS saved_tokens, count(*) FILTER (kids.n IS NULL) AS n_leaves
      FROM up LEFT JOIN kids ON kids.key = up.key GROUP BY up.up)
    SELECT nodes.conv_id, nodes.depth, p.conv_id AS parent_conv_id, nodes.n_convs, coalesce(kids.n, 0) AS n_children,
           n_leaves, saved_tokens::BIGINT AS saved_tokens, nodes.ends_sha256
    FROM nodes JOIN totals USING (key) LEFT JOIN kids USING (key)
    LEFT JOIN up e ON e.key = nodes.key AND e.up_depth = nodes.depth - 1 LEFT JOIN nodes p ON p.key = e.up
    """,
)
def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.rebranched(turns))
