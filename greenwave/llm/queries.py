"""The registered query of each operator, over its whole table, and SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenwave.llm import (
    extraction,
    hamming,
    host_rules,
    mixing,
    ngram_join,
    prefix_trie,
    pseudonyms,
    quality,
    redirects,
    spelling,
    token_files,
    toxicity,
    winnowing,
)
from greenwave.llm.common import table


#: Fixed rules of op1.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = redirects.judge(table(spark, sf_dir, "pages"), redirects.rule_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality")
    return quality.score(docs, model)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def tokenizer_file() -> str:
    """The public byte-level vocabulary installed beside the tokenizer library."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_and_read(table(spark, sf_dir, "documents"), tokenizer_file())


#: Only for these queries; who keeps real pseudonyms keeps a key of their own.
PSEUDONYM_KEY = "registered query"


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


#: Rows that op10 learns from; the others are held out.
HELD_OUT = "pmod(crc32(CAST(doc_id AS STRING)), 3) = 1"


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold=f"NOT ({HELD_OUT})")
    return toxicity.score(docs, model).selectExpr(
        "doc_id",
        f"coalesce({HELD_OUT}, false) AS held_out",
        "score",
        "CAST(score >= 0.7 AS INT) AS predicted",
    )


def op11_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"), host="source")
    return judged.drop("host", "n_lines", "host_failed")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_quality": op3_quality,
    "op4_html_text": op4_html_text,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_decontaminate": op7_decontaminate,
    "op8_token_files": op8_token_files,
    "op9_pii": op9_pii,
    "op10_toxicity": op10_toxicity,
    "op11_host_rules": op11_host_rules,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}

#: A-Z in lower case, as DuckDB text.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Runs of letters of op13, as DuckDB text.
RUNS = LOWER.format(r"unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+'))")
#: CRC-32 of a text of code points below 2048, as DuckDB text; needs ``crc`` (the 256 steps) in scope.
CRC_STEPS = """SELECT list_transform(range(256), lambda i: list_reduce(
           list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS steps"""
CRC = """xor(list_reduce(
           list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({text}, ''), lambda ch:
             CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
                  ELSE [192 + (unicode(ch) >> 6)::BIGINT, 128 + (unicode(ch) & 63)::BIGINT] END))),
           lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295)"""

ORACLE: dict[str, str] = {
    # The given pages hold no canonical links or refreshes; a rule, or else no block, decides.
    "op1_url_filter": f"""
WITH p AS (
  SELECT page_id, regexp_extract(u, '^([^/?#]*)', 1) AS h, regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0
                             THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS u FROM pages)),
q AS (SELECT page_id, {LOWER.format("h")} AS host, path FROM p),
r AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) v(verdict, h, s)),
best AS (
  SELECT page_id, arg_max(r.h || r.s, length(r.h || r.s)) AS rule, arg_max(verdict, length(r.h || r.s)) AS verdict
  FROM q JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.s) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM q LEFT JOIN best USING (page_id)
""",
    "op7_decontaminate": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWER.format("text")},
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
hits AS (
  SELECT doc_id, i, n, item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS words
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM d CROSS JOIN sizes WHERE len(w) >= n)) AS x
  JOIN windows USING (n, words)),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p
        FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)
""",
    "op11_host_rules": rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, source, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
         coalesce(repeated.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines
  FROM w LEFT JOIN repeated USING (doc_id) LEFT JOIN lines USING (doc_id)),
failed AS (
  SELECT *, unnest([1, 2, 3, 4, 5]) AS rule,
         unnest([n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words,
                 100 * n_dup_lines > 30 * n_lines,
                 n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words)])::INT AS fails FROM m),
hosts AS (SELECT source, rule, count(*) AS n, sum(fails) AS k FROM failed GROUP BY ALL),
sums AS (
  SELECT rule, count(*) - 1 AS others, sum(n) AS docs, sum(n * n::DOUBLE) AS squares, sum(k) / sum(n) AS p,
         sum(k * k / n) - sum(k) * (sum(k) / sum(n)) AS spread
  FROM hosts GROUP BY rule),
room AS (SELECT *, p * (1 - p) AS pq, p * (1 - p) * (docs - squares / docs - others) AS room FROM sums),
priors AS (
  SELECT rule, p, 1 / CASE WHEN room > 0 THEN least(1, greatest(1e-6, (spread - pq * others) / room)) ELSE 1e-6 END - 1 AS s
  FROM room),
bad AS (
  SELECT source, bool_or((k + s * p) / (n + s) > 0.5) AS bad FROM hosts JOIN priors USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT bad AS kept
FROM m JOIN bad ON m.source IS NOT DISTINCT FROM bad.source
""",
    "op12_prefix_trie": f"""
WITH crc AS ({CRC_STEPS}),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id AS c, {CRC.format(text="CAST(conv_id AS VARCHAR)")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc),
rebuilt AS (
  SELECT c, 0 AS part, pos, role, text FROM convs JOIN turns ON turns.conv_id = c - c % 5 AND pos < h
  UNION ALL SELECT c, 1, pos, role, text FROM convs JOIN turns ON turns.conv_id = c AND pos >= h),
hashed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, strlen(text) AS bytes,
         md5(length(role) || ':' || role || text) AS turn FROM rebuilt),
paths AS (
  SELECT c, d, bytes, md5(string_agg(turn, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM hashed
  UNION ALL SELECT c, 0, 0, '' FROM convs),
ends AS (
  SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM paths JOIN (SELECT c, max(d) AS d FROM paths GROUP BY c) USING (c, d) GROUP BY k),
nodes AS (SELECT k, min(c) AS c, min(d) AS d, count(*) AS n, min(bytes) AS bytes FROM paths GROUP BY k),
parents AS (
  SELECT nodes.k, paths.k AS parent FROM nodes JOIN paths ON paths.c = nodes.c AND paths.d = nodes.d - 1),
children AS (SELECT parent AS k, count(*) AS n_children FROM parents GROUP BY parent),
totals AS (
  SELECT paths.k, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n - 1) * nodes.bytes)::BIGINT AS saved
  FROM nodes LEFT JOIN children USING (k) JOIN paths ON paths.c = nodes.c AND paths.d <= nodes.d GROUP BY paths.k)
SELECT nodes.c AS conv_id, nodes.d AS depth, above.c AS parent_conv_id, nodes.n AS n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN totals USING (k) LEFT JOIN children USING (k) LEFT JOIN ends USING (k)
LEFT JOIN parents USING (k) LEFT JOIN nodes above ON above.k = parents.parent
""",
    "op13_spelling": rf"""
WITH RECURSIVE crc AS ({CRC_STEPS}),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, {RUNS} AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
marked AS (SELECT run, n, {CRC.format(text="doc_id || ':' || run")} AS h FROM runs, crc),
v AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                       ELSE run END AS word FROM marked)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = rest
  UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = rest),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM pairs GROUP BY word),
known AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form,
         CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM v LEFT JOIN best USING (word)),
ways AS (
  SELECT word, word AS root FROM known
  UNION ALL SELECT ways.word, form FROM ways JOIN known ON known.word = root WHERE form IS NOT NULL)
SELECT known.*, ways.root FROM known JOIN ways USING (word)
WHERE ways.root NOT IN (SELECT word FROM known WHERE form IS NOT NULL)
""",
}
