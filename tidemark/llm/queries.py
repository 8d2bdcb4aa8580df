"""The queries opN_ and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import licenses, secrets
from tidemark.llm.leaks import decontaminate
from tidemark.llm.licenses import find_licenses
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.near_copies import jaccard_join
from tidemark.llm.packing import pack
from tidemark.llm.quality_model import classify
from tidemark.llm.quality_rules import RULES, STOP_WORDS, quality
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.secrets import find_secrets
from tidemark.llm.tables import documents
from tidemark.llm.toxicity import learn, score


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).drop("failed_rules")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir), exact_chars=1)
    return out.select("doc_id", "n_lines", "n_exact", "n_near", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def crc_part(parts: int, part: int) -> Column:
    """Whether the crc32 of doc_id as text leaves this remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


def scored(df: DataFrame, parts: int, part: int) -> DataFrame:
    return df.select("doc_id", crc_part(parts, part).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), ~crc_part(5, 0)), 5, 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(score(docs.select("doc_id", "text"), learn(docs, documents(spark, sf_dir, "labels"), ~crc_part(4, 2))), 4, 2)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(documents(spark, sf_dir))
    n = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.kind != "entropy")
    return out.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


#: Words as the contracts have them, for DuckDB.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

STOP_LIST = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))
OP1_RULES = " AND ".join(f"({r.whole} < {r.least} OR 1000 * {r.part} BETWEEN {r.low} * {r.whole} AND {r.high} * {r.whole})" for r in RULES)

OP1_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' '))) AS g FROM d),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(8) r(k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS u FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.u, 0) AS n_dup_lines,
    coalesce(cover.n, 0) AS n_repeat_words, CAST(len(list_filter(w, lambda x: x IN ({STOP_LIST}))) AS BIGINT) AS n_stop_words, CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct_words
    FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN cover USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {OP1_RULES} AS kept FROM b
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TOKENS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (("assign", ASSIGN), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]{16,}"), ("entropy", "[A-Za-z0-9+/_=-]{20,}"))

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({" UNION ALL ".join(f"SELECT doc_id, {k} AS kind, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS s FROM d" for k, (_, p) in enumerate(PATTERNS))}),
found AS (SELECT doc_id, kind, m, s, unnest(m) AS x, unnest(range(len(m))) AS i FROM parts),
placed AS (SELECT doc_id, kind, x, CAST(list_sum(list_transform(s[1:i + 1], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i], lambda y: length(y))), 0) AS BIGINT) AS a FROM found),
base AS (SELECT doc_id, kind, a, a + length(x) AS b FROM placed WHERE kind = 2 OR kind = 1 AND length(x) >= 18 OR kind = 0 AND length(regexp_extract(x, '{ASSIGN}', 2)) >= 12),
candidate AS (SELECT doc_id, x, a, CASE WHEN regexp_full_match(x, '[0-9a-fA-F]+') THEN 2.9 WHEN regexp_full_match(x, '[A-Za-z0-9]+') THEN 3.6 ELSE 3.7 END AS bound FROM placed
    WHERE kind = 3 AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]') AND NOT regexp_matches(x, '(?i){secrets.ALLOWED.pattern}')),
win AS (SELECT doc_id, a, bound, x, unnest(range(length(x) - 19)) AS w FROM candidate),
letters AS (SELECT doc_id, a, bound, w, unnest(string_split(x[w + 1:w + 20], '')) AS c FROM win),
counted AS (SELECT doc_id, a, bound, w, c, count(*) AS n FROM letters GROUP BY ALL),
bits AS (SELECT doc_id, a, w FROM counted GROUP BY doc_id, a, bound, w HAVING log2(20) - sum(n * log2(n)) / 20 > bound),
even AS (SELECT doc_id, 3 AS kind, a + min(w) AS a, a + max(w) + 20 AS b FROM bits GROUP BY doc_id, bits.a),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM even WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = even.doc_id AND base.a < even.b AND even.a < base.b)),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || a || ':' || b AS t FROM spans),
all_ AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, string_agg(t, ',' ORDER BY a, kind, b) FILTER (kind < 3) AS base, string_agg(t, ',' ORDER BY a, kind, b) AS spans FROM named GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN all_ USING (doc_id)
"""

OP8_SQL = rf"""
WITH d AS (SELECT doc_id, {TOKENS} AS w FROM documents),
tok AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS p FROM d),
phrase(phrase, label) AS (VALUES {", ".join(f"('{p}', '{label}')" for p, label in licenses.BASE)}),
base AS (SELECT doc_id, label, p FROM tok JOIN phrase ON t = string_split(phrase, ' ')[1] JOIN d USING (doc_id) WHERE w[p + 1:p + len(string_split(phrase, ' '))] = string_split(phrase, ' ')),
tm(k, label, words, key) AS (VALUES {", ".join(f"({k}, '{label}', string_split('{t}', ' '), string_split('{key}', ' '))" for k, (label, t, key) in enumerate(licenses.TEMPLATES))}),
keyed AS (SELECT doc_id, k, p FROM tok JOIN tm ON t = key[1] JOIN d USING (doc_id) WHERE w[p + 1:p + len(key)] = key),
tw AS (SELECT k, unnest(words) AS t, unnest(range(len(words))) AS q FROM tm),
hit AS (SELECT DISTINCT doc_id, k, p - q AS s, q FROM tok JOIN tw USING (t) SEMI JOIN keyed USING (doc_id, k)),
shift AS (SELECT DISTINCT doc_id, k, s + x AS s FROM hit, range(-{licenses.DRIFT}, 1) r(x)),
shared AS (SELECT shift.doc_id, shift.k, shift.s, count(DISTINCT q) AS n FROM shift JOIN hit ON hit.doc_id = shift.doc_id AND hit.k = shift.k AND hit.s BETWEEN shift.s AND shift.s + {licenses.DRIFT} GROUP BY ALL),
notice AS (SELECT doc_id, label, n / len(words) AS share FROM shared JOIN tm USING (k) WHERE n >= {licenses.LEAST_SHARE} * len(words)
    AND EXISTS (SELECT 1 FROM keyed WHERE keyed.doc_id = shared.doc_id AND keyed.k = shared.k AND p >= s - len(key) AND p + len(key) <= s + {licenses.DRIFT} + len(words) + len(key))),
b AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share FROM (SELECT doc_id, label, 0.5::DOUBLE AS share FROM base UNION ALL SELECT doc_id, label, share::DOUBLE FROM notice) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(share, 0)::DOUBLE AS score FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)
"""

OP9_SQL = rf"""
WITH d AS (SELECT doc_id, {TOKENS} AS w FROM documents),
b AS (SELECT item_id, {TOKENS} AS w FROM benchmark),
dt AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS p FROM d),
bt AS (SELECT item_id, len(w) AS n, unnest(w) AS t, unnest(range(len(w))) AS q FROM b),
hit AS (SELECT doc_id, item_id, p - q AS shift, q, n FROM dt JOIN bt USING (t)),
near AS (SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY q RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) AS c FROM hit),
diagonal AS (SELECT DISTINCT doc_id, item_id, shift, n FROM near WHERE c >= CASE WHEN n < 8 THEN n ELSE 0.75 * least(20, n) END),
overlap AS (SELECT doc_id, item_id, shift, greatest(0, -shift) AS lo, least(n, len(w) - shift) AS hi FROM diagonal JOIN d USING (doc_id)),
win AS (SELECT doc_id, item_id, shift, least(20, hi - lo) AS size, unnest(range(lo, hi - least(20, hi - lo) + 1)) AS s FROM overlap),
counted AS (SELECT doc_id, item_id, shift, size, s, count(*) AS c FROM win JOIN hit USING (doc_id, item_id, shift) WHERE q BETWEEN s AND s + size - 1 GROUP BY ALL)
SELECT doc_id, item_id, s + shift AS doc_start, s AS item_start, size AS n_tokens, c AS n_equal FROM counted QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY c DESC, shift, s) = 1
"""

OP10_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 10 * count(*) >= 8 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id) AS class_id, (SELECT count(*) FROM link l WHERE l.a = d.doc_id) AS n_links, coalesce(n.n, 0) AS n_shingles
FROM documents d LEFT JOIN n USING (doc_id)
"""

OP7_SQL = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i+49], ' ')))) AS g FROM w WHERE len(w) >= 50),
first AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g),
later AS (SELECT doc_id, i FROM win JOIN first USING (g) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(50) r(k)),
pos AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, (SELECT count(*) FROM gone WHERE gone.doc_id = w.doc_id) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""

QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op3_best_fit_packing, op4_quality_classifier, op5_toxicity, op6_secret_scan, op7_substring_dedup, op8_license_scan, op9_decontamination, op10_ngram_jaccard)}
ORACLE_SQL: dict[str, str] = {"op1_quality_rules": OP1_SQL, "op6_secret_scan": OP6_SQL, "op7_substring_dedup": OP7_SQL, "op8_license_scan": OP8_SQL, "op9_decontamination": OP9_SQL, "op10_ngram_jaccard": OP10_SQL}
