"""The registered queries of this folder: each applies one operator, with its
production parameters, to its whole table. ``ORACLE_SQL`` has the DuckDB form
where SQL can express the operator; two more queries give the columns of op4 and op10
that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm import alignment, bpe, langid, tokencount
from logtally.llm.exact import exact_groups
from logtally.llm.fingerprint import fingerprints
from logtally.llm.htmltext import extract_text
from logtally.llm.lexical import search
from logtally.llm.mixing import mix_counts
from logtally.llm.pii import find_pii
from logtally.llm.simhash import near_groups
from logtally.llm.substring import remove_repeats
from logtally.llm.suffixranks import remove_repeated_bytes


# Vocabulary files of the registered queries.
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
UNIGRAM_PIECES = "piece_bpe_32k.model"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN,
                              carry=["doc_id"]).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    content = langid.fit(docs.where(~langid.held_out()))
    return langid.identify(docs.select("doc_id", "text"), content).select(
        F.col("row.doc_id").alias("doc_id"), "lang_pred", F.col("lang_score").alias("score")).withColumn(
        "held_out", langid.held_out()).select("doc_id", "held_out", "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(UNIGRAM_PIECES))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED), carry=["doc_id"]).select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_suffix_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op4: the base spans, in counts and digest."""
    return find_pii(_table(spark, sf_dir, "documents")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op10: which document is the next, and the edited text."""
    return fingerprints(_table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe": op2_bpe,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_html_text": op5_html_text,
    "op6_language_id": op6_language_id,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_fingerprint": op10_fingerprint,
    "op11_token_alignment": op11_token_alignment,
    "op12_suffix_ranks": op12_suffix_ranks,
    "op13_lexical_search": op13_lexical_search,
    "pii_base_spans": pii_base_spans,
    "edited_texts": edited_texts,
}

_OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
k AS (SELECT doc_id, i, word,
             list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS g FROM u),
r AS (SELECT doc_id, i, word, len(g) = 20 AND row_number() OVER (
               PARTITION BY len(g), array_to_string(g, ' ') ORDER BY doc_id NULLS LAST, i) > 1 AS again FROM k),
c AS (SELECT doc_id, i, word,
             max(again::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
g AS (SELECT doc_id, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept
      FROM c GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id IS NOT DISTINCT FROM g.doc_id
"""

_OP8 = r"""
WITH k AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || md5(concat(coalesce(doc_id::VARCHAR, ''), '|', coalesce(text, '')))[1:8])::BIGINT AS draw
  FROM documents),
n AS (SELECT greatest(64, ceil(count(*) / 65536.0))::BIGINT AS buckets FROM k),
r AS (SELECT k.*, len(bin(size)) AS class, draw % buckets AS bucket FROM k, n),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
              3 * source_size AS most FROM s0),
s2 AS (SELECT *, ((sum(source_size) OVER ()
                   - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                  / (sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE) AS level
       FROM s1),
s3 AS (SELECT *, (SELECT arg_min(level, most / weight) FROM s2 WHERE level * weight <= most) AS common FROM s2),
s AS (SELECT source, source_size, least(weight * common, most::DOUBLE) AS target,
             ('0x' || md5(concat('mix-1:', coalesce('s' || source, '')))[1:6])::BIGINT AS start_off FROM s3),
t AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216)::BIGINT ELSE 16777216 END AS step FROM s),
p AS (SELECT doc_id, r.size, t.source_size, t.target, t.step, t.start_off,
             row_number() OVER (PARTITION BY r.source ORDER BY class, bucket, r.size, doc_id, draw) AS passed
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((((passed * step + start_off) >> 24) - (((passed - 1) * step + start_off) >> 24)) * size)::BIGINT AS taken
FROM p
"""

_OP9 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
"""

_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
u AS (SELECT r, x, unnest(range(len(x) // 2)) AS i FROM d),
k AS (SELECT r, i, substr(x, 2 * i + 1, 2) AS byte, 2 * i + 400 <= len(x) AS whole, md5(substr(x, 2 * i + 1, 400)) AS s FROM u),
a AS (SELECT r, i, byte, whole AND count(*) OVER (PARTITION BY whole, s) > 1 AS again FROM k),
c AS (SELECT r, i, byte, max(again::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone FROM a),
b AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), 0) AS before FROM c),
g AS (SELECT r, sum(gone)::BIGINT AS n_removed, sum(gone * (1 - before))::BIGINT AS n_spans,
             string_agg(byte, '' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM b GROUP BY r)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""

_OP13 = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
c AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT r, sum(tf)::BIGINT AS n FROM c GROUP BY r),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS size FROM n),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM c, g GROUP BY term),
q AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT i, item_id, r, c.doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // size))))::BIGINT AS score
      FROM q JOIN c USING (term) JOIN w USING (term) JOIN n USING (r), g GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 10
"""

# Fixed patterns of the base kinds.
_PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
_PII_MATCHES = " UNION ALL ".join(
    f"SELECT r, {k} AS place, '{kind}' AS kind, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps FROM d"
    for k, (kind, pattern) in enumerate(_PII.items(), 1))

# Where a match begins follows from the pieces between matches.
_PII_BASE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_PII_MATCHES}),
u AS (SELECT r, place, kind, unnest(ms) AS m, unnest(ps[:len(ms)]) AS p, generate_subscripts(ms, 1) AS i FROM m WHERE len(ms) > 0),
s AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits,
             (sum(length(p) + length(m)) OVER (PARTITION BY r, place ORDER BY i))::BIGINT AS stop FROM u),
v AS (SELECT r, place, kind, stop - length(m) AS start, stop,
             CASE kind
               WHEN 'email' THEN true
               WHEN 'ip' THEN len([x for x in string_split(m, '.') if length(ltrim(x, '0')) > 3 OR right(x, 3)::INT > 255]) = 0
               WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(
                 [x - 9 * (x > 9)::INT for x in [substr(digits, length(digits) - j, 1)::BIGINT * (1 + j % 2) for j in range(length(digits))]]) % 10 = 0
               ELSE length(digits) BETWEEN 9 AND 15 END AS valid
      FROM s)
SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
       count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
       sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place), '')) AS base_sha256
FROM d LEFT JOIN (SELECT * FROM v WHERE valid) USING (r) GROUP BY r, doc_id
"""

_EDITED = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, length(t) // 3 AS c, coalesce(lead(t) OVER w, first_value(t) OVER w) AS next
      FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST))
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(substr(t, 1, length(t) - c) || substr(next, 1, c)) AS edited_sha256 FROM n
"""

ORACLE_SQL: dict[str, str] = {"op1_substring_dedup": _OP1, "op8_mixing": _OP8, "op9_exact_dedup": _OP9, "op12_suffix_ranks": _OP12,
                              "op13_lexical_search": _OP13, "pii_base_spans": _PII_BASE, "edited_texts": _EDITED}
