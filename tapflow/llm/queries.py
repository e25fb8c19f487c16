"""The registered queries of the training-data operators, and their SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapflow.llm import conversations, decontamination, fingerprints, line_dedup, lm_scoring, minhash, mixing, personal, spelling, token_files, toxicity, url_filters, warc
from tapflow.llm.shared import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of the whole benchmark in every document."""
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op1_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edited_and_next(table(spark, folder, "documents"))


def op2_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near copies of every document."""
    return minhash.classes(table(spark, folder, "documents"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as archives, read back."""
    out = shared_folder(spark)
    warc.write(table(spark, folder, "pages"), out)
    return warc.read(spark, out).drop("url", "payload")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score, by a model that knows only labels of rows that aren't held out."""
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "threshold", "toxic",
    )


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that an earlier one has: counts and digest of what stays."""
    kept = line_dedup.without_repeats(table(spark, folder, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


def op7_token_files(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    """All documents as token files, read back."""
    out = shared_folder(spark)
    token_files.write(table(spark, folder, "documents"), out, vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, out)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed by temperature, at as many tokens as there are."""
    return mixing.draws(table(spark, folder, "documents"))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return personal.find(table(spark, folder, "documents"))


def op10_lm_scoring(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Every document's score by a unigram and by an attention model of those that aren't held out."""
    return lm_scoring.score(table(spark, folder, "documents"), vocabulary or public_tokenizers.path("byte_bpe_50k.json"))


def op11_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the fixed rules, else by the rules FP-growth mines from the pages that those label."""
    judged = url_filters.judge(table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_verdict", "confidence")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of all documents with its near words, form and root."""
    return spelling.variants(table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation after planted damage: its faults and the cheapest repair."""
    return conversations.repair(table(spark, folder, "conversations"))


def queries() -> dict[str, Query]:
    return {
        "op1_spotsigs": op1_spotsigs,
        "op2_minhash_dedup": op2_minhash_dedup,
        "op3_warc": op3_warc,
        "op4_toxicity": op4_toxicity,
        "op5_decontamination": op5_decontamination,
        "op6_line_dedup": op6_line_dedup,
        "op7_token_files": op7_token_files,
        "op8_mixing": op8_mixing,
        "op9_personal_data": op9_personal_data,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_url_filters": op11_url_filters,
        "op12_spelling": op12_spelling,
        "op13_conversation_repair": op13_conversation_repair,
    }


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS words
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p
        FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS words
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT doc_id, places.k, p, item_id FROM places JOIN windows USING (k, words)),
items AS (SELECT DISTINCT doc_id, item_id FROM found),
hit AS (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS p FROM found)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(s.n, 0)::BIGINT AS n_items,
       sha256(coalesce(s.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM hit GROUP BY 1) h USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM items GROUP BY 1) s
  USING (doc_id)
"""


MIXING_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x09-\\x0D\\x20]+'))::BIGINT AS n_tokens
  FROM documents),
sums AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY 1),
shares AS (
  SELECT list(tokens / total) AS p, min(tokens / total) AS least, any_value(total) AS total
  FROM (SELECT tokens, sum(tokens) OVER () AS total FROM sums WHERE tokens > 0)),
halved AS (
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN low ELSE (low + high) / 2 END, CASE WHEN ok THEN (low + high) / 2 ELSE high END
  FROM (SELECT i, low, high, pow(least, (low + high) / 2 - 1)
               / list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))) <= {mixing.MAX_REPEATS} AS ok
        FROM halved, shares WHERE i < {mixing.SECTIONS.bit_length() * mixing.ROUNDS - mixing.ROUNDS})),
ends AS (
  SELECT CASE WHEN pow(least, -1) / len(p) <= {mixing.MAX_REPEATS} THEN 0.0 ELSE high END AS a, p
  FROM shares, (SELECT high FROM halved ORDER BY i DESC LIMIT 1)),
quotas AS (
  SELECT source, tokens,
         CASE WHEN tokens > 0 THEN floor(total * (pow(tokens / total, a) / list_sum(list_transform(p, lambda x: pow(x, a)))))::BIGINT
              ELSE 0 END AS quota
  FROM sums, ends, (SELECT total FROM shares)),
plan AS (
  SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE 0 END AS epochs,
         CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest,
         greatest(1, ceil(sum(quota) OVER () / {mixing.BLOCK_TOKENS}))::BIGINT AS blocks
  FROM quotas),
copies AS (
  SELECT *, ('0x' || substr(md5('{mixing.SEED}:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS sort_key
  FROM (SELECT d.doc_id, d.source, n_tokens, tokens, quota, epochs, rest, blocks, unnest(range(0, epochs + 1)) AS epoch
        FROM d JOIN plan ON d.source = plan.source)),
paid AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY sort_key RANGE UNBOUNDED PRECEDING) AS cost FROM copies)
SELECT doc_id, source, n_tokens, epoch::BIGINT AS epoch,
       least(blocks - 1, floor((epoch + (sort_key >> 30) / 1073741824::DOUBLE) * greatest(tokens, 1) / greatest(quota, 1)
             * blocks::DOUBLE))::BIGINT AS block, sort_key
FROM paid WHERE epoch < epochs OR cost <= rest
"""


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages),
digests AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + (i // 4) * 5, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '') AS digest
  FROM p)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM digests
"""


_CRC32 = """crc(b, k, c) AS (SELECT b, 0, b::UBIGINT FROM range(256) r(b)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM crc WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS tab FROM crc WHERE k = 8)"""


def _crc32(text: str) -> str:
    """DuckDB SQL: unsigned crc32 of the UTF-8 bytes of `text` (needs `crc_table` joined as `tab`)."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::UBIGINT"
    steps = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte})"
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {steps}), "
            f"lambda acc, y: xor(acc >> 8, tab[(xor(acc, y) & 255)::BIGINT + 1])), 4294967295::UBIGINT)")


SPELLING_SQL = f"""
WITH RECURSIVE {_CRC32},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
hashed AS (SELECT low, {_crc32("id || ':' || low")} AS h FROM runs, crc_table),
cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(low, 1, (h % length(low))::BIGINT) || substr(low, (h % length(low))::BIGINT + 2)
              ELSE low END AS word
  FROM hashed),
words AS (SELECT word, count(*) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
positions AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
dels AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM positions),
pairs AS (
  SELECT a.word AS w, b.word AS v, b.n AS vn FROM dels a JOIN dels b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM dels a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM dels a JOIN words b ON a.d = b.word),
best AS (SELECT w, count(*) AS n_near, max(vn) AS best_n, min(v) FILTER (WHERE vn = best_n_all) AS v
         FROM (SELECT *, max(vn) OVER (PARTITION BY w) AS best_n_all FROM pairs) GROUP BY w),
forms AS (
  SELECT words.word, words.n, coalesce(best.n_near, 0) AS n_near,
         CASE WHEN best.best_n >= 2 * words.n THEN best.v END AS form,
         CASE WHEN best.best_n >= 2 * words.n THEN best.best_n END AS form_n
  FROM words LEFT JOIN best ON best.w = words.word),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, chain.at AS root, forms.n::BIGINT AS n, forms.n_near::BIGINT AS n_near,
       forms.form_n::BIGINT AS form_n
FROM forms JOIN chain ON chain.word = forms.word JOIN forms AS last ON last.word = chain.at AND last.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": WARC_SQL,
        "op5_decontamination": DECONTAMINATION_SQL,
        "op8_mixing": MIXING_SQL,
        "op12_spelling": SPELLING_SQL,
    }
