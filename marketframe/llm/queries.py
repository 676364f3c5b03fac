"""Queries of this subpackage: each operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, collocations, conversation_repair, html_extraction, language_model, near_duplicates, neighbours, packing, pii, quality_classifier, quality_rules, secrets
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_language_model")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"), held_out=language_model.held_out_rows(), exact=True)


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT row, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS g
  FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM d)
),
places AS (
  SELECT DISTINCT row, i + k AS i
  FROM (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, g) > 1), range(0, 3) AS r(k)
),
repeats AS (SELECT row, count(*) AS n FROM places GROUP BY row),
m AS (
  SELECT doc_id, text, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         length(text) - length(regexp_replace(text, '\p{Lu}+', '', 'g')) AS capitals,
         length(text) - length(regexp_replace(text, '\p{L}+', '', 'g')) AS letters
  FROM d LEFT JOIN repeats USING (row)
),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT 100 * n_symbols > 30 * n_words AND NOT 100 * capitals > 40 * letters
       AND NOT 100 * n_dup_lines > 50 * n_lines AND NOT word_chars < 2 * n_words AND NOT word_chars > 20 * n_words AS kept
FROM v
"""


@query("op2_quality_rules", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measures(table(spark, sf_dir, "documents"))


@query("op3_html")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_text(table(spark, sf_dir, "pages"))


@query("op4_near_duplicates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
marked AS (
  SELECT *, coalesce(lag(role) OVER w = role, FALSE) AS same,
         length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS size,
         length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1\\|', 'g')) AS role_size
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(size + CASE WHEN same THEN length('<|im_next|>') ELSE length('<|im_start|>') + role_size + 1 + length('<|im_end|>') + 1 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op9_chat", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text")
    )
    return chat_format.report(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))


@query("op10_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(table(spark, sf_dir, "conversations"))


@query("op12_secrets")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS row, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
),
places AS (SELECT row, lang, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM pieces),
grams AS (
  SELECT lang, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c, lead(word, 3) OVER p AS d
  FROM places WINDOW p AS (PARTITION BY row ORDER BY i)
),
f AS (
  SELECT lang, 1 AS m, a AS phrase, count(*) AS a FROM grams GROUP BY ALL
  UNION ALL SELECT lang, 2, concat_ws(' ', a, b), count(*) FROM grams WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, concat_ws(' ', a, b, c), count(*) FROM grams WHERE c IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, concat_ws(' ', a, b, c, d), count(*) FROM grams WHERE d IS NOT NULL GROUP BY ALL
),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE a >= 30),
candidates AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM often WHERE m > 1),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM candidates AS c, range(1, 4) AS r(k) WHERE k < c.m
),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
  FROM cuts AS c JOIN often AS x ON x.lang = c.lang AND x.phrase = c.x JOIN often AS y ON y.lang = c.lang AND y.phrase = c.y
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
),
inside AS (
  SELECT lang, phrase, max(a) AS f
  FROM (
    SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM candidates, range(2, 4) AS r(k), range(1, 4) AS s(i) WHERE k < m AND i + k - 1 <= m
  )
  GROUP BY lang, phrase
),
kept AS (
  SELECT s.* FROM scored AS s LEFT JOIN inside AS i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.f IS NULL OR 100::HUGEINT * i.f < 80::HUGEINT * s.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r.r, n, score FROM ranked AS r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""


@query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
