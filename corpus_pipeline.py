"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm import near_duplicates, packing, pii, quality_classifier, quality_rules
from marketframe.llm.common import remainder, small_side, table, written

#: Scores from which documents stay.
LEAST_SCORE = 0.3
#: Share of their shingles from which documents are near duplicates.
NEAR_PERCENT = 80
#: Keys of dropped documents that are broadcast at most.
BROADCAST_KEYS = 500_000


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.kept(docs)


def keep_good_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from the labelled rows of the whole table, rejected ones too."""
    model = quality_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), use=remainder("doc_id", 5) != 0)
    scored = quality_classifier.with_score(docs, model, out="__score")
    return scored.where(F.col("__score") >= LEAST_SCORE).select(docs.columns)


def keep_one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest key of each group of near duplicates; of repeated rows one.

    Rows without a key can't be told apart and all stay.
    """
    groups = near_duplicates.grouped(docs, percent=NEAR_PERCENT).select("doc_id", F.col("text_hash").alias("__text_hash"), "kept")
    groups = written(groups, "groups")
    # A key may stand in rows of different texts: only those of the dropped text go.
    dropped = groups.where(~F.col("kept")).select("doc_id", "__text_hash").distinct()
    hashed = docs.withColumn("__text_hash", near_duplicates.text_hash("text"))
    left = hashed.join(small_side(dropped, BROADCAST_KEYS), ["doc_id", "__text_hash"], "left_anti").select(docs.columns)
    repeated = groups.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not repeated.take(1):
        return left
    repeated = small_side(repeated, BROADCAST_KEYS)
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once).select(docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced by the kinds' names; n_chars follows."""
    clean = pii.with_spans(docs, "text", "__pii").withColumn("text", pii.redacted(F.col("text"), F.col("__pii")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in training sequences."""
    return packing.packed(docs, path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", keep_good_text),
    ("quality_classifier", keep_good_scores),
    ("near_duplicates", keep_one_of_a_group),
    ("pii", hide_personal_data),
    ("packing", pack),
]

#: SQL can't express the classifier, the tokenizer and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
