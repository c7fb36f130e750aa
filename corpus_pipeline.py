"""From raw documents to packed training sequences, in five stages.

Each stage takes the session, the documents its predecessor kept and the
folder of the input tables, and works on all of them. All but the last return
the columns of documents, with ``n_chars`` following the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.llm.common import read_table, written
from goldvein.llm.exact_dedup import exact_dedup
from goldvein.llm.jaccard_join import jaccard_components
from goldvein.llm.packing import pack_documents
from goldvein.llm.quality_classifier import quality_scores
from goldvein.llm.queries import tokenizer_path
from goldvein.llm.suffix_dedup import without_later_passages


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _keep(docs: DataFrame, kept: DataFrame, text_key: Column) -> DataFrame:
    """The rows whose (doc_id, text key) is among ``kept`` (_id, _key); a null id matches a null id."""
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (text_key == F.col("_key"))
    return docs.join(kept.select("_id", "_key").distinct(), same, "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    keyed = docs.select("doc_id", "text", F.xxhash64(_text()).alias("_key"))
    scores = quality_scores(keyed, read_table(spark, sf_dir, "labels"), carry=("_key",))
    return _keep(docs, scores.where("predicted = 1").withColumnRenamed("doc_id", "_id"), F.xxhash64(_text()))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one of the largest id."""
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_key"))
    once = _keep(docs, kept, F.sha2(_text(), 256)).withColumn("_key", F.sha2(_text(), 256))
    return once.dropDuplicates(["doc_id", "_key"]).drop("_key")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one whose id names it (of several texts of that id, one)."""
    kept = jaccard_components(docs).where("leads").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_key"))
    once = _keep(docs, kept, F.xxhash64(_text())).withColumn("_key", F.xxhash64(_text()))
    return once.dropDuplicates(["doc_id", "_key"]).drop("_key")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier place has; documents that had nothing else go."""
    out = without_later_passages(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("jaccard_join", near),
          ("suffix_dedup", passages), ("best_fit_packing", pack)]

#: The first stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
