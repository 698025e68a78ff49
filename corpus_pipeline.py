"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as
Parquet to the shared folder and hands what it reads back to the next stage.  All stages
but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kiln.llm import decontaminate, packing, simhash, substrings, toxicity
from kiln.llm.storage import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the noisy-or model.  Null and empty texts and rows without
    id are scored like others, equal rows alike, whole texts of any length; an empty table
    stays empty."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    score = _free(docs, "score")
    scored = toxicity.score(docs, model, score_col=score, sentences_col=None)
    return scored.where(F.col(score) < 0.5).select(docs.columns)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name = f"_{name}"
    return name


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest id.  Of rows equal in
    id and text one stays; rows without id stay.  Null and empty texts have one fingerprint
    and so form one component; an empty table stays empty."""
    found = simhash.near_duplicates(docs.select("doc_id", "text"))
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    digest, n = _free(docs, "digest"), _free(docs, "n")
    again = Window.partitionBy("doc_id", digest).orderBy(digest)
    chosen = (docs.join(kept, "doc_id", "left_semi")
              .withColumn(digest, F.xxhash64("text"))
              .withColumn(n, F.row_number().over(again)).where(F.col(n) == 1))
    return docs.where("doc_id IS NULL").union(chosen.select(docs.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start earlier; texts that lose none
    stay as they are, null and empty ones too.  ``n_chars`` follows the text.  Equal rows are
    documents of their own; an empty table stays empty."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # names that the operator's own columns cannot meet
    place = {c: f"rest_{k}" for k, c in enumerate(rest)}
    renamed = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(p) for c, p in place.items()))
    kept = substrings.remove_repeats(renamed, carry=list(place.values()), keep_untouched=True)

    def column(c: str):
        if c == "text":
            return F.col("kept_text").alias("text")
        if c == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(
                F.col(place[c])).cast(docs.schema[c].dataType).alias(c)
        return F.col(place.get(c, c)).alias(c)

    return kept.select(*(column(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that repeats a benchmark item.  Null and empty texts and rows
    without id repeat none and stay; all rows of an id that does go; an empty table stays
    empty."""
    hits = (decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))
            .select("doc_id").distinct().checkpoint())
    return docs.join(decontaminate.bounded(hits), "doc_id", "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids, with a checksum of each piece's ids.  Every row
    is a document, null and empty texts are their end id; an empty table has no pieces."""
    return packing.piece_digests(packing.pack_documents(docs))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("substrings", cut_repeats), ("decontamination", drop_contaminated), ("packing", pack)]

#: tokenisers, trained models and components are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
