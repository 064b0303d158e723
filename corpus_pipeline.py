"""A training-data pipeline: toxic documents go, near-duplicates go, personal data is replaced, sources are mixed,
and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's
docs. All but the last return the columns of documents, further ones included. An empty table gives an empty result
in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import packing, pii_surrogates, simhash_dedup, source_mix, toxicity
from corpusloom.llm.common import surrogate_key, table, written

#: Several stages depend on fitted models or iterate, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the toxicity model does not reject.

    Every row is judged by its text: null and empty texts stay, null and repeated ids change nothing. Without labels of
    both classes all stay.
    """
    scored = toxicity.Model(docs, table(spark, sf_dir, "labels")).score(docs)
    return scored.where(F.col("__tox_score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the document with the smallest id, and of equal ids one row.

    Near-duplicates share at least 0.8 of their five-word shingles, or have equal fingerprints. Rows with a null id
    stay unless a row with an id is in their group. Texts without a word, null ones too, are one group.
    """
    found = written(simhash_dedup.similar_documents(docs), "near_duplicates")
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = docs.join(keep.select(F.col("doc_id").alias("__id")), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    if keep.where("rows > 1 and doc_id is not null").isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts surrogates in place of personal data and secrets; n_chars follows the text.

    The key comes from spark.corpusloom.surrogateKey. Rows without such data, null and empty texts stay as they are.
    """
    done = pii_surrogates.replace(docs, surrogate_key(spark))
    touched = F.size("__pii_found") > 0
    return done.withColumn("n_chars", F.when(touched, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources meet their targets.

    A null source is a source of its own. Texts without a word count as size 0; equal rows are dealt with one by one.
    """
    mixed = source_mix.mix(docs, keep=tuple(docs.columns))
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences; one row per piece. A null or empty text is one piece of its end token alone."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
