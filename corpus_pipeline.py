"""Cleaning pipeline over ``documents``: a list of stages, each one operator.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last one returns their token ids.  What a
stage returns is written as Parquet and read again as the input of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontaminate, minhash, queries, secret_scan, toxicity
from tidewater.llm.common import scratch_folder, small_batches, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier predicts toxic go.

    A null text scores as an empty one; rows that repeat a text share its fate,
    whatever their ids; an empty table, or one without labels, keeps what scores low.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.coalesce(docs["text"], F.lit(""))) < toxicity.THRESHOLD)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of near copies stays (shingles of five words, similarity 0.8)."""
    small_batches(spark)
    return minhash.keep_one(docs, minhash.NearRule(width=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents of which a twentieth is benchmark text go.

    Null and empty texts have no words and stay; rows that repeat a text share its
    fate; without benchmark items all stay.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every document stays; secrets in its text are masked and n_chars follows."""
    small_batches(spark)
    text = secret_scan.redacted(docs["text"])
    return docs.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast("long"))
    )


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids of every document, checked by decoding them again in the same worker.

    Null and empty texts have no tokens; every row gives one, repeated ones too.
    """
    small_batches(spark)
    encoded = bpe.encode(docs, queries.tokenizer(), verify=True)
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode_tokens),
]

#: The stages run trained and iterative code, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each on what the one before kept.

    What a stage was given goes when what it returned is written, so two copies
    of the corpus are stored at most.
    """
    docs = table(spark, sf_dir, "documents")
    folder = scratch_folder(spark, "pipeline")
    given = None
    for step, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{step}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if given:
            remove_folder(spark, given)
        given = path
    return docs


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
