"""Score a growing folder of texts with a saved pipeline."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from penprint.functions import keys
from penprint.functions import lexicon as lex
from penprint.functions import text as tx
from penprint.plans.score import Scorer


def read_new_texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """A stream with one row per new file: ``file_path, file_name, text``, prepared for scoring.

    The path tells files apart; names may repeat in different folders.
    """
    files = (
        spark.readStream.schema("value string")
        .option("pathGlobFilter", pattern)
        .text(folder, wholetext=True)
    )
    tokens = tx.word_tokens(tx.clean(F.col("value"), lex.COMPACT_RULES), remove_stopwords=True)
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        keys.path_part(F.col("_metadata.file_path"), 1).alias("file_name"),
        F.array_join(tokens, " ").alias("text"),
    )


def score_stream(
    texts: DataFrame, model: PipelineModel, output: str, checkpoint: str
) -> StreamingQuery:
    """Score all files present and stop; run again to go on with later ones."""
    scored = model.transform(texts).select(
        "file_path", "file_name", F.col("prediction").cast("int").alias("prediction")
    )
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_batches(
    texts: DataFrame, scorer: Scorer, key: str, text: str, output: str, checkpoint: str
) -> StreamingQuery:
    """Score all texts present with any fitted models, word-vector features included, and stop.

    Word vectors are looked up by a join with a static table, so each micro-batch is scored as a
    table of its own. Its predictions have a folder by the number of the batch: a batch that is
    repeated after a failure replaces what it wrote before.
    """

    def write(batch: DataFrame, number: int) -> None:
        scored = scorer.score(batch, key, text).withColumn("batch", F.lit(number))
        writer = scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(output)

    return (
        texts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
