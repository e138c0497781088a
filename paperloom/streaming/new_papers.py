"""New documents as a stream: identities kept as they come, and candidate groups over all that came."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom.functions.text import formula_fingerprint, text_fingerprint


def identified(docs: DataFrame) -> DataFrame:
    """Identity columns of ``docs(block_id, paper_id, text)``; works on streams and on tables."""
    return docs.select("block_id", "paper_id", text_fingerprint(F.col("text")).alias("text_fingerprint"), formula_fingerprint(F.col("text")).alias("latex_fingerprint"))


def counted(identities: DataFrame) -> DataFrame:
    """Running group sizes by fingerprint, for a stream in complete or update mode."""
    return identities.where(F.length("text_fingerprint") > 0).groupBy("text_fingerprint").agg(F.count("*").alias("n"), F.approx_count_distinct("paper_id").alias("papers"))


def keep(docs: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the identities of a stream of documents to Parquet below ``path``, each exactly once.

    A batch writes its own folder, replacing what an earlier try left there.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = identified(docs).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Steps by kind and window of event time; late rows within the watermark are counted."""
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
