"""Extensions beyond batch: articles tagged, and links counted, as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tesserae.operators import wikitext as w


def read_stream(spark: SparkSession, path: str, schema: str, per_trigger: int = 64) -> DataFrame:
    """New Parquet files of a folder, a bounded number at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def tag_stream(articles: DataFrame, page: DataFrame, entities: DataFrame, redirects: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Tag each batch of articles against the tables as they are, and append it.

    A batch that is tried again overwrites its own folder, so nothing is
    written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        w.as_json(w.tagged_documents(batch, page, entities, redirects)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return articles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def link_counts(tagged: DataFrame, late: str = "1 day", window: str = "1 hour") -> DataFrame:
    """target, window, n_links of a stream of tagged pages with loaded_at, closed `late` after their time."""
    timed = tagged.withColumn("loaded_at", F.col("loaded_at").cast("timestamp")).withWatermark("loaded_at", late)
    flat = F.flatten(F.filter(F.from_json("link_titles", "array<array<string>>"), lambda x: x.isNotNull()))
    links = timed.select("loaded_at", F.explode(flat).alias("target")).where("target <> ''")
    return links.groupBy(F.window("loaded_at", window), "target").agg(F.count(F.lit(1)).alias("n_links"))


