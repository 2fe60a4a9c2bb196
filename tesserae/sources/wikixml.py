"""XML dumps of pages, and plain tables as sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: how the namespace of an export begins.
EXPORT = "http://www.mediawiki.org/xml/export-"
SCHEMA = "id long, title string, revision array<struct<text: struct<_VALUE: string, _bytes: string>>>"


def check_namespace(spark: SparkSession, path: str) -> None:
    """The head of the dump must name the export namespace."""
    head = "".join(r[0] for r in spark.read.text(path).where("value like '%<mediawiki%'").limit(1).collect())
    if f'xmlns="{EXPORT}' not in head:
        raise ValueError(f"{path} is no export of pages")


def write_dump(pages: DataFrame, path: str) -> None:
    """pages(title, id, revision) as a dump; every file has the export's root."""
    pages.write.format("xml").option("rootTag", f'mediawiki xmlns="{EXPORT}0.11/"').option("rowTag", "page").save(path)


def read_pages(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """page_id, title, text of each page, of its first revision; pages without a text element are left out, empty texts are null."""
    if check:
        check_namespace(spark, path)
    pages = spark.read.format("xml").option("rowTag", "page").schema(SCHEMA).load(path)
    first = F.element_at("revision", 1)["text"]
    return pages.where(first.isNotNull()).select(F.col("id").alias("page_id"), "title", F.nullif(first["_VALUE"], F.lit("")).alias("text"))


def write_pages(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Appended as Parquet, in ranges of page ids so that single pages are found by few files."""
    pages.withColumn("range", F.floor(F.col("page_id") / 10_000)).repartition("range").sortWithinPartitions("page_id").write.mode(mode).partitionBy("range").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a table that df may read from: written beside it first, then swapped in.

    The old table is set aside before the new one takes its place, and deleted
    last: a crash leaves one of them whole, at `path` or at `path.old`.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    new, old, aside = (jvm.org.apache.hadoop.fs.Path(path + x) for x in (".new", "", ".old"))
    df.write.mode("overwrite").parquet(path + ".new")
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old):
        fs.delete(aside, True)
        if not fs.rename(old, aside):
            raise OSError(f"{path} could not be moved to {path}.old")
    if not fs.rename(new, old):
        raise OSError(f"{path}.new could not be moved to {path}")
    fs.delete(aside, True)


def write_by_language(mapping: dict[str, DataFrame], folder: str) -> None:
    """One table a language."""
    for lang, df in mapping.items():
        df.write.mode("overwrite").parquet(f"{folder}/{lang.lower()}-entities")
