"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def local_session(cpus: int = 8, shuffle_partitions: int = 8, app: str = "tesserae") -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset (tests), a fresh local one is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.tesserae.sharedFolder", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tesserae-")
        spark.conf.set("spark.tesserae.sharedFolder", folder)
    return folder.rstrip("/")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once an application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        home = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="tesserae-code-")  # on the driver only; Spark hands the file out
        atexit.register(shutil.rmtree, folder, True)
        shutil.copytree(home, f"{folder}/code/{home.name}", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{home.name}", "zip", f"{folder}/code"))


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:
        pass  # the session is gone; the folder's owner clears it


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, name: str, **sums: Column) -> DataFrame:
    """Cut the lineage by a written table in the shared folder.

    The files outlive any executor, unlike cached blocks; they are removed when
    the driver's Python ends, or before by drop_materialized. sums are taken
    as the rows are written, without a job of their own: see written_sums.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    seen = Observation()
    if sums:
        df = df.observe(seen, *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in sums.items()])
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tesserae_path = path
    out._tesserae_sums = seen.get if sums else {}
    return out


def written_sums(df: DataFrame) -> dict[str, int]:
    """The sums that materialize took of a table's rows."""
    return df._tesserae_sums


def drop_materialized(*frames: DataFrame) -> None:
    """Delete tables of materialize that no later plan reads."""
    for df in frames:
        path = getattr(df, "_tesserae_path", None)
        if path:
            _remove(df.sparkSession, path)
