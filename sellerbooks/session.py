"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark, with a stage folder of its own; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sellerbooks")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", own_folder())
        .getOrCreate()
    )


def own_folder() -> str:
    """A folder for the stages of one process on one machine, removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="sellerbooks-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def configured_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def on_one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; a local cluster is not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names, which every executor can reach."""
    folder = configured_folder(spark)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder


def stage_folder(spark: SparkSession) -> str:
    """Where this application's stages are written; the application owns the folder."""
    return f"{shared_folder(spark).rstrip('/')}/sellerbooks/{spark.sparkContext.applicationId}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def table_folder(spark: SparkSession) -> str:
    """A new folder among this application's stages for a table that lives as long as they do."""
    return f"{stage_folder(spark)}/table-{uuid.uuid4().hex}"


def remove_stages(spark: SparkSession) -> None:
    """Delete the stages this application has written, once no result needs them."""
    _delete(spark, stage_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package, once an application, to executors that do not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_sellerbooks_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="sellerbooks-code-")) / "sellerbooks-code.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    context._sellerbooks_shipped = True


#: Spark's switch that removes the shuffle files of a query when it ends, not when the driver's memory is cleared.
_CLEAR = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Queries begun in here leave no shuffle files behind; the session's own setting is put back."""
    before = spark.conf.get(_CLEAR, None)
    spark.conf.set(_CLEAR, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAR) if before is None else spark.conf.set(_CLEAR, before)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but keeps the data columnar, so
    later reads prune columns and know the size of what they read. Stages are packed
    with zstd: texts take a third less room than with the default. The shuffles of the
    write are gone when it ends.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{uuid.uuid4().hex}"
    _write_stage(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _write_stage(df: DataFrame, path: str) -> None:
    with shuffles_cleared(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)


@contextlib.contextmanager
def passing_stages(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``materialise`` for stages that are deleted at the end; what is made of them must be written by then."""
    folder = table_folder(spark)

    def stage(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        _write_stage(df, path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        _delete(spark, folder)


def unstaged(df: DataFrame) -> DataFrame:
    """Stands for a stage where a plan is to stay one query."""
    return df
