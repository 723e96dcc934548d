"""Session helpers: shared checkpoint folder, reads, shipping of the package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "sparkloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the workers, once a context, so that their Python can import what functions refer to."""
    sc = spark.sparkContext
    if getattr(sc, "_sparkloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    # the driver serves this file to executors for the life of the context
    archive = Path(tempfile.mkdtemp(prefix="sparkloom-code-"), "sparkloom_package.zip")
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    sc.addPyFile(str(archive))
    sc._sparkloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` where the cluster names one,
    else (tests, a single machine) a fresh temporary folder that is kept for the session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return str(current.get())
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sparkloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = "file://" + folder
        spark.sparkContext.setCheckpointDir(named)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path for a table written to the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this session wrote, on whatever file system it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def full_path(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system."""
    p, fs = _fs(spark, path)
    return fs.makeQualified(p).toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file on whatever file system the path names; parent folders are made."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()


def replace_path(spark: SparkSession, new: str, old: str) -> None:
    """Renames ``new`` to ``old``, replacing it in one step."""
    p, fs = _fs(spark, new)
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(p), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(old)), options)


def materialise(df: DataFrame, label: str, partition: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by ``partition`` if given, and read it again; cuts lineage and survives a
    lost executor."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
