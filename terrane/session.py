"""Session construction and shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"


def build_session(app: str = "terrane", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for (UTC, AQE with skew splitting)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Hand the package to the Python workers of this application, once; needed where they do not have it on their path.
    The archive is built for the upload only; Spark serves it to the executors itself."""
    if spark.conf.get("terrane.shipped", None) == spark.sparkContext.applicationId:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="terrane-ship-")) / "terrane.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, str(Path("terrane") / path.relative_to(package)))
    spark.sparkContext.addPyFile(str(archive))
    spark.conf.set("terrane.shipped", spark.sparkContext.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share. A cluster names it in ``spark.checkpoint.dir``; only where
    that is unset and the session runs on one machine (tests) a local folder is made and recorded there; a cluster
    without a shared folder is an error."""
    root = spark.conf.get(SCRATCH_CONF, None) or _java_conf(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"{SCRATCH_CONF} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="terrane-scratch-")
        spark.conf.set("terrane.scratch", root)
    return root.rstrip("/")


def _java_conf(spark: SparkSession) -> str | None:
    conf = spark.sparkContext.getConf().get(SCRATCH_CONF)
    return conf or spark.conf.get("terrane.scratch", None)


class Scratch:
    """Tables written to the shared folder to cut lineage; they survive the loss of executors.

    ``put`` writes a frame and returns it read back; ``drop`` deletes the ones no longer needed.
    """

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark = spark
        self.base = f"{scratch_root(spark)}/terrane/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        remove(self.spark, f"{self.base}/{name}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables this application has written with :class:`Scratch`; results read from them must be stored before."""
    remove(spark, f"{scratch_root(spark)}/terrane/{spark.sparkContext.applicationId}")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark can reach."""
    where, system = _file_system(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where, system = _file_system(spark, path)
    system.delete(where, True)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of a file or of the files of a folder."""
    where, system = _file_system(spark, path)
    found = system.globStatus(where)
    files = [f for one in (found or []) for f in (system.listStatus(one.getPath()) if one.isDirectory() else [one])]
    return sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    where, system = _file_system(spark, path)
    out = system.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
