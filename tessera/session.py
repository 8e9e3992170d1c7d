"""Session and shared-folder helpers."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "tessera", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "6g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``.

    Only where that is unset (a local test session) a temporary folder is made and set.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="tessera-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_SHIPPED: set[str] = set()
_WRITTEN: dict[str, list[str]] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, unless they find it by themselves."""
    app, home = spark.sparkContext.applicationId, Path(__file__).resolve().parents[1]
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    seen = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home in seen or (spark.sparkContext.master.startswith("local[") and Path.cwd().resolve() == home):
        return
    folder = shared_dir(spark).removeprefix("file://")
    folder = folder if os.path.isdir(folder) else tempfile.gettempdir()  # the driver serves the file from here
    path = f"{folder}/tessera-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(Path(__file__).parent.rglob("*.py")):
            z.write(f, f.relative_to(home))
    spark.sparkContext.addPyFile(path)


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it is proven to have ``most`` rows at most; else as it is, joined by shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which ``clear`` deletes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def persisted(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: it is there under its name only once it is complete. The name must be new."""
    fs, target = _file_system(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)


def newest_text(spark: SparkSession, pattern: str) -> str | None:
    """The content of the last file (by name) that a path pattern matches, null if none."""
    fs, p = _file_system(spark, pattern)
    found = sorted(f.getPath().toString() for f in fs.globStatus(p) or [])
    if not found:
        return None
    stream = fs.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found[-1]))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def fingerprint(df: DataFrame) -> str:
    """A name for the files that a table is read from: their names, sizes and times of change."""
    spark, seen = df.sparkSession, []
    for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
        fs, p = _file_system(spark, folder)
        seen += [f"{folder}/{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in fs.listStatus(p)]
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()


def clear(spark: SparkSession) -> int:
    """Delete what this application wrote with ``persisted``, once its results are no longer needed; returns how many."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        fs, p = _file_system(spark, path)
        fs.delete(p, True)
    return len(paths)


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Rebalance an input of few splits before a CPU-bound Python stage.

    A large table has more splits than cores and is left as it is (no shuffle).
    """
    ship(df.sparkSession)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * per_core) if df.rdd.getNumPartitions() < cores else df
