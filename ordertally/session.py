"""Session helpers: local builder for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every report run relies on; a cluster may already have them.
# forceOptimizeSkewedJoin lets AQE split a hot order id in the shuffled
# order-line join even though the per-order aggregate above it then needs
# one more (partially aggregated, hence small) exchange.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ordertally") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_recommended(spark: SparkSession) -> None:
    """Set the recommended settings that the session does not set already."""
    for k, v in RECOMMENDED_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is.  A
    local session without it gets a scratch folder; elsewhere that would be
    another folder on every machine, so it is refused.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ordertally-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def _on_file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate or replaced files, wherever it lies."""
    fs, at = _on_file_system(spark, path)
    fs.delete(at, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _on_file_system(spark, path)
    return fs.exists(at)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder or file; fails if the file system refuses."""
    fs, at = _on_file_system(spark, source)
    if not fs.rename(at, _on_file_system(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replaced if it is there."""
    fs, at = _on_file_system(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None without one."""
    fs, at = _on_file_system(spark, path)
    if not fs.exists(at):
        return None
    source = fs.open(at)
    try:
        size = fs.getFileStatus(at).getLen()
        return bytes(b & 0xFF for b in source.readNBytes(int(size))).decode()
    finally:
        source.close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables inside the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
