"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_KEY = "premiere.scratch.dir"


def local_session(cpus: int | str = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("premiere")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="premiere-warehouse-"))
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one named in spark.checkpoint.dir.

    Only a local-mode session, whose executors share this machine, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = spark.conf.get(_SCRATCH_KEY, None)
    if not own:
        own = tempfile.mkdtemp(prefix="premiere-")
        spark.conf.set(_SCRATCH_KEY, own)
    return own


class _Scopes(threading.local):
    """Per thread: the paths handed out inside each open scratch_scope."""

    def __init__(self) -> None:
        self.paths: list[list[str]] = []


_scopes = _Scopes()


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes.paths:
        _scopes.paths[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Drop the stages this thread writes inside the block; for jobs that run without end."""
    _scopes.paths.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _scopes.paths.pop():
            spark.sql(f"DROP TABLE IF EXISTS `{path.rsplit('/', 1)[1].replace('-', '_')}`")
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


@contextmanager
def outside_scopes() -> Iterator[None]:
    """Stages written inside the block are kept, whatever scratch_scope is open around it."""
    _scopes.paths.append([])
    try:
        yield
    finally:
        _scopes.paths.pop()


def materialise(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write a stage once and go on from the written table.

    The copy is columnar, survives lost executors and has known sizes, so later joins are
    planned from real statistics. With `by` it is written in buckets of that column, so what is
    grouped, windowed or joined by it later is not shuffled again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if by is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = path.rsplit("/", 1)[1].replace("-", "_")
    # Rows that lie by the column already, in as many partitions, are not shuffled for it.
    dealt = df.repartition(buckets, by).write.bucketBy(buckets, by)
    dealt.format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)
