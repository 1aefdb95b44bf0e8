"""Session settings the library relies on, and where its scratch files go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"

#: Scratch folders made inside ``scratch_noted``, innermost last.
_made: list[list[str]] = []


def local_session(cpus: str | int = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own.

    Without a checkpoint folder it gets one of its own, deleted when the process ends.
    """
    if CHECKPOINT_DIR not in conf:
        conf[CHECKPOINT_DIR] = tempfile.mkdtemp(prefix="stateline-")
        atexit.register(shutil.rmtree, conf[CHECKPOINT_DIR], ignore_errors=True)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stateline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session, else under its warehouse."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_scratch"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for noted in _made:
        noted.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the scratch folder: what made it runs once, whatever reads it later.

    Lost executors cost a re-read. The folder lives as long as the checkpoint folder does, or as the
    ``scratch_deleted`` block around the call.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    """The folder for Spark's file systems, and the one it is in."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, system = _folder(spark, path)
    return system.exists(found)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such folder."""
    found, system = _folder(spark, path)
    return [status.getPath().getName() for status in system.listStatus(found)] if system.exists(found) else []


def modified(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of the files and folders in a folder, with the second of their last change."""
    found, system = _folder(spark, path)
    if not system.exists(found):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in system.listStatus(found)}


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    found, system = _folder(spark, path)
    stream = system.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> bool:
    """A small file, there as a whole or not at all; False, and nothing changed, if there is one of that name.

    It is written under another name and renamed, which file systems do in one step.
    """
    jvm = spark.sparkContext._jvm
    found, system = _folder(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(found.getParent(), f"_{uuid.uuid4().hex}")
    system.mkdirs(found.getParent())
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    no_overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    no_overwrite[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(found.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(found), no_overwrite)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    found, system = _folder(spark, path)
    system.delete(found, True)


@contextmanager
def scratch_noted() -> Iterator[list[str]]:
    """A list of the scratch folders made in the block."""
    _made.append([])
    try:
        yield _made[-1]
    finally:
        _made.pop()


@contextmanager
def scratch_deleted(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the scratch folders made in it: for steps that end in tables of their own."""
    with scratch_noted() as made:
        try:
            yield
        finally:
            for path in made:
                delete(spark, path)
