"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import itertools
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are maximal runs of characters other than space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

_SEQ = itertools.count()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its own;
    a cluster without it raises, as its executors could not read each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    own = tempfile.mkdtemp(prefix="tidemark-llm-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under this application's id."""
    return f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{next(_SEQ)}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *staged: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in staged:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that working columns clash with none of them."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def word_count(text: Column) -> Column:
    """Words of a text (null: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most ``rows`` rows: a Python worker then holds few texts at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= rows:
        df.sparkSession.conf.set(name, str(rows))
    return df


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """Work that makes many small objects and no reference cycles, without Python's searches for such cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def release_memory() -> None:
    """Give back what a task's large objects held: Python workers live on, and keep freed memory otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not the GNU C library
        pass


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *forget: Callable[[], None]):
    """``work`` for ``mapInArrow``; at the end of its task caches are cleared by ``forget`` and memory given back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        for clear in forget:
            clear()
        release_memory()
    return run
