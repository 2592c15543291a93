"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Rows handed to Python at once: rows are whole texts here, and Spark's default is 10,000.
ARROW_ROWS = 1_000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes handed over at once, about: a batch of long texts is cut sooner.
ARROW_BYTES = 8 << 20
_ARROW_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()
_kept: dict[str, tuple[Hashable, object]] = {}
_Kept = TypeVar("_Kept")


def keep(kind: str, key: Hashable, make: Callable[[], _Kept]) -> _Kept:
    """What ``make`` gives, kept by a Python worker from task to task under ``key``.

    Workers outlive stages. One thing is kept at a time: whatever stage comes next
    lets go of the models and tables of the one before.
    """
    if kind not in _kept or _kept[kind][0] != key:
        _kept.clear()
        give_back()
        _kept[kind] = (key, make())
    return _kept[kind][1]


def let_go() -> None:
    """Ends what ``keep`` holds, for stages that keep nothing themselves."""
    if _kept:
        _kept.clear()
        give_back()


def give_back() -> None:
    """Returns freed memory to the system, which a long-lived worker would hold on to."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def prepare(spark: SparkSession) -> None:
    """Readies a session for operators that run Python: small batches, and this package on the executors.

    The package is sent as ``--py-files`` does, from the driver and once per
    application, unless it was itself loaded from an archive: then it has been
    submitted with the job. Smaller batches that the session asks for are kept.
    """
    if not 0 < int(spark.conf.get(_ARROW)) <= ARROW_ROWS:
        spark.conf.set(_ARROW, str(ARROW_ROWS))
    if not 0 < _bytes(spark.conf.get(_ARROW_SIZE)) <= ARROW_BYTES:
        spark.conf.set(_ARROW_SIZE, str(ARROW_BYTES))
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="llm-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def _bytes(setting: str) -> int:
    """A size as Spark tells it, such as ``268435456B``; -1 if it has another form."""
    digits = setting.rstrip("bB")
    return int(digits) if digits.lstrip("-").isdigit() else -1


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session that names none, such as one in a test, gets a temporary
    folder of its own. On a cluster executors would not see it: that is refused.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {_SETTING} to a folder that the cluster shares")
        root = f"file://{tempfile.mkdtemp(prefix='llm-stage-')}"
        spark.conf.set(_SETTING, root)
    return root.rstrip("/")


def stage(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs at most the tasks of one stage. The
    folder has a name of its own and goes when the session's JVM ends.
    """
    spark = rows.sparkSession
    target = f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    rows.write.parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run meanwhile hand Python at most ``rows`` rows at once: for rows of several kilobytes each."""
    before = spark.conf.get(_ARROW)
    spark.conf.set(_ARROW, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ARROW, before)
