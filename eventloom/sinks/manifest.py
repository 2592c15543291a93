"""Which stored batches count: a manifest per root that readers follow and writers switch at once.

A batch run, a stream batch or a compaction first writes its files, which nobody reads
yet. Then one new version of the manifest puts it in place of what it replaces, for all
its facts together. A run that breaks before that has changed nothing for readers, and one
that breaks behind it has nothing left to do but to tidy up.

Versions are files ``<root>/.manifest/<number>.json``, created under another name and renamed
to a number that must be free: of two writers one tries again on top of the other's version.
What was replaced stays on disk for readers that have begun, until ``tidy`` removes it.
It lists batches, not rows or files, so it stays small: compaction keeps a day at one.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from eventloom.schemas import BATCH, FACTS, SOURCE_DATE

_FOLDER = ".manifest"
#: Seconds that replaced files stay for readers that began before.
KEEP_SECONDS = 24 * 3600
_VERSIONS_KEPT = 20
#: The name of the folder of rows without a day.
UNDATED = "__HIVE_DEFAULT_PARTITION__"


def location(spark: SparkSession, target: str):
    """The file system of ``target`` and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


@dataclass
class Manifest:
    """``live``: the batches of each fact by day of the files; ``retired``: (fact, day, batch, since);
    ``streams``: the number of the last batch of each stream, by fact."""

    live: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    retired: list[tuple[str, str, str, float]] = field(default_factory=list)
    streams: dict[str, dict[str, int]] = field(default_factory=dict)
    version: int = -1

    def batches(self, fact: str, day: str) -> list[str]:
        return self.live.get(fact, {}).get(day, [])

    def follows(self, fact: str, query: str, number: int) -> bool:
        """Whether a batch of a stream has not been in place yet. Notes are kept of the last one, also where it is replaced."""
        return self.streams.get(fact, {}).get(query, -1) < number

    def note(self, fact: str, query: str, number: int) -> None:
        self.streams.setdefault(fact, {})[query] = number

    def put(self, fact: str, day: str, batches: list[str]) -> None:
        """Lets ``batches`` alone count for a day; what counted before is retired."""
        now = time.time()
        self.retired += [(fact, day, old, now) for old in self.batches(fact, day) if old not in batches]
        days = self.live.setdefault(fact, {})
        if batches:
            days[day] = batches
        else:
            days.pop(day, None)

    def retire(self, fact: str, day: str, batch: str) -> None:
        """Marks files that never counted for removal."""
        self.retired.append((fact, day, batch, time.time()))

    def condition(self, fact: str) -> Column:
        """On the partition columns of a stored fact: whether a row counts."""
        keys = [f"{day}/{batch}" for day, batches in sorted(self.live.get(fact, {}).items()) for batch in batches]
        if not keys:
            return F.lit(False)
        text = ", ".join("'" + key.replace("\\", "\\\\").replace("'", "\\'") + "'" for key in keys)
        return F.expr(f"concat(coalesce(cast({SOURCE_DATE} as string), '{UNDATED}'), '/', {BATCH}) IN ({text})")


def day_key(day) -> str:
    """A day as the manifest and the folders name it; rows of files without one have a name too."""
    return UNDATED if day is None else str(day)


def _versions(spark: SparkSession, root: str) -> list[tuple[int, object]]:
    files, folder = location(spark, f"{root.rstrip('/')}/{_FOLDER}")
    if not files.exists(folder):
        return []
    names = [status.getPath() for status in files.listStatus(folder)]
    return sorted(((int(p.getName()[:-5]), p) for p in names if p.getName()[:-5].isdigit()), key=lambda v: v[0])


def _read(spark: SparkSession, path) -> str:
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, target: str, text: str) -> bool:
    """Writes a file that must not be there yet; False if it is. It appears whole or not at all."""
    files, path = location(spark, target)
    _, draft = location(spark, f"{target.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = files.create(draft, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.makeQualified(path).toUri(), spark._jsc.hadoopConfiguration())
    over_nothing = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(path), over_nothing)
        return True
    except Exception as failure:  # noqa: BLE001 - told apart by the Java class
        files.delete(draft, False)
        if "FileAlreadyExists" in str(failure):
            return False
        raise


def latest_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and text of the newest version kept under ``root``, if there is one."""
    versions = _versions(spark, root)
    return (versions[-1][0], _read(spark, versions[-1][1])) if versions else None


def store_version(spark: SparkSession, root: str, number: int, text: str, keep: int) -> bool:
    """Makes ``text`` the version ``number``, unless there is one; of older ones ``keep`` stay."""
    if not _create(spark, f"{root.rstrip('/')}/{_FOLDER}/{number:020d}.json", text):
        return False
    for _, path in _versions(spark, root)[:-keep]:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    return True


def read_manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The newest version, or None for a root that no run of this kind has written."""
    newest = latest_version(spark, root)
    if newest is None:
        return None
    number, found = newest[0], json.loads(newest[1])
    return Manifest(found["live"], [tuple(r) for r in found["retired"]], found["streams"], number)


def _adopted(spark: SparkSession, root: str) -> Manifest:
    """All that lies in a root without a manifest."""
    found = Manifest()
    for fact in FACTS:
        files, pattern = location(spark, f"{root.rstrip('/')}/{fact}/{SOURCE_DATE}=*/date=*/{BATCH}=*")
        for status in files.globStatus(pattern) or []:
            batch, day = (p.getName().partition("=")[2] for p in (status.getPath(), status.getPath().getParent().getParent()))
            if batch not in found.batches(fact, day):
                found.live.setdefault(fact, {}).setdefault(day, []).append(batch)
    return found


def begin(spark: SparkSession, root: str) -> Manifest:
    """The manifest as it is before files are written: from now on they count only once they are committed."""
    return read_manifest(spark, root) or commit(spark, root, lambda manifest: None)


def commit(spark: SparkSession, root: str, change: Callable[[Manifest], None]) -> Manifest:
    """Applies ``change`` to the newest version and stores the next, again if another writer was faster."""
    while True:
        manifest = read_manifest(spark, root) or _adopted(spark, root)
        change(manifest)
        manifest.version += 1
        text = json.dumps({"live": manifest.live, "retired": manifest.retired, "streams": manifest.streams})
        if _create(spark, f"{root.rstrip('/')}/{_FOLDER}/{manifest.version:020d}.json", text):
            return manifest


def keep_inputs(spark: SparkSession, root: str, batch: str, files: list[dict]) -> None:
    """Stores beside the manifest which files a run has read, as (path, length, modified)."""
    _create(spark, f"{root.rstrip('/')}/{_FOLDER}/inputs-{batch}.json", json.dumps(files))


def inputs_of(spark: SparkSession, root: str, batch: str) -> list[dict]:
    """The files that a run has read."""
    return json.loads(_read(spark, location(spark, f"{root.rstrip('/')}/{_FOLDER}/inputs-{batch}.json")[1]))


def tidy(spark: SparkSession, root: str, keep_seconds: float = KEEP_SECONDS) -> int:
    """Removes the files of batches replaced longer ago than that, and old versions; returns how many batches.

    A batch leaves the manifest only when its files are gone, so a failure
    between the two is made up for by the next call.
    """
    manifest = read_manifest(spark, root)
    if manifest is None:
        return 0
    due = {tuple(r) for r in manifest.retired if r[3] <= time.time() - keep_seconds}
    for fact, day, batch, _ in due:
        files, pattern = location(spark, f"{root.rstrip('/')}/{fact}/{SOURCE_DATE}={day}/date=*/{BATCH}={batch}")
        for status in files.globStatus(pattern) or []:
            files.delete(status.getPath(), True)
    if due:
        def drop(newest: Manifest) -> None:
            newest.retired = [r for r in newest.retired if tuple(r) not in due]

        commit(spark, root, drop)
    for _, path in _versions(spark, root)[:-_VERSIONS_KEPT]:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    return len(due)
