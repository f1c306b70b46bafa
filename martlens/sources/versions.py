"""Numbered commits beside data: what readers see changes at once, and two writers never take one number.

A root has a ``_versions`` folder with one small JSON file a commit, numbered from 1. A writer first writes its
data into a folder of its own, under a name nobody else has, and then puts the next number's file in place, whole and
*only if it is absent* (a rename or link that does not replace). If another writer has it already, the commit is
computed again from what that writer left and tries the next number, so high-water marks (ids) that one
commit hands to the next never overlap. A file that is empty or cut short (a store without such a rename) was not
committed: readers skip it, and its number is not used again.

Readers resolve the highest version once and read its data folder; a replace adds a folder and a version and
deletes nothing, so a reader that is open, and a replace that is killed at any place, both see the old
table. ``expire`` removes folders that versions before the last few name, for a deployment's clean-up.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_END = "\n"
ATTEMPTS = 100


class Conflict(RuntimeError):
    """Another writer committed first, again and again."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place that was not there; False if it was. Of several callers, one gets True.

    The text is written under a hidden name first and gets its own name when it is whole, so a reader, and a
    stream over the folder, never see a part of it."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    hidden = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() != "file":  # a rename takes no name that is taken
            return fs.rename(hidden, p)
        local = [jvm.java.io.File(fs.makeQualified(x).toUri().getPath()).toPath() for x in (p, hidden)]
        try:  # a local rename replaces; a link does not
            jvm.java.nio.file.Files.createLink(*local)
            return True
        except Exception as e:
            cause = getattr(e, "java_exception", None)
            if cause is not None and "FileAlreadyExists" in cause.getClass().getName():
                return False
            raise
    finally:
        fs.delete(hidden, False)


def _read(spark: SparkSession, path) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Every number taken so far, committed or not, ascending."""
    fs, p = _fs(spark, f"{root}/_versions")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def entry(spark: SparkSession, root: str, number: int) -> dict | None:
    """What a version says; None if its file is not whole."""
    text = _read(spark, _file(root, number))
    return json.loads(text) | {"version": number} if text.endswith(_END) else None


def _file(root: str, number: int) -> str:
    return f"{root}/_versions/{number:020d}.json"


def committed(spark: SparkSession, root: str) -> list[dict]:
    """All versions, oldest first."""
    return [e for e in (entry(spark, root, n) for n in numbers(spark, root)) if e is not None]


def current(spark: SparkSession, root: str) -> dict | None:
    """The highest version."""
    return next((e for e in (entry(spark, root, n) for n in reversed(numbers(spark, root))) if e is not None), None)


def commit(spark: SparkSession, root: str, build: Callable[[dict | None], dict | None]) -> dict | None:
    """Add the version that ``build`` makes from the current one (None before the first); again from the new
    current one if another writer was faster. If it makes None, nothing is committed."""
    for _ in range(ATTEMPTS):
        taken = numbers(spark, root)
        new = build(current(spark, root))
        if new is None:
            return None
        number = (taken[-1] if taken else 0) + 1
        if create_if_absent(spark, _file(root, number), json.dumps(new, sort_keys=True) + _END):
            return new | {"version": number}
    raise Conflict(f"{root}: no free version after {ATTEMPTS} attempts")


def new_folder(root: str) -> str:
    """Where a writer puts data that no version names yet."""
    return f"{root.rstrip('/')}/data-{uuid.uuid4().hex}"


# --------------------------------------------------------------------------- a table that is replaced as a whole
def replace_table(df: DataFrame, root: str) -> int:
    """Write ``df`` beside the current data and make it the table in one step; returns its version."""
    folder = new_folder(root)
    df.write.parquet(folder)
    name = folder.rsplit("/", 1)[1]
    return commit(df.sparkSession, root, lambda _: {"data": name, "schema": df.schema.json()})["version"]


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the current one unless one is named; it stays that one for this frame."""
    found = current(spark, root) if version is None else entry(spark, root, version)
    if found is None:
        raise AnalysisException(f"{root} has no version{'' if version is None else f' {version}'}")
    return spark.read.schema(schema_of(found)).parquet(f"{root}/{found['data']}")


def schema_of(found: dict) -> StructType:
    return StructType.fromJson(json.loads(found["schema"]))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the data folders that only versions before the last ``keep`` name; returns their names."""
    entries = committed(spark, root)
    kept = {e["data"] for e in entries[-keep:]}
    old = sorted({e["data"] for e in entries[:-keep]} - kept)
    gone = []
    for name in old:
        fs, p = _fs(spark, f"{root}/{name}")
        if fs.exists(p):
            fs.delete(p, True)
            gone.append(name)
    return gone
