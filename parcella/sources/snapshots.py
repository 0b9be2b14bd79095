"""Tables that are replaced as a whole, so that a reader sees one version or the other.

A version is a folder of its own that is never written again. Once it is complete, a small
pointer file is written beside its place and renamed over the old one, which is the commit;
file systems replace a file by rename in one step. A run that dies before it leaves the old
version in use, and one that reads follows the pointer once and keeps its folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "current.json"  # Spark does not read files whose names begin with _ or .
VERSIONS = "versions"


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, function that makes its paths) for a path or URI."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at(path))


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or absent: written beside its place, then renamed over it."""
    fs, at = _fs(spark, path)
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    out = fs.create(at(beside), True)
    out.write(text.encode())
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(at(beside), at(path), overwrite)


def read_small(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None if it is absent."""
    if not exists(spark, path):
        return None
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def current(spark: SparkSession, root: str) -> dict | None:
    """What the pointer says: ``version``, ``folder`` and what the writer noted."""
    text = read_small(spark, f"{root}/{POINTER}")
    return json.loads(text) if text else None


def commit(
    spark: SparkSession, root: str, write: Callable[[str], dict | None], version: str
) -> dict:
    """Have ``write`` fill a fresh folder, then point ``root`` at it.

    ``write`` gets the folder and may return notes for the pointer. Two commits at once
    write to different folders; the later rename wins whole.
    """
    folder = f"{VERSIONS}/{version}-{uuid.uuid4().hex[:12]}"
    notes = write(f"{root}/{folder}") or {}
    pointer = {"version": version, "folder": folder, **notes}
    write_small(spark, f"{root}/{POINTER}", json.dumps(pointer))
    return pointer


def replace(df: DataFrame, root: str, version: str) -> dict:
    """Commit ``df`` as the Parquet table at ``root``."""
    return commit(df.sparkSession, root, lambda folder: df.write.parquet(folder), version)


def table(spark: SparkSession, root: str) -> DataFrame:
    """The committed table at ``root``, of one version however long the reader takes."""
    found = current(spark, root)
    if found is None:
        raise FileNotFoundError(f"nothing was committed at {root}")
    return spark.read.parquet(f"{root}/{found['folder']}")


def forget(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest versions, never the one in use; names of those gone."""
    fs, at = _fs(spark, root)
    if not fs.exists(at(f"{root}/{VERSIONS}")):
        return []
    found = sorted(
        (s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(at(f"{root}/{VERSIONS}"))
    )
    used = (current(spark, root) or {}).get("folder", "").removeprefix(f"{VERSIONS}/")
    gone = [name for _, name in found[: max(0, len(found) - keep)] if name != used]
    for name in gone:
        fs.delete(at(f"{root}/{VERSIONS}/{name}"), True)
    return gone


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder, its new parent made if need be; the target must be free."""
    fs, at = _fs(spark, target)
    fs.mkdirs(at(target).getParent())
    if fs.exists(at(target)) or not fs.rename(at(source), at(target)):
        raise RuntimeError(f"{source} could not become {target}")


def glob_count(spark: SparkSession, pattern: str) -> int:
    """Number of paths that match."""
    fs, at = _fs(spark, pattern)
    return len(fs.globStatus(at(pattern)) or [])


def ordinal(spark: SparkSession, folder: str) -> int:
    """Number of folders in ``folder`` so far: a name for the next that sorts after them."""
    return glob_count(spark, f"{folder}/*=*")
