"""Outputs that are there as a whole or not at all: a staged folder, a manifest of its parts, one rename.

``publish`` writes beside the target, lists what was written, and only then puts the folder in place; what was there before is moved aside first and removed
last. A write that dies leaves the old output as it was (and a staged folder, which the next write to the target removes). A rename of a folder is
one step on HDFS and on local disks; an object store copies, so there the manifest, which is checked part by part, tells a whole output from a torn one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_manifest"


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def _parts(spark: SparkSession, path: str) -> dict[str, int]:
    """Relative name and size of every data file below ``path``."""
    target, fs = _path(spark, path)
    root = fs.makeQualified(target).toString().rstrip("/")
    found, out = fs.listFiles(target, True), {}
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString()[len(root) + 1 :]
        if not any(p.startswith(("_", ".")) and "=" not in p for p in name.split("/")):
            out[name] = f.getLen()
    return out


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """``files``, name and bytes of each part, of a published output; None if there is no manifest."""
    target, fs = _path(spark, f"{path}/{MANIFEST}")
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def finished(spark: SparkSession, path: str) -> bool:
    """Whether an output is whole: every part of its manifest is there in its size, and no other. Outputs without a manifest count by the mark that Spark
    leaves at the end of a write."""
    listed = read_manifest(spark, path)
    if listed is None:
        return exists(spark, f"{path}/_SUCCESS")
    return _parts(spark, path) == listed["files"]


def assert_complete(spark: SparkSession, path: str) -> str:
    """The path, for a reader, if the output is whole."""
    if not finished(spark, path):
        raise FileNotFoundError(f"no whole output in {path}")
    return path


def _aside(path: str, kind: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}.{kind}"


def _siblings(spark: SparkSession, path: str, kind: str) -> list:
    target, fs = _path(spark, f"{_aside(path, kind)}-*")
    return [s.getPath() for s in (fs.globStatus(target) or [])]


def recover(spark: SparkSession, path: str) -> None:
    """Put the tree of ``path`` in order after a write that died: an output that was moved aside comes back if nothing took its place, leftovers go."""
    target, fs = _path(spark, path)
    for old in _siblings(spark, path, "old"):
        if fs.exists(target):
            fs.delete(old, True)
        else:
            fs.rename(old, target)
    for staged in _siblings(spark, path, "staged"):
        fs.delete(staged, True)


def publish(df: DataFrame, path: str, fmt: str, if_exists: str = "overwrite", partition_by: tuple[str, ...] = (), **options) -> bool:
    """Write ``df`` to ``path`` as a whole. ``if_exists``: ``overwrite``; ``skip`` (leave a whole output alone, write a torn one again); ``error``.
    Returns whether something was written. One writer at a time per path."""
    spark = df.sparkSession
    recover(spark, path)
    target, fs = _path(spark, path)
    if fs.exists(target):
        if if_exists == "skip" and finished(spark, path):
            return False
        if if_exists == "error":
            raise FileExistsError(path)
    tag = uuid.uuid4().hex
    staged, old = f"{_aside(path, 'staged')}-{tag}", f"{_aside(path, 'old')}-{tag}"
    df.write.format(fmt).options(**options).partitionBy(*partition_by).save(staged)
    listed = {"files": _parts(spark, staged)}
    out = fs.create(_path(spark, f"{staged}/{MANIFEST}")[0])
    out.write(bytearray(json.dumps(listed).encode()))
    out.close()
    if fs.exists(target) and not fs.rename(target, _path(spark, old)[0]):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(_path(spark, staged)[0], target):
        recover(spark, path)
        raise OSError(f"cannot put {path} in place")
    recover(spark, path)
    return True
