"""Committed output: readers see whole versions only.

A writer puts its files aside, in a folder of their own, and publishes them with one small
manifest (schema, row count, file names and lengths, a hash of what they were made
from).  Readers follow the newest whole manifest.  A writer that ends midway leaves
files that no manifest names, so the version before stays readable; overwriting never
removes what a reader may be reading (:func:`vacuum` does, when told to).

Manifests are numbered; a number is claimed by creating its file, which fails if it
exists, so two writers never share one.  A manifest cut off midway does not end in
its mark and is passed over.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_MANIFESTS, _DATA = "_manifests", "data"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def spec_hash(spec: object) -> str:
    """Digest of a description (a dataclass, a mapping, text) by its text."""
    return hashlib.sha256(repr(spec).encode()).hexdigest()


def files_of(spark: SparkSession, path: str) -> dict[str, int]:
    """Name (below ``path``) and length of every data file, marks of writers left out."""
    p, fs = _fs(spark, path)
    root = str(fs.makeQualified(p).toString()).rstrip("/") + "/"
    out, it = {}, fs.listFiles(p, True)
    while it.hasNext():
        s = it.next()
        name = str(s.getPath().toString()).removeprefix(root)
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            out[name] = int(s.getLen())
    return out


def _numbers(spark: SparkSession, root: str) -> list[int]:
    p, fs = _fs(spark, f"{root}/{_MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [str(s.getPath().getName()) for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, root: str, number: int) -> dict | None:
    path = f"{root}/{_MANIFESTS}/{number:010d}.json"
    rows = spark.read.option("wholetext", "true").text(path).collect()
    try:
        found = json.loads(rows[0].value if rows else "")
    except ValueError:
        return None
    return found if found.get("end") is True else None


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The newest whole manifest, or that of ``number``; None if there is none."""
    root = root.rstrip("/")
    for n in reversed(_numbers(spark, root) if number is None else [number]):
        if found := _load(spark, root, n):
            return {**found, "number": n}
    return None


def publish(spark: SparkSession, root: str, content: Mapping[str, object]) -> int:
    """Publish a manifest under the next free number, which is returned."""
    root = root.rstrip("/")
    text = json.dumps({**content, "end": True}, sort_keys=True)
    number = max(_numbers(spark, root), default=0) + 1
    while True:
        p, fs = _fs(spark, f"{root}/{_MANIFESTS}/{number:010d}.json")
        try:
            out = fs.create(p, False)           # fails if another writer has the number
        except Exception as e:
            if not fs.exists(p):
                raise e
            number += 1
            continue
        out.write(bytearray(text.encode()))
        out.close()
        return number


def new_version(root: str) -> str:
    """A fresh folder below ``root`` for a version's files."""
    return f"{root.rstrip('/')}/{_DATA}/{uuid.uuid4().hex}"


def commit(df: DataFrame, root: str, fmt: str = "parquet", mode: str = "errorifexists",
           spec: object = None, partition_by: list[str] | None = None,
           options: Mapping[str, str] | None = None) -> dict:
    """Write ``df`` aside and publish it; returns the manifest.

    ``mode``: "errorifexists" raises where a version is published, "overwrite" publishes
    the next one.  ``spec`` is hashed into the manifest.
    """
    spark = df.sparkSession
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "errorifexists" and manifest(spark, root):
        raise FileExistsError(f"{root} has a published version")
    path = new_version(root)
    w = df.write.format(fmt).options(**(options or {}))
    (w.partitionBy(*partition_by) if partition_by else w).save(path)
    content = {"path": path, "format": fmt, "schema": df.schema.json(),
               "options": dict(options or {}), "spec": spec_hash(spec),
               "files": files_of(spark, path)}
    content["rows"] = _open(spark, content).count()
    return {**content, "number": publish(spark, root, content)}


def _open(spark: SparkSession, found: Mapping) -> DataFrame:
    schema = StructType.fromJson(json.loads(found["schema"]))
    return (spark.read.format(found["format"]).options(**found["options"]).schema(schema)
            .load(found["path"]).select(*schema.fieldNames()))


def check_files(spark: SparkSession, found: Mapping) -> None:
    """Raise if files of a version are missing or of another length."""
    there = files_of(spark, found["path"])
    if bad := sorted(n for n, size in found["files"].items() if there.get(n) != size):
        raise OSError(f"{found['path']}: missing or changed files {bad[:5]}")


def read_committed(spark: SparkSession, root: str, number: int | None = None,
                   spec: object = None) -> DataFrame:
    """The newest published version (or ``number``), with the schema it was written with.

    Raises if nothing is published, if its files are not those of the manifest, or if
    ``spec`` is given and is not what it was made from.
    """
    found = manifest(spark, root, number)
    if not found:
        raise FileNotFoundError(f"{root} has no published version")
    if spec is not None and found["spec"] != spec_hash(spec):
        raise ValueError(f"{root}: made from another specification")
    check_files(spark, found)
    return _open(spark, found)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove the files of all but the newest ``keep`` published versions, and of writers
    that never published; returns the folders removed.  Readers of them fail, so call it
    when there are none, nor writers."""
    root = root.rstrip("/")
    kept = [m["path"].rsplit("/", 1)[-1] for n in _numbers(spark, root)
            if (m := _load(spark, root, n))][-keep:]
    p, fs = _fs(spark, f"{root}/{_DATA}")
    gone = []
    for s in fs.listStatus(p) if fs.exists(p) else ():
        if str(s.getPath().getName()) not in kept:
            fs.delete(s.getPath(), True)
            gone.append(str(s.getPath().getName()))
    return gone
