"""Tables replaced part by part, where readers see whole commits only.

Rows go into a folder of their own version, which nobody reads yet; a list then says in which
version each part (a value of the key column) stands, and last one small file under the next
commit number appears by a rename. Whatever ends the job before that leaves the last
commit as it was, and a part that is written again without rows is empty afterwards. Two
writers cannot both take one number: the later one fails and keeps nothing.

Each commit also holds the schemas its versions were written with, so that columns may be
added and widened between them; reading gives all rows in the newest schema.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow import schemas
from evalflow.sinks.tables import write_table

_COMMITS, _ENTRIES, _VERSION, _SCHEMA = "_commits", "_entries", "version", "schema_id"


class CommitConflict(RuntimeError):
    """Another writer has taken the commit number."""


@dataclass(frozen=True)
class Snapshot:
    """One commit: its number, where the list of parts lies, and the schemas in use."""

    number: int = -1
    entries: str | None = None
    #: Of each table every schema that some version has, oldest first.
    tables: Mapping[str, list[str]] = field(default_factory=dict)
    #: Whatever else the writer keeps from commit to commit, as text.
    notes: Mapping[str, str] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def current(spark: SparkSession, root: str) -> Snapshot:
    """The last commit, or one without parts."""
    fs, folder = _files(spark, f"{root}/{_COMMITS}")
    if not fs.exists(folder):
        return Snapshot()
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    names = sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))
    if not names:
        return Snapshot()
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(folder, names[-1]))
    try:
        return Snapshot(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def parts(spark: SparkSession, root: str, key: str = "slug", at: Snapshot | None = None) -> DataFrame:
    """``(key, version, schema_id)`` of every part of a commit, the last one by default."""
    at = at or current(spark, root)
    schema = f"`{key}` string, {_VERSION} string, {_SCHEMA} int"
    return spark.read.schema(schema).parquet(f"{root}/{at.entries}") if at.entries else spark.createDataFrame([], schema)


def commit(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    replaced: DataFrame,
    *,
    key: str = "slug",
    notes: Mapping[str, str] | None = None,
    before: Snapshot | None = None,
) -> Snapshot:
    """Replace the parts named in ``replaced`` by the rows of ``tables``, all in one commit.

    Every row's key must be among those. ``before`` is the commit that the rows rest on;
    when another has come since, this one fails with :class:`CommitConflict`.
    """
    before = before or current(spark, root)
    number = before.number + 1
    version = f"{number:012d}-{uuid.uuid4().hex[:12]}"
    known = {name: list(old) for name, old in before.tables.items()}
    for name, rows in tables.items():
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name != key]).json()
        # the newest schema stands last; an older one that is written again counts as new
        known[name] = known.get(name, [])
        if not known[name] or known[name][-1] != plain:
            known[name].append(plain)
    # tables of one commit share their places in the lists: shorter lists repeat their last
    longest = max(map(len, known.values()))
    known = {name: old + old[-1:] * (longest - len(old)) for name, old in known.items()}
    for name, rows in tables.items():
        write_table(rows, f"{root}/{name}/{_VERSION}={version}", partition_by=(key,))
    mine = replaced.select(F.col(key).cast("string")).distinct()
    listed = parts(spark, root, key, before).join(mine, key, "left_anti").unionByName(
        mine.withColumns({_VERSION: F.lit(version), _SCHEMA: F.lit(longest - 1)})
    )
    write_table(listed, f"{root}/{_ENTRIES}/{version}")
    done = Snapshot(number, f"{_ENTRIES}/{version}", known, dict(before.notes) | dict(notes or {}))
    _publish(spark, root, done, version)
    return done


def _publish(spark: SparkSession, root: str, done: Snapshot, version: str) -> None:
    fs, draft = _files(spark, f"{root}/{_COMMITS}/_{version}.draft")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{_COMMITS}/{done.number:012d}.json")
    stream = fs.create(draft)
    stream.write(json.dumps(done.__dict__).encode())
    stream.close()
    # a rename onto a file that is there fails; some local file systems replace it, so look first
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise CommitConflict(f"commit {done.number} of {root} is taken")


def read(spark: SparkSession, root: str, name: str, *, key: str = "slug", at: Snapshot | None = None) -> DataFrame:
    """All rows of a table as of a commit, in its newest schema, with the key column.

    Files of versions with one schema are read together; only the parts that the commit
    lists are kept, which prunes the folders that are opened.
    """
    at = at or current(spark, root)
    if name not in at.tables:
        raise FileNotFoundError(f"no committed table {name} in {root}")
    listed = parts(spark, root, key, at)
    versions: dict[str, list[str]] = {}
    for row in listed.select(_VERSION, _SCHEMA).distinct().collect():
        versions.setdefault(at.tables[name][row[_SCHEMA]], []).append(row[_VERSION])
    newest = schemas.from_json_text(at.tables[name][-1])
    out = spark.createDataFrame([], T.StructType([*newest.fields, T.StructField(key, T.StringType())]))
    for text, some in versions.items():
        own = schemas.from_json_text(text)
        stored = T.StructType([*own.fields, T.StructField(_VERSION, T.StringType()), T.StructField(key, T.StringType())])
        fs, _ = _files(spark, root)
        paths = [f"{root}/{name}/{_VERSION}={v}" for v in sorted(some)]
        paths = [p for p in paths if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p))]
        if paths:
            rows = spark.read.schema(stored).option("basePath", f"{root}/{name}").parquet(*paths)
            rows = rows.join(listed.select(_VERSION, key), [_VERSION, key], "left_semi").drop(_VERSION)
            out = out.unionByName(schemas.cast_to(rows, newest))
    return out


def discard_old(spark: SparkSession, root: str, *, keep: int = 2, key: str = "slug") -> list[str]:
    """Remove versions that none of the last ``keep`` commits lists; gives their folders.

    Not while a writer is at work: its version is not listed yet.
    """
    fs, folder = _files(spark, f"{root}/{_COMMITS}")
    last = current(spark, root)
    live: set[str] = set()
    for number in range(max(0, last.number - keep + 1), last.number + 1):
        stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}.json"))
        old = Snapshot(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        stream.close()
        live |= {r[_VERSION] for r in parts(spark, root, key, old).select(_VERSION).distinct().collect()}
        live.add(old.entries.rsplit("/", 1)[-1])
    gone = []
    for name in [*last.tables, _ENTRIES]:
        for status in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")):
            if status.getPath().getName().removeprefix(f"{_VERSION}=") not in live:
                gone.append(status.getPath().toString())
                fs.delete(status.getPath(), True)
    return gone
