"""Lines of JSONL members inside tar.gz archives, as a data source that SQL can use."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from evalflow.functions.paths import ARCHIVE_PATH, archive_parts, member_parts
from evalflow.sources.files import Roots, discover, folders

FORMAT = "archive_lines"
SCHEMA = "path string, member string, line_no long, line string, data string, params string, seed int"


def list_archives(
    spark: SparkSession, root: Roots, data: str | None = None, params: str | None = None, seed: int | None = None
) -> DataFrame:
    """Archives below a root in order, with data / params / seed, optionally of one setting."""
    path = F.col("path")
    found = discover(spark, root, "*.tar.gz").withColumns(archive_parts(path))
    for name, wanted in (("data", data), ("params", params), ("seed", seed)):
        if wanted is not None:
            found = found.where(F.col(name) == wanted)
    return found.select("path", "length", "data", "params", "seed").orderBy("path")


def _archive_source() -> type[DataSource]:
    """The data source class. Holds all it needs, so workers run it without this package."""
    pattern, schema, label = ARCHIVE_PATH, SCHEMA, FORMAT

    def located(path):
        from pyarrow import fs as pafs

        for scheme in ("s3a://", "s3n://"):
            path = path.replace(scheme, "s3://", 1) if path.startswith(scheme) else path
        return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)

    def archives(root):
        """Archives below a root, but for those in folders whose names start with ``_`` or ``.``."""
        from pyarrow import fs as pafs

        fs, base = located(root)
        base = base.rstrip("/")
        for info in fs.get_file_info(pafs.FileSelector(base, recursive=True)):
            below = info.path[len(base) :].strip("/")
            hidden = any(part[0] in "_." for part in below.split("/"))
            if info.is_file and below.endswith(".tar.gz") and not hidden:
                yield f"{root.rstrip('/')}/{below}"

    def setting(path):
        found = re.search(pattern, path)
        if not found:
            return {"data": "", "params": "", "seed": None}
        seed = int(found[3])
        return {"data": found[1], "params": found[2], "seed": seed if seed < 2**31 else None}

    class Reader(DataSourceReader):
        def __init__(self, roots, wanted):
            self.roots = roots
            self.wanted = wanted

        def partitions(self):
            paths = sorted({path for root in self.roots for path in archives(root)})
            placed = [(path, setting(path)) for path in paths]
            return [
                InputPartition((path, *parts.values()))
                for path, parts in placed
                if all(str(parts[name]) == value for name, value in self.wanted.items())
            ]

        def read(self, partition):
            import tarfile

            if partition is None or partition.value is None:
                return
            path, data, params, seed = partition.value
            fs, name = located(path)
            with fs.open_input_stream(name, compression=None) as stream:
                with tarfile.open(fileobj=stream, mode="r|gz") as archive:
                    for member in archive:
                        if not (member.isfile() and member.name.endswith(".jsonl")):
                            continue
                        for number, raw in enumerate(archive.extractfile(member)):
                            line = raw.decode("utf-8").rstrip("\r\n")
                            if line.strip():
                                yield path, member.name, number, line, data, params, seed

    class ArchiveLines(DataSource):
        @classmethod
        def name(cls):
            return label

        def schema(self):
            return schema

        def reader(self, schema):
            roots = self.options.get("roots")
            wanted = {name: self.options[name] for name in ("data", "params", "seed") if name in self.options}
            return Reader(json.loads(roots) if roots else [self.options["path"]], wanted)

    return ArchiveLines


def register_archives(spark: SparkSession) -> None:
    """Make the format known: ``CREATE TEMPORARY VIEW v USING archive_lines OPTIONS (path ..., data ...)``.

    A partition is one archive, read as a stream whatever its size. The options
    ``data``, ``params`` and ``seed`` choose archives while they are listed; the
    others are never opened. They are options and no pushed filters, since Spark keeps
    a pushed listing with the frame, and later queries over it would lack the rest.
    """
    spark.dataSource.register(_archive_source())


def read_archive_lines(
    spark: SparkSession, root: Roots, data: str | None = None, params: str | None = None, seed: int | None = None
) -> DataFrame:
    """``(path, member, line_no, line, data, params, seed, step, task)`` of all archives, or of one setting."""
    register_archives(spark)
    reader = spark.read.format(FORMAT).option("roots", json.dumps(folders(spark, root)))
    for name, wanted in (("data", data), ("params", params), ("seed", seed)):
        if wanted is not None:
            reader = reader.option(name, str(wanted))
    return reader.load().withColumns(member_parts(F.col("member")))
