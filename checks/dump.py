"""Writes lines of the given tables as dump files, so the file readers have work.

The task functions hold all they need, so workers run them without this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_files(rows: DataFrame, root: str) -> None:
    """Write ``(file, line)`` rows: each file whole, streamed by one task.

    A task that is run again writes the same files again.
    """

    def write(batches):
        import pandas as pd
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)
        current, out = None, None
        for batch in batches:
            for file, line in zip(batch["file"], batch["line"]):
                if file != current:
                    if out is not None:
                        out.close()
                    path = f"{base}/{file}"
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out, current = fs.open_output_stream(path, compression=None), file
                out.write(line.encode("utf-8") + b"\n")
        if out is not None:
            out.close()
        yield pd.DataFrame({"done": [1]})

    ordered = rows.select("file", "line").repartition("file").sortWithinPartitions("file", "line")
    ordered.mapInPandas(write, "done int").count()


def write_archives(rows: DataFrame, root: str) -> None:
    """Write ``(archive, member, line)`` rows as tar.gz files with JSONL members."""

    def write(batches):
        import io
        import tarfile

        import pandas as pd
        from pyarrow import fs as pafs

        def add(tar, member, lines):
            data = ("\n".join(lines) + "\n").encode("utf-8")
            info = tarfile.TarInfo(member)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))

        fs, base = pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)
        archive = member = packed = tar = None
        lines = []

        def finish():
            add(tar, member, lines)
            tar.close()
            path = f"{base}/{archive}"
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(path, compression=None) as out:
                out.write(packed.getvalue())

        for batch in batches:
            for name, part, line in zip(batch["archive"], batch["member"], batch["line"]):
                if name != archive:
                    if tar is not None:
                        finish()
                        lines = []
                    packed = io.BytesIO()
                    tar = tarfile.open(fileobj=packed, mode="w:gz")
                elif part != member:
                    add(tar, member, lines)
                    lines = []
                archive, member = name, part
                lines.append(line)
        if tar is not None:
            finish()
        yield pd.DataFrame({"done": [1]})

    ordered = rows.select("archive", "member", "line").repartition("archive")
    ordered.sortWithinPartitions("archive", "member", "line").mapInPandas(write, "done int").count()
