"""Whole files and byte ranges in the shared folder, read and written inside tasks.

A file is written under a name of its own attempt and then renamed: a repeated or lost
task never leaves half a file under the name that readers look for, and a repeated
one replaces it by the same bytes.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def at(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (``file:``, ``hdfs:``, ``s3:``, ``gs:``) or a plain path."""
    for scheme in ("s3a://", "s3n://"):
        if path.startswith(scheme):
            path = "s3://" + path.removeprefix(scheme)
    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class Writer:
    """A file that appears when it is complete."""

    def __init__(self, path: str):
        self._fs, self._path = at(path)
        self._fs.create_dir(self._path.rpartition("/")[0], recursive=True)
        self._part = f"{self._path}.{uuid.uuid4().hex}.part"
        self._out = self._fs.open_output_stream(self._part)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; gives the place of the first byte."""
        place = self.size
        self._out.write(data)
        self.size += len(data)
        return place

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._part, self._path)

    def abandon(self) -> None:
        self._out.close()
        self._fs.delete_file(self._part)


def size_of(path: str) -> int:
    system, name = at(path)
    return system.get_file_info(name).size


class Reader:
    """Byte ranges of one file."""

    def __init__(self, path: str):
        system, name = at(path)
        self._in = system.open_input_file(name)
        self.size = self._in.size()

    def read(self, start: int, length: int) -> bytes:
        self._in.seek(start)
        return self._in.read(max(0, min(length, self.size - start)))

    def close(self) -> None:
        self._in.close()
