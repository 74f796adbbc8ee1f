"""Names and values read from file paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_replace(path, r"^.*/", "")


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def file_stem(path: Column) -> Column:
    """Last path part without its last extension."""
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def artifact_prefix(path: Column, artifact: str) -> Column:
    """File stem without the artifact suffix; other names keep their stem."""
    return F.regexp_replace(file_stem(path), f"-{artifact}$", "")


def strict_artifact_prefix(path: Column, artifact: str) -> Column:
    """As :func:`artifact_prefix`, but a name without the suffix is an error."""
    stem = file_stem(path)
    return F.when(stem.endswith(f"-{artifact}"), artifact_prefix(path, artifact)).otherwise(
        F.raise_error(F.concat(F.lit(f"no -{artifact} suffix in "), path)).cast("string")
    )


def task_name_from_prefix(prefix: Column) -> Column:
    """File prefix without the leading ``task-<digits>-``."""
    return F.regexp_replace(prefix, r"^task-\d+-", "")


def task_stem(task_idx: Column, task_name: Column) -> Column:
    """``task-007-name``; null without an index or a name."""
    name = F.regexp_replace(task_name, r"(?U)^\s+|\s+$", "")
    return F.when(
        task_idx.isNotNull() & (name != ""),
        F.format_string("task-%03d-%s", task_idx, name),
    )


def result_slug(
    result_dir: Column, roots: str | Sequence[str], *, prefix: str = "", doc_id: int | str | None = None
) -> Column:
    """Output name of a results directory relative to the innermost root that holds it.

    The root itself, and a directory outside all roots, use their own name. With several
    roots each name starts with its root: the last part of its path, and its number
    where two roots end alike. A double underscore in a name is escaped, as it stands
    for a slash.
    """
    roots = [r.rstrip("/") for r in ([roots] if isinstance(roots, str) else roots)]
    ends = [r.rsplit("/", 1)[-1] for r in roots]
    labels = [e if ends.count(e) == 1 else f"{e}-{i}" for i, e in enumerate(ends)]
    relative, label = F.lit(None).cast("string"), F.lit("")
    for root, own in sorted(zip(roots, labels), key=lambda pair: len(pair[0])):
        inside = result_dir.startswith(root + "/")
        below = F.substring(result_dir, F.lit(len(root) + 2), F.length(result_dir))
        relative = F.when(inside, below).otherwise(relative)
        if len(roots) > 1:
            label = F.when(inside | (result_dir == root), F.lit(own + "/")).otherwise(label)
    name = F.concat(label, F.coalesce(relative, base_name(result_dir)))
    name = F.replace(F.replace(name, F.lit("__"), F.lit("_%5F")), F.lit("/"), F.lit("__"))
    suffix = "" if doc_id is None else f"__doc{doc_id}"
    return F.concat(F.lit(prefix), name, F.lit(suffix))


#: ``.../<data>/<params>/seed-<n>/<name>.tar.gz``
ARCHIVE_PATH = r"([^/]+)/([^/]+)/seed-([0-9]+)/[^/]+$"


def archive_parts(path: Column) -> dict[str, Column]:
    """data / params / seed of an archive's path."""
    return {
        "data": F.regexp_extract(path, ARCHIVE_PATH, 1),
        "params": F.regexp_extract(path, ARCHIVE_PATH, 2),
        "seed": F.regexp_extract(path, ARCHIVE_PATH, 3).try_cast("int"),
    }


def member_parts(member: Column) -> dict[str, Column]:
    """step / task of ``.../step-<k>/<task>.jsonl``."""
    return {
        "step": F.regexp_extract(member, r"-(\d+)/[^/]+$", 1).try_cast("int"),
        "task": file_stem(member),
    }
