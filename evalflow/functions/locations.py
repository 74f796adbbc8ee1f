"""Dataset URIs and the links derived from them, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalflow import constants as C


def normalize_path(path: Column) -> Column:
    """Repository path: no leading slash, no empty or ``.`` parts."""
    parts = F.filter(F.split(path, "/"), lambda part: (part != "") & (part != "."))
    return F.array_join(parts, "/")


def is_directory(path: Column) -> Column:
    """Trailing slash, or a last part without an extension."""
    last = F.element_at(F.split(F.regexp_replace(path, r"/+$", ""), "/"), -1)
    # an extension starts at the last dot, which may neither lead nor end the name
    return path.endswith("/") | ~last.rlike(r"^.+\.[^.]+$")


def parse_location(uri: Column) -> Column:
    """Struct ``org, repo_name, path, error``; exactly one of repo and error is set."""
    body = F.when(uri.startswith(C.DATASET_SCHEME), F.substring(uri, F.lit(len(C.DATASET_SCHEME) + 1), F.length(uri)))
    parts = F.filter(F.split(body, "/"), lambda part: part != "")
    typed = F.get(parts, F.lit(0)).isin(*C.DATASET_TYPE_SPELLINGS)
    # org, repo and the rest, after the optional type part
    place = F.when(typed, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    error = (
        F.when(uri.isNull() | (uri == ""), F.lit("empty"))
        .when(body.isNull(), F.lit("scheme"))
        .when(F.size(parts) < 2, F.lit("too short"))
        .when(~typed & (F.size(parts) > 2), F.lit("path without type"))
        .when(F.size(place) < 2, F.lit("no repo"))
    )
    ok = error.isNull()
    path = F.nullif(F.array_join(F.slice(place, 3, F.greatest(F.size(place) - 2, F.lit(0))), "/"), F.lit(""))
    return F.struct(
        F.when(ok, F.get(place, F.lit(0))).alias("org"),
        F.when(ok, F.get(place, F.lit(1))).alias("repo_name"),
        F.when(ok, normalize_path(path)).alias("path"),
        error.alias("error"),
    )


def repo_links(org: Column, repo: Column, path: Column) -> dict[str, Column]:
    """Repository and path links; each is null where it does not apply."""
    repo_id = F.concat_ws("/", org, repo)
    base = F.concat(F.lit(f"{C.DATASET_WEB}/{C.DATASET_TYPE}/"), repo_id)
    api = F.concat(F.lit(f"{C.DATASET_WEB}/api/{C.DATASET_TYPE}/"), repo_id)
    uri = F.concat(F.lit(f"{C.DATASET_SCHEME}{C.DATASET_TYPE}/"), repo_id)
    folder = is_directory(path)
    kind = F.when(folder, F.lit("tree")).otherwise(F.lit("blob"))
    return {
        "repo_id": repo_id,
        "repo_uri": uri,
        "repo_link": base,
        "api_link": api,
        "path_uri": F.concat(uri, F.lit("/"), path),
        "path_link": F.concat(base, F.lit("/"), kind, F.lit("/main/"), path),
        "api_path_link": F.when(folder, F.concat(api, F.lit("/tree/main/"), path)),
        "download_link": F.when(~folder, F.concat(base, F.lit("/resolve/main/"), path)),
    }


def resolve_paths(
    paths: Column,
    org: Column,
    repo: Column,
    *,
    local_dir: str | None = None,
    include_org: bool = True,
    include_repo: bool = True,
) -> Column:
    """Distinct paths in first-seen order, below ``local_dir`` when given."""
    kept = F.array_distinct(F.transform(paths, normalize_path))
    if local_dir is None:
        return kept
    folder = F.concat_ws(
        "/", F.lit(local_dir), *([org] if include_org else []), *([repo] if include_repo else [])
    )
    return F.transform(kept, lambda path: F.concat_ws("/", folder, path))


def path_count_error(paths: Column, *, required: bool = True, exactly_one: bool = False) -> Column:
    """Reason why a list of paths does not fit, null when it does."""
    size = F.coalesce(F.size(paths), F.lit(0))
    error = F.lit(None).cast("string")
    if exactly_one:
        error = F.when(size != 1, F.lit("expected exactly one path"))
    if required:
        error = F.when(size <= 0, F.lit("no paths")).otherwise(error)
    return error
