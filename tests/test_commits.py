"""Exports that meet unreadable files, new fields, rival writers and sudden ends."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow import schemas
from evalflow.operators import evolve
from evalflow.plans import export
from evalflow.sinks import snapshots
from evalflow.sources import files, records


def put(path, *rows, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(end.join(r if isinstance(r, str) else json.dumps(r) for r in rows).encode() + end.encode())


def dump(root, *names):
    for name in names:
        put(root / name / "metrics-all.jsonl", {"task_name": "n"})
        put(root / name / "task-000-n-predictions.jsonl", {"doc_id": name}, "", {"doc_id": name + "2"})


def states(job):
    return {r["slug"]: r["status"] for r in job["status"].collect()}


def docs(job):
    return sorted((r["slug"], r["doc_id"]) for r in job["data"].select("slug", "doc_id").collect())


def test_unread_files(spark, tmp_path):
    put(tmp_path / "r" / "a-predictions.jsonl", "1", "", "é")
    put(tmp_path / "r" / "b-predictions.jsonl", "1", "2", end="\r\n")
    (tmp_path / "r" / "c-predictions.jsonl").write_bytes(b"\xef\xbb\xbf{}\n{}")
    (tmp_path / "r" / "d-predictions.jsonl").write_bytes(b"")
    (tmp_path / "r" / "in" / "x").mkdir(parents=True)
    put(tmp_path / "r" / "in" / "x" / "e-predictions.jsonl", "1")
    found = files.discover(spark, tmp_path / "r", "*.jsonl").select(F.lit(f"{tmp_path}/r").alias("results_dir"), "path", "length")
    nested = found.where("path like '%/in/%'").withColumn("results_dir", F.lit(f"{tmp_path}/r/in"))
    claimed = found.unionAll(nested)
    lines = records.read_claimed(spark, claimed, "*-predictions.jsonl")
    assert records.unread_files(claimed, lines).count() == 0
    assert sorted(r["line"] for r in lines.where("path like '%/b-%' or path like '%/e-%'").collect()) == ["1", "1", "1", "2"]
    longer = claimed.withColumn("length", F.col("length") + F.when(F.col("path").like("%/b-%"), 5).otherwise(0))
    assert [r["path"][-22:] for r in records.unread_files(longer, lines).collect()] == ["/r/b-predictions.jsonl"]


def test_topmost():
    assert files.topmost(["/a/b", "/a", "/a-b", "/ab/c", "/ab/c/d", "/a"]) == ["/a-b", "/a", "/ab/c"]


def test_a_lost_file_fails_its_directory_alone(spark, tmp_path):
    root, out = tmp_path / "dump", str(tmp_path / "out")
    dump(root, "r1", "r2", "r3/in")
    put(root / "r3" / "metrics-all.jsonl", {"task_name": "n"})
    listing = files.manifest(spark, root, lengths=True).toPandas()
    listing = spark.createDataFrame(listing)
    (root / "r2" / "task-000-n-predictions.jsonl").unlink()
    (root / "r3" / "in" / "metrics-all.jsonl").write_text("{")
    job = export.run_export(spark, root, out, str(tmp_path / "w1"), listing=listing)
    # a file of r3/in that r3 does not claim
    assert states(job) == {"r1": "processed", "r2": "failed", "r3": "processed", "r3__in": "failed"}
    assert docs(job) == [("r1", "r1"), ("r1", "r12"), ("r3", "r3/in"), ("r3", "r3/in2")]
    named = {r["path"].split("/dump/")[1]: r["reason"] for r in job["quarantine"].where("line is null").collect()}
    assert set(named) == {"r2/task-000-n-predictions.jsonl", "r3/in/metrics-all.jsonl"}
    assert named["r2/task-000-n-predictions.jsonl"] == "0 of 36 bytes were read"
    dump(root, "r2", "r3/in")
    job = export.run_export(spark, root, out, str(tmp_path / "w2"))
    assert states(job) == {"r1": "skipped", "r2": "processed", "r3": "skipped", "r3__in": "processed"}
    assert len(docs(job)) == 8 and job["quarantine"].count() == 0


def test_an_error_while_reading_fails_its_directory_alone(spark, tmp_path, monkeypatch):
    root = tmp_path / "dump"
    dump(root, "r1", "r2", "r3", "r4", "r5")
    plain = records.read_claimed

    def denied(spark, claimed, glob):
        lines = plain(spark, claimed, glob)
        bad = F.col("path").contains("/r2/") | F.col("path").contains("/r5/task")
        return lines.withColumn("line", F.when(bad, F.raise_error(F.lit("denied"))).otherwise(F.col("line")))

    monkeypatch.setattr(records, "read_claimed", denied)
    job = export.run_export(spark, root, str(tmp_path / "out"), str(tmp_path / "w"))
    assert states(job) == {"r1": "processed", "r2": "failed", "r3": "processed", "r4": "processed", "r5": "failed"}
    assert {slug for slug, _ in docs(job)} == {"r1", "r3", "r4"}
    assert job["quarantine"].where("reason like '%denied%'").count() >= 2


def test_finished_directories_are_not_opened(spark, tmp_path):
    root, out = tmp_path / "dump", str(tmp_path / "out")
    dump(root, "r1", "r2")
    first = docs(export.run_export(spark, root, out, str(tmp_path / "w1")))
    put(root / "r1" / "task-000-n-predictions.jsonl", "junk that a reader would set aside")
    dump(root, "r3")
    job = export.run_export(spark, root, out, str(tmp_path / "w2"))
    assert states(job) == {"r1": "skipped", "r2": "skipped", "r3": "processed"}
    assert job["quarantine"].count() == 0 and [d for d in docs(job) if d[0] != "r3"] == first


def test_a_job_that_ends_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "dump", str(tmp_path / "out")
    dump(root, "r1")
    before = docs(export.run_export(spark, root, out, str(tmp_path / "w1")))
    dump(root, "r2")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(snapshots, "_publish", killed)
        export.run_export(spark, root, out, str(tmp_path / "w2"), force=True)
    assert docs(export.exported(spark, out)) == before
    assert states(export.run_export(spark, root, out, str(tmp_path / "w3"))) == {"r1": "skipped", "r2": "processed"}
    assert len(snapshots.discard_old(spark, out)) == 3 and len(docs(export.exported(spark, out))) == 4


def test_a_run_without_rows_replaces_what_was_there(spark, tmp_path):
    root, out = tmp_path / "dump", str(tmp_path / "out")
    dump(root, "r1", "r2")
    export.run_export(spark, root, out, str(tmp_path / "w1"))
    old = snapshots.current(spark, out)
    (root / "r1" / "task-000-n-predictions.jsonl").unlink()
    assert {s for s, _ in docs(export.run_export(spark, root, out, str(tmp_path / "w2"), force=True))} == {"r2"}
    assert snapshots.read(spark, out, "data", at=old).count() == 4  # as of the first commit


def test_two_writers_cannot_take_one_number(spark, tmp_path):
    out = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "slug string, x int")
    first = snapshots.commit(spark, out, {"rows": rows}, rows)
    snapshots.commit(spark, out, {"rows": rows.where("x = 1").withColumn("x", F.lit(7))}, rows.where("x = 1"), before=first)
    with pytest.raises(snapshots.CommitConflict):
        snapshots.commit(spark, out, {"rows": rows.withColumn("x", F.lit(9))}, rows, before=first)
    assert sorted(r["x"] for r in snapshots.read(spark, out, "rows").collect()) == [2, 7]
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, out, "none")


def test_commits_of_several_schemas(spark, tmp_path):
    out = str(tmp_path / "t")
    steps = [
        spark.createDataFrame([("a", 1, 5)], "slug string, x int, y long"),
        spark.createDataFrame([("1", 2.5, True)], "slug string, x double, z boolean").select("slug", "x", F.lit(None).cast("long").alias("y"), "z"),
        spark.createDataFrame([("a/b=c", "t", None, None)], "slug string, x string, y long, z boolean"),
    ]
    for rows in steps:
        snapshots.commit(spark, out, {"rows": rows, "same": rows.select("slug", F.lit(1).alias("one"))}, rows)
    got = {r["slug"]: (r["x"], r["y"], r["z"]) for r in snapshots.read(spark, out, "rows").collect()}
    assert got == {"a": ("1", 5, None), "1": ("2.5", None, True), "a/b=c": ("t", None, None)}
    assert snapshots.read(spark, out, "same").count() == 3


def test_types_only_widen():
    kinds = {"i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(), "s": T.StringType(), "b": T.BooleanType(), "n": T.NullType()}
    for a, b, c in ("iil", "ild", "ldd", "sds", "bls", "nll", "bbb"):
        assert schemas.widened(kinds[a], kinds[b]) in (kinds[c], kinds[b], kinds[a])
    assert schemas.widened(kinds["l"], kinds["d"]) == schemas.widened(kinds["d"], kinds["l"]) == kinds["d"]
    assert schemas.widened(kinds["b"], kinds["l"]) == kinds["s"] and schemas.widened(kinds["n"], kinds["b"]) == kinds["b"]
    old, new = schemas._struct("a int, B bigint"), schemas._struct("b double, c string, a int")
    assert [(f.name, f.dataType.simpleString()) for f in schemas.merged_schema(old, new).fields] == [("a", "int"), ("B", "double"), ("c", "string")]


def test_found_fields(spark):
    texts = ['{"a": 1, "b": "x", "c": [1], "d": null, "A": 2}', '{"a": 2.5, "b": 3, "d": null, "e": true}', None, '{"a": 1e300}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "e int, t string")
    schema = evolve.found_schema(df, "t")
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {"A": "bigint", "b": "string", "c": "string", "e": "boolean"}
    wide = schemas.merged_schema(T.StructType([T.StructField("a", T.DoubleType())]), schema)
    rows = evolve.promoted(df, "t", wide).collect()
    # "e" is a column already and stays in the text
    assert [(r["a"], r["b"], r["c"], r["e"]) for r in rows] == [(1.0, "x", "[1]", 0), (2.5, "3", None, 1), (None, None, None, 2), (1e300, None, None, 3)]
    assert evolve.found_schema(df, "t", most=1).names == ["a"]


def test_new_and_wider_fields_over_two_runs(spark, tmp_path):
    root, out = tmp_path / "dump", str(tmp_path / "out")
    put(root / "a" / "metrics-all.jsonl", {"task_name": "n"})
    put(root / "a" / "t-predictions.jsonl", {"doc_id": "1", "size": 3, "odd": "x"})
    put(root / "b" / "metrics-all.jsonl", {"task_name": "n"})
    export.run_export(spark, root, out, str(tmp_path / "w1"))
    put(root / "c" / "metrics-all.jsonl", {"task_name": "n"})
    put(root / "c" / "t-predictions.jsonl", {"doc_id": "2", "size": 3.5, "fresh": True})
    put(root / "c" / "t-requests.jsonl", {"doc_id": "2", "idx": 0, "extra": {"k": 1}})
    data = export.run_export(spark, root, out, str(tmp_path / "w2"))["data"]
    kinds = dict(data.dtypes)
    assert (kinds["prd_size"], kinds["prd_odd"], kinds["prd_fresh"], kinds["req_extra"]) == ("double", "string", "boolean", "string")
    got = {(r["doc_id"], r["idx"]): (r["prd_size"], r["prd_odd"], r["prd_fresh"], r["req_extra"]) for r in data.collect()}
    assert got == {("1", None): (3.0, "x", None, None), ("2", None): (3.5, None, True, None), ("2", 0): (3.5, None, True, '{"k":1}')}
    third = export.run_export(spark, root, out, str(tmp_path / "w3"), force=True)["data"]
    assert dict(third.dtypes) == kinds and third.count() == 3
