import datetime

import pytest
from pyspark.sql import functions as F

from evalflow.functions import jsontext, labels, locations, lookups, numbers, paths, setups, text
from evalflow.operators import columns as ops
from evalflow.plans import train


def test_normalize_text(value):
    assert value(text.normalize_text(F.lit("  Falcon+CC (QC 20%) "))) == "falcon cc qc 20"
    assert value(text.normalize_text(F.lit("A-b/c"), "_")) == "a_b_c"
    assert value(text.normalize_text(F.lit(" \t-/ "))) is None
    assert value(text.normalize_text(F.lit(None).cast("string"))) is None
    assert value(text.normalize_text(F.lit("É x"))) == "é x"


def test_missing(value):
    assert value(text.is_missing(F.lit(" \n")))
    assert not value(text.is_missing(F.lit("a")))
    assert value(text.is_missing(F.lit(float("nan")), floating=True))


def test_prefix_groups(spark, value):
    prefixes = {"mm": "short", "MMLU_ ": "long"}
    assert value(text.group_by_prefix(F.lit("mmlu_law"), prefixes)) == "long"
    assert value(text.group_by_prefix(F.lit("Mmx"), prefixes)) == "short"
    assert value(text.group_by_prefix(F.lit("arc"), prefixes)) == "arc"
    assert value(text.group_by_prefix(F.lit(None).cast("string"), prefixes)) is None
    assert value(text.group_by_prefix(F.lit("arc"), None)) == "arc"
    with pytest.raises(ValueError):
        text.group_by_prefix(F.lit("a"), {" ": "x"})
    with pytest.raises(TypeError):
        text.group_by_prefix(F.lit("a"), [("a", 1)])


def test_sizes(value):
    assert value(numbers.parse_size(F.lit(" 1b "))) == 1e9
    assert value(numbers.parse_size(F.lit("10M"))) == 1e7
    assert value(numbers.parse_size(F.lit("2.5K"))) == 2500
    for bad in ("x", "", "12", "M"):
        assert value(numbers.parse_size(F.lit(bad))) is None
        with pytest.raises(Exception, match="Invalid size string"):
            value(numbers.parse_size(F.lit(bad), strict=True))


def test_token_counts(value):
    counts = {"10M": 1e7, "5B": 5e9, "3G": 3e9, "2Gt": 2e9, "500Mt": 5e8, "77": 77.0, "x": None}
    for shown, number in counts.items():
        assert value(numbers.token_count(F.lit(shown))) == number


def test_timestamps(value):
    moment = datetime.datetime(2025, 8, 21, 8, 24, 43)
    assert value(numbers.parse_timestamp(F.lit("250821-082443"))) == moment
    assert value(numbers.parse_timestamp(F.lit("2025_08_21-08_24_43"))) == moment
    assert value(numbers.parse_timestamp(F.lit("bad"))) is None
    assert value(numbers.parse_timestamp(F.lit("690101-010203"))).year == 1969
    assert value(numbers.parse_timestamp(F.lit("680101-010203"))).year == 2068


def test_canonical_json(value):
    canon = '{"a":{"c":[1,2],"d":1},"b":1}'
    assert value(jsontext.canonical_json(F.lit('{"b":1,"a":{"d":1.0,"c":[1,2]}}'))) == canon
    assert value(jsontext.canonical_json(F.lit('{"a":{"c":[1,2],"d":1.0},"b":1}'))) == canon
    assert value(jsontext.canonical_json(F.lit("notjson"))) is None
    assert value(jsontext.canonical_json(F.lit('{"a":true}'))) != value(jsontext.canonical_json(F.lit('{"a":1}')))


def test_config_key(value):
    one, two = '{"k":1,"task_name":"a","n":{"task_name":1}}', '{"task_name":"b","n":{"task_name":1.0},"k":1}'
    assert value(jsontext.config_key(F.lit(one))) == value(jsontext.config_key(F.lit(two)))
    assert value(jsontext.config_key(F.lit(one), mode="raw")) == one
    assert value(jsontext.config_key(F.lit("free text"))) == "free text"
    assert value(jsontext.config_key(F.lit(None).cast("string"))) is None
    with pytest.raises(ValueError):
        jsontext.config_key(F.lit(one), mode="other")


def test_sql_functions(spark):
    jsontext.register_sql(spark)
    row = spark.sql("""
        SELECT normalize_config('{"task_name":"a","k":1.0}') AS a, normalize_config('{"k":1}') AS b,
            normalize_config(NULL) AS c, canonical_json('{"b":1,"a":2}') AS d
    """).first()
    assert tuple(row) == ('{"k":1}', '{"k":1}', None, '{"a":2,"b":1}')


def test_paths(value):
    path = F.lit("/d/task-038-mmlu_management:0shot_cot::tulu3-metrics.json")
    assert value(paths.artifact_prefix(path, "metrics")) == "task-038-mmlu_management:0shot_cot::tulu3"
    assert value(paths.strict_artifact_prefix(path, "metrics")) == "task-038-mmlu_management:0shot_cot::tulu3"
    with pytest.raises(Exception, match="no -requests suffix"):
        value(paths.strict_artifact_prefix(path, "requests"))
    assert value(paths.task_name_from_prefix(F.lit("task-002-boolq:mc::olmes"))) == "boolq:mc::olmes"
    assert value(paths.task_stem(F.lit(7), F.lit(" a "))) == "task-007-a"
    assert value(paths.task_stem(F.lit(None).cast("int"), F.lit("a"))) is None
    assert value(paths.task_stem(F.lit(7), F.lit("  "))) is None
    slug = paths.result_slug(F.lit("/m/_eval_results/run1"), "/m/", prefix="nov_", doc_id=0)
    assert value(slug) == "nov__eval_results__run1__doc0"
    assert value(paths.result_slug(F.lit("/m"), "/m")) == "m"
    assert value(paths.result_slug(F.lit("/mm/x"), "/m")) == "x"
    parts = paths.archive_parts(F.lit("/root/c4/4M/seed-2/a.tar.gz"))
    assert [value(parts[n]) for n in ("data", "params", "seed")] == ["c4", "4M", 2]
    member = paths.member_parts(F.lit("a/step-1250/boolq.jsonl"))
    assert [value(member[n]) for n in ("step", "task")] == [1250, "boolq"]


def test_safe_names(value):
    assert [ops.safe_name(n) for n in ("a.b--c", "__x__", "::", "é")] == ["a_b_c", "x", "col", "é"]
    assert [value(ops.safe_name_column(F.lit(n))) for n in ("a.b--c", "__x__", "::", "é")] == ["a_b_c", "x", "col", "é"]
    assert ops.safe_names(["a.b", "a-b", "c"]) == {"a.b": "a_b", "a-b": "a_b_2", "c": "c"}


def test_setups(value):
    default, point, no = "3_param-default", "5_param-helper_points-step2=0.5", "3_param-no_750M_no_530M"
    config = value(setups.fit_config(F.lit(point)))
    assert config.asDict() == {
        "name": point, "one_step": False, "params": "5", "filtering": "50_Percent", "helper_point": True, "heldout": ["1B"],
    }
    assert value(setups.fit_config(F.lit(default)))["filtering"] == "None"
    assert value(setups.is_one_step(F.lit("3_param-1_step")))
    assert value(setups.heldout(F.lit(no))) == ["1B", "750M", "530M"]


def test_labels(spark):
    cases = {
        "pile": "pile None",
        "c4_en-valppl": "c4 en valppl",
        "mmlu_average_acc_raw": "mmlu average acc raw",
        "pile_foo": "pile None foo",
        "zzz": "None None zzz",
        "mmlu_high_school_government_and_politics_margin": "mmlu high school government and politics margin",
        None: "None None",
    }
    df = spark.createDataFrame([(k,) for k in cases], "label string").withColumn("raw", F.col("label"))
    got = {r["raw"]: r["label"] for r in labels.canonical_labels(df, "label").collect()}
    assert got == cases
    with pytest.raises(Exception, match="Invalid metric label"):
        labels.canonical_labels(df, "label", strict=True).collect()
    good = df.where("raw = 'c4_en-valppl'")
    assert labels.canonical_labels(good, "label", strict=True).first()["label"] == "c4 en valppl"


def test_locations(spark, value):
    cases = {
        "hf://datasets/org/repo/data/x.parquet": ("org", "repo", "data/x.parquet", None),
        "hf://dataset/org/repo": ("org", "repo", None, None),
        "hf://org/repo": ("org", "repo", None, None),
        "hf://org/repo/x.parquet": (None, None, None, "path without type"),
        "hf://datasets/org": (None, None, None, "no repo"),
        "hf://org": (None, None, None, "too short"),
        "s3://a/b": (None, None, None, "scheme"),
        "": (None, None, None, "empty"),
        None: (None, None, None, "empty"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "uri string")
    rows = df.select("uri", locations.parse_location(F.col("uri")).alias("p")).select("uri", "p.*").collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == cases
    links = locations.repo_links(F.lit("o"), F.lit("r"), F.lit("data/x.parquet"))
    assert value(links["download_link"]) == "https://huggingface.co/datasets/o/r/resolve/main/data/x.parquet"
    assert value(links["api_path_link"]) is None
    links = locations.repo_links(F.lit("o"), F.lit("r"), F.lit("data"))
    assert value(links["path_link"]) == "https://huggingface.co/datasets/o/r/tree/main/data"
    assert value(links["api_path_link"]) == "https://huggingface.co/api/datasets/o/r/tree/main/data"
    assert value(links["download_link"]) is None
    for path, folder in (("a/", True), ("a.b/c", True), ("a/.hidden", True), ("a/b.", True), ("a/b.c", False)):
        assert value(locations.is_directory(F.lit(path))) is folder
    listed = F.array(F.lit("/b//x"), F.lit("a"), F.lit("b/x"))
    assert value(locations.resolve_paths(listed, F.lit("o"), F.lit("r"))) == ["b/x", "a"]
    assert value(locations.resolve_paths(listed, F.lit("o"), F.lit("r"), local_dir="/c", include_org=False)) == [
        "/c/r/b/x", "/c/r/a",
    ]
    assert value(locations.path_count_error(listed, exactly_one=True)) == "expected exactly one path"
    assert value(locations.path_count_error(F.array())) == "no paths"
    assert value(locations.path_count_error(F.array(F.lit("a")), exactly_one=True)) is None


def test_lookups(value):
    assert value(lookups.normalize_recipe(F.lit("DCLM-baseline"))) == "dclm_baseline"
    assert value(lookups.normalize_recipe(F.lit("unknown"))) == "unknown"
    assert value(lookups.normalize_recipe(F.lit(None).cast("string"))) is None
    assert value(lookups.restore_recipe(F.lit("dolma16"))) == "Dolma1.6++"
    assert value(lookups.acc_baseline(F.lit("csqa"))) == 0.2
    assert value(lookups.acc_baseline(F.lit("mmlu_law"))) == 0.25
    assert value(lookups.display_rank(F.lit("6M"), ["4M", "6M"])) == 2
    assert value(lookups.display_rank(F.lit("x"), ["4M", "6M"])) is None


def test_words_inside_quotes_stay(value):
    from evalflow.functions.jsontext import python_literal_to_json

    text = """{'a': None, 'None': 'None of the above', "b": [True, "it's False", 'x\\'None'], 'c': False}"""
    shown = value(python_literal_to_json(F.lit(text)))
    assert shown == """{'a': null, 'None': 'None of the above', "b": [true, "it's False", 'x\\'None'], 'c': false}"""
    long = "{'a': '" + "x None " * 20000 + "', 'b': None}"
    assert value(python_literal_to_json(F.lit(long))) == long.replace("'b': None", "'b': null")


def test_plain_dicts_take_a_shorter_way_to_the_same_json(spark, monkeypatch):
    plain = ["{}", "{'a': 1}", "{'a': -0.5e-3, 'b_2': None, '': True, 'a': False}", "{" + ", ".join(f"'k{i}': None" for i in range(150)) + "}"]
    other = [
        "{'a': 1, }", "{'a': 01}", "{'a': nan}", "{'a': .5}", "{'a': 'None'}", "{'None': None}", "{'a': 1}\n", "{'a': {'b': None}}",
        "{'a': 1", "{'a': 1} x", "{'a':1}", "{'a': None 'b': 1}", "", "{" + ", ".join(f"'k{i}': True" for i in range(300)) + "}",
    ]
    rows = spark.createDataFrame([(t,) for t in plain + other], "metrics string").coalesce(1)

    def shown():
        as_json = rows.select("metrics", jsontext.python_literal_to_json(F.col("metrics")))
        return [tuple(r) for r in as_json.collect()], [r.metrics for r in train.bad_metrics(rows).collect()]

    assert [r.metrics for r in rows.where(jsontext.is_plain_dict(F.col("metrics"))).collect()] == plain
    short = shown()
    monkeypatch.setattr(jsontext, "_PLAIN_DICT", "^never$")
    assert short == shown()
    assert not set(short[1]) & set(plain) and "{'a': nan}" in short[1]
