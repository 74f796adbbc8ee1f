import random

import pytest
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow import schemas
from evalflow.operators.skew import salted_left_join
from evalflow.operators import columns as ops
from evalflow.operators import dedupe, joins
from evalflow.operators.ordering import number_in_order, pack_order
from evalflow.operators.summaries import summary_metrics, summary_task_maps
from evalflow.plans import export, metrics_all, qa, runs, scaling, train

RUN_IDS = {
    "2025_08_21-08_24_43_ft_DD-dolma1_7-10M_main_10Mtx1_--learning_rate=5e-05": ("FT1", "simple_ft_vary_tokens"),
    "2025_08_21-08_24_43_e_DD-c4-1B_main_10M_toks_--learning_rate=5e-05": ("FT3", "simple_ft_vary_tokens"),
    "2025_08_21-08_24_43_e_DD-c4-1B_Ft_--learning_rate=5e-05": ("FT4", "simple_ft"),
    "250901-120000_e_DD-dolma1-7-1B_Ft_learning_rate=5e-05": ("FT5", "simple_ft"),
    "250901-120000_match_150M_finetune_10Mtx1_DD-c4-60M-5000-3_lr=1e-05": ("FT6", "simple_ft_vary_tokens"),
    "250901-120000_match_150M_finetune_Ft_DD-c4-60M-5000-3_lr=1e-05": ("FT7", "simple_ft"),
    "250901-120000_match_150M_pile_finetune_10Mtx2_DD-c4-60M-5000-3": ("MATCHED1", "matched"),
    "250901-120000_match_150M_pile_finetune_Ft_DD-c4-60M-5000-3": ("MATCHED2", "matched"),
    "250901-120000_match_150M_finetune_10Mtx1_DD-c4-60M-5000-3": ("MATCHED4", "matched"),
    "250901-120000_match_150M_finetune_Ft_DD-c4-60M-5000-3": ("MATCHED5", "matched"),
    "250901-120000_x_DD-d-c4-150M_Ft_DD-c4-60M-5000-3_lr=1e-05": ("MATCHED6", "matched"),
    "2025_08_21-08_24_43_x_DD-d-c4-150M_Ft_DD-c4-60M-5000-3_lr=1e-05": ("MATCHED7", "matched"),
    "250901-120000_match_150M_finetune_1Gtx1_DD-c4-60M-5000-3_lr=1e-05": ("MATCHED8", "matched"),
    "2025_08_21-08_24_43_e_DD-c4-1B_main_default_--max_train_samples=100_--reduce_loss=sum": ("REDUCE_LOSS", "reduce_type"),
    "2025_08_21-08_24_43_dpo_DD-c4-1B_main_default": ("DPO1", "dpo"),
    "2025_08_21-08_24_43_e_dd__c4-1B__main__500Mt_lr=1e-5_default_--learning_rate=2e-5": ("DPO2", "dpo"),
    "x_main_default": (None, "old"),
    "x_main_default_dpo": (None, "other"),
    "junk": (None, "other"),
}


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_classification(spark):
    df = frame(spark, [(i,) for i in [*RUN_IDS, None]], "run_id string")
    got = {r["run_id"]: (r["pattern_name"], r["run_type"]) for r in runs.classified(df, drop_types=None).collect()}
    assert got.pop("None") == (None, "other")
    assert got == {i: (n and f"{n}_PATTERN", t) for i, (n, t) in RUN_IDS.items()}
    assert runs.classified(df).where("run_type = 'old'").count() == 0
    log = runs.classification_log(df)
    assert log.columns == ["run_id", "run_type", "pattern"] and log.count() == len(RUN_IDS) + 1
    matched = runs.by_run_type(runs.classified(df), ["matched"])["matched"]
    names = [r["pattern_name"] for r in matched.collect()]
    assert matched.columns[0] == "run_id" and names == sorted(names) and len(names) == 7
    with pytest.raises(KeyError):
        runs.classified(df, "absent")


def test_hydration_and_normalization(spark):
    typed = frame(
        spark,
        [("a_Ft_b", "simple_ft", "N/A", "3", "1", None), ("plain", "matched", "0.1", None, None, "10M")],
        "run_id string, run_type string, lr string, seed string, num_finetuned_tokens_real string,"
        " num_finetune_tokens_per_epoch string",
    )
    payloads = frame(
        spark,
        [
            ("a_Ft_b", '{"learning_rate":0.5,"seed":9}', '{"total_tokens":77}'),
            ("plain", '{"num_train_epochs":2}', "oops"),
        ],
        "run_id string, config string, summary string",
    )
    full = runs.hydrate(typed, payloads)
    first, second = full.orderBy("run_id").collect()
    assert (first["lr"], first["seed"], first["num_finetuned_tokens_real"]) == ("0.5", "3", "77")
    assert (second["lr"], second["seed"], second["num_finetuned_tokens_real"]) == ("0.1", None, None)
    beside = runs.hydrate(joins.left_join(typed, payloads, ["run_id"]))
    assert sorted(map(str, beside.select(full.columns).collect())) == sorted(map(str, full.collect()))

    done = {r["run_id"]: r for r in runs.normalize(full).collect()}
    whole, plain = done["a_Ft_b"], done["plain"]
    assert whole["num_finetune_tokens_per_epoch"] == C.FULL_FT_TOKENS
    assert whole["num_finetune_epochs"] == 2
    assert whole["num_finetune_tokens"] == whole["num_finetuned_tokens_real"] == 1330254868
    assert whole["ckpt_steps"] == "main"
    assert plain["num_finetune_tokens"] == 2e7
    assert whole["comparison_metric"] is None
    assert plain["comparison_metric"] == "None None none none"

    twice = payloads.unionAll(payloads)
    with pytest.raises(Exception, match="found 2 for"):
        runs.hydrate(typed, twice).collect()
    with pytest.raises(Exception, match="found 0 for a_Ft_b"):
        runs.hydrate(typed, payloads.where("run_id = 'plain'")).collect()
    assert runs.hydrate(typed, twice, check=False).count() == 4


def test_hooks_and_classifier_of_a_whole_job(spark):
    df = frame(spark, [("a",), ("b",)], "run_id string")

    def by_name(rows, run_id):
        typed = rows.withColumn("run_type", F.when(F.col(run_id) == "a", "x").otherwise("y"))
        return typed.withColumn("pattern_name", F.lit("p"))

    seen = runs.process_runs(df, classifier=by_name, hooks={"x": lambda rows: rows.withColumn("mark", F.lit(1))})
    assert {r["run_id"]: r["mark"] for r in seen.collect()} == {"a": 1, "b": None}
    log = runs.classification_log(df, classifier=by_name).collect()
    assert {(r["run_id"], r["run_type"]) for r in log} == {("a", "x"), ("b", "y")}


def test_run_options(spark):
    df = frame(spark, [("2025_08_21-08_24_43_e_DD-c4-1B_Ft_--learning_rate=5e-05",)], "run_id string")
    one = runs.process_runs(df, recipe_mode="original", column_map={"lr": "rate"}, defaults={"unknown": 1}).first()
    assert one["ckpt_data"] == "C4" and one["rate"] == "5e-05"
    assert runs.process_runs(df).first()["ckpt_data"] == "c4"
    with pytest.raises(ValueError):
        runs.process_runs(df, recipe_mode="other")
    mapped = runs.hydrate(
        frame(spark, [("r", '{"u":1}', None)], "run_id string, config string, summary string"),
        config_fields={"mine": "u"}, summary_fields={},
    )
    assert mapped.first()["mine"] == "1" and "num_finetuned_tokens_real" not in mapped.columns
    dated = frame(spark, [("a", "2025-08-22"), ("b", "2025-08-20"), ("c", "bad")], "run_id string, created_at string")
    assert [r["run_id"] for r in runs.since(dated, "created_at", "2025-08-21").collect()] == ["a"]


def test_summary(spark):
    doc = (
        '{"oe_eval_metrics/arc/acc":0.5,"oe_eval_metrics/arc":7,"oe_eval_metrics/piqa":0.1,'
        '"oe_eval_metrics/x/y/z":1,"other":2,"oe_eval_metrics/b/extra_metrics":{"p":1,"q":null},'
        '"oe_eval_metrics/o":{"u":1,"w":null,"v":{"k":2},"extra_metrics":{"e":5,"v":6}},"oe_eval_metrics/o/u":3,'
        '"oe_eval_metrics/late/m":1,"oe_eval_metrics/late":{"n":1},'
        '"oe_eval_metrics/c/task_config":{"a":1},"oe_eval_metrics/b/p":9}'
    )
    df = frame(spark, [("r", doc), ("s", "bad"), ("t", None)], "run_id string, summary string")
    got = {(r["task"], r["metric"]): r["value"] for r in summary_metrics(df).collect()}
    assert got == {
        ("arc", "acc"): "0.5", ("arc", "value"): "7", ("piqa", "value"): "0.1", ("b", "p"): "1",
        ("o", "u"): "3", ("o", "v"): "6", ("o", "e"): "5", ("late", "m"): "1", ("late", "value"): '{"n":1}',
    }
    maps = {r["task"]: r["scalar"] or r["metrics"] for r in summary_task_maps(df).collect()}
    assert maps["piqa"] == "0.1" and maps["arc"] == {"acc": "0.5", "value": "7"} and maps["b"] == {"p": "1"}


def fit_rows(spark, rows):
    """Fit rows in list order: setup, mix, task, metric, and one value for all numbers."""
    data = [(i, s, m, t, k, v, v, v, v, v) for i, (s, m, t, k, v) in enumerate(rows)]
    return frame(
        spark, data,
        "n long, setup string, mix string, task string, metric string, step_1_y double, step_1_pred double,"
        " step_2_y double, step_2_pred double, stacked_pred double",
    )


def test_scaling(spark):
    rows = [
        ("2_param-default", "C4", "t1", "acc_raw", 9.0),
        ("3_param-default", "C4", "t1", "acc_raw", 1.0),
        ("3_param-default", "C4", "t1", "margin", 2.0),
        ("3_param-default", "C4", "t1", "acc_raw", 3.0),
        ("3_param-default", "DCLM-Baseline", "t1", "acc_raw", 4.0),
        ("3_param-default", "DCLM-baseline", "t1", "acc_raw", None),
        ("3_param-1_step", "C4", "t1", "unknown", 5.0),
    ]
    order, bucket = F.col("n"), F.floor(F.col("first_seen") / 2)
    macro = frame(spark, [(1,)], "a int")
    for seed in (0, 1):
        fits = fit_rows(spark, rows)
        if seed:
            fits = fits.orderBy(F.rand(1)).repartition(3)
        tables = scaling.parse_scaling_laws(fits, macro, order, bucket)
        assert list(tables) == [
            "scaling_law_pred_one_step.parquet", "scaling_law_pred_two_step.parquet",
            "scaling_law_true.parquet", "macro_avg.parquet",
        ]
        two = {r["id"]: r for r in tables["scaling_law_pred_two_step.parquet"].collect()}
        assert [two[i]["recipe"] for i in range(3)] == ["c4", "c4", "dclm_baseline"]
        metrics = two[1]["pred_task_metrics"].asDict()
        assert metrics["acc_raw"] == 3.0 and metrics["margin_raw"] == 2.0
        assert sum(v is None for v in metrics.values()) == 13
        assert two[2]["pred_task_losses"]["acc_raw"] is None
        true = {r["id"]: r for r in tables["scaling_law_true.parquet"].collect()}
        assert sorted(true) == [1, 2] and true[1]["task_losses"]["acc_raw"] == 3.0
        (one,) = tables["scaling_law_pred_one_step.parquet"].collect()
        assert one["id"] == 0 and all(v is None for v in one["pred_task_metrics"])


def test_numbering_over_many_buckets(spark):
    firsts = random.Random(3).sample(range(10**6), 500)
    groups = frame(spark, [(f,) for f in firsts], "first long")
    for width in (1, 1000, 10**7):
        got = number_in_order(groups, F.col("first"), F.floor(F.col("first") / width)).collect()
        assert {r["first"]: r["id"] for r in got} == {f: i for i, f in enumerate(sorted(firsts))}


def test_packed_order(value):
    packed = pack_order((F.lit(12), 4), (F.lit(3), 2))
    assert int(value(packed)) == 1203
    with pytest.raises(ValueError):
        pack_order((F.lit(1), 30), (F.lit(1), 9))
    with pytest.raises(Exception, match="no place for more than 2 digits"):
        value(pack_order((F.lit(12), 4), (F.lit(300), 2)))


def test_train(spark):
    rows = [
        ("1B", "Falcon+CC (QC 20%)", "mmlu_anatomy", 2, "default", "c", 5e6, 2e15,
         "{'acc_raw': 0.5, 'no_answer': None, 'margin': -0.1, 'new': True}"),
        ("10M", "unknown", "csqa", 1, "default", "c", 1e6, 1e15, "{'acc_raw': 1}"),
        ("x", "C4", "arc", 1, "default", "c", 1e6, 1e15, "{'acc_raw': nan}"),
    ]
    df = frame(spark, rows, schemas.TRAIN_INPUT)
    small, big, odd = train.sorted_train_results(df, keep_extra=True).collect()
    assert (big["params_numeric"], big["recipe"], big["task_group"]) == (1e9, "falcon_cc_qc_20", "mmlu")
    assert (big["tokens_millions"], big["compute_e15"]) == (5.0, 2.0)
    assert (big["acc_baseline"], big["prob_baseline"]) == (0.25, 0.0)
    assert (big["metrics_acc_raw"], big["metrics_margin_raw"]) == (0.5, -0.1)
    assert big["extra_metrics"] == {"new": "true"}
    assert (small["acc_baseline"], small["task_group"], small["recipe"]) == (0.2, "csqa", "unknown")
    assert odd["params_numeric"] is None
    assert not {"metrics", "chinchilla", *C.TRAIN_METRICS_DROPPED} & set(train.parse_train_results(df).columns)
    assert [r["task"] for r in train.bad_metrics(df).collect()] == ["arc"]
    with pytest.raises(Exception, match="Invalid size string"):
        train.parse_train_results(df, strict_sizes=True).collect()


def spine_inputs(spark):
    preds = frame(spark, [("d", "a", 1, "x"), ("d", "a", 2, "y")], "results_dir string, file_prefix string, doc_id long, pred string")
    reqs = frame(
        spark, [("d", "a", 1, 0, "q0", None), ("d", "a", 1, 1, "q1", None), ("d", "a", 3, 0, "q2", "job")],
        "results_dir string, file_prefix string, doc_id long, idx long, req string, task_name string",
    )
    recs = frame(spark, [], "results_dir string, file_prefix string, doc_id long, task_name string")
    metrics = frame(
        spark, [("d", "job", 9, '{"k":1}'), ("d", "aggregate", 8, None), ("e", "job", 7, None)],
        "results_dir string, task_name string, score long, task_config string",
    )
    return preds, recs, reqs, metrics


def test_spine(spark):
    out = export.export_documents(*spine_inputs(spark))
    got = {(r["file_prefix"], r["doc_id"], r["idx"], r["prd_pred"], r["req_req"], r["met_score"]) for r in out.collect()}
    assert got == {
        ("a", 1, 0, "x", "q0", 9), ("a", 1, 1, "x", "q1", 9), ("a", 1, None, "x", None, 9),
        ("a", 2, None, "y", None, 9), ("a", 3, 0, None, "q2", 9),
    }
    one = export.export_documents(*spine_inputs(spark), doc_id=1)
    assert {r["idx"] for r in one.collect()} == {None, 0, 1}


def test_attached_rows_are_those_of_a_left_join(spark):
    spine = frame(spark, [("a", 1), ("a", None), ("b", 2), (None, 3)], "k string, idx long")
    right = frame(spark, [("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), (None, 3, "w")], "k string, idx long, v string")
    for safe in ([], ["idx"], ["k", "idx"]):
        plain = joins.left_join(spine, right, ["k", "idx"], safe)
        split = salted_left_join(spine, right, ["k", "idx"], [(("a", 1), 1, 2)], null_safe=safe, split_rows=1)
        assert plain.columns == split.columns
        assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_spine_without_idx(spark):
    preds, recs, reqs, metrics = spine_inputs(spark)
    out = export.export_documents(preds, recs, reqs.drop("idx"), metrics.drop("task_name"))
    assert {r["idx"] for r in out.collect()} == {None}
    assert "met_score" not in out.columns


def test_task_names(spark):
    preds = frame(spark, [("d", "task-002-boolq:mc::olmes")], "results_dir string, file_prefix string")
    none = frame(spark, [], "results_dir string, file_prefix string, task_name string")
    assert export.task_names(preds, none, none).first()["task_name"] == "boolq:mc::olmes"


CONFIG_ROWS = [
    ("p1", 0, '{"k":1,"task_name":"a"}'),
    ("p2", 0, '{"k":1,"task_name":"b"}'),
    ("p3", 0, '{"k":1,"task_name":"a"}'),
    ("p4", 0, None),
    ("p5", 1, None),
]


def test_config_dedupe(spark):
    df = frame(spark, CONFIG_ROWS, "file_prefix string, doc_id long, met_task_config string")
    raw = export.dedupe_configurations(df, key_mode="raw")
    assert raw.columns == ["doc_id", "met_task_config"]
    assert {tuple(r) for r in raw.collect()} == {(0, CONFIG_ROWS[0][2]), (0, CONFIG_ROWS[1][2]), (0, None), (1, None)}
    structural = export.dedupe_configurations(df)
    expected = {(0, CONFIG_ROWS[0][2]), (0, None), (1, None)}
    assert {tuple(r) for r in structural.collect()} == expected
    again = export.dedupe_configurations(structural)
    assert {tuple(r) for r in again.collect()} == expected
    plain = df.drop("met_task_config")
    assert {tuple(r) for r in export.dedupe_configurations(plain).collect()} == {(0,), (1,)}
    with pytest.raises(ValueError, match="nothing would be left"):
        export.dedupe_configurations(df.select("file_prefix"))
    dropped = export.dedupe_configurations(df, drop=["doc_id"])
    assert dropped.columns == ["file_prefix", "met_task_config"]
    assert export.dedupe_configurations(df, drop=["doc_id"], extend=True).columns == ["met_task_config"]


def test_hot_configuration_sends_one_row_per_task(spark):
    df = spark.range(20000).select(
        F.format_string("p%05d", F.col("id")).alias("file_prefix"),
        F.when(F.col("id") % 3 != 0, F.lit('{"k":1}')).otherwise(F.concat(F.lit('{"k":'), F.col("id"), F.lit("}"))).alias("met_task_config"),
    )
    out = export.dedupe_configurations(df, drop=["none"])
    assert out.count() == 1 + 20000 // 3 + 1
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def lines(spark, rows):
    return frame(spark, rows, "path string, line string")


RECORD = '{"task_name":" a ","task_idx":7,"metrics":{"d":1.0,"c":[1,2]}}'
SAME = '{"metrics":{"c":[1,2],"d":1},"task_idx":7,"task_name":" a "}'


def test_records(spark):
    src = lines(spark, [
        ("/x/r1/metrics-all.jsonl", RECORD), ("/x/r1/metrics-all.jsonl", SAME), ("/x/r2/metrics-all.jsonl", SAME),
        ("/x/r1/metrics-all.jsonl", "notjson"), ("/x/r1/metrics-all.jsonl", "[1]"), ("/x/r1/metrics-all.jsonl", '{"task_name":3}'),
    ])
    rows = metrics_all.directory_records(src)
    assert rows.where("task_name is not null").count() == 2
    from evalflow.sources import files

    index = files.artifact_index(frame(spark, [("/x/r1/task-007-a-recorded-inputs.jsonl",), ("/x/r2/task-007-a-recorded-inputs.jsonl",), ("/x/r1/sub/task-007-a-requests.jsonl",)], "path string"))
    full = metrics_all.enriched_records(rows, index)
    assert {r["recorded-inputs"] for r in full.collect()} == {
        "/x/r1/task-007-a-recorded-inputs.jsonl", "/x/r2/task-007-a-recorded-inputs.jsonl",
    }
    assert {r["requests"] for r in full.collect()} == {None}
    merged = metrics_all.merged_records(full)
    (one,) = merged.collect()
    assert (one["result_dir"], one["copies"], one["task_file_stem"]) == ("/x/r1", 2, "task-007-a")
    paths = metrics_all.record_paths(full)
    assert {r["path"] for r in paths.where("role = 'result_dir'").collect()} == {"/x/r1", "/x/r2"}
    assert [r["path"] for r in paths.where("role = 'predictions'").collect()] == [None]
    assert metrics_all.merged_records(full, strict=True).count() == 2
    reasons = sorted(r["reason"] for r in metrics_all.rejected_records(src).collect())
    assert reasons == ["no object", "not JSON", "task_name must be a string"]


def test_paths_of_a_record_stay_in_long_form(spark):
    df = spark.range(40).select(
        F.when(F.col("id") < 30, F.lit("hot")).otherwise(F.lit("cold")).alias("canon"),
        F.format_string("/r%03d", F.col("id")).alias("result_dir"),
    ).withColumn("_dir", F.col("result_dir"))
    long = dedupe.copy_paths(df, ["canon"], ["_dir"], ["result_dir"])
    (hot,) = dedupe.merge_copies(df.where("canon = 'hot'"), ["canon"], ["_dir"], ["result_dir"]).collect()
    paths = [r["path"] for r in long.where(F.col("record") == hot["record"]).orderBy("first_seen").collect()]
    assert paths == [f"/r{i:03d}" for i in range(30)] and hot["copies"] == 30


def test_merging_records_is_lazy(spark):
    broken = lines(spark, [("/x/r1/metrics-all.jsonl", RECORD)]).withColumn("line", F.raise_error(F.lit("ran")).cast("string"))
    index = spark.createDataFrame([], "result_dir string, stem string, predictions string, `recorded-inputs` string, requests string")
    rows = metrics_all.enriched_records(metrics_all.directory_records(broken), index)
    metrics_all.merged_records(rows), metrics_all.record_paths(rows)


def test_content_hash_tells_nulls_apart(spark):
    rows = [("p", "a", None, '{"k":1}'), ("p", None, "a", '{"k":1}')]
    picked = set()
    for order in (rows, rows[::-1]):
        df = frame(spark, order, "file_prefix string, x string, y string, met_task_config string").coalesce(1)
        picked.add(str(export.dedupe_configurations(df, ties=()).collect()))
    assert len(picked) == 1


def test_qa(spark):
    line = '{"doc_id":0,"metrics":{"acc":1,"doc_id":99},"task_hash":"t","model_hash":"m","answer_outputs":[{"num_tokens":1,"is_greedy":true}]}'
    df = frame(spark, [(0, line), (1, '{"doc_id":1,"metrics":5,"task_hash":"t","model_hash":"m"}')], "n long, line string").withColumns(
        {"data": F.lit("c4"), "params": F.lit("4M"), "seed": F.lit(2), "task": F.lit("q"), "step": F.lit(3)}
    )
    payloads = qa.question_payloads(df, ["n"])
    shown = {r["n"]: r["payload"] for r in payloads.collect()}
    assert shown == {0: '{"doc_id":0,"model_output":[{"is_greedy":true,"num_tokens":1}]}', 1: '{"doc_id":1}'}
    assert [r["output_keys"] for r in qa.output_keys(payloads, "n").collect()] == [["is_greedy", "num_tokens"]]
    preview = {r["doc_id"]: r["acc"] for r in qa.metric_rows(df, ["acc", "doc_id"]).collect()}
    assert preview == {0: "1", 1: None}
    assert [tuple(r) for r in qa.file_metadata(df).collect()] == [("t", "m", "c4", "4M", 2, "q", 3)]
    typed = {r["doc_id"]: r for r in qa.task_outputs(df).collect()}
    assert typed[0]["model_output"][0]["num_tokens"] == 1 and typed[0]["task_hash"] == "t"
    broken = frame(spark, [('{"doc_id":"x"}',)], "payload string")
    assert qa.typed_questions(broken).first()["doc_id"] is None
    with pytest.raises(Exception):
        qa.typed_questions(broken, strict=True).collect()


def test_columns(spark):
    df = frame(spark, [(1, None, float("nan")), (2, "b", 2.0)], "id long, name string, score double")
    assert ops.ensure_column(df, "new", "x").first()["new"] == "x"
    assert ops.ensure_column(df, "new").schema["new"].dataType.simpleString() == "string"
    assert {r["name"] for r in ops.ensure_column(df, "name", "z").collect()} == {"z", "b"}
    assert [r["score"] for r in ops.fill_missing(df, {"score": 0.0, "absent": 1}).orderBy("id").collect()] == [0.0, 2.0]
    assert ops.rename_present(df, {"name": "n", "zz": "y"}).columns == ["id", "n", "score"]
    assert ops.add_prefix(df, "p_", skip=["id"]).columns == ["id", "p_name", "p_score"]
    assert ops.apply_converters(df, {"name": F.upper, "absent": F.upper}).where("id=2").first()["name"] == "B"
    assert ops.apply_if_column(df, "absent", F.upper) is df
    assert ops.map_column(df, "name", {"b": "c"}).where("id=2").first()["name"] == "c"
    marked = ops.assign_where(df, F.col("name").isNull(), {"name": "was null", "flag": 1}).orderBy("id").collect()
    assert [(r["name"], r["flag"]) for r in marked] == [("was null", 1), ("b", None)]
    assert df.agg(ops.first_where(F.col("name"), F.col("id") > 1, F.col("id")).alias("v")).first()["v"] == "b"
    nested = frame(spark, [((1, [2]), "a b")], "`x.y` struct<a:int,b:array<int>>, `c d` string")
    aliased = nested.select(*ops.prefixed(nested, "prd_"))
    assert aliased.columns == ["prd_x_y", "prd_c_d"] and aliased.first()["prd_x_y"] == '{"a":1,"b":[2]}'
    assert ops.sanitize_columns(nested).columns == ["x_y", "c_d"]
    assert dict(ops.stringify(nested).dtypes) == {"x.y": "string", "c d": "string"}
    both = ops.union_by_name(df, frame(spark, [("z", 5)], "name string, extra int"))
    assert both.columns == ["id", "name", "score", "extra"] and both.count() == 3
    updated = joins.apply_updates(df, frame(spark, [(1, "n")], "id long, name string"), "id", ["name"], "fill_missing")
    assert {r["name"] for r in updated.collect()} == {"n", "b"}


def test_json_string_columns_keep_their_quotes(spark):
    df = frame(spark, [('{"native_id":"org/x"}',), ('{"native_id":5}',)], "line string").select(
        F.from_json("line", "native_id variant").alias("r")
    ).select("r.*")
    shown = {r["prd_native_id"] for r in df.select(*ops.prefixed(df, "prd")).collect()}
    assert shown == {'"org/x"', "5"}


def test_row_order_never_matters(spark):
    rng = random.Random(5)
    rows = [(f"/x/r{rng.randrange(4)}/metrics-all.jsonl", f'{{"task_name":"t{rng.randrange(5)}","task_idx":{rng.randrange(3)}}}') for _ in range(200)]
    index = spark.createDataFrame([], "result_dir string, stem string, predictions string, `recorded-inputs` string, requests string")
    results = []
    for _ in range(2):
        rng.shuffle(rows)
        full = metrics_all.enriched_records(metrics_all.directory_records(lines(spark, rows)), index)
        results.append(sorted(map(str, metrics_all.merged_records(full).collect())))
    assert results[0] == results[1]


def test_scaling_job_aggregates_by_hash(spark, tmp_path):
    from evalflow.plans import tables as table_plans
    from evalflow.sources.tables import with_source_order

    fit_rows(spark, [("t1", "C4", "3_param-default", "acc_raw", 1.0)]).drop("row_order").write.parquet(str(tmp_path / "fit"))
    fits = table_plans.with_ordinal(with_source_order(spark.read.parquet(str(tmp_path / "fit"))))
    wide = scaling.pivot_metrics(scaling.prepare_fits(fits), scaling.KEYS, scaling.ONE_STEP, table_plans.source_order()[0])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rules_in_a_table(spark, value):
    from evalflow.functions.text import group_by_prefix

    rules = [("small ", "little"), ("small r", "ringlike"), ("RED", "red"), ("red", "other"), (" s", "s"), ("smaller than all", "none")]
    values = ["Small rings", "small", "SMALLER", "Reddish", "x", "", None, "S", "Small rings", "small x", "İred"]
    df = frame(spark, [(i, v) for i, v in enumerate(values)], "i int, name string")
    table = frame(spark, [(p, g, i) for i, (p, g) in enumerate(rules)], "prefix string, group string, place int")
    table = table.unionByName(frame(spark, [(None, "n", 9), ("x", None, 9)], table.schema))
    got = {r["i"]: r["g"] for r in joins.group_by_rules(df, "name", table, "g", turn="place").collect()}
    plain = {r["i"]: r["g"] for r in df.select("i", group_by_prefix(F.col("name"), rules).alias("g")).collect()}
    assert got == plain and len(got) == len(values)
    assert joins.group_by_rules(df, "name", table.limit(0), "g").where("name <=> g").count() == len(values)
    with pytest.raises(ValueError):
        joins.group_by_rules(df, "name", frame(spark, [(" ", "g")], "prefix string, group string"), "g")
    plan = joins.group_by_rules(df, "name", table, "g")._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan


def test_counts_come_with_the_write(spark, tmp_path):
    ids = frame(spark, [("x_main_default",), ("junk",), ("junk2",), (None,)], "run_id string")
    got = {(r["run_type"], r["pattern_name"]): r["runs"] for r in runs.write_classified(ids, str(tmp_path / "runs")).collect()}
    assert got == {(r["run_type"], r["pattern_name"]): r["runs"] for r in runs.run_type_counts(runs.classified(ids, drop_types=None)).collect()}
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 4
    own = lambda df, _: df.withColumns({"run_type": F.lit("mine"), "pattern_name": F.lit("P")})
    (row,) = runs.write_classified(ids, str(tmp_path / "own"), classifier=own, kinds=[("mine", "P")]).collect()
    assert tuple(row) == ("mine", "P", 4)
    with pytest.raises(ValueError, match="known kind"):
        runs.write_classified(ids, str(tmp_path / "odd"), classifier=own)


def test_a_stream_batch_is_classified_once(spark, tmp_path):
    from evalflow.functions.runids import classify_runs
    from evalflow.streaming import ingest

    frame(spark, [("x_main_default",), ("junk",)], "run_id string").write.parquet(str(tmp_path / "in"))
    calls = []

    def counting(df, column):
        calls.append(1)
        return classify_runs(df, column)

    stream = spark.readStream.schema("run_id string").parquet(str(tmp_path / "in"))
    ingest.classify_stream(stream, str(tmp_path / "out"), classifier=counting).awaitTermination()
    assert len(calls) == 1
    assert spark.read.parquet(str(tmp_path / "out" / "classification_log")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out" / "runs")).count() == 1
