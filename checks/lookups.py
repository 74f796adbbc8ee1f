"""Lookups, orders, paths, dataset locations, unions and calendar counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import case_sql, pick, pick_sql, quoted, table
from evalflow import constants as C
from evalflow.functions import locations, lookups, paths
from evalflow.functions.numbers import parse_size, to_number, token_count
from evalflow.functions.text import group_by_prefix
from evalflow.operators import columns as ops
from evalflow.operators import joins
from evalflow.operators.ordering import number_in_order, sorted_nulls_last
from evalflow.plans.reports import counts_by_period
from evalflow.sinks import tables as sinks
from evalflow.sources.tables import merge_as_text

MIXES = [*C.RECIPES, "house mix"]
NAMES = [*C.RECIPE_ORDER, "house mix"]


def lookup_fallback(spark, folder):
    """Recipe names both ways over all orders; unknown names stay, null stays null."""
    n = F.col("o_orderkey")
    mix = F.when(n % 19 != 0, pick(n % len(MIXES), MIXES))
    name = pick(n % len(NAMES), NAMES)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        lookups.normalize_recipe(mix).alias("recipe"),
        lookups.restore_recipe(name).alias("display_name"),
        lookups.acc_baseline(pick(n % 4, ["piqa", "csqa", "socialiqa", "other"])).alias("baseline"),
    )


def prefix_group(spark, folder):
    prefixes = {"small ": "little", "small r": "ringlike", "RED": "red"}
    return table(spark, folder, "part").select(
        "p_partkey", group_by_prefix(F.col("p_name"), prefixes).alias("name_group")
    )


def prefix_rules(spark, folder):
    """Orders grouped by rules that stand in a table: many lengths, several rules of one prefix."""
    name = F.concat(F.lit("Key "), F.lpad((F.col("o_orderkey") * 7919 % 1_000_000).cast("string"), 6, "0"), F.lit("/"), "o_orderstatus")
    orders = table(spark, folder, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 31 != 0, name).alias("name"))
    start = F.concat(F.lit(" KEY "), F.lpad((F.col("l_orderkey") * 7919 % 1_000_000).cast("string"), 6, "0"))
    rules = table(spark, folder, "lineitem").select(
        F.substring(start, F.lit(1), (F.col("l_linenumber") % 4 + F.col("l_orderkey") % 3 + 6).cast("int")).alias("prefix"),
        F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("group"),
    )
    return joins.group_by_rules(orders, "name", rules, "name_group").drop("name")


def display_order(spark, folder):
    n = F.col("p_partkey")
    return sorted_nulls_last(
        table(spark, folder, "part").select(
            "p_partkey",
            lookups.display_rank(pick(n % 15, [*C.PARAM_ORDER, "2B"]), C.PARAM_ORDER).cast("int").alias("size_rank"),
            lookups.display_rank(pick(n % 5, C.SEED_ORDER), C.SEED_ORDER).cast("int").alias("seed_rank"),
            lookups.display_rank(pick(n % 26, NAMES), C.RECIPE_ORDER).cast("int").alias("recipe_rank"),
        ),
        ["size_rank", "seed_rank", "recipe_rank"],
        ["p_partkey"],
    )


def sizes(spark, folder):
    size = F.col("p_size").cast("string")
    text = F.concat(size, pick(F.col("p_partkey") % 6, ["M", "b", " k ", "T", "", "Mt"]))
    return table(spark, folder, "part").select(
        "p_partkey",
        parse_size(text).alias("size"),
        token_count(text).alias("tokens"),
        to_number(F.concat(size, pick(F.col("p_partkey") % 2, [".5", "x"]))).alias("number"),
    )


def union_by_name(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_nationkey").cast("long").alias("nation"), F.col("s_name").alias("name")
    )
    return merge_as_text([customers, suppliers])


def month_counts(spark, folder):
    return counts_by_period(
        table(spark, folder, "orders"), "o_orderdate", "yyyy-MM", where=F.col("o_orderstatus") == "F",
        name="month", count="orders",
    )


def ilike_year_counts(spark, folder):
    return counts_by_period(
        table(spark, folder, "orders"), "o_orderdate", "yyyy",
        where=F.col("o_orderpriority").ilike("%urgent") & (F.col("o_orderstatus") == "O"),
        name="year", count="orders",
    )


def dataset_uri(spark, folder):
    """Page URLs rewritten to dataset URIs of every valid and invalid form."""
    rest = F.regexp_replace("url", r"^https?://", "")
    host = F.regexp_extract(rest, r"^([^/]*)", 1)
    n = F.col("page_id") % 6
    uri = (
        F.when(n == 0, F.concat(F.lit("hf://datasets/"), rest))
        .when(n == 1, F.concat(F.lit("hf://dataset/"), host, F.lit("/repo//./data/x.parquet")))
        .when(n == 2, F.concat(F.lit("hf://"), host, F.lit("/repo")))
        .when(n == 3, F.col("url"))
        .when(n == 4, F.concat(F.lit("hf://"), rest, F.lit("/more")))
        .otherwise(F.concat(F.lit("hf://datasets/"), host))
    )
    parsed = table(spark, folder, "pages").select("page_id", uri.alias("uri")).withColumn(
        "place", locations.parse_location(F.col("uri"))
    )
    flat = parsed.select("page_id", "uri", "place.*")
    links = locations.repo_links(F.col("org"), F.col("repo_name"), F.col("path"))
    ok = F.col("error").isNull()
    return flat.select("*", *[F.when(ok, c).alias(k) for k, c in links.items()])


def path_parts(spark, folder):
    path = F.concat(
        F.lit("/m/c4/4M/seed-"), (F.col("page_id") % 5).cast("string"), F.lit("/task-"),
        F.lpad((F.col("page_id") % 90).cast("string"), 3, "0"), F.lit("-a.b::c-"),
        pick(F.col("page_id") % 3, ["predictions", "metrics", "notes"]), F.lit(".jsonl"),
    )
    p = F.col("p")
    arch = paths.archive_parts(p)
    return table(spark, folder, "pages").select("page_id", path.alias("p")).select(
        "page_id",
        paths.base_name(p).alias("base"),
        paths.parent_dir(p).alias("parent"),
        paths.file_stem(p).alias("stem"),
        paths.artifact_prefix(p, "predictions").alias("prefix"),
        paths.task_name_from_prefix(paths.artifact_prefix(p, "metrics")).alias("task"),
        arch["data"].alias("data"),
        arch["params"].alias("params"),
        arch["seed"].alias("seed"),
        paths.result_slug(paths.parent_dir(p), "/m", prefix="nov_", doc_id=0).alias("slug"),
        paths.task_stem((F.col("page_id") % 90).cast("int"), F.lit(" x ")).alias("task_stem"),
        ops.safe_name_column(paths.file_stem(p)).alias("safe"),
    )


def cell_updates(spark, folder):
    """Customer balances from their orders: totals overwrite, segments fill gaps."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("N/A")).when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment")).alias("segment"),
        F.col("c_name").alias("name"),
    )
    updates = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("key")).agg(
        F.max("o_orderpriority").alias("segment"), F.max("o_orderstatus").alias("name")
    )
    filled = joins.apply_updates(customers, updates, "key", ["segment"], "fill_missing")
    return joins.apply_updates(filled, updates, "key", ["name"], "overwrite")


def key_checks(spark, folder):
    """Customers with several orders and customers with none."""
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("key"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"))
    many = joins.duplicate_keys(orders, ["key"]).select("key", "rows")
    none = joins.unmatched_keys(customers, orders, ["key"]).withColumn("rows", F.lit(0).cast("long"))
    return many.unionByName(none)


def first_seen_ids(spark, folder):
    """Dense ids of customers in the order of their first order."""
    groups = table(spark, folder, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"))
    return number_in_order(groups, F.col("first"), F.floor(F.col("first") / (1 << 20))).drop("first")


def masked_values(spark, folder):
    """Masked assignment over orders, and the first masked value per customer."""
    orders = ops.assign_where(
        table(spark, folder, "orders"), F.col("o_orderstatus") == "F", {"o_totalprice": 0.0, "flag": "done"}
    )
    return orders.groupBy("o_custkey").agg(
        ops.first_where(F.col("o_orderkey"), F.col("o_orderstatus") == "O", F.col("o_orderkey")).alias("first_open"),
        F.round(F.sum("o_totalprice"), 2).alias("open_total"),
        F.count("flag").alias("done"),
    )


def work_status(spark, folder):
    """Nations as wanted directories, those with a supplier in debt and much owed as finished ones."""
    wanted = table(spark, folder, "customer").select(F.concat(F.lit("run"), F.col("c_nationkey").cast("string")).alias("slug"))
    finished = table(spark, folder, "supplier").where("s_acctbal < -900").select(
        F.concat(F.lit("run"), F.col("s_nationkey").cast("string")).alias("slug")
    ).distinct()
    return sinks.status_counts(sinks.plan_work(wanted, finished))


def column_shaping(spark, folder):
    """Customers through renames, defaults, prefixes and dropped source columns."""
    df = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        F.col("c_name").alias("name.full"),
        F.when(F.col("c_nationkey") > 3, F.col("c_mktsegment")).alias("segment"),
        F.struct(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("s")).alias("doc"),
        F.lit("/runs/x").alias("source_path"),
    )
    df = ops.fill_missing(ops.ensure_column(df, "seed", 7), {"segment": "none", "absent": 1})
    df = ops.rename_present(ops.drop_source_columns(df), {"segment": "part", "absent": "x"})
    return df.select("doc_id", *ops.prefixed(df, "prd", ["doc_id"]))


def path_lists(spark, folder):
    """Page URLs as path lists: normalized, distinct in first-seen order, below a local folder."""
    path = F.regexp_replace("url", r"^https?:/", "")
    listed = F.array(path, F.concat(F.lit("/"), path), F.lit("a//b"), F.lit("./a/b"))
    org = F.concat(F.lit("o"), (F.col("page_id") % 3).cast("string"))
    return table(spark, folder, "pages").select(
        "page_id",
        F.array_join(locations.resolve_paths(listed, org, F.lit("r")), ",").alias("plain"),
        F.array_join(locations.resolve_paths(listed, org, F.lit("r"), local_dir="/c"), ",").alias("local"),
        locations.path_count_error(locations.resolve_paths(listed, org, F.lit("r")), exactly_one=True).alias("error"),
    )


_URI = """
    src AS (
        SELECT page_id, url, regexp_replace(url, '^https?://', '') AS rest FROM pages
    ), named AS (
        SELECT *, regexp_extract(rest, '^([^/]*)', 1) AS host FROM src
    ), uris AS (
        SELECT page_id, CASE page_id % 6
            WHEN 0 THEN 'hf://datasets/' || rest
            WHEN 1 THEN 'hf://dataset/' || host || '/repo//./data/x.parquet'
            WHEN 2 THEN 'hf://' || host || '/repo' WHEN 3 THEN url
            WHEN 4 THEN 'hf://' || rest || '/more' ELSE 'hf://datasets/' || host END AS uri
        FROM named
    ), cut AS (
        SELECT *, starts_with(uri, 'hf://') AS good,
            list_filter(string_split(substr(uri, 6), '/'), lambda x: x <> '') AS parts
        FROM uris
    ), typed AS (
        SELECT *, parts[1] IN ('dataset', 'datasets') AS has_type FROM cut
    ), placed AS (
        SELECT *, CASE WHEN has_type THEN parts[2:] ELSE parts END AS place FROM typed
    ), judged AS (
        SELECT *, CASE WHEN NOT good THEN 'scheme' WHEN len(parts) < 2 THEN 'too short'
            WHEN NOT has_type AND len(parts) > 2 THEN 'path without type'
            WHEN len(place) < 2 THEN 'no repo' END AS error
        FROM placed
    ), split AS (
        SELECT page_id, uri, error, CASE WHEN error IS NULL THEN place[1] END AS org,
            CASE WHEN error IS NULL THEN place[2] END AS repo_name,
            CASE WHEN error IS NULL THEN
                nullif(array_to_string(list_filter(place[3:], lambda x: x <> '.'), '/'), '') END AS path
        FROM judged
    ), full_rows AS (
        SELECT *, org || '/' || repo_name AS repo_id, path IS NOT NULL AS has_path,
            NOT regexp_matches(regexp_extract(path, '([^/]*)$', 1), '^.+\\.[^.]+$') AS folder
        FROM split
    )
"""

QUERIES = {
    "lookup_fallback": lookup_fallback,
    "prefix_group": prefix_group,
    "prefix_rules": prefix_rules,
    "display_order": display_order,
    "parse_sizes": sizes,
    "union_by_name": union_by_name,
    "month_counts": month_counts,
    "ilike_year_counts": ilike_year_counts,
    "dataset_uri": dataset_uri,
    "path_parts": path_parts,
    "cell_updates": cell_updates,
    "key_checks": key_checks,
    "first_seen_ids": first_seen_ids,
    "masked_values": masked_values,
    "work_status": work_status,
    "column_shaping": column_shaping,
    "path_lists": path_lists,
}
_RANK = "nullif(list_position([{names}], {value}), 0)"


def _rank(value, order):
    return f"CAST({_RANK.format(names=', '.join(map(quoted, order)), value=value)} AS INTEGER)"


SQL = {
    "lookup_fallback": f"""
    WITH src AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 19 <> 0 THEN {pick_sql(f"o_orderkey % {len(MIXES)}", MIXES)} END AS mix,
            {pick_sql(f"o_orderkey % {len(NAMES)}", NAMES)} AS name,
            {pick_sql("o_orderkey % 4", ["piqa", "csqa", "socialiqa", "other"])} AS task
        FROM orders
    )
    SELECT o_orderkey, {case_sql("mix", C.RECIPES, "mix")} AS recipe,
        {case_sql("name", C.RECIPE_ORIGINALS, "name")} AS display_name,
        CAST({case_sql("task", C.TASK_ACC_BASELINES, "0.25")} AS DOUBLE) AS baseline
    FROM src
    """,
    "prefix_group": """
    SELECT p_partkey, CASE WHEN starts_with(lower(p_name), 'small r') THEN 'ringlike'
        WHEN starts_with(lower(p_name), 'small') THEN 'little'
        WHEN starts_with(lower(p_name), 'red') THEN 'red' ELSE p_name END AS name_group
    FROM part
    """,
    "prefix_rules": """
    WITH names AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 31 <> 0 THEN
            'Key ' || lpad(CAST(o_orderkey * 7919 % 1000000 AS VARCHAR), 6, '0') || '/' || o_orderstatus END AS name
        FROM orders
    ), rules AS (
        SELECT trim(lower(substr(' KEY ' || lpad(CAST(l_orderkey * 7919 % 1000000 AS VARCHAR), 6, '0'), 1,
            CAST(l_linenumber % 4 + l_orderkey % 3 + 6 AS INTEGER)))) AS prefix, 'g' || l_partkey AS grp
        FROM lineitem
    ), best AS (
        SELECT o_orderkey, grp, row_number() OVER (PARTITION BY o_orderkey ORDER BY n DESC, grp) AS place
        FROM (SELECT o_orderkey, name, unnest(range(1, len(name) + 1)) AS n FROM names) v
        JOIN rules ON rules.prefix = substr(lower(name), 1, n)
    )
    SELECT names.o_orderkey, coalesce(grp, name) AS name_group
    FROM names LEFT JOIN best ON best.o_orderkey = names.o_orderkey AND place = 1
    """,
    "display_order": f"""
    SELECT p_partkey, {_rank(pick_sql("p_partkey % 15", [*C.PARAM_ORDER, "2B"]), C.PARAM_ORDER)} AS size_rank,
        {_rank(pick_sql("p_partkey % 5", C.SEED_ORDER), C.SEED_ORDER)} AS seed_rank,
        {_rank(pick_sql("p_partkey % 26", NAMES), C.RECIPE_ORDER)} AS recipe_rank
    FROM part ORDER BY size_rank NULLS LAST, seed_rank NULLS LAST, recipe_rank NULLS LAST, p_partkey
    """,
    "parse_sizes": """
    SELECT p_partkey,
        CASE p_partkey % 6 WHEN 0 THEN p_size * CAST(1e6 AS DOUBLE) WHEN 1 THEN p_size * CAST(1e9 AS DOUBLE)
            WHEN 2 THEN p_size * CAST(1e3 AS DOUBLE) WHEN 3 THEN p_size * CAST(1e12 AS DOUBLE) END AS size,
        CASE p_partkey % 6 WHEN 0 THEN p_size * CAST(1e6 AS DOUBLE) WHEN 4 THEN CAST(p_size AS DOUBLE)
            WHEN 5 THEN p_size * CAST(1e6 AS DOUBLE) END AS tokens,
        CASE WHEN p_partkey % 2 = 0 THEN p_size + CAST(0.5 AS DOUBLE) END AS number
    FROM part
    """,
    "union_by_name": """
    SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment FROM customer
    UNION ALL BY NAME SELECT CAST(s_nationkey AS VARCHAR) AS nation, s_name AS name FROM supplier
    """,
    "month_counts": """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders
    WHERE o_orderstatus = 'F' GROUP BY month ORDER BY month
    """,
    "ilike_year_counts": """
    SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS orders FROM orders
    WHERE o_orderpriority ILIKE '%urgent' AND o_orderstatus = 'O' GROUP BY year ORDER BY year
    """,
    "dataset_uri": f"""
    WITH {_URI}
    SELECT page_id, uri, org, repo_name, path, error, repo_id,
        'hf://datasets/' || repo_id AS repo_uri,
        'https://huggingface.co/datasets/' || repo_id AS repo_link,
        'https://huggingface.co/api/datasets/' || repo_id AS api_link,
        'hf://datasets/' || repo_id || '/' || path AS path_uri,
        'https://huggingface.co/datasets/' || repo_id || '/' || CASE WHEN folder THEN 'tree' ELSE 'blob' END
            || '/main/' || path AS path_link,
        CASE WHEN folder THEN 'https://huggingface.co/api/datasets/' || repo_id || '/tree/main/' || path END
            AS api_path_link,
        CASE WHEN NOT folder THEN 'https://huggingface.co/datasets/' || repo_id || '/resolve/main/' || path END
            AS download_link
    FROM full_rows
    """,
    "path_parts": """
    WITH p AS (
        SELECT page_id, lpad(CAST(page_id % 90 AS VARCHAR), 3, '0') AS nnn, CAST(page_id % 5 AS INTEGER) AS seed,
            list_extract(['predictions', 'metrics', 'notes'], CAST(page_id % 3 AS INTEGER) + 1) AS kind
        FROM pages
    )
    SELECT page_id, 'task-' || nnn || '-a.b::c-' || kind || '.jsonl' AS base, '/m/c4/4M/seed-' || seed AS parent,
        'task-' || nnn || '-a.b::c-' || kind AS stem,
        'task-' || nnn || '-a.b::c' || CASE WHEN kind = 'predictions' THEN '' ELSE '-' || kind END AS prefix,
        'a.b::c' || CASE WHEN kind = 'metrics' THEN '' ELSE '-' || kind END AS task,
        'c4' AS data, '4M' AS params, seed, 'nov_c4__4M__seed-' || seed || '__doc0' AS slug,
        'task-' || nnn || '-x' AS task_stem, 'task_' || nnn || '_a_b_c_' || kind AS safe
    FROM p
    """,
    "cell_updates": """
    WITH u AS (
        SELECT o_custkey AS key, max(o_orderpriority) AS segment, max(o_orderstatus) AS name FROM orders GROUP BY ALL
    ), c AS (
        SELECT c_custkey AS key, c_name AS name, CASE c_custkey % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN c_mktsegment END AS segment
        FROM customer
    )
    SELECT c.key, CASE WHEN c.segment IS NULL OR c.segment = 'N/A' THEN coalesce(u.segment, c.segment)
        ELSE c.segment END AS segment, coalesce(u.name, c.name) AS name
    FROM c LEFT JOIN u USING (key)
    """,
    "key_checks": """
    SELECT o_custkey AS key, count(*) AS rows FROM orders GROUP BY ALL HAVING count(*) > 1
    UNION ALL SELECT c_custkey, 0 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    """,
    "first_seen_ids": """
    WITH g AS (SELECT o_custkey, min(o_orderkey) AS seen FROM orders GROUP BY ALL)
    SELECT o_custkey, row_number() OVER (ORDER BY seen) - 1 AS id FROM g
    """,
    "masked_values": """
    SELECT o_custkey, min(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS first_open,
        round(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END), 2) AS open_total,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS done
    FROM orders GROUP BY o_custkey
    """,
    "work_status": """
    WITH wanted AS (SELECT DISTINCT c_nationkey AS n FROM customer),
        finished AS (SELECT DISTINCT s_nationkey AS n FROM supplier WHERE s_acctbal < -900)
    SELECT CASE WHEN f.n IS NULL THEN 'processed' ELSE 'skipped' END AS status, count(*) AS directories
    FROM wanted w LEFT JOIN finished f ON f.n = w.n GROUP BY ALL
    """,
    "column_shaping": """
    SELECT c_custkey AS doc_id, c_name AS prd_name_full,
        CASE WHEN c_nationkey > 3 THEN c_mktsegment ELSE 'none' END AS prd_part,
        '{"n":' || c_nationkey || ',"s":"' || c_mktsegment || '"}' AS prd_doc, 7 AS prd_seed
    FROM customer
    """,
    "path_lists": """
    WITH p AS (
        SELECT page_id, array_to_string(list_filter(string_split(regexp_replace(url, '^https?:/', ''), '/'),
            lambda x: x <> '' AND x <> '.'), '/') AS path
        FROM pages
    )
    SELECT page_id, path || ',a/b' AS plain,
        '/c/o' || (page_id % 3) || '/r/' || path || ',/c/o' || (page_id % 3) || '/r/a/b' AS local,
        'expected exactly one path' AS error
    FROM p
    """,
}
