"""Table sources and sinks over files written from the given tables, and sorts with their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.shape import table
from evalflow.functions import jsontext
from evalflow.functions.runids import legacy_type
from evalflow.operators import columns as ops
from evalflow.operators.ordering import sorted_nulls_as_blank, sorted_nulls_last
from evalflow.plans.reports import counts_by_period
from evalflow.session import fresh_folder, settle
from evalflow.sinks import tables as sinks
from evalflow.sources import tables


def numbered(ordered: DataFrame) -> DataFrame:
    """Rows of a sorted frame with their ``place`` in it, from 1.

    Each task numbers the rows of its range; the ranges' sizes give the rest.
    """
    ranged = settle(
        ordered.withColumns({"_range": F.spark_partition_id(), "_n": F.monotonically_increasing_id()})
    )
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"), F.min("_n").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    return (
        ranged.join(starts, "_range")
        .withColumn("place", F.col("_start") + F.col("_n") - F.col("_first") + 1)
        .drop("_range", "_n", "_size", "_first", "_start")
    )


def shard_rows(spark, folder):
    """Orders in two shards, read back as one table; each row has a place of its own."""
    root = fresh_folder(spark, "shards")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for side in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == side).write.parquet(f"{root}/shard{side}")
    read = tables.with_source_order(tables.read_shards(spark, [f"{root}/shard0", f"{root}/shard1"]))
    places = read.groupBy("source_path", "source_row").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("o_orderkey"))
    return read.drop("source_path", "source_row").join(places.select("o_orderkey", "n"), "o_orderkey")


def cached_merge(spark, folder):
    """Customers and suppliers as files of one folder, merged by column name."""
    root = fresh_folder(spark, "cached")
    table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    ).write.parquet(f"{root}/part=a")
    table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
    ).write.parquet(f"{root}/part=b")
    return tables.read_cached(spark, root).select("name", "nation", "segment", "balance")


def merged_as_text(spark, folder):
    """Two tables by file stem, then as one with all columns as text."""
    root = fresh_folder(spark, "named")
    table(spark, folder, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("key")).write.parquet(f"{root}/nation.parquet")
    table(spark, folder, "part").select(F.col("p_name").alias("name"), F.array("p_size").alias("sizes")).write.parquet(f"{root}/part.parquet")
    read = tables.read_tables(spark, [f"{root}/nation.parquet", f"{root}/part.parquet"])
    return tables.merge_as_text([read["nation"], read["part"]])


def csv_view(spark, folder):
    """Customers as CSV with a header, registered as a view and counted there."""
    path = fresh_folder(spark, "csv")
    table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey").write.option("header", "true").csv(path)
    view = tables.read_csv_view(spark, path, f"csv_{path.rsplit('-', 1)[1]}")
    return view.groupBy("c_mktsegment").agg(
        F.count("*").alias("customers"), F.sum("c_nationkey").cast("long").alias("nations")
    )


def json_rows(spark, folder):
    """Suppliers as JSON lines, converted to Parquet once: the second call reads the first's."""
    root = fresh_folder(spark, "json")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    tables.write_json_rows(suppliers, f"{root}/a")
    tables.write_json_rows(suppliers.withColumn("s_name", F.lit("later")), f"{root}/b")
    schema = suppliers.schema
    tables.json_to_parquet(spark, f"{root}/a", f"{root}/out", schema)
    return tables.json_to_parquet(spark, f"{root}/b", f"{root}/out", schema)


def published(spark, folder):
    """A table with every column as text, published to a target folder."""
    root = fresh_folder(spark, "publish")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", F.struct("p_size", "p_type").alias("kind"))
    sinks.write_text_table(parts, f"{root}/parts")
    sinks.publish(spark, {"parts.parquet": f"{root}/parts"}, f"{root}/target")
    return spark.read.parquet(f"{root}/target/parts.parquet")


def replaced_partitions(spark, folder):
    """Orders by status; a later write replaces the partitions it writes and no other."""
    path = fresh_folder(spark, "replaced")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_table(orders, path, partition_by=("o_orderstatus",))
    changed = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    sinks.write_table(changed, path, partition_by=("o_orderstatus",))
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def sql_functions(spark, folder):
    """The functions registered for SQL over configurations in two key orders."""
    jsontext.register_sql(spark)
    view = f"configs_{fresh_folder(spark, 'v').rsplit('-', 1)[1]}"
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    text = F.when(
        F.col("o_orderkey") % 2 == 0, F.concat(F.lit('{"task_name":"t","s":"'), status, F.lit('","k":'), key, F.lit("}"))
    ).otherwise(F.concat(F.lit('{"k":'), key, F.lit('.0,"s":"'), status, F.lit('"}')))
    table(spark, folder, "orders").select("o_orderkey", text.alias("c")).createOrReplaceTempView(view)
    return spark.sql(f"SELECT o_orderkey, normalize_config(c) AS config, canonical_json(c) AS canon FROM {view}")


def legacy_types(spark, folder):
    """The first naming scheme's rule over made-up run names."""
    name = F.concat(
        F.when(F.col("o_custkey") % 5 == 0, F.lit("x_main_default_")).otherwise(F.lit("x_")),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("dpo_")).otherwise(F.lit("")),
        F.when(F.col("o_custkey") % 7 == 0, F.lit("--reduce_loss=sum")).otherwise(F.lit("")),
    )
    return table(spark, folder, "orders").select("o_orderkey", legacy_type(name).alias("kind"))


def default_columns(spark, folder):
    """A column that is added, one whose nulls are filled, one that is left."""
    base = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).alias("segment")
    )
    out = ops.ensure_column(ops.ensure_column(ops.ensure_column(base, "segment", "none"), "made", 5), "empty")
    return ops.add_prefix(out, "p_", skip=("c_custkey",))


def _gaps(spark, folder):
    brand = F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand"))
    return table(spark, folder, "part").select("p_partkey", brand.alias("brand"), "p_size")


def sort_nulls_last(spark, folder):
    return numbered(sorted_nulls_last(_gaps(spark, folder), ["brand", "p_size"], ["p_partkey"]))


def sort_nulls_as_blank(spark, folder):
    rows = _gaps(spark, folder).withColumn("key", F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    return numbered(sorted_nulls_as_blank(rows, ["brand", "key"]))


def period_order(spark, folder):
    return numbered(counts_by_period(table(spark, folder, "orders"), "o_orderdate", "yyyy-MM", name="month", count="orders"))


QUERIES = {
    "shard_rows": shard_rows,
    "cached_merge": cached_merge,
    "merged_as_text": merged_as_text,
    "csv_view": csv_view,
    "json_rows": json_rows,
    "published": published,
    "replaced_partitions": replaced_partitions,
    "sql_functions": sql_functions,
    "legacy_types": legacy_types,
    "default_columns": default_columns,
    "sort_nulls_last": sort_nulls_last,
    "sort_nulls_as_blank": sort_nulls_as_blank,
    "period_order": period_order,
}
_GAPS = "(SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS brand, p_size FROM part)"
SQL = {
    "shard_rows": "SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS n FROM orders",
    "cached_merge": """
    SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_name, s_nationkey, NULL, s_acctbal FROM supplier
    """,
    "merged_as_text": """
    SELECT n_name AS name, CAST(n_regionkey AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS sizes FROM nation
    UNION ALL SELECT p_name, NULL, '[' || p_size || ']' FROM part
    """,
    "csv_view": """
    SELECT c_mktsegment, count(*) AS customers, CAST(sum(c_nationkey) AS BIGINT) AS nations
    FROM customer GROUP BY c_mktsegment
    """,
    "json_rows": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "published": """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand,
        '{"p_size":' || p_size || ',"p_type":"' || p_type || '"}' AS kind FROM part
    """,
    "replaced_partitions": """
    SELECT o_orderstatus, count(*) AS orders,
        round(sum(CASE o_orderstatus WHEN 'F' THEN 0.0 ELSE o_totalprice END), 2) AS total
    FROM orders GROUP BY o_orderstatus
    """,
    "sql_functions": """
    SELECT o_orderkey, '{"k":' || o_orderkey || ',"s":"' || o_orderstatus || '"}' AS config,
        '{"k":' || o_orderkey || ',"s":"' || o_orderstatus || '"'
            || CASE WHEN o_orderkey % 2 = 0 THEN ',"task_name":"t"' ELSE '' END || '}' AS canon
    FROM orders
    """,
    "legacy_types": """
    SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 AND o_custkey % 3 <> 0 AND o_custkey % 7 <> 0
        THEN 'old' ELSE 'other' END AS kind FROM orders
    """,
    "default_columns": """
    SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE 'none' END AS p_segment,
        5 AS p_made, CAST(NULL AS VARCHAR) AS p_empty FROM customer
    """,
    "sort_nulls_last": f"""
    SELECT *, row_number() OVER (ORDER BY brand NULLS LAST, p_size, p_partkey) AS place FROM {_GAPS}
    """,
    "sort_nulls_as_blank": f"""
    SELECT *, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS key,
        row_number() OVER (ORDER BY coalesce(brand, ''), p_partkey) AS place FROM {_GAPS}
    """,
    "period_order": """
    SELECT *, row_number() OVER (ORDER BY month) AS place FROM (
        SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders GROUP BY month)
    """,
}
