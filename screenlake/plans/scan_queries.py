"""Source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files as io
from ..sources.tables import read_table, table_path
from . import fixtures as fx
from .catalog import register
from .fixture_sql import with_views
from .metric_queries import rounded

LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("scan_project_limit", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
    FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1000""")
def q_scan_project_limit(spark, sf):
    # head(n) of a projection: the limit is the feature (nrows); TakeOrderedAndProject.
    return io.read_parquet_file(spark, table_path(sf, "lineitem"), LI_KEY + ["l_quantity"],
                                nrows=1000, order_by=LI_KEY)


@register("load_features_labels", with_views("""
    SELECT row_id, y, len(bits) AS width, CAST(list_sum(bits) AS BIGINT) AS n_set
    FROM text_vectors_parsed""", "text_vectors", extra=[("text_vectors_parsed", """
    SELECT row_id, y, [TRY_CAST(trim(t) AS FLOAT) FOR t IN string_split(bits_text, ',')] AS bits
    FROM text_vectors""")]))
def q_load_features_labels(spark, sf):
    feats = io.load_features(fx.text_vectors(spark, sf), ["bits_text"], "y")
    return feats.select("row_id", "y", F.size("bits_text").cast("bigint").alias("width"),
                        F.aggregate("bits_text", F.lit(0.0), lambda a, x: a + x).cast("bigint")
                        .alias("n_set"))


ORDERS_CSV_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                     "o_orderdate TIMESTAMP, o_orderpriority STRING")


@register("read_csv_or_parquet", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders,
           round(sum(o_totalprice), 6) AS total_price, count(DISTINCT o_custkey) AS n_customers
    FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def q_read_csv_or_parquet(spark, sf):
    # Write a CSV copy into the shared folder, then read it back through the dispatcher.
    path = scratch_path(spark, "orders") + ".csv"
    io.write_csv(read_table(spark, sf, "orders"), path)
    df = io.read_any(spark, path, ORDERS_CSV_SCHEMA)
    return rounded(df.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price"),
        F.countDistinct("o_custkey").alias("n_customers")))


@register("multi_file_source_tag", """
    SELECT 'lineitem_' || l_returnflag AS source, count(*) AS n_rows,
           round(sum(l_quantity), 6) AS sum_qty
    FROM lineitem GROUP BY l_returnflag""")
def q_multi_file_source_tag(spark, sf):
    # One file set per source value, then ONE read of all of them; identity from the path.
    base = scratch_path(spark, "lineitem_split")
    li = read_table(spark, sf, "lineitem", ["l_returnflag", "l_quantity"])
    io.write_partitioned(li.withColumn("source", F.concat(F.lit("lineitem_"), "l_returnflag")),
                         base, ["source"])
    back = io.with_source_file(spark.read.parquet(base))
    return rounded(back.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"),
                                              F.sum("l_quantity").alias("sum_qty")))
