"""The driver's tables seen as the engine's: files of pages, chunks, record tables, grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents: doc_id, line_no, line."""
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def web_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as one text element each: the host is the file, the page's number the page, tags are line ends."""
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    return read(spark, sf_dir, "pages").select(
        host.alias("doc_id"), F.col("page_id").cast("int").alias("element_no"), F.lit("text").alias("element_type"), F.lit("html").alias("file_type"), F.col("page_id").cast("int").alias("page"), F.lit("body").alias("region"), F.regexp_replace("html", "<[^>]*>", "\n").alias("text"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chunks: doc_id, chunk_index, section (the role), page (turn / 2), text."""
    c = read(spark, sf_dir, "conversations")
    index = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role")) - 1
    return c.select(F.col("conv_id").alias("doc_id"), index.alias("chunk_index"), F.col("role").alias("section"), F.floor(F.col("turn") / 2).cast("int").alias("page"), "text")


DATE_STYLES = ("yyyy-MM-dd", "d MMM yyyy", "MM-dd-yyyy", "MMM d", "dd/MM/yy")


def order_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record table for each customer with orders: dates in five styles, amounts with signs and commas, an own column."""
    o = read(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    style = F.pmod("o_orderkey", F.lit(5))
    day = F.date_format("d", DATE_STYLES[0])
    for k, s in enumerate(DATE_STYLES[1:], 1):
        day = F.when(style == k, F.date_format("d", s)).otherwise(day)
    amount = F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.concat(F.lit("+"), F.format_number(F.floor("o_totalprice"), 0))).when(F.pmod("o_orderkey", F.lit(3)) == 1, F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string")).otherwise("n/a")
    key = F.concat(F.lit("ORD-"), (F.col("o_orderkey") - F.pmod("o_orderkey", F.lit(7)).isin(6).cast("int")).cast("string"))
    owner = F.when(F.pmod("o_orderkey", F.lit(4)) == 0, "-").otherwise(F.col("o_orderpriority"))
    row = F.array(key, day, "o_orderstatus", amount, owner, F.concat(F.lit("see "), F.col("o_orderkey").cast("string")))
    grouped = o.select("o_custkey", F.struct(F.col("o_orderkey"), row.alias("row")).alias("r")).groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"]).alias("rows"))
    header = F.array(*map(F.lit, ("ID", "Order Date", "Record Status", "Total Amount", "Assigned To", "Legacy Code")))
    text = lambda v: F.lit(v).cast("string")
    return grouped.select(
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")).alias("doc_id"), F.lit(0).alias("element_no"), F.lit("t001").alias("table_id"), F.lit("table").alias("element_type"), F.lit("pdf").alias("file_type"), F.lit(False).alias("secondary_sheet"), F.lit(True).alias("has_header"),
        header.alias("columns"), header.alias("headers"), "rows", F.size("rows").alias("n_rows"), F.lit("Orders").alias("title"), text(None).alias("heading"), F.lit("Sales").alias("section"), F.array(F.lit(1)).alias("pages"), F.lit(1).alias("page"), text(None).alias("sheet_name"), F.lit(None).cast("int").alias("sheet_index"), text(None).alias("block_range"), text(None).alias("file_name"), F.lit("orders").alias("source"), text(None).alias("text"), F.lit(1).alias("merged_parts"),
    )


def line_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each order of its lines: doc_id, table_id, columns, rows."""
    li = read(spark, sf_dir, "lineitem")
    row = F.array(F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string"), "l_returnflag", F.date_format("l_shipdate", "yyyy-MM-dd"))
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", row.alias("row"))
    grouped = li.select("l_orderkey", order.alias("r")).groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"]).alias("rows"))
    return grouped.select(F.col("l_orderkey").alias("doc_id"), F.lit("t001").alias("table_id"), F.array(*map(F.lit, ("Line", "Part", "Supplier", "Quantity", "Flag", "Ship Date"))).alias("columns"), "rows")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a sparse grid: a sheet for each event type, a row for a user, a column for a day."""
    e = read(spark, sf_dir, "events")
    day = F.datediff(F.to_date("ts"), F.lit("2020-01-01").cast("date"))
    return e.select(F.col("event_type").alias("doc_id"), F.lit(1).alias("sheet_index"), F.col("user_id").cast("int").alias("row"), day.alias("col")).groupBy("doc_id", "sheet_index", "row", "col").agg(F.count(F.lit(1)).cast("string").alias("value"))


def boxes(spark: SparkSession, sf_dir: str, name: str = "orders", key: str = "o_orderkey") -> DataFrame:
    """Boxes on pages, their places worked out from a key."""
    k = F.col(key)
    at = lambda a, m: F.pmod(k * a, F.lit(m)).cast("double")
    return read(spark, sf_dir, name).select(k.alias("box"), F.pmod(k, F.lit(40)).alias("doc_id"), F.pmod(k, F.lit(7)).alias("page"), at(37, 600).alias("x0"), at(53, 800).alias("top"), (at(37, 600) + 5 + at(3, 11)).alias("x1"), (at(53, 800) + 4 + at(5, 13)).alias("bottom"))
