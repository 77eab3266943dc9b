"""Scans, filters, expressions, joins, aggregates, windows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from registry import register
from registry.star import (CLEAN_LINES, CLICKS, EMPLOYEES, LINE_KEY, LINE_ORDER, LINE_TIEBREAK,
                           NET_AMOUNT, USERS, clicks, employees, table, users)
from tradeloom.functions import columns as C
from tradeloom.operators import aggregates, dedup, joins, layout, quality, ranking, skew
from tradeloom.plans.sessions import funnel_events
from tradeloom.session import scratch_path
from tradeloom.sources import files, rows
from tradeloom.sources.versioned import merge_frames

# --- sources and sinks -------------------------------------------------------------------


@register("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    files.write_results(table(spark, d, "customer"), path, "csv")
    return files.read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@register("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_json_roundtrip(spark, d):
    return files.round_trip(table(spark, d, "events"), "json")


@register("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_parquet(spark, d):
    return files.round_trip(table(spark, d, "part"), "parquet")


@register("""SELECT range AS id, 'SESS' || lpad(CAST(range AS VARCHAR), 10, '0') AS session_id
FROM range((SELECT count(*) FROM events))""")
def range_source(spark, d):
    total = table(spark, d, "events").count()
    return rows.sequence(spark, 0, total).withColumn("session_id", C.format_key("SESS", "id", 10))


@register("""SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS n FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-15' GROUP BY 1, 2""")
def partition_pruned_scan(spark, d):
    path = scratch_path(spark, "by-date")
    events = table(spark, d, "events").withColumn("event_date", F.to_date("ts"))
    files.write_results(events, path, partition_by=["event_date"])
    # the filter on the folder column opens only the folders of those days
    return (files.read_parquet(spark, path).filter(F.col("event_date") >= F.lit("2024-01-15").cast("date"))
            .groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("n")))


@register("SELECT o_orderkey, 'orders.parquet' AS source_file, true AS has_time, 'day-1' AS _batch_id FROM orders")
def ingest_provenance(spark, d):
    path = scratch_path(spark, "bronze")
    files.ingest(files.read_parquet(spark, f"{d}/orders.parquet").select("o_orderkey"), path, "day-1")
    return files.read_parquet(spark, path).select(
        "o_orderkey", F.element_at(F.split("_source_file", "/"), -1).alias("source_file"),
        F.col("_ingested_at").isNotNull().alias("has_time"), "_batch_id")


@register("""SELECT * FROM (VALUES ('overwrite', 1), ('append', 2), ('ignore', 1), ('error', 1)) v(mode, copies),
  (SELECT count(*) AS n FROM customer) c""".replace("SELECT *", "SELECT mode, copies * n AS n", 1))
def write_modes(spark, d):
    source = table(spark, d, "customer").select("c_custkey")
    counts = None
    for mode in ("overwrite", "append", "ignore", "error"):
        path = scratch_path(spark, f"mode-{mode}")
        files.write_results(source, path)
        try:
            files.write_results(source, path, mode=mode)
        except AnalysisException as refused:
            if mode != "error" or refused.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        one = files.read_parquet(spark, path).agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


# --- projections and filters -------------------------------------------------------------


@register("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders")
def project_columns(spark, d):
    return (table(spark, d, "orders").withColumnRenamed("o_orderkey", "order_id")
            .select("order_id", F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount")))


# Order size labels and the discount each one earns.
AMOUNT_STEPS = [(50_000, "Premium"), (20_000, "Standard")]
LOWEST_AMOUNT = "Budget"
AMOUNT_CASE = """CASE WHEN o_totalprice >= 50000 THEN 'Premium' WHEN o_totalprice >= 20000 THEN 'Standard'
  ELSE 'Budget' END"""


@register(f"SELECT o_orderkey, o_totalprice, {AMOUNT_CASE} AS category FROM orders")
def amount_category(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", C.tier("o_totalprice", AMOUNT_STEPS, LOWEST_AMOUNT).alias("category"))


@register(f"""SELECT o_orderkey, category, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CASE category
  WHEN 'Premium' THEN 0.10 WHEN 'Standard' THEN 0.05 ELSE 0.00 END, 2) AS DOUBLE) AS discount_amount
FROM (SELECT o_orderkey, o_totalprice, {AMOUNT_CASE} AS category FROM orders)""")
def category_discount(spark, d):
    share = F.expr("CASE category WHEN 'Premium' THEN 0.10BD WHEN 'Standard' THEN 0.05BD ELSE 0.00BD END")
    return amount_category(spark, d).select(
        "o_orderkey", "category", F.round(C.as_money("o_totalprice") * share, 2).alias("discount_amount"))


@register("""SELECT s_suppkey, s_acctbal,
  CASE WHEN s_acctbal >= 8000 THEN 'A' WHEN s_acctbal >= 6500 THEN 'B' ELSE 'C' END AS grade FROM supplier""")
def price_grade(spark, d):
    return table(spark, d, "supplier").select(
        "s_suppkey", "s_acctbal", C.tier("s_acctbal", [(8_000, "A"), (6_500, "B")], "C").alias("grade"))


@register("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 7000")
def filter_compare(spark, d):
    return table(spark, d, "supplier").filter(F.col("s_acctbal") > 7000).select("s_suppkey", "s_name", "s_acctbal")


@register("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000")
def filter_and(spark, d):
    return (table(spark, d, "orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 50_000))
            .select("o_orderkey", "o_totalprice"))


@register("SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 10")
def filter_sql_text(spark, d):
    return (table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity >= 10")
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"))


@register(f"WITH {USERS} SELECT user_id, name, city FROM users WHERE city IN ('NATION_3', 'NATION_7')")
def filter_isin(spark, d):
    return (users(spark, d).filter(F.col("city").isin("NATION_3", "NATION_7"))
            .select("user_id", "name", "city"))


@register("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, array_to_string(list_filter([
    CASE WHEN l_quantity > 5 THEN NULL ELSE 'quantity' END,
    CASE WHEN l_extendedprice > 10000 THEN NULL ELSE 'unit_price' END,
    CASE WHEN l_discount < 0.1 THEN NULL ELSE 'discount' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM lineitem""")
def quality_split(spark, d):
    good, bad = quality.split(table(spark, d, "lineitem"), {
        "quantity": F.col("l_quantity") > 5, "unit_price": F.col("l_extendedprice") > 10_000,
        "discount": F.col("l_discount") < 0.1})
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return good.select(*keys, F.lit("").alias("reasons")).unionByName(
        bad.select(*keys, F.array_join(quality.REASONS, ",").alias("reasons")))


@register(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST({NET_AMOUNT} AS DOUBLE) AS net_amount FROM lineitem")
def net_amount(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        C.net_amount("l_quantity", "l_extendedprice", "l_discount").alias("net_amount"))


# --- joins -------------------------------------------------------------------------------
# Facts are the order headers. The dimension holds the customers in credit, so that some
# orders have no match, and the suppliers, who never order.

IN_CREDIT = """credit AS (SELECT c_custkey AS user_id, c_name AS name FROM customer WHERE c_acctbal > 0
  UNION ALL SELECT -1 - s_suppkey, s_name FROM supplier WHERE s_acctbal > 0)"""
ALL_ORDERS = "facts AS (SELECT o_orderkey AS order_id, o_custkey AS user_id, o_totalprice AS amount FROM orders)"


def _in_credit(spark, d) -> DataFrame:
    customers = (table(spark, d, "customer").filter("c_acctbal > 0")
                 .select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")))
    suppliers = (table(spark, d, "supplier").filter("s_acctbal > 0")
                 .select((F.lit(-1) - F.col("s_suppkey")).alias("user_id"), F.col("s_name").alias("name")))
    return customers.unionByName(suppliers)


def _facts(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                                            F.col("o_totalprice").alias("amount"))


@register(f"WITH {IN_CREDIT}, {ALL_ORDERS} SELECT user_id, order_id, amount, name FROM facts JOIN credit USING (user_id)")
def join_inner(spark, d):
    # no hint: Spark compares both sides' sizes, also at run time, and splits skewed partitions
    return _facts(spark, d).join(_in_credit(spark, d), "user_id")


@register(f"WITH {IN_CREDIT}, {ALL_ORDERS} SELECT user_id, order_id, amount, name FROM facts JOIN credit USING (user_id)")
def join_broadcast(spark, d):
    return joins.lookup_join(_facts(spark, d), _in_credit(spark, d), ["user_id"])


@register(f"WITH {IN_CREDIT}, {ALL_ORDERS} SELECT user_id, order_id, amount, name FROM facts LEFT JOIN credit USING (user_id)")
def join_left(spark, d):
    return joins.lookup_join(_facts(spark, d), _in_credit(spark, d), ["user_id"], "left")


@register(f"WITH {IN_CREDIT}, {ALL_ORDERS} SELECT user_id, order_id, amount FROM facts SEMI JOIN credit USING (user_id)")
def join_left_semi(spark, d):
    return quality.keep_known(_facts(spark, d), _in_credit(spark, d), "user_id")


@register(f"WITH {IN_CREDIT}, {ALL_ORDERS} SELECT user_id, order_id, amount FROM facts ANTI JOIN credit USING (user_id)")
def join_left_anti(spark, d):
    return quality.orphans(_facts(spark, d), _in_credit(spark, d), "user_id")


@register(f"WITH {IN_CREDIT}, {ALL_ORDERS} SELECT user_id, order_id, amount, name FROM facts RIGHT JOIN credit USING (user_id)")
def join_right(spark, d):
    return joins.keep_all_of_right(_facts(spark, d), _in_credit(spark, d), ["user_id"])


@register(f"WITH {IN_CREDIT}, {ALL_ORDERS} SELECT user_id, order_id, amount, name FROM facts FULL JOIN credit USING (user_id)")
def join_full_outer(spark, d):
    return joins.keep_all(_facts(spark, d), _in_credit(spark, d), ["user_id"])


@register("""SELECT count(*) AS lines,
  count(*) FILTER (l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25)
                   AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')) AS known,
  count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)) AS unknown_product,
  count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')) AS unknown_order
FROM lineitem""")
def referential_integrity(spark, d):
    parts = table(spark, d, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    heads = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    tagged = quality.tag_unknown(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), parts, "l_partkey")
    tagged = quality.tag_unknown(tagged, heads, "l_orderkey")

    def broken(reason):
        return F.count(F.when(F.array_contains(quality.REASONS, reason), 1))

    return tagged.agg(F.count(F.lit(1)).alias("lines"),
                      F.count(F.when(F.size(quality.REASONS) == 0, 1)).alias("known"),
                      broken("unknown_l_partkey").alias("unknown_product"),
                      broken("unknown_l_orderkey").alias("unknown_order"))


@register("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, p_type
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def salted_join(spark, d):
    facts = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return skew.salted_join(facts, parts, ["l_partkey"], min_share=0.0005)


@register("""SELECT l_orderkey, l_linenumber, l_partkey, line_class, p_type
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 3 THEN 1 ELSE l_partkey END AS l_partkey,
             l_linenumber % 3 AS line_class FROM lineitem)
LEFT JOIN part ON l_partkey = p_partkey""")
def salted_join_mixed_keys(spark, d):
    # one key holds most lines at every scale, the others are cold
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") <= 3, F.lit(1)).otherwise(
        F.col("l_partkey")).cast("long").alias("l_partkey"), (F.col("l_linenumber") % 3).alias("line_class"))
    parts = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("l_partkey"), "p_type")
    return skew.salted_join(lines, parts, ["l_partkey"], "left", min_share=0.1)


@register("""SELECT event_id, event_type, first_ts
FROM events JOIN (SELECT event_type, min(ts) AS first_ts FROM events GROUP BY event_type) USING (event_type)""")
def salted_join_hot_keys(spark, d):
    # a handful of keys: every one is hot at every scale
    facts = table(spark, d, "events").select("event_id", "event_type")
    kinds = table(spark, d, "events").groupBy("event_type").agg(F.min("ts").alias("first_ts"))
    return skew.salted_join(facts, kinds, ["event_type"])


@register("""SELECT o_orderkey, (SELECT max(o_orderdate) FROM orders) AS as_of,
  date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS recency_days
FROM orders""".replace("date_diff(", "CAST(date_diff(").replace("AS DATE)) AS recency", "AS DATE)) AS INTEGER) AS recency"))
def scalar_as_of(spark, d):
    orders = table(spark, d, "orders")
    newest = orders.agg(F.max("o_orderdate")).scalar()
    return (orders.withColumn("as_of", newest)
            .select("o_orderkey", "as_of", F.datediff("as_of", "o_orderdate").alias("recency_days")))


@register("""SELECT o_custkey, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE),
  CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS INTEGER) AS recency_days FROM orders GROUP BY o_custkey""")
def recency_days(spark, d):
    orders = table(spark, d, "orders")
    newest = orders.agg(F.max("o_orderdate")).scalar()
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    return last.select("o_custkey", F.datediff(newest, "last").alias("recency_days"))


# --- aggregates --------------------------------------------------------------------------


@register(f"WITH {EMPLOYEES} SELECT city, CAST(sum(salary) AS DOUBLE) AS total FROM employees GROUP BY city")
def agg_sum(spark, d):
    return employees(spark, d).groupBy("city").agg(F.sum("salary").alias("total")).orderBy(F.desc("total"), "city")


@register("""SELECT o_custkey, c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey, c_name""")
def spend_per_customer(spark, d):
    # totals first: the join then sees one row per customer
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(C.as_money("o_totalprice")).alias("total_spend"))
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return spent.join(names, "o_custkey").orderBy(F.desc("total_spend"), "o_custkey")


@register("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def agg_count(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@register("""SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_extendedprice) AS max_price,
  min(l_extendedprice) AS min_price, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_quantity
FROM lineitem GROUP BY 1, 2""")
def agg_stats(spark, d):
    return (table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("max_price"),
                 F.min("l_extendedprice").alias("min_price"), F.avg("l_quantity").alias("avg_quantity")))


@register("""SELECT o_orderpriority, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS finished_rate
FROM orders GROUP BY o_orderpriority""")
def rate_by_group(spark, d):
    return (table(spark, d, "orders").groupBy("o_orderpriority")
            .agg(C.rate(F.col("o_orderstatus") == "F").alias("finished_rate")))


@register("""SELECT p_type, CAST(round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS DOUBLE)
  AS avg_price FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def agg_avg_rounded(spark, d):
    # per part first, so that a part sold in most lines is one row when the type is looked up
    per_part = (table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
                .agg(F.sum(C.as_money("l_extendedprice")).alias("total"), F.count(F.lit(1)).alias("n")))
    parts = table(spark, d, "part").select("p_partkey", "p_type")
    return (per_part.join(parts, "p_partkey").groupBy("p_type")
            .agg(F.round(F.sum("total") / F.sum("n").cast("decimal(18,0)"), 2).alias("avg_price")))


@register("SELECT CAST(sum(l_linenumber) AS BIGINT) AS total, count(*) AS n FROM lineitem")
def global_sum(spark, d):
    return table(spark, d, "lineitem").agg(F.sum("l_linenumber").alias("total"), F.count(F.lit(1)).alias("n"))


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@register(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES))
def table_counts(spark, d):
    counts = None
    for name in TABLES:
        one = table(spark, d, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem" for c in DESCRIBED))
def describe_numeric(spark, d):
    stats = aggregates.describe_numeric(table(spark, d, "lineitem"), DESCRIBED)
    return stats.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


WORDS = "SELECT unnest(string_split(lower(text), ' ')) AS token FROM documents"


@register(f"SELECT token, count(*) AS n FROM ({WORDS}) WHERE token <> '' GROUP BY token")
def word_count(spark, d):
    return aggregates.word_count(table(spark, d, "documents").select(F.lower("text").alias("text")), "text")


@register(f"SELECT token, count(*) AS n FROM ({WORDS}) WHERE token <> '' GROUP BY token ORDER BY n DESC, token LIMIT 20")
def word_count_top20(spark, d):
    return aggregates.top_words(table(spark, d, "documents").select(F.lower("text").alias("text")), "text", 20)


@register("""SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n,
  max(l_quantity) AS largest FROM lineitem GROUP BY l_returnflag""")
def salted_agg(spark, d):
    lines = table(spark, d, "lineitem").withColumn("price", C.as_money("l_extendedprice"))
    return skew.salted_agg(lines, ["l_returnflag"], {"total": ("sum", "price"), "n": ("count", "price"),
                                                     "largest": ("max", "l_quantity")},
                           salts=16, salt_on=["l_orderkey", "l_linenumber", "l_partkey"])


@register("""SELECT l_suppkey, count(*) AS rows, count(*) / sum(count(*)) OVER () AS share,
  count(*) * count(*) OVER () / sum(count(*)) OVER () AS ratio_to_mean FROM lineitem GROUP BY l_suppkey""")
def skew_report(spark, d):
    return skew.skew_report(table(spark, d, "lineitem"), ["l_suppkey"])


# --- windows, order, sets ----------------------------------------------------------------


@register(f"WITH {CLEAN_LINES} SELECT * FROM clean_lines")
def dedup_latest(spark, d):
    return dedup.dedup_latest(table(spark, d, "lineitem"), LINE_KEY, LINE_ORDER, LINE_TIEBREAK)


RANKED = f"""WITH {USERS} SELECT o_orderkey, city, o_totalprice,
  CAST(rank() OVER (PARTITION BY city ORDER BY o_totalprice DESC) AS INTEGER) AS rank_in_city
FROM orders JOIN users ON o_custkey = user_id"""


def _orders_with_city(spark, d) -> DataFrame:
    homes = users(spark, d).select(F.col("user_id").alias("o_custkey"), "city")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.lookup_join(orders, homes, ["o_custkey"]).select("o_orderkey", "city", "o_totalprice")


@register(RANKED)
def rank_in_group(spark, d):
    return ranking.rank_in_group(_orders_with_city(spark, d), ["city"], ["o_totalprice desc"], ["o_orderkey"],
                                 "rank_in_city")


@register(RANKED)
def rank_distributed(spark, d):
    return ranking.spread_rank(_orders_with_city(spark, d), ["city"], ["o_totalprice desc"], ["o_orderkey"],
                               "rank_in_city")


TOP_EARNERS = """SELECT department, name, salary
FROM (SELECT *, RANK() OVER (PARTITION BY department ORDER BY salary DESC) AS place FROM {employees})
WHERE place = 1"""


@register(f"""WITH {EMPLOYEES} SELECT department, name, CAST(salary AS DOUBLE) AS salary FROM employees
QUALIFY rank() OVER (PARTITION BY department ORDER BY salary DESC) = 1""")
def top_per_group_sql(spark, d):
    # the frame is an argument, so no view of the session changes; the rank limit runs before the shuffle too
    return spark.sql(TOP_EARNERS, employees=employees(spark, d))


@register(f"""WITH {EMPLOYEES} SELECT department, name, CAST(salary AS DOUBLE) AS salary FROM employees
QUALIFY rank() OVER (PARTITION BY department ORDER BY salary DESC) = 1""")
def top_per_group(spark, d):
    return ranking.top_per_group(employees(spark, d), ["department"], "salary").select("department", "name", "salary")


@register("""SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS tile FROM orders""")
def ntile_distributed(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ranking.spread_ntile(orders, 5, ["o_totalprice", "o_orderkey"], "tile").select("o_orderkey", "tile")


@register("""SELECT n_name AS name, 'nation' AS kind FROM nation UNION ALL SELECT r_name, 'region' FROM region
UNION ALL SELECT c_name, 'customer' FROM customer""")
def union_by_name(spark, d):
    kinds = {"nation": "n_name", "region": "r_name", "customer": "c_name"}
    parts = [table(spark, d, t).select(F.lit(t).alias("kind"), F.col(c).alias("name")) for t, c in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("SELECT DISTINCT c_mktsegment AS segment FROM customer")
def distinct_values(spark, d):
    return table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment")).distinct().orderBy("segment")


@register("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer
UNION ALL SELECT -1 - s_suppkey, s_acctbal FROM supplier""")
def upsert_merge(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    settled = customers.filter("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    joined = table(spark, d, "supplier").select((F.lit(-1) - F.col("s_suppkey")).alias("c_custkey"),
                                                F.col("s_acctbal").alias("c_acctbal"))
    return merge_frames(customers, settled.unionByName(joined), ["c_custkey"])


# --- functions ---------------------------------------------------------------------------


@register(f"WITH {USERS} SELECT user_id, lower(trim(email)) AS email FROM users")
def normalize_strings(spark, d):
    return users(spark, d).select("user_id", C.clean_email("email").alias("email"))


@register("""SELECT c_custkey, 'USR' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS user_key FROM customer""")
def format_keys(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.format_key("USR", "c_custkey", 8).alias("user_key"))


@register("""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_time,
  CAST(o_orderdate AS DATE) AS order_date, CAST(NULL AS DATE) AS bad_date, CAST(NULL AS TIMESTAMP) AS bad_time
FROM orders""")
def parse_dates(spark, d):
    text = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("text"))
    return text.select("o_orderkey", C.as_timestamp("text").alias("order_time"), C.as_date("text").alias("order_date"),
                       C.as_date("o_orderpriority").alias("bad_date"), C.as_timestamp("o_orderpriority").alias("bad_time"))


@register("""SELECT event_id, ts + to_seconds(CAST(floor(value) AS INTEGER)) AS plus_seconds,
  ts + to_days(CAST(user_id AS INTEGER)) AS plus_days FROM events""")
def timestamp_add(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.expr("timestampadd(SECOND, cast(floor(value) AS int), ts)").alias("plus_seconds"),
        F.timestamp_add("DAY", F.col("user_id").cast("int"), "ts").alias("plus_days"))


@register("""SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'first' WHEN 1 THEN 'second' WHEN 2 THEN 'third'
  ELSE 'Segment ' || (c_nationkey + 1) END AS label FROM customer""")
def label_by_index(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", C.label_at(["first", "second", "third"], F.col("c_nationkey") + 1).alias("label"))


@register("""SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 5 END AS stage
FROM events""")
def map_lookup(spark, d):
    return table(spark, d, "events").select(
        "event_id", C.lookup({"view": 1, "click": 2, "purchase": 5}, "event_type").alias("stage"))


@register(f"""WITH {CLICKS} SELECT session_id, user_id, event_type, min(event_timestamp) AS event_timestamp
FROM clicks GROUP BY session_id, user_id, event_type""")
def funnel_unpivot(spark, d):
    stages = {"view": "view_ts", "add_to_cart": "cart_ts", "checkout_start": "checkout_ts",
              "payment_attempt": "payment_ts", "purchase": "purchase_ts"}
    wide = clicks(spark, d).groupBy("session_id", "user_id").agg(*[
        F.min(F.when(F.col("event_type") == event, F.col("event_timestamp"))).alias(column)
        for event, column in stages.items()])
    return funnel_events(wide, stages, ["session_id", "user_id"])


@register("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def parse_json_payload(spark, d):
    shape = T.StructType([T.StructField("k", T.IntegerType())])
    return (table(spark, d, "events").select("event_id", F.from_json("props", shape).alias("data"))
            .select("event_id", "data.*"))


@register("""SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS whole,
  TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS lead,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS money FROM orders""")
def safe_cast(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", C.as_int("o_orderpriority").alias("whole"),
        C.as_int(F.split("o_orderpriority", "-")[0]).alias("lead"), C.as_money("o_totalprice").alias("money"))


@register("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 AS doubled FROM lineitem WHERE l_quantity * 2 > 50""")
def range_map_filter(spark, d):
    return (table(spark, d, "lineitem")
            .select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") * 2).alias("doubled"))
            .filter("doubled > 50"))


# --- draws and layout ----------------------------------------------------------------------


@register("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE CAST(('0x' || substr(md5('7:' || l_orderkey || ':' || l_linenumber), 1, 8)) AS BIGINT) / 4294967296.0 < 0.1""")
def sampled_tenth(spark, d):
    return table(spark, d, "lineitem").where(C.portable_draw(7, "l_orderkey", "l_linenumber") < 0.1).select("l_orderkey", "l_linenumber", "l_quantity")


@register("""WITH layouts AS (SELECT unnest(['read', 'by key', 'by range', 'rebalanced', 'fewer']) AS layout)
SELECT layout, count(*) AS rows, CASE layout WHEN 'by key' THEN true END AS keys_whole, CASE layout WHEN 'by range' THEN true END AS ranges_apart
FROM layouts, lineitem GROUP BY layout""")
def layout_report(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    laid = {"read": lines, "by key": lines.repartition(16, "l_orderkey"), "by range": lines.repartitionByRange(16, "l_shipdate"),
            "rebalanced": lines.hint("rebalance"), "fewer": lines.coalesce(2)}
    none, report = F.lit(None).cast("boolean"), None
    for name, df in laid.items():
        whole = layout.keys_whole(df, ["l_orderkey"]).scalar() if name == "by key" else none
        apart = layout.ranges_apart(df, "l_shipdate").scalar() if name == "by range" else none
        line = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layout"), "rows", whole.alias("keys_whole"), apart.alias("ranges_apart"))
        report = line if report is None else report.unionByName(line)
    return report
