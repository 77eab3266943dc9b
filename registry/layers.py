"""Silver and gold tables, reports and segments."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from registry import register
from registry.star import (ACCOUNTS, CLICKS, EMPLOYEES, LINE_ORDER, LINE_TIEBREAK, ORDER_LINES,
                           PRODUCTS, SESSIONS, USERS, accounts, clicks, employees, lines_of, order_lines, products, sessions, table,
                           users)
from tradeloom.operators import quality
from tradeloom.operators.ordering import sort_names
from tradeloom.plans import employees as report
from tradeloom.plans import leakage, rfm, rollups, segments, silver
from tradeloom.plans import sessions as stitching
from tradeloom.session import scratch_path, written
from tradeloom.sources import files

# --- silver ------------------------------------------------------------------------------
# The tables hold no duplicates of customers and parts, so the raw ones carry every row twice,
# the older copy with a stale value.


def _raw_users(spark, d) -> DataFrame:
    fresh = users(spark, d).withColumn("signup_date", F.lit("2024-02-30")).drop("balance")
    stale = fresh.withColumn("email", F.lit("stale"))
    return fresh.withColumn("_ingested_at", F.lit(2)).unionByName(stale.withColumn("_ingested_at", F.lit(1)))


def _raw_products(spark, d) -> DataFrame:
    fresh = products(spark, d).withColumns({
        "category": F.concat(F.lit(" "), F.col("category"), F.lit(" ")),
        # prices of size 1 are unreadable, so those products are rejected
        "list_price": F.when(F.col("size") == 1, F.lit("n/a")).otherwise(F.col("list_price").cast("string"))}).drop("size")
    stale = fresh.withColumn("list_price", F.lit("0.01"))
    return fresh.withColumn("_ingested_at", F.lit(2)).unionByName(stale.withColumn("_ingested_at", F.lit(1)))


@register(f"""WITH {USERS} SELECT user_id, name, lower(trim(email)) AS email, city, state,
  CAST(NULL AS DATE) AS signup_date, preferred_device FROM users""")
def silver_users(spark, d):
    return quality.accepted(silver.users(_raw_users(spark, d)))


@register(f"""WITH {PRODUCTS} SELECT product_id, product_name, category, sub_category, brand,
  CAST(list_price AS DOUBLE) AS list_price FROM products WHERE size <> 1""")
def silver_products(spark, d):
    return quality.accepted(silver.products(_raw_products(spark, d)))


KNOWN = """known_users AS (SELECT c_custkey AS user_id FROM customer WHERE c_acctbal > 0),
  known_products AS (SELECT p_partkey AS product_id FROM part WHERE p_size <= 25)"""


def _known(spark, d) -> tuple[DataFrame, DataFrame]:
    """Dimensions with gaps, so that some facts point nowhere."""
    return (table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id")),
            table(spark, d, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("product_id")))


@register(f"""WITH {ORDER_LINES}, {KNOWN}
SELECT order_id, line_no, user_id, product_id, order_timestamp, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(discount_pct AS DOUBLE) AS discount_pct, order_status, return_timestamp, CAST(net_amount AS DOUBLE) AS net_amount
FROM order_lines SEMI JOIN known_users USING (user_id) SEMI JOIN known_products USING (product_id)
WHERE quantity > 0 AND unit_price > 0""")
def silver_orders(spark, d):
    # straight from the lines with their duplicates
    sort_only = sort_names(LINE_ORDER + LINE_TIEBREAK)
    raw = lines_of(table(spark, d, "lineitem"), table(spark, d, "orders"), *sort_only)
    return quality.accepted(silver.orders(raw, *_known(spark, d), keys=["order_id", "line_no"], order=LINE_ORDER,
                                          tiebreak=LINE_TIEBREAK)).drop(*sort_only)


@register(f"""WITH {CLICKS}, {KNOWN} SELECT event_id, session_id, user_id, device_type, event_type, event_timestamp,
  product_id, payment_status
FROM clicks SEMI JOIN known_users USING (user_id) SEMI JOIN known_products USING (product_id)""")
def silver_clickstream(spark, d):
    return quality.accepted(silver.clickstream(clicks(spark, d), *_known(spark, d), order=["event_timestamp desc"],
                                               tiebreak=["session_id"]))


# The rejected sides, with rows added that lost their key: none of them is a copy of another.


def _without(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.lit(None).cast(df.schema[key].dataType))


def _reasons(tagged: DataFrame, *columns: str) -> DataFrame:
    return quality.rejected(tagged).select(*columns, F.array_join(quality.REASONS, ",").alias("reasons"))


@register(f"""WITH {USERS} SELECT CAST(NULL AS BIGINT) AS user_id, name, 'user_id' AS reasons FROM users WHERE balance < 0""")
def silver_users_rejected(spark, d):
    lost = users(spark, d).filter("balance < 0").drop("balance").withColumns(
        {"signup_date": F.lit("2024-01-01"), "_ingested_at": F.lit(2)})
    return _reasons(silver.users(_raw_users(spark, d).unionByName(_without(lost, "user_id"))), "user_id", "name")


@register(f"""WITH {PRODUCTS} SELECT product_id, product_name, 'list_price' AS reasons FROM products WHERE size = 1
UNION ALL SELECT NULL, product_name, 'product_id' FROM products WHERE size = 2""")
def silver_products_rejected(spark, d):
    lost = products(spark, d).filter("size = 2").drop("size").withColumns(
        {"list_price": F.col("list_price").cast("string"), "_ingested_at": F.lit(2)})
    return _reasons(silver.products(_raw_products(spark, d).unionByName(_without(lost, "product_id"))), "product_id", "product_name")


@register(f"""WITH {ORDER_LINES}, {KNOWN}, every_line AS (
  SELECT order_id, line_no, user_id, product_id, quantity, unit_price FROM order_lines
  UNION ALL SELECT NULL, l_linenumber, o_custkey, l_partkey, CAST(l_quantity AS INTEGER), CAST(l_extendedprice AS DECIMAL(18,2))
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1),
judged AS (
  SELECT order_id, line_no, concat_ws(',', CASE WHEN order_id IS NULL THEN 'order_id' END,
           CASE WHEN quantity > 0 THEN NULL ELSE 'quantity' END, CASE WHEN unit_price > 0 THEN NULL ELSE 'unit_price' END,
           CASE WHEN u.user_id IS NULL THEN 'unknown_user_id' END,
           CASE WHEN p.product_id IS NULL THEN 'unknown_product_id' END) AS reasons
  FROM every_line e LEFT JOIN known_users u ON e.user_id = u.user_id LEFT JOIN known_products p ON e.product_id = p.product_id)
SELECT order_id, line_no, reasons FROM judged WHERE reasons <> ''""")
def silver_orders_rejected(spark, d):
    raw = lines_of(table(spark, d, "lineitem"), table(spark, d, "orders"), *sort_names(LINE_ORDER + LINE_TIEBREAK))
    raw = raw.unionByName(_without(raw.filter("line_no = 1"), "order_id"))
    return _reasons(silver.orders(raw, *_known(spark, d), keys=["order_id", "line_no"], order=LINE_ORDER,
                                  tiebreak=LINE_TIEBREAK), "order_id", "line_no")


@register(f"""WITH {CLICKS}, {KNOWN}, every_click AS (
  SELECT event_id, session_id, user_id, product_id FROM clicks
  UNION ALL SELECT NULL, session_id, user_id, product_id FROM clicks WHERE event_type = 'purchase'),
judged AS (
  SELECT event_id, session_id, concat_ws(',', CASE WHEN event_id IS NULL THEN 'event_id' END,
           CASE WHEN u.user_id IS NULL THEN 'unknown_user_id' END,
           CASE WHEN p.product_id IS NULL THEN 'unknown_product_id' END) AS reasons
  FROM every_click e LEFT JOIN known_users u ON e.user_id = u.user_id LEFT JOIN known_products p ON e.product_id = p.product_id)
SELECT event_id, session_id, reasons FROM judged WHERE reasons <> ''""")
def silver_clickstream_rejected(spark, d):
    raw = clicks(spark, d)
    raw = raw.unionByName(_without(raw.filter("event_type = 'purchase'"), "event_id"))
    return _reasons(silver.clickstream(raw, *_known(spark, d), order=["event_timestamp desc"], tiebreak=["session_id"]),
                    "event_id", "session_id")


@register(f"""WITH {SESSIONS} SELECT session_id, user_id, session_start, session_end, num_events, device_type,
  first_product_id, payment_status, funnel_stage_reached, session_duration_secs FROM sessions""")
def session_stitch(spark, d):
    return sessions(spark, d)


@register(f"WITH {SESSIONS} SELECT funnel_stage_reached, count(*) AS num_sessions FROM sessions GROUP BY 1")
def funnel_counts(spark, d):
    return stitching.funnel_counts(sessions(spark, d))


# --- gold --------------------------------------------------------------------------------


def _rfm_sql(r: str, f: str, m: str) -> str:
    return f"""{ORDER_LINES}, measures AS (
  SELECT user_id, CAST(date_diff('day', CAST(max(order_timestamp) AS DATE),
           CAST((SELECT max(order_timestamp) FROM order_lines) AS DATE)) AS INTEGER) AS recency_days,
         count(order_id) AS frequency, CAST(sum(net_amount) AS DECIMAL(18,2)) AS monetary
  FROM order_lines WHERE order_status = 'completed' GROUP BY user_id),
tiles AS (
  SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days {r}, user_id) AS INTEGER) AS r_score,
         CAST(ntile(5) OVER (ORDER BY frequency {f}, user_id) AS INTEGER) AS f_score,
         CAST(ntile(5) OVER (ORDER BY monetary {m}, user_id) AS INTEGER) AS m_score FROM measures),
scored AS (
  SELECT *, r_score + f_score + m_score AS rfm_score,
         CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
              WHEN r_score + f_score + m_score >= 10 THEN 'Loyal Customers'
              WHEN r_score + f_score + m_score >= 7 THEN 'Potential Loyalists'
              WHEN r_score + f_score + m_score >= 5 THEN 'At Risk' ELSE 'Lost / Hibernating' END AS rfm_segment
  FROM tiles)"""


SCORED = "SELECT user_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score, rfm_score, rfm_segment FROM scored"


@register(f"WITH {_rfm_sql('DESC', 'ASC', 'ASC')} {SCORED}")
def rfm_scores(spark, d):
    return rfm.score(rfm.measures(order_lines(spark, d)))


@register(f"WITH {_rfm_sql('ASC', 'DESC', 'DESC')} {SCORED}")
def rfm_scores_reference(spark, d):
    return rfm.score(rfm.measures(order_lines(spark, d)), orientation="reference")


@register(f"WITH {_rfm_sql('DESC', 'ASC', 'ASC')} {SCORED}")
def rfm_scores_distributed(spark, d):
    return rfm.score(rfm.measures(order_lines(spark, d)), method="spread")


CUSTOMERS = f"""{ACCOUNTS}, {_rfm_sql('DESC', 'ASC', 'ASC')}, customers AS (
  SELECT user_id, name, city, state, preferred_device, coalesce(recency_days, 9999) AS recency_days,
         coalesce(frequency, 0) AS frequency, coalesce(monetary, 0) AS monetary, r_score, f_score, m_score,
         coalesce(rfm_score, 0) AS rfm_score, coalesce(rfm_segment, 'Never Purchased') AS rfm_segment
  FROM accounts LEFT JOIN scored USING (user_id))"""


def _customers(spark, d, lines: DataFrame | None = None) -> DataFrame:
    lines = order_lines(spark, d) if lines is None else lines
    return rfm.customer_360(accounts(spark, d), rfm.score(rfm.measures(lines)))


@register(f"""WITH {CUSTOMERS} SELECT user_id, name, city, state, preferred_device, recency_days, frequency,
  CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score, rfm_score, rfm_segment FROM customers""")
def customer_360(spark, d):
    return _customers(spark, d)


@register(f"WITH {CUSTOMERS} SELECT rfm_segment, count(*) AS customers FROM customers GROUP BY 1")
def segment_distribution(spark, d):
    return rfm.segment_distribution(_customers(spark, d))


ROLLUP = f"""{PRODUCTS}, {ORDER_LINES}, rollup_daily AS (
  SELECT CAST(order_timestamp AS DATE) AS order_date, category, sub_category, count(order_id) AS num_orders,
         CAST(sum(quantity) AS BIGINT) AS units_sold, round(sum(net_amount), 2) AS revenue
  FROM order_lines JOIN products USING (product_id) WHERE order_status = 'completed' GROUP BY 1, 2, 3)"""


@register(f"""WITH {ROLLUP} SELECT order_date, category, sub_category, num_orders, units_sold,
  CAST(revenue AS DOUBLE) AS revenue FROM rollup_daily""")
def daily_category_rollup(spark, d):
    return rollups.daily_category_rollup(order_lines(spark, d), products(spark, d))


@register(f"WITH {ROLLUP} SELECT order_date, category, CAST(sum(revenue) AS DOUBLE) AS revenue FROM rollup_daily GROUP BY 1, 2")
def bi_daily_revenue(spark, d):
    return rollups.daily_revenue(rollups.daily_category_rollup(order_lines(spark, d), products(spark, d)))


@register(f"WITH {ROLLUP} SELECT category, CAST(sum(revenue) AS DOUBLE) AS revenue FROM rollup_daily GROUP BY 1")
def bi_category_totals(spark, d):
    return rollups.category_totals(rollups.daily_category_rollup(order_lines(spark, d), products(spark, d)))


LEAKAGE = f"""{PRODUCTS}, {SESSIONS}, {ORDER_LINES}, lost AS (
  SELECT CAST(session_start AS DATE) AS event_date, CASE funnel_stage_reached WHEN 'cart_abandoned'
           THEN 'abandoned_cart' ELSE 'failed_payment' END AS leakage_type, list_price AS amount
  FROM sessions LEFT JOIN products ON first_product_id = product_id
  WHERE funnel_stage_reached = 'cart_abandoned'
     OR (funnel_stage_reached = 'payment_attempted' AND payment_status = 'failed')
  UNION ALL SELECT CAST(return_timestamp AS DATE), 'return', net_amount FROM order_lines WHERE order_status = 'returned'),
leakage AS (
  SELECT event_date, leakage_type, count(*) AS num_incidents, round(sum(amount), 2) AS estimated_revenue_lost
  FROM lost GROUP BY 1, 2)"""


def _leakage(spark, d, lines: DataFrame | None = None) -> DataFrame:
    lines = order_lines(spark, d) if lines is None else lines
    return leakage.revenue_leakage_daily(sessions(spark, d), products(spark, d), lines)


@register(f"""WITH {LEAKAGE} SELECT event_date, leakage_type, num_incidents,
  CAST(estimated_revenue_lost AS DOUBLE) AS estimated_revenue_lost FROM leakage""")
def revenue_leakage_daily(spark, d):
    return _leakage(spark, d)


@register(f"""WITH {LEAKAGE} SELECT leakage_type, CAST(sum(num_incidents) AS BIGINT) AS total_incidents,
  CAST(sum(estimated_revenue_lost) AS DOUBLE) AS total_revenue_lost FROM leakage GROUP BY 1""")
def leakage_totals(spark, d):
    return leakage.leakage_totals(_leakage(spark, d))


@register(f"""WITH {LEAKAGE} SELECT event_date, leakage_type,
  CAST(sum(estimated_revenue_lost) AS DOUBLE) AS estimated_revenue_lost FROM leakage GROUP BY 1, 2""")
def bi_leakage_trend(spark, d):
    return rollups.leakage_trend(_leakage(spark, d))


@register(f"""WITH {CUSTOMERS}, {LEAKAGE.split(', clean_lines AS')[0]}, lost AS (
  SELECT list_price AS amount FROM sessions LEFT JOIN products ON first_product_id = product_id
  WHERE funnel_stage_reached = 'cart_abandoned' OR (funnel_stage_reached = 'payment_attempted' AND payment_status = 'failed')
  UNION ALL SELECT net_amount FROM order_lines WHERE order_status = 'returned')
SELECT count(*) AS customers, CAST(sum(monetary) AS DOUBLE) AS total_revenue,
  CAST((SELECT sum(amount) FROM lost) AS DOUBLE) AS revenue_lost,
  count(*) FILTER (rfm_segment = 'Champions') AS champions FROM customers""")
def bi_kpis(spark, d):
    lines = written(order_lines(spark, d), "lines")  # two gold tables from one cleaning
    return rollups.kpis(_customers(spark, d, lines), _leakage(spark, d, lines))


@register(f"""WITH {LEAKAGE}, copies AS (SELECT unnest(['csv', 'parquet']) AS format)
SELECT format, event_date, leakage_type, num_incidents, CAST(estimated_revenue_lost AS DOUBLE) AS estimated_revenue_lost
FROM leakage, copies""")
def bi_export_roundtrip(spark, d):
    root = scratch_path(spark, "exports")
    daily = _leakage(spark, d)
    files.export_for_bi(daily, root, "leakage")
    as_csv = spark.read.schema(daily.schema).option("header", True).csv(f"{root}/leakage_csv")
    as_parquet = files.read_parquet(spark, f"{root}/leakage_parquet")
    return as_csv.withColumn("format", F.lit("csv")).unionByName(as_parquet.withColumn("format", F.lit("parquet")))


# --- employee report ---------------------------------------------------------------------
# Balances stand in for salaries, so the grades use thresholds a tenth of the usual ones.

GRADES = [(8_500, "Senior"), (7_000, "Mid")]


@register(f"""WITH {EMPLOYEES} SELECT department, count(*) AS headcount,
  round(CAST(sum(salary) AS DOUBLE) / count(*), 2) AS avg_salary, CAST(max(salary) AS DOUBLE) AS max_salary,
  CAST(min(salary) AS DOUBLE) AS min_salary, count(*) FILTER (salary >= 8500) AS senior_count,
  count(*) FILTER (salary >= 7000 AND salary < 8500) AS mid_count, count(*) FILTER (salary < 7000) AS junior_count
FROM employees GROUP BY department""")
def department_summary(spark, d):
    return report.department_summary(report.with_grade(employees(spark, d), GRADES))


@register(f"""WITH {EMPLOYEES} SELECT city, count(*) AS employee_count,
  round(CAST(sum(salary) AS DOUBLE) / count(*), 2) AS avg_salary FROM employees GROUP BY city""")
def city_summary(spark, d):
    return report.city_summary(employees(spark, d))


@register(f"""WITH {EMPLOYEES} SELECT emp_id, name, department, CAST(salary AS DOUBLE) AS salary, city,
  CASE WHEN salary >= 8500 THEN 'Senior' WHEN salary >= 7000 THEN 'Mid' ELSE 'Junior' END AS salary_grade,
  CAST(rank() OVER (PARTITION BY department ORDER BY salary DESC) AS INTEGER) AS dept_rank, true AS stamped
FROM employees""")
def employee_report(spark, d):
    enriched = report.enrich(employees(spark, d), GRADES)
    return enriched.withColumn("stamped", F.col("processed_at").isNotNull()).drop("processed_at")


# --- segments ----------------------------------------------------------------------------

FEATURES_SQL = f"""{CUSTOMERS}, {SESSIONS}, behaviour AS (
  SELECT user_id, count(*) AS num_sessions, avg(session_duration_secs) AS avg_session_duration_secs,
         avg(CASE WHEN funnel_stage_reached = 'cart_abandoned' THEN 1.0 ELSE 0.0 END) AS cart_abandonment_rate
  FROM sessions GROUP BY user_id),
features AS (
  SELECT user_id, recency_days, frequency, monetary, coalesce(num_sessions, 0) AS num_sessions,
         coalesce(avg_session_duration_secs, 0.0) AS avg_session_duration_secs,
         coalesce(cart_abandonment_rate, 0.0) AS cart_abandonment_rate
  FROM customers LEFT JOIN behaviour USING (user_id) WHERE frequency > 0)"""


def _features(spark, d) -> DataFrame:
    return segments.customer_features(_customers(spark, d), sessions(spark, d)).select("user_id", *segments.FEATURES)


@register(f"WITH {FEATURES_SQL} SELECT * REPLACE (CAST(monetary AS DOUBLE) AS monetary) FROM features")
def customer_features(spark, d):
    return _features(spark, d)


@register(f"WITH {FEATURES_SQL} SELECT user_id, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_samp(CAST({c} AS DOUBLE)) OVER (), 6) AS {c}"
    for c in segments.FEATURES) + " FROM features")
def standardized_features(spark, d):
    scaled = segments.scaled_features(written(_features(spark, d), "features"))
    values = scaled.select("user_id", vector_to_array("scaled_features").alias("v"))
    return values.select("user_id", *[F.round(F.col("v")[i], 6).alias(c) for i, c in enumerate(segments.FEATURES)])


@register()
def kmeans_segments(spark, d):
    return segments.cluster_customers(written(_features(spark, d), "features"))


@register()
def kmeans_elbow(spark, d):
    features = written(_features(spark, d), "features")
    return segments.elbow(written(segments.scaled_features(features), "scaled"))


@register(f"WITH {FEATURES_SQL} SELECT user_id, true AS nearest, true AS label_fits FROM features")
def kmeans_report(spark, d):
    return segments.clustering_report(written(_features(spark, d), "features"))


@register(f"""WITH {FEATURES_SQL}, ks AS (SELECT unnest([2, 3, 4, 5, 6]) AS k)
SELECT k, count(*) AS customers, true AS cost_below_total, true AS silhouette_in_range FROM ks, features GROUP BY k""")
def kmeans_elbow_report(spark, d):
    scaled = written(segments.scaled_features(written(_features(spark, d), "features")), "scaled")
    curve = segments.elbow(scaled).withColumn("customers", F.lit(scaled.count()).cast("long"))
    # scaled features have a variance of 1, so this is the cost of one cluster
    total = (F.col("customers") - 1) * len(segments.FEATURES)
    return curve.select("k", "customers", ((F.col("wssse") > 0) & (F.col("wssse") < total)).alias("cost_below_total"),
                        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"))


@register("""SELECT o_orderpriority, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_spend,
  row_number() OVER (ORDER BY CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) DESC) AS rank,
  CASE row_number() OVER (ORDER BY CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) DESC)
    WHEN 1 THEN 'High-Value Loyalists' WHEN 2 THEN 'Growing Spenders' WHEN 3 THEN 'Occasional Buyers'
    WHEN 4 THEN 'Low-Engagement / Price-Sensitive' ELSE 'Segment 5' END AS segment_label
FROM orders GROUP BY o_orderpriority""".replace("row_number() OVER (ORDER BY CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) DESC) AS rank",
                                                "CAST(row_number() OVER (ORDER BY CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) DESC) AS INTEGER) AS rank"))
def rank_clusters_by_mean(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("monetary"), F.lit(1).alias("frequency"))
    ranked = segments.rank_groups(orders, "o_orderpriority")
    return ranked.select("o_orderpriority", F.round("avg_monetary", 2).alias("avg_spend"), "rank", "segment_label")
