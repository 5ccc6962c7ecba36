"""Aggregates and statistics over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.operators import quantiles, shaping, summaries
from taxaflow.plans.registry import Tables, query


@query("""SELECT l_returnflag, count(*) AS n, CAST(count_if(l_discount > 0.05) AS BIGINT) AS discounted, count(DISTINCT l_partkey) AS parts, min(l_shipdate) AS first_ship,
max(l_shipdate) AS last_ship, round(sum(TRY_CAST(l_linestatus || '1' AS DOUBLE)), 2) AS coerced, round(avg(CASE WHEN l_tax > 0.04 THEN 1.0 ELSE 0.0 END), 6) AS fraction, round(avg(l_quantity), 6) AS mean_qty
FROM lineitem GROUP BY 1""")
def group_multi_agg(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.countDistinct("l_partkey").alias("parts"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        F.round(F.sum(shaping.number(F.concat("l_linestatus", F.lit("1")))), 2).alias("coerced"),
        F.round(F.avg((F.col("l_tax") > 0.04).cast("double")), 6).alias("fraction"), F.round(F.avg("l_quantity"), 6).alias("mean_qty"),
    )


@query("""WITH c AS (SELECT p_brand, l_returnflag, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
m AS (SELECT p_brand, l_returnflag AS mode_flag FROM c QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, l_returnflag) = 1)
SELECT p_brand, mode_flag, round(median(l_quantity), 6) AS median_qty, min(p_name) AS first_name FROM lineitem JOIN part ON p_partkey = l_partkey JOIN m USING (p_brand) GROUP BY ALL""")
def group_mode_median_first(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    found = joined.groupBy("p_brand").agg(F.mode("l_returnflag", True).alias("mode_flag"), F.min("p_name").alias("first_name"))
    medians = quantiles.exact_quantiles(joined, ["p_brand"], "l_quantity", {"median_qty": 0.5})
    return quantiles.with_quantiles(found, medians, ["p_brand"]).withColumn("median_qty", F.round("median_qty", 6))


@query("SELECT l_suppkey, round(median(l_extendedprice / nullif(l_quantity * 10, 0)), 6) AS px_per_mm FROM lineitem GROUP BY 1")
def ratio_median(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.median(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity") * 10)), 6).alias("px_per_mm"))


@query("""SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'purchase') DESC, n DESC, event_type) = 1""")
def preferred_else_most_frequent(t: Tables) -> DataFrame:
    return summaries.preferred_else_most_frequent(t.events, "user_id", "event_type", "purchase")


@query("""SELECT l_suppkey, median(l_quantity) FILTER (l_returnflag = 'A') AS A, median(l_quantity) FILTER (l_returnflag = 'N') AS N, median(l_quantity) FILTER (l_returnflag = 'R') AS R FROM lineitem GROUP BY 1""")
def pivot_median(t: Tables) -> DataFrame:
    return summaries.pivoted(t.lineitem, "l_suppkey", "l_returnflag", ["A", "N", "R"], F.median("l_quantity"))


@query("""SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def pivot_count_fill0(t: Tables) -> DataFrame:
    return summaries.pivoted(t.orders.withColumn("y", F.year("o_orderdate")), "y", "o_orderstatus", ["F", "O", "P"], F.count(F.lit(1)), fill=0)


@query("SELECT o_custkey, coalesce(nullif(string_agg(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, ', ' ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END), ''), 'none') AS statuses FROM orders GROUP BY 1")
def listagg_distinct(t: Tables) -> DataFrame:
    named = t.orders.withColumn("s", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    return named.groupBy("o_custkey").agg(summaries.joined_distinct("s").alias("statuses"))


@query("""SELECT n_name, o_orderstatus, n, n / sum(n) OVER (PARTITION BY n_name) AS share FROM (SELECT n_name, o_orderstatus, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)""")
def share_of_total(t: Tables) -> DataFrame:
    named = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey"))
    return summaries.share_of_total(named, "o_orderstatus", "n_name")


_TRUTH = "l_quantity * 1500"
_STATS = """round(avg(m - x), 4) AS bias, round(avg(abs(m - x)), 4) AS mae, round(median(abs(m - x) / x) * 100, 6) AS median_abs_pct,
round(avg(CASE WHEN abs(m - x) / x <= 0.1 THEN 1.0 ELSE 0.0 END), 6) AS within_10pct, round(corr(m, x), 6) AS pearson_r, round(regr_slope(m, x), 6) AS slope"""


@query(f"""WITH p AS (SELECT l_returnflag, l_extendedprice AS m, CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN 0 ELSE {_TRUTH} END AS x FROM lineitem)
SELECT l_returnflag, count(*) AS n, n_both, {_STATS} FROM p JOIN (SELECT l_returnflag, count(*) AS n_both FROM p WHERE x IS NOT NULL AND m IS NOT NULL GROUP BY 1) USING (l_returnflag) WHERE x > 0 GROUP BY ALL""")
def agreement_stats(t: Tables) -> DataFrame:
    truth = F.when(F.col("l_linenumber") == 5, F.lit(0.0)).when(F.col("l_linenumber") != 4, F.col("l_quantity") * 1500)
    found = summaries.agreement_by(t.lineitem, ["l_returnflag"], truth, F.col("l_extendedprice"))
    digits = {"bias": 4, "mae": 4, "median_abs_pct": 6, "within_10pct": 6, "pearson_r": 6, "slope": 6}
    return found.withColumns({k: F.round(k, d) for k, d in digits.items()})


@query(f"""WITH p AS (SELECT *, l_extendedprice AS m, {_TRUTH} AS x FROM lineitem), s AS (
SELECT 'all' AS subset, * FROM p UNION ALL SELECT 'returned', * FROM p WHERE l_returnflag = 'R' UNION ALL SELECT 'none', * FROM p WHERE l_quantity < 0),
w AS (SELECT subset, count(*) AS n, avg(m - x) AS bias, avg(abs(m - x)) AS mae, median(abs(m - x) / x) * 100 AS median_abs_pct FROM s GROUP BY 1
UNION ALL SELECT 'none', 0, NULL, NULL, NULL)
SELECT subset, 'price' AS pair, metric, round(value, 4) AS value, n FROM (SELECT subset, n, unnest(['bias', 'mae', 'median_abs_pct']) AS metric, unnest([bias, mae, median_abs_pct]) AS value FROM w)""")
def agreement_long(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("x", F.col("l_quantity") * 1500)
    subsets = {"all": F.lit(True), "returned": F.col("l_returnflag") == "R", "none": F.col("l_quantity") < 0}
    found = summaries.agreement_long(rows, subsets, {"price": ("x", "l_extendedprice")})
    return found.withColumn("value", F.round("value", 4))


@query("""SELECT sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) / greatest(sum(quality), 1) AS precision,
sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) / greatest(sum(toxic), 1) AS recall FROM labels""")
def precision_recall(t: Tables) -> DataFrame:
    tp = ((F.col("quality") == 1) & (F.col("toxic") == 1)).cast("int")
    return t.labels.agg(*[c.alias(k) for k, c in summaries.precision_recall(tp, F.col("quality"), F.col("toxic")).items()])


@query("""WITH c AS (SELECT l_orderkey, count(*) AS found, CAST(max(l_linenumber) AS BIGINT) AS expected FROM lineitem GROUP BY 1)
SELECT avg(CASE WHEN found = expected THEN 1.0 ELSE 0 END)::DOUBLE AS exact, avg(CASE WHEN abs(found - expected) <= 1 THEN 1.0 ELSE 0 END)::DOUBLE AS within_one,
avg(CASE WHEN found > expected THEN 1.0 ELSE 0 END)::DOUBLE AS "over", avg(CASE WHEN found < expected THEN 1.0 ELSE 0 END)::DOUBLE AS "under" FROM c""")
def count_agreement(t: Tables) -> DataFrame:
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("found"), F.max("l_linenumber").alias("expected"))
    return counts.agg(*[c.alias(k) for k, c in summaries.count_agreement(F.col("found"), F.col("expected")).items()])


@query("""WITH j AS (SELECT quality = 1 AS correct, n_chars FROM labels JOIN documents USING (doc_id)), s AS (SELECT 'all' AS subset, correct FROM j
UNION ALL SELECT 'long', correct FROM j WHERE n_chars >= 1000 UNION ALL SELECT 'longer', correct FROM j WHERE n_chars >= 1000 AND n_chars >= 5000)
SELECT subset, count(*) AS n, CAST(count_if(correct) AS BIGINT) AS n_correct, CAST(count_if(correct) AS BIGINT) / count(*) AS accuracy FROM s GROUP BY 1""")
def nested_subset_accuracy(t: Tables) -> DataFrame:
    joined = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    long = F.col("n_chars") >= 1000
    return summaries.nested_accuracy(joined, F.col("quality") == 1, {"all": F.lit(True), "long": long, "longer": long & (F.col("n_chars") >= 5000)})


@query("""SELECT CAST(least(floor((l_quantity - 0) / 5.0), 9) AS INT) AS bin, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 GROUP BY 1""")
def histogram_closed(t: Tables) -> DataFrame:
    return summaries.histogram(t.lineitem, "l_quantity", 0.0, 50.0, 10)


@query("""SELECT l_linestatus, round(quantile_cont(l_extendedprice, 0.995), 6) AS p995, round(median(l_extendedprice), 6) AS med FROM lineitem GROUP BY 1""")
def percentiles(t: Tables) -> DataFrame:
    found = quantiles.exact_quantiles(t.lineitem, ["l_linestatus"], "l_extendedprice", {"p995": 0.995, "med": 0.5})
    return found.withColumns({c: F.round(c, 6) for c in ("p995", "med")})


@query("""WITH c AS (SELECT c_custkey, bool_or(o_orderkey IS NOT NULL) AS ordered, bool_or(o_totalprice > 200000) AS large, bool_or(o_orderstatus = 'P') AS pending
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1), n AS (SELECT count(*) AS a, count_if(ordered) AS b, count_if(ordered AND large) AS c, count_if(ordered AND large AND pending) AS d FROM c)
SELECT CAST(step AS INT) AS step, stage, CAST(n AS BIGINT) AS n, n / a AS share FROM (SELECT a, unnest([0, 1, 2, 3]) AS step, unnest(['customers', 'ordered', 'large', 'pending']) AS stage, unnest([a, b, c, d]) AS n FROM n)""")
def funnel(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_totalprice") > 200000).alias("large"), F.bool_or(F.col("o_orderstatus") == "P").alias("pending"))
    joined = t.customer.join(per, F.col("o_custkey") == F.col("c_custkey"), "left")
    steps = {"customers": F.lit(True), "ordered": F.col("o_custkey").isNotNull(), "large": F.col("large"), "pending": F.col("pending")}
    return summaries.funnel(joined, steps)


@query("""SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(median(o_totalprice), 4) AS med FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL""")
def group_by_all_median(t: Tables) -> DataFrame:
    sql = "SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(median(o_totalprice), 4) AS med FROM {orders} JOIN {customer} ON c_custkey = o_custkey GROUP BY ALL"
    return t.spark.sql(sql, orders=t.orders, customer=t.customer)


@query("""SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ALL""")
def value_counts(t: Tables) -> DataFrame:
    return t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""SELECT 'region' AS name, count(*) AS rows FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'orders', count(*) FROM orders""")
def lake_catalog(t: Tables) -> DataFrame:
    from taxaflow.sources.lake import table_catalog

    return table_catalog({n: getattr(t, n) for n in ("region", "nation", "customer", "orders")}).select("name", "rows")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL""")
def stream_tumbling(t: Tables) -> DataFrame:
    from taxaflow.streaming.windows import tumbling_from_files

    return tumbling_from_files(t.spark, f"{t.path}/events.parquet", "ts", ["event_type"], "value", "1 hour")
