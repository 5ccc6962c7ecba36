"""Selection, linkage and shaping over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.operators import linkage, selection, shaping
from taxaflow.plans.registry import Tables, query


@query("""WITH l AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT n_name, count(*) AS customers, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS open_orders, count(DISTINCT c_mktsegment) AS segments,
  CAST(min(year(o_orderdate)) AS INT) AS first_year, CAST(max(year(o_orderdate)) AS INT) AS last_year, round(sum(o_totalprice), 2) AS total,
  count(*) / sum(count(*)) OVER () AS share
FROM l JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def site_report(t: Tables) -> DataFrame:
    last = selection.latest_wide(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey")
    named = last.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey"))
    found = named.groupBy("n_name").agg(
        F.count("*").alias("customers"), F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
        F.countDistinct("c_mktsegment").alias("segments"), F.min(F.year("o_orderdate")).alias("first_year"),
        F.max(F.year("o_orderdate")).alias("last_year"), F.round(F.sum("o_totalprice"), 2).alias("total"),
    )
    total = found.agg(F.sum("customers").alias("_all"))
    return found.join(F.broadcast(total)).withColumn("share", F.col("customers") / F.col("_all")).drop("_all")


@query("SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(t: Tables) -> DataFrame:
    return selection.latest_wide(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey").select(t.orders.columns)


@query("""SELECT o_custkey, o_orderkey, d FROM (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS d FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC NULLS FIRST, o_orderkey DESC) = 1""")
def latest_nulls_win(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("d", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")))
    return selection.latest(dated, ["o_custkey"], "d", [F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "d")


@query("""SELECT p_brand, p_partkey, p_size, p_type FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY
CASE p_size WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END, p_retailprice DESC, p_partkey) = 1""")
def first_per_key_priority(t: Tables) -> DataFrame:
    ranked = t.part.withColumn("_size", F.col("p_size").cast("string"))
    order = [selection.priority_order("_size", ["1", "2"]), F.desc("p_retailprice"), F.asc("p_partkey")]
    return selection.first_by(ranked, ["p_brand"], order).select("p_brand", "p_partkey", "p_size", "p_type")


@query("""SELECT c_custkey, c_name, p_partkey, p_name FROM customer LEFT JOIN (SELECT * FROM part WHERE p_partkey % 5 <> 0
QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY CASE WHEN p_brand = 'Brand#11' THEN 0 WHEN p_brand = 'Brand#12' THEN 1 ELSE 2 END, p_retailprice DESC, p_partkey) = 1) p
ON p_size = c_custkey % 60""")
def best_candidate_link(t: Tables) -> DataFrame:
    parts = t.part.withColumn("key", F.when(F.col("p_partkey") % 5 != 0, F.col("p_size").cast("long")))
    order = [selection.priority_order("p_brand", ["Brand#11", "Brand#12"]), F.desc("p_retailprice"), F.asc("p_partkey")]
    asked = t.customer.withColumn("key", F.col("c_custkey") % 60)
    return linkage.best_candidate(asked, parts, "key", order, ["p_partkey", "p_name"]).select("c_custkey", "c_name", "p_partkey", "p_name")


@query("""SELECT c_custkey, CASE WHEN s_name IS NOT NULL THEN s_suppkey ELSE c_custkey END AS best_key,
CASE WHEN s_name IS NOT NULL THEN s_acct ELSE c_acctbal END AS best_balance, CASE WHEN s_name IS NOT NULL THEN 'supplier' ELSE 'customer' END AS source
FROM customer LEFT JOIN (SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS s_acct FROM supplier) ON s_suppkey = c_custkey""")
def best_of_two_sources(t: Tables) -> DataFrame:
    expert = t.supplier.select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).alias("s_acct"))
    both = t.customer.join(expert, F.col("s_suppkey") == F.col("c_custkey"), "left")
    has = F.col("s_name").isNotNull()
    return both.select(
        "c_custkey", shaping.preferred(has, F.col("s_suppkey"), F.col("c_custkey")).alias("best_key"),
        shaping.preferred(has, F.col("s_acct"), F.col("c_acctbal")).alias("best_balance"),
        shaping.preferred(has, F.lit("supplier"), F.lit("customer")).alias("source"),
    )


@query("""WITH e AS (SELECT event_id, user_id * 3 AS a, user_id + 5 AS b, CASE WHEN event_id % 2 = 0 THEN event_id % 50 END AS c FROM events),
r AS (SELECT s_name, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey END AS k1, CASE WHEN s_suppkey % 4 = 1 THEN s_suppkey END AS k2,
CASE WHEN s_suppkey % 4 >= 2 THEN s_suppkey END AS k3 FROM supplier)
SELECT event_id, coalesce(r1.s_name, r2.s_name, r3.s_name) AS link, CASE WHEN r1.s_name IS NOT NULL THEN 'sample ID' WHEN r2.s_name IS NOT NULL THEN 'sample ID hash'
WHEN r3.s_name IS NOT NULL THEN 'barcode' END AS link_kind FROM e LEFT JOIN r r1 ON r1.k1 = a LEFT JOIN r r2 ON r2.k2 = b LEFT JOIN r r3 ON r3.k3 = c""")
def fallback_link(t: Tables) -> DataFrame:
    e = t.events.select("event_id", (F.col("user_id") * 3).alias("a"), (F.col("user_id") + 5).alias("b"), F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 50).alias("c"))
    k, part = F.col("s_suppkey"), F.col("s_suppkey") % 4
    r = t.supplier.select("s_name", "s_suppkey", F.when(part == 0, k).alias("k1"), F.when(part == 1, k).alias("k2"), F.when(part >= 2, k).alias("k3"))
    tries = [("a", "k1", "sample ID"), ("b", "k2", "sample ID hash"), ("c", "k3", "barcode")]
    return linkage.fallback_link(e, r, tries, "s_name", [F.asc("s_suppkey")], "event_id").select("event_id", "link", "link_kind")


@query("SELECT l.*, p_name, p_brand FROM lineitem l LEFT JOIN part ON p_partkey = l_partkey AND p_partkey % 10 <> 3")
def lookup_left_unique(t: Tables) -> DataFrame:
    known = t.part.filter("p_partkey % 10 <> 3")
    return linkage.lookup(t.lineitem, known, "l_partkey", "p_partkey", ["p_name", "p_brand"], [F.asc("p_name")])


@query("""SELECT o_orderkey, k, c_name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS k FROM orders)
LEFT JOIN (SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey END AS ck, c_name FROM customer) ON ck = k""")
def null_safe_lookup(t: Tables) -> DataFrame:
    asked = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("k"))
    known = t.customer.select(F.when(F.col("c_custkey") % 11 != 0, F.col("c_custkey")).alias("ck"), "c_name")
    return linkage.lookup(asked, known, "k", "ck", ["c_name"], [F.asc("c_name")])


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def inner_equi_join(t: Tables) -> DataFrame:
    return t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_resume(t: Tables) -> DataFrame:
    return linkage.not_done(t.orders, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").select("o_orderkey", "o_orderstatus")


@query("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_member(t: Tables) -> DataFrame:
    return linkage.members(t.customer, t.orders.filter("o_totalprice > 300000"), "c_custkey", "o_custkey")


@query("""SELECT n_nationkey AS k, list(DISTINCT c_mktsegment ORDER BY c_mktsegment) AS candidates FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""")
def candidate_lists(t: Tables) -> DataFrame:
    return linkage.collected_candidates(t.customer.withColumn("k", F.col("c_nationkey")), ["k"], "c_mktsegment")


@query("""SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS level, CAST(NULL AS BIGINT) AS extra FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, 'supplier', NULL FROM supplier""")
def union_align(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("level"))
    b = t.supplier.select(F.lit("supplier").alias("level"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("balance", T.DoubleType()), T.StructField("segment", T.StringType()), T.StructField("level", T.StringType()), T.StructField("extra", T.LongType())])
    return shaping.ensure_columns(shaping.union_aligned(a, b), schema)


@query("SELECT n_name AS value FROM nation UNION SELECT r_name FROM region UNION SELECT c_mktsegment FROM customer")
def distinct_union_names(t: Tables) -> DataFrame:
    return shaping.distinct_values((t.nation, "n_name"), (t.region, "r_name"), (t.customer, "c_mktsegment"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE o_orderstatus END AS status FROM orders")
def recode_passthrough(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", shaping.recode(F.col("o_orderstatus"), {"O": "open", "F": "filled"}).alias("status"))


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, l_extendedprice / nullif(l_quantity - 10, 0) AS price_mm,
l_tax / nullif((l_quantity - 10) * (l_quantity - 10), 0) AS tax_mm2 FROM lineitem""")
def unit_convert(t: Tables) -> DataFrame:
    scaled = t.lineitem.withColumn("k", F.col("l_quantity") - 10)
    return shaping.to_units(scaled, {"l_extendedprice": "price_mm"}, {"l_tax": "tax_mm2"}, "k").select("l_orderkey", "l_linenumber", "l_extendedprice", "price_mm", "tax_mm2")


@query("""SELECT l_orderkey, l_linenumber, coalesce(s < 0.05, false) AS qc_low, coalesce(s IS NOT NULL AND l_quantity > 0, false) AS qc_has_scale,
coalesce(s < 0.05, false) AND l_returnflag <> 'R' AS composite FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS s FROM lineitem)""")
def quality_flags(t: Tables) -> DataFrame:
    low = shaping.flag(F.col("s") < 0.05)
    rows = t.lineitem.withColumn("s", F.when(F.col("l_linenumber") != 3, F.col("l_discount")))
    return rows.select("l_orderkey", "l_linenumber", low.alias("qc_low"), shaping.flag(F.col("s").isNotNull() & (F.col("l_quantity") > 0)).alias("qc_has_scale"), (low & (F.col("l_returnflag") != "R")).alias("composite"))


@query("""SELECT event_id, value AS confidence, CASE WHEN value >= 50 THEN value * 2 END AS px_per_mm, CASE WHEN value >= 50 THEN event_type END AS scale_source FROM events""")
def gated_value(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events.select("event_id", v.alias("confidence"), "event_type", "value").withColumns(shaping.gated(v >= 50, px_per_mm=v * 2, scale_source=F.col("event_type"))).drop("event_type", "value")


@query("""SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view') AND NOT coalesce(event_type = 'click', false) OR value BETWEEN 10 AND 20""")
def filters(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.events.filter((kind.isin("click", "view") & ~shaping.flag(kind == "click")) | F.col("value").between(10, 20)).select("event_id", "event_type")


@query("""SELECT doc_id, sha256(text) AS digest, CASE WHEN doc_id <> min(doc_id) OVER (PARTITION BY sha256(text)) THEN min(doc_id) OVER (PARTITION BY sha256(text)) END AS duplicate_of FROM documents""")
def content_dedup(t: Tables) -> DataFrame:
    hashed = t.documents.select("doc_id", F.sha2("text", 256).alias("digest"))
    return selection.content_duplicates(hashed, "doc_id", "digest").select("doc_id", "digest", "duplicate_of")


@query("""SELECT doc_id, lang, doc_id IN (SELECT item_id FROM benchmark) AS is_copy FROM documents""")
def known_copy_dedup(t: Tables) -> DataFrame:
    other = t.benchmark.select(F.col("item_id").alias("doc_id"))
    return selection.known_copies(t.documents.select("doc_id", "lang"), other, "doc_id")


@query("""WITH a AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1)
SELECT page_id, url FROM a QUALIFY row_number() OVER (PARTITION BY md5(html) ORDER BY page_id) = 1""")
def two_stage_dedup(t: Tables) -> DataFrame:
    rows = t.pages.select("page_id", "url", F.md5("html").alias("digest"))
    return selection.two_stage_distinct(rows, ["url"], ["digest"], [F.asc("page_id")]).select("page_id", "url")


@query("""SELECT l_orderkey, l_partkey, l_quantity, l_orderkey || '#' || CASE WHEN length(CAST(n AS VARCHAR)) < 3 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS instance_id
FROM (SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_quantity) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey, l_quantity FROM lineitem))""")
def ordinal_ids(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").distinct()
    return selection.ordinal_ids(rows, "l_orderkey", [F.asc("l_partkey"), F.asc("l_quantity")])


@query("""WITH m AS (SELECT user_id, value > 30 AS ok, row_number() OVER w AS n, sum(CASE WHEN value > 30 THEN 1 ELSE 0 END) OVER w AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT user_id, n - s AS island, count_if(ok) AS c FROM m GROUP BY ALL) SELECT user_id, CAST(max(c) AS BIGINT) AS longest_run FROM i GROUP BY user_id""")
def gaps_islands_longest_run(t: Tables) -> DataFrame:
    return selection.longest_run(t.events, "user_id", [F.asc("ts"), F.asc("event_id")], F.col("value") > 30)


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 15")
def top_k(t: Tables) -> DataFrame:
    return selection.top_k(t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n")), 15, F.desc("n"), F.asc("l_partkey"))


@query("SELECT * FROM orders ORDER BY md5(o_orderkey || ':3'), o_orderkey LIMIT 100")
def seeded_sample(t: Tables) -> DataFrame:
    return selection.seeded_sample(t.orders, "o_orderkey", 100, seed=3)


@query("""SELECT o_orderkey, year(o_orderdate)::INT AS y, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE year(o_orderdate)::INT END AS y_text FROM orders""")
def year_from_string(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 3 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", shaping.year_of(F.col("o_orderdate")).alias("y"), shaping.year_of(text).alias("y_text"))


@query("""WITH g AS (SELECT l_returnflag, l_linestatus, median(l_extendedprice / l_quantity / 1500) AS frame_factor FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, round(CASE WHEN abs(frame_factor - 1) > 0.08 THEN frame_factor ELSE 1.0 END, 6)::DOUBLE AS frame_factor, abs(frame_factor - 1) <= 0.08 AS frame_ok, round(CASE WHEN abs(frame_factor - 1) > 0.08 THEN l_tax * frame_factor ELSE l_tax END, 6) AS x1
FROM lineitem JOIN g USING (l_returnflag, l_linestatus)""")
def median_broadcast_correct(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumns({"m": F.col("l_extendedprice") / F.col("l_quantity"), "a": F.lit(1500.0), "x1": F.col("l_tax")})
    found = shaping.fixed_annotation_frame(rows, ["l_returnflag", "l_linestatus"], "m", "a", ["x1"])
    return found.select("l_orderkey", "l_linenumber", F.round("frame_factor", 6).alias("frame_factor"), "frame_ok", F.round("x1", 6).alias("x1"))


@query("""SELECT e.event_id, e.user_id, (SELECT max_by(o.value, (o.ts, o.value)) FROM events o WHERE o.user_id = e.user_id AND o.event_type = 'purchase' AND o.ts <= e.ts AND o.value IS NOT NULL) AS last_value
FROM events e WHERE e.event_type = 'click'""")
def asof_lookup(t: Tables) -> DataFrame:
    clicks = t.events.filter("event_type = 'click'").select("user_id", "event_id", "ts")
    bought = t.events.filter("event_type = 'purchase'").select("user_id", "ts", "value")
    found = linkage.asof(clicks, bought, "user_id", "ts", "ts", "value")
    return found.select("event_id", "user_id", F.col("value").alias("last_value"))
