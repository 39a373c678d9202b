"""Further relational queries: what the driver's tables allow beyond the bibliographic operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.sequences import paged
from .base import Catalog, table

CATALOG = Catalog()


@CATALOG.query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def extra_pricing_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@CATALOG.query("SELECT lang, source, count(*) AS n FROM documents GROUP BY CUBE (lang, source)")
def extra_cube(spark, sf_dir):
    return table(spark, sf_dir, "documents").cube("lang", "source").agg(F.count("*").alias("n"))


@CATALOG.query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def extra_rollup(spark, sf_dir):
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"))


@CATALOG.query("SELECT lang, source, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang), (source), ())")
def extra_grouping_sets(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupingSets([["lang"], ["source"], []], "lang", "source").agg(F.count("*").alias("n"))


@CATALOG.query("SELECT o_custkey, o_orderkey, rank() OVER w AS place, dense_rank() OVER w AS dense, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS earlier, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS later FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)")
def extra_ranking(spark, sf_dir):
    w = Window.partitionBy("o_custkey")
    full = w.orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.rank().over(w.orderBy("o_orderdate")).cast("long").alias("place"), F.dense_rank().over(w.orderBy("o_orderdate")).cast("long").alias("dense"), F.lag("o_orderkey").over(full).alias("earlier"), F.lead("o_orderkey").over(full).alias("later"))


@CATALOG.query("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS 2 PRECEDING), 2) AS moving FROM orders")
def extra_frames(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("moving"))


@CATALOG.query("SELECT doc_id, CAST(floor((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) / 4) AS BIGINT) AS page FROM documents")
def pagination(spark, sf_dir):
    return paged(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["doc_id"], ["lang"]).select("doc_id", "page")


@CATALOG.query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def extra_intersect(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).intersect(table(spark, sf_dir, "orders").select("o_custkey"))


@CATALOG.query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def extra_except(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").select("o_custkey"))


@CATALOG.query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY n_name")
def extra_revenue_by_nation(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


_ASOF = "SELECT a.event_id, b.event_id AS before FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY ALL) b ON a.user_id = b.user_id AND a.ts >= b.ts"


@CATALOG.query(_ASOF)
def extra_asof_join(spark, sf_dir):
    """The last click at or before each purchase: one union and a window, not a range join."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "click")).select("user_id", "ts", "event_id", (F.col("event_type") == "click").alias("click"))
    w = Window.partitionBy("user_id").orderBy("ts", F.desc("click"), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("click"), F.col("event_id")), ignorenulls=True).over(w)
    return e.withColumn("before", last).where("not click").select("event_id", "before")


@CATALOG.query("SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'error' AND b.event_type = 'purchase' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL '6 hours'")
def extra_range_join(spark, sf_dir):
    """Purchases within six hours of an error, by user and time bucket: an equality join with a residual."""
    width = 6 * 3600
    bucket = lambda c: F.floor(F.unix_timestamp(c) / width)
    events = table(spark, sf_dir, "events")
    a = events.where("event_type = 'error'").select("user_id", F.col("event_id").alias("a"), F.col("ts").alias("ta"), F.explode(F.array(bucket("ts"), bucket("ts") + 1)).alias("k"))
    b = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("b"), F.col("ts").alias("tb"), bucket("ts").alias("k"))
    return a.join(b, ["user_id", "k"]).where((F.col("tb") > F.col("ta")) & (F.col("tb") <= F.col("ta") + F.expr("interval 6 hours"))).select("a", "b")


@CATALOG.query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def extra_tumbling(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


@CATALOG.query("SELECT s AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS s FROM events) GROUP BY s")
def extra_sliding(spark, sf_dir):
    from ..streaming.stages import sliding

    return sliding(table(spark, sf_dir, "events"), "1 hour", "30 minutes")


@CATALOG.query("SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL '2 hours' OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS fresh FROM events)) GROUP BY user_id, s")
def extra_sessions(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


@CATALOG.query("SELECT event_type, true AS close FROM events GROUP BY event_type")
def extra_approx_distinct(spark, sf_dir):
    """Whether the sketch is within a tenth (five of its standard errors) of the exact count.

    Beside ``count_distinct`` each pair of type and user would carry a sketch of its own; over distinct pairs, which leave a sketch as it is, a type has one a task.
    """
    pairs = table(spark, sf_dir, "events").select("event_type", "user_id").distinct()
    rows = pairs.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("near"), F.count("user_id").alias("n"))
    return rows.select("event_type", (F.abs(F.col("near") - F.col("n")) <= 0.1 * F.col("n")).alias("close"))
