"""Queries on ordered events, vectors and the star schema."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.operators import blocks, coreset, joins, sessions
from millrace.plans.records import query
from millrace.sources.files import json_rows
from millrace.streaming import incremental

_GAP = """g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 4 * 3600000000 THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)"""


@query(f"WITH {_GAP} SELECT user_id, session::BIGINT AS session, count(*) AS n, min(event_id) AS first_event FROM s GROUP BY 1, 2")
def time_gap_sessions(t):
    """W1."""
    s = sessions.gap_sessions(t("events"), ["user_id"], "ts", ["ts", "event_id"])
    return s.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query(
    """WITH e AS (SELECT *, sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM events),
k AS (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY s) - 1 AS session FROM e WHERE event_type <> 'error') SELECT user_id, session, count(*) AS n FROM k GROUP BY 1, 2"""
)
def merge_boundary_sessions(t):
    """W2, with errors as boundaries."""
    s = sessions.boundary_sessions(t("events"), ["user_id"], F.col("event_type") == "error", ["ts", "event_id"])
    return s.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH e AS (SELECT *, CASE WHEN event_type <> 'error' THEN event_type END AS p FROM events),
c AS (SELECT *, CASE WHEN p IS DISTINCT FROM lag(p) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
d AS (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY run) - 1 AS session FROM r WHERE p IS NOT NULL) SELECT user_id, session, p AS prefix, count(*) AS n FROM d GROUP BY 1, 2, 3"""
)
def prefix_runs(t):
    """W3, with event types as prefixes and errors as rows without one."""
    e = t("events").withColumn("prefix", F.when(F.col("event_type") != "error", F.col("event_type")))
    s = sessions.prefix_runs(e, ["user_id"], F.col("prefix"), ["ts", "event_id"])
    return s.groupBy("user_id", "session", "prefix").agg(F.count(F.lit(1)).alias("n"))


@query("WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders) SELECT o_orderkey FROM r WHERE rn >= floor(0.4 * n) AND rn < floor(0.8 * n)")
def lifecycle_band(t):
    """W4."""
    return sessions.lifecycle_band(t("orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey")


@query(
    """WITH r AS (SELECT *, floor((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 3)::BIGINT AS arc FROM events)
SELECT user_id, arc, arg_min(event_id, struct_pack(a := ts, b := event_id)) AS base, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS head, count(*) AS n FROM r GROUP BY 1, 2"""
)
def arcs_of_3(t):
    """W5."""
    a = sessions.arcs(t("events"), ["ts", "event_id"], 3, ["user_id"])
    at = F.struct("ts", "event_id")
    return a.groupBy("user_id", "arc").agg(F.min_by("event_id", at).alias("base"), F.max_by("event_id", at).alias("head"), F.count(F.lit(1)).alias("n"))


@query(
    """WITH r AS (SELECT user_id, ts, max(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1, 2), l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view')
SELECT event_id, (SELECT arg_max(v, r.ts) FROM r WHERE r.user_id = l.user_id AND r.ts <= l.ts) AS value_asof FROM l"""
)
def asof_value(t):
    """P15."""
    e = t("events")
    left, right = e.filter("event_type = 'view'").select("event_id", "user_id", "ts"), e.filter("event_type = 'purchase'").select("user_id", "ts", "value")
    return sessions.asof(left, right, ["user_id"], "ts", "value").select("event_id", "value_asof")


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def json_props(t):
    """Y9, S2."""
    return t("events").select("event_id", json_rows(F.col("props"), "struct<k:bigint>")[0]["k"].alias("k"))


@query("SELECT user_id, arg_min(event_id, struct_pack(a := value, b := event_id)) AS best FROM events WHERE value IS NOT NULL GROUP BY 1")
def best_step(t):
    """J19."""
    return t("events").filter("value is not null").groupBy("user_id").agg(F.min_by("event_id", F.struct("value", "event_id")).alias("best"))


_V = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)"


@query(
    f"""WITH {_V}, q AS (SELECT * FROM v WHERE vec_id % 20 = 0), p AS (SELECT q.vec_id AS vec_id, v.vec_id AS vec_id_match, list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e)) + 1e-8) AS c FROM q, v)
SELECT vec_id, vec_id_match, round(c, 6) AS similarity, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, vec_id_match) AS rank FROM p WHERE c >= 0.15 QUALIFY rank <= 5"""
)
def cosine_topk(t):
    """The stated queries (ids divisible by 20) against all vectors."""
    e = t("embeddings")
    top = joins.vector_top(e.filter("vec_id % 20 = 0"), e, "embedding", "embedding", "vec_id", "vec_id", 5)
    return top.select("vec_id", "vec_id_match", F.round("similarity", 6).alias("similarity"), "rank")


@query(
    f"""WITH {_V}, f AS (SELECT unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v), c AS (SELECT list(m ORDER BY i) AS c FROM (SELECT i, avg(x) AS m FROM f GROUP BY 1))
SELECT vec_id, round(list_dot_product(e, c) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(c, c)) + 1e-8), 6) AS similarity FROM v, c"""
)
def centroid_sim(t):
    """A13, J6."""
    e = t("embeddings").select("vec_id", "embedding")
    return joins.centroid_similarity(e, "embedding", joins.centroid(e, "embedding")).select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {_V}, f AS (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) - 1 AS pos FROM v) SELECT label, pos, round(avg(x), 8) AS mean FROM f GROUP BY 1, 2")
def label_centroids(t):
    """A13 by label."""
    c = joins.centroid(t("embeddings"), "embedding", ["label"])
    return c.select("label", F.posexplode("centroid").alias("pos", "mean")).withColumn("mean", F.round("mean", 8))


@query(f"WITH {_V} SELECT a.vec_id AS vec_id, round(sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 6) AS distance FROM v a JOIN v b ON b.vec_id = a.vec_id + 1")
def neighbour_distance(t):
    """Each vector against the next by id."""
    e = t("embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(V.euclidean("embedding", "other"), 6).alias("distance"))


@query(
    f"""WITH {_V} SELECT a.vec_id AS query_id, b.vec_id AS found_id FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)) + 1e-8) >= 0.3"""
)
def near_search(t):
    """The stated queries (ids divisible by 20) against all rows, at a low threshold, block by block; nothing is broadcast."""
    e = t("embeddings")
    found = blocks.near(blocks.packed(e.filter("vec_id % 20 = 0"), "vec_id", "embedding"), blocks.packed(e, "vec_id", "embedding"), "vec_id", "vec_id", 0.3)
    return found.toDF("query_id", "found_id").filter("query_id <> found_id")


@query("SELECT doc_id, sum(b) AS ones FROM (SELECT doc_id, unnest(list_transform(string_split(sha256(text), ''), lambda h: bit_count(('0x' || h)::INT))) AS b FROM documents) GROUP BY 1".replace("sum(b)", "sum(b)::BIGINT"))
def hash_embedding_bits(t):
    """How many dimensions of the hash embedding are set."""
    return t("documents").select("doc_id", F.size(F.filter(V.hash_embedding("text"), lambda x: x > 0)).alias("ones"))


@query(
    f"""WITH {_V} SELECT b.vec_id AS vec_id, b.label AS label FROM v b WHERE NOT EXISTS (SELECT 1 FROM v a WHERE a.vec_id < b.vec_id
AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)) + 1e-8) > 0.9)"""
)
def semantic_near(t):
    """D6, B19. The SQL is the greedy pass where no two near pairs meet; `tests/test_operators.py` has those that do."""
    e = t("embeddings").withColumn("n", F.size("embedding"))
    return coreset.semantic_near(e, "vec_id", "embedding", "n").select("vec_id", "label")


@query()
def coreset_kcenter(t):
    """B12."""
    return coreset.k_center(t("embeddings"), "vec_id", "embedding", 25)


@query()
def kmeans_budget(t):
    """B15."""
    e = t("embeddings").withColumn("words", (F.pmod(F.xxhash64("vec_id"), F.lit(200)) + 20).cast("long"))
    return coreset.kmeans_budget(e, "vec_id", "embedding", "words", 20000).select("vec_id", "cluster", "words")


@query()
def blend_centroid(t):
    """A14, by label."""
    e = t("embeddings").withColumn("author", F.col("label").cast("string"))
    return coreset.blend(e, "author", "vec_id", "embedding", "0", ["1", "2", "3"], top_percent=0.2)


# Star-schema extras: what the engine gives beside the inventory.


@query(
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, avg(l_discount) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2"""
)
def pricing_summary(t):
    """Filter, projection and partial aggregation."""
    d = t("lineitem").filter("l_shipdate <= timestamp'1998-09-02'").groupBy("l_returnflag", "l_linestatus")
    revenue = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return d.agg(F.sum("l_quantity").alias("sum_qty"), revenue.alias("revenue"), F.avg("l_discount").alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query(
    """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY 1"""
)
def local_supplier_volume(t):
    """A six-way join; AQE picks broadcasts by the sizes it sees."""
    d = t("region").filter("r_name = 'ASIA'").join(t("nation"), F.expr("n_regionkey = r_regionkey")).join(t("supplier"), F.expr("s_nationkey = n_nationkey"))
    d = t("lineitem").join(d, F.expr("l_suppkey = s_suppkey")).join(t("orders"), F.expr("o_orderkey = l_orderkey")).join(t("customer"), F.expr("c_custkey = o_custkey and c_nationkey = s_nationkey"))
    return d.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R') GROUP BY 1")
def semi_join(t):
    """EXISTS."""
    return t("orders").join(t("lineitem").filter("l_returnflag = 'R'"), F.expr("l_orderkey = o_orderkey"), "left_semi").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderpriority = '1-URGENT') GROUP BY 1")
def anti_join(t):
    """NOT EXISTS."""
    return t("customer").join(t("orders").filter("o_orderpriority = '1-URGENT'"), F.expr("o_custkey = c_custkey"), "left_anti").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping_id(l_returnflag, l_linestatus) AS g FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_counts(t):
    """CUBE."""
    return t("lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.grouping_id("l_returnflag", "l_linestatus").alias("g"))


@query("SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_size), ())")
def grouping_sets(t):
    """GROUPING SETS."""
    return t("part").groupingSets([["p_brand"], ["p_size"], []], "p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT o_orderkey, o_custkey, rank() OVER w AS r, round(sum(o_totalprice) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving, lag(o_orderkey) OVER w AS prev FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""
)
def window_frames(t):
    """Ranks, lags and frames."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t("orders").select("o_orderkey", "o_custkey", F.rank().over(w).alias("r"), F.round(F.sum("o_totalprice").over(w.rowsBetween(-2, 0)), 2).alias("moving"), F.lag("o_orderkey").over(w).alias("prev"))


@query("(SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL (SELECT n_nationkey FROM nation EXCEPT SELECT c_nationkey FROM customer)")
def set_operations(t):
    """INTERSECT, EXCEPT, UNION ALL."""
    c, s, n = t("customer").select("c_nationkey"), t("supplier").select("s_nationkey"), t("nation").select("n_nationkey")
    return c.intersect(s).toDF("k").unionAll(n.exceptAll(c.distinct()).distinct().toDF("k"))


@query("SELECT c_mktsegment, count(DISTINCT c_nationkey) AS nations, quantile_disc(c_custkey, 0.5) AS middle FROM customer GROUP BY 1")
def distinct_and_percentile(t):
    """DISTINCT aggregate and percentile."""
    return t("customer").groupBy("c_mktsegment").agg(F.countDistinct("c_nationkey").alias("nations"), F.expr("cast(percentile_disc(0.5) within group (order by c_custkey) as long)").alias("middle"))


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY 1")
def event_pivot(t):
    """PIVOT, J18."""
    kinds = ["view", "click", "purchase"]
    return t("events").groupBy("user_id").pivot("event_type", kinds).agg(F.count(F.lit(1))).na.fill(0, kinds)


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_counts(t):
    """Tumbling windows: the batch form of the streaming rates."""
    return incremental.rates(t("events"), "event_type", "ts")


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 4 * 3600000000 THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 4 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k"""
)
def stream_sessions(t):
    """T6 over the whole table as a batch."""
    return incremental.sessions(t("events"), "user_id", "ts")
