"""Queries for distances, clusterings and projections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlab.operators import clustering as K
from flowlab.operators import distances as D
from flowlab.plans.packet_queries import rounded
from flowlab.plans.registry import query, with_views
from flowlab.sources import tables as t

EPS, MIN_SAMPLES = 0.03, 10
DIST = "sqrt((a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2))"


def points(spark, sf):
    df = t.vec2(spark, sf)
    return D.as_vec(df, ["x1", "x2"]).select(F.col("vec_id").alias("id"), "label", "vec")


def wide(spark, sf):
    """All dimensions of the embeddings as ML vectors."""
    df = t.embeddings(spark, sf).select(
        F.col("vec_id").alias("id"), "label", F.transform("embedding", lambda x: x.cast("double")).alias("vec")
    )
    return K.with_features(df)


@query("eps_pairs", with_views("vec2", then=f"""
select a.vec_id as id_a, b.vec_id as id_b, round({DIST}, 9) as distance from vec2 a join vec2 b on a.vec_id < b.vec_id
 where {DIST} <= {EPS}"""))
def _eps_pairs(spark, sf):
    return rounded(D.eps_pairs(points(spark, sf), EPS), 9)


@query("eps_pairs_crowded", with_views("vec2", then=f"""
select a.vec_id as id_a, b.vec_id as id_b, round({DIST}, 9) as distance from vec2 a join vec2 b on a.vec_id < b.vec_id
 where {DIST} <= {EPS}"""))
def _eps_pairs_crowded(spark, sf):
    """The split join: every cell above two points counts as crowded."""
    return rounded(D.eps_pairs(points(spark, sf), EPS, cell_rows=2), 9)


NEAR = ("near", f"""select a.vec_id as id, {DIST} as d,
 row_number() over (partition by a.vec_id order by {DIST}, b.vec_id) as rn from vec2 a, vec2 b""")


@query("k_distance", with_views("vec2", NEAR, then="select id, round(d, 9) as distance from near where rn = 10"))
def _k_distance(spark, sf):
    return rounded(D.k_distance(points(spark, sf), 10), 9)


@query("k_distance_curve", with_views("vec2", NEAR, then="""
select id, round(d, 9) as distance, cast(row_number() over (order by d, id) as integer) as position from near where rn = 10"""))
def _k_curve(spark, sf):
    return rounded(D.k_distance_curve(points(spark, sf), 10, block_rows=170), 9)


@query("suggest_eps", with_views("vec2", NEAR, then="""
select round(d, 9) as eps from (select d, lead(d) over (order by d) - d as step from near where rn = 10)
 where step is not null order by step desc, d limit 1"""))
def _suggest_eps(spark, sf):
    return rounded(D.suggest_eps(points(spark, sf), 10), 9)


NEAREST = with_views("vec2", then=f"""
select a.vec_id as id, min_by(b.label, {DIST}) as label, round(min({DIST}), 9) as distance
 from vec2 a, vec2 b where a.vec_id % 2 = 0 and b.vec_id % 2 = 1 group by a.vec_id""")


@query("nearest_label", NEAREST)
def _nearest(spark, sf):
    p = points(spark, sf)
    return rounded(D.nearest_label(p.where("id % 2 = 0"), p.where("id % 2 = 1")), 9)


@query("nearest_label_blocks", NEAREST)
def _nearest_blocks(spark, sf):
    p = points(spark, sf)
    return rounded(
        D.nearest_label(p.where("id % 2 = 0"), p.where("id % 2 = 1"), broadcast_rows=10, block_rows=90), 9
    )


SIL = ("sil", f"""select id, c, case when size = 1 or greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end as s from (
 select id, c, max(case when c = o then n end) as size, max(case when c = o and n > 1 then total / (n - 1) end) as a,
  min(case when c <> o then total / n end) as b from (
  select a.vec_id as id, a.label as c, b.label as o, sum({DIST}) as total, count(*) as n from vec2 a, vec2 b group by all)
 group by id, c)""")


@query("silhouette_points", with_views("vec2", SIL, then="select id, cast(c as bigint) as label, round(s, 7) as silhouette from sil"))
def _sil_points(spark, sf):
    return rounded(D.silhouette_points(points(spark, sf), "label", block_rows=170), 7)


@query("silhouette", with_views("vec2", SIL, then="select round(avg(s), 7) as silhouette_score from sil"))
def _sil(spark, sf):
    return rounded(D.silhouette(points(spark, sf), "label"), 7)


CENTERS = ("centers", "select label, count(*) as n, avg(x1) as m1, avg(x2) as m2 from vec2 group by label")
CH = """(select sum(n * ((m1 - g1) * (m1 - g1) + (m2 - g2) * (m2 - g2))) from centers, (select avg(x1) as g1, avg(x2) as g2 from vec2))
 * ((select count(*) from vec2) - (select count(*) from centers)) /
 ((select sum((x1 - m1) * (x1 - m1) + (x2 - m2) * (x2 - m2)) from vec2 join centers using (label)) * ((select count(*) from centers) - 1))"""


@query("calinski_harabasz", with_views("vec2", CENTERS, then=f"select round({CH}, 6) as calinski_harabasz"))
def _ch(spark, sf):
    return rounded(K.calinski_harabasz(points(spark, sf), "label"))


SPREAD = ("spread", """select label, m1, m2, avg(sqrt((x1 - m1) * (x1 - m1) + (x2 - m2) * (x2 - m2))) as s
 from vec2 join centers using (label) group by label, m1, m2""")
DB = """(select avg(r) from (select a.label, max((a.s + b.s) / sqrt((a.m1 - b.m1) * (a.m1 - b.m1) + (a.m2 - b.m2) * (a.m2 - b.m2))) as r
 from spread a join spread b on a.label <> b.label group by a.label))"""


@query("davies_bouldin", with_views("vec2", CENTERS, SPREAD, then=f"select round({DB}, 6) as davies_bouldin"))
def _db(spark, sf):
    return rounded(K.davies_bouldin(points(spark, sf), "label"))


CONTINGENCY = ("cells", "select vec_id % 3 as y, label as c, cast(count(*) as double) as n from vec2 group by all")
EXTERNAL = """
union all select 'adjusted_rand_index', round((s - a * b / t) / ((a + b) / 2 - a * b / t), 6) from
 (select sum(n * (n - 1) / 2) as s from cells), (select sum(n * (n - 1) / 2) as a from (select sum(n) as n from cells group by y)),
 (select sum(n * (n - 1) / 2) as b from (select sum(n) as n from cells group by c)), (select sum(n) * (sum(n) - 1) / 2 as t from cells)
union all select 'nmi', round(mi / ((ha + hp) / 2), 6) from
 (select sum(n / t * ln(n * t / (na * np))) as mi from (select n, sum(n) over (partition by y) as na, sum(n) over (partition by c) as np, sum(n) over () as t from cells)),
 (select -sum(n / t * ln(n / t)) as ha from (select sum(n) as n, sum(sum(n)) over () as t from cells group by y)),
 (select -sum(n / t * ln(n / t)) as hp from (select sum(n) as n, sum(sum(n)) over () as t from cells group by c))"""


@query("cluster_report", with_views("vec2", SIL, CENTERS, SPREAD, CONTINGENCY, then=f"""
select 'n_clusters' as metric, cast(count(*) as double) as value from centers
union all select 'silhouette_score', round(avg(s), 6) from sil
union all select 'calinski_harabasz', round({CH}, 6) union all select 'davies_bouldin', round({DB}, 6) {EXTERNAL}"""))
def _report(spark, sf):
    df = points(spark, sf).withColumn("y", F.col("id") % 3)
    return rounded(K.cluster_report(df, "label", actual="y"))


NOISY = ("cells", "select vec_id % 3 as y, case when label = 0 then -1 else label end as c, cast(count(*) as double) as n from vec2 group by all")
SIL_REAL = ("sil", SIL[1].replace("from vec2 a, vec2 b", "from vec2 a, vec2 b where a.label <> 0 and b.label <> 0"))


@query("cluster_report_with_noise", with_views("vec2", SIL_REAL, NOISY, then=f"""
select 'n_clusters' as metric, cast(count(distinct label) as double) as value from vec2 where label <> 0
union all select 'n_noise_points', cast(count(*) as double) from vec2 where label = 0
union all select 'noise_ratio', round(count(case when label = 0 then 1 end) / count(*), 6) from vec2
union all select 'silhouette_score', round(avg(s), 6) from sil {EXTERNAL}"""))
def _noise_report(spark, sf):
    df = points(spark, sf).withColumn("y", F.col("id") % 3).withColumn(
        "label", F.when(F.col("label") == 0, -1).otherwise(F.col("label"))
    )
    return rounded(K.cluster_report(df, "label", actual="y", noise=True))


DBSCAN_SQL = "with recursive " + with_views("vec2", (
    "pairs", f"select a.vec_id as a, b.vec_id as b from vec2 a join vec2 b on {DIST} <= {EPS}"), (
    "core", f"select a as id from pairs group by a having count(*) >= {MIN_SAMPLES}"), (
    "links", "select a, b from pairs where a in (select id from core) and b in (select id from core)"), (
    "reached", "select id as a, id as b from core union select r.a, l.b from reached r join links l on r.b = l.a"), (
    "roots", "select b as id, min(a) as root from reached group by b"), (
    "named", "select id, cast(dense_rank() over (order by root) - 1 as integer) as cluster from roots"), (
    "border", "select a as id, min(cluster) as cluster from pairs join named on b = named.id where a not in (select id from core) group by a"),
    then="""select vec_id as id, coalesce(named.cluster, border.cluster, -1) as cluster from vec2
 left join named on vec_id = named.id left join border on vec_id = border.id""")[len("with "):]


@query("dbscan", DBSCAN_SQL)
def _dbscan(spark, sf):
    return K.dbscan(points(spark, sf), EPS, MIN_SAMPLES)


@query("dbscan_crowded", DBSCAN_SQL.replace(f"<= {EPS}", "<= 0.08").replace(f">= {MIN_SAMPLES}", ">= 4"))
def _dbscan_crowded(spark, sf):
    """Wide radius: most cells are dense, so cells are compared as boxes."""
    return K.dbscan(points(spark, sf), 0.08, 4, cell_rows=5)


WIDE_DIST = "list_distance(cast(a.embedding as double[]), cast(b.embedding as double[]))"


def all_coordinates(spark, sf):
    return t.embeddings(spark, sf).select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vec")
    )


@query("dbscan_all_dimensions", "with recursive pairs as (" + f"""
 select a.vec_id as a, b.vec_id as b from embeddings a, embeddings b where {WIDE_DIST} <= 1.1),
core as (select a as id from pairs group by a having count(*) >= 4),
links as (select a, b from pairs where a in (select id from core) and b in (select id from core)),
reached as (select id as a, id as b from core union select r.a, l.b from reached r join links l on r.b = l.a),
roots as (select b as id, min(a) as root from reached group by b),
named as (select id, cast(dense_rank() over (order by root) - 1 as integer) as cluster from roots),
border as (select a as id, min(cluster) as cluster from pairs join named on b = named.id where a not in (select id from core) group by a)
select vec_id as id, coalesce(named.cluster, border.cluster, -1) as cluster from embeddings
 left join named on vec_id = named.id left join border on vec_id = border.id""")
def _dbscan_wide(spark, sf):
    """Density clusters of all 64 coordinates."""
    return K.dbscan(all_coordinates(spark, sf), 1.1, 4)


@query("k_distance_all_dimensions", f"""select id, round(d, 9) as distance from (
 select a.vec_id as id, {WIDE_DIST} as d, row_number() over (partition by a.vec_id order by {WIDE_DIST}, b.vec_id) as rn
  from embeddings a, embeddings b) where rn = 10""")
def _k_distance_wide(spark, sf):
    """The tenth nearest over all 64 coordinates."""
    return rounded(D.k_distance(all_coordinates(spark, sf), 10), 9)


@query("nearest_label_all_dimensions", f"""select a.vec_id as id, min_by(b.label, {WIDE_DIST}) as label, round(min({WIDE_DIST}), 9) as distance
 from embeddings a, embeddings b where a.vec_id % 2 = 0 and b.vec_id % 2 = 1 group by a.vec_id""")
def _nearest_wide(spark, sf):
    """Labels by the nearest of all 64 coordinates, through the cells."""
    p = t.embeddings(spark, sf).select(
        F.col("vec_id").alias("id"), "label", F.transform("embedding", lambda x: x.cast("double")).alias("vec")
    )
    return rounded(D.nearest_label(p.where("id % 2 = 0"), p.where("id % 2 = 1"), broadcast_rows=0), 9)


@query("kmeans", """select vec_id as id, label, true as is_nearest, cast(8 as bigint) as n_clusters,
 count(*) over () as n_points, true as better_than_one from embeddings""")
def _kmeans(spark, sf):
    """Every point is in the cluster whose centre is nearest, of eight that are
    all used and leave at least 3 % less spread than one centre."""
    df = wide(spark, sf)
    model = K.fit_kmeans(df)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.centres])
    scored = K.with_vec(model.transform(df)).withColumn("gaps", F.transform(centres, lambda c: D.distance(c, F.col("vec"))))
    own = F.element_at("gaps", F.col("cluster") + 1)
    one = sum(F.var_pop(F.element_at("vec", i + 1)) for i in range(len(model.centres[0]))) * F.count("*")
    left = F.sum(F.pow(F.array_min("gaps"), 2))
    used = scored.agg(
        F.count_distinct("cluster").alias("n_clusters"),
        F.count("*").alias("n_points"),
        ((left <= 0.97 * one) & (F.abs(left - model.cost) <= 1e-6 * left)).alias("better_than_one"),
    )
    return scored.select("id", "label", (own <= F.array_min("gaps") + 1e-9).alias("is_nearest")).join(F.broadcast(used))


@query("choose_k", """select cast(k as int) as k, true as inertia_falls, true as silhouette_in_range, cast(1 as bigint) as n_best
 from (select unnest(range(2, 16)) as k) where exists (select 1 from embeddings)""")
def _choose_k(spark, sf):
    """The sweep covers every k, inertia falls with k, one k is the best."""
    table = K.choose_k(wide(spark, sf))
    whole = Window.partitionBy()  # one row per k
    before = F.lag("inertia").over(whole.orderBy("k"))
    top = F.max(F.when(F.col("is_best"), F.col("silhouette"))).over(whole) == F.max("silhouette").over(whole)
    return table.select(
        "k",
        F.coalesce(F.col("inertia") < before, F.lit(True)).alias("inertia_falls"),
        (F.col("silhouette").between(-1, 1) & top).alias("silhouette_in_range"),
        F.sum(F.col("is_best").cast("int")).over(whole).alias("n_best"),
    )


@query("pca_projection", """select label, count(*) as n, true as centred, true as uncorrelated, true as ordered, true as share_in_range
 from embeddings group by label""")
def _pca(spark, sf):
    """Scores are centred and uncorrelated, the first has the larger variance."""
    scores = K.pca2(wide(spark, sf), ["id", "label"])
    facts = scores.agg(
        (F.greatest(F.abs(F.avg("pc1")), F.abs(F.avg("pc2"))) < 1e-9).alias("centred"),
        (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("uncorrelated"),
        (F.var_samp("pc1") >= F.var_samp("pc2")).alias("ordered"),
        F.max("explained").between(0, 1).alias("share_in_range"),
    )
    return scores.groupBy("label").agg(F.count("*").alias("n")).join(F.broadcast(facts))


@query("eps_pairs_all_dimensions", """
select id_a, id_b from (
 select a.vec_id as id_a, b.vec_id as id_b, list_distance(cast(a.embedding as double[]), cast(b.embedding as double[])) as d
  from embeddings a join embeddings b on a.vec_id < b.vec_id)
 where d <= 1.15""")
def _eps_pairs_wide(spark, sf):
    """The radius join over all 64 coordinates."""
    df = t.embeddings(spark, sf).select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    return D.eps_pairs(df, 1.15).select("id_a", "id_b")
