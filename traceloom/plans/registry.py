"""Router, registry, set and clustering queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from traceloom.operators import clustering as K
from traceloom.operators import registry as G
from traceloom.operators import router as R
from traceloom.plans import views as V
from traceloom.plans.registered import query
from traceloom.sources.tables import read_table

Q = V.REQUESTS
POST = f"""{Q}, v_o as (select *, row_number() over (partition by cluster_id, arm order by received_at, id) as rn, count(*) over (partition by cluster_id, arm) as n from v_request where outcome is not null and not fallback),
 v_p as (select cluster_id, arm, sum(outcome::int * pow(0.995, n - rn)) + pow(0.995, max(n)) as alpha, sum((1 - outcome::int) * pow(0.995, n - rn)) + pow(0.995, max(n)) as beta, count(*) as n from v_o group by all)"""


def posterior(spark, d):
    rows = V.requests(spark, d).where("outcome is not null and not fallback")
    return R.posterior(rows, ["cluster_id", "arm"], ["received_at", "id"])


@query("decayed_posterior", f"with {POST} select cluster_id, arm, round(alpha, 5) as alpha, round(beta, 5) as beta, n from v_p")
def decayed_posterior(spark, d):
    return posterior(spark, d).select("cluster_id", "arm", F.round("alpha", 5).alias("alpha"), F.round("beta", 5).alias("beta"), "n")


@query("router_greedy", f"""with {POST}, w as (select cluster_id, max(alpha) filter (where arm = 'student') as sa, max(beta) filter (where arm = 'student') as sb, max(alpha) filter (where arm = 'teacher') as ta, max(beta) filter (where arm = 'teacher') as tb from v_p group by 1)
select cluster_id, case when sa + sb - 2 >= 10 and sa / (sa + sb) < 0.55 then 'teacher' when sa / (sa + sb) >= ta / (ta + tb) then 'student' else 'teacher' end as choice from w""")
def router_greedy(spark, d):
    p = posterior(spark, d)
    side = lambda a, c: F.max(F.when(F.col("arm") == a, F.col(c))).alias(f"{a}_{c}")
    w = p.groupBy("cluster_id").agg(*(side(a, c) for a in ("student", "teacher") for c in ("alpha", "beta")))
    return w.select("cluster_id", R.greedy_arm("student", "teacher").alias("choice"))


@query("canary_split", f"with {Q} select adapter, count(distinct user_id) as n from v_request group by 1")
def canary_split(spark, d):
    return V.requests(spark, d).groupBy("adapter").agg(F.countDistinct("user_id").alias("n"))


@query("route_resolution", """with n as (select event_id, case event_id % 6 when 0 then 'teacher' when 1 then 'student:a' when 2 then 'cascade:a:auto' when 3 then 'cascade:a:0.5' when 4 then 'big-model' else 'other' end as name from events)
select case when name = 'teacher' then 'teacher' when name like 'student%' then 'student' when name like 'cascade:%' then 'cascade' when name = 'big-model' then 'router' else 'error' end as kind, count(*) as n from n group by 1""")
def route_resolution(spark, d):
    name = F.element_at(F.array(*map(F.lit, ["teacher", "student:a", "cascade:a:auto", "cascade:a:0.5", "big-model", "other"])), (F.col("event_id") % 6 + 1).cast("int"))
    return read_table(spark, d, "events", "event_id").groupBy(R.resolve_route(name, ["big-model"]).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("rolling_rate", f"""with {Q} select id, count(*) over w as n, round(avg(fallback::int) over w, 6) as rate, count(*) over w >= 2 and avg(fallback::int) over w > 0.2 as alert from v_request
 window w as (order by received_at range between interval 3600 seconds preceding and current row)""")
def rolling_rate(spark, d):
    return R.rolling_rate(V.requests(spark, d), F.col("fallback"), 3600, 2).select("id", "n", F.round("rate", 6).alias("rate"), "alert")


@query("outcome_join", """with f as (select user_id as id, arg_max(event_type = 'click', event_id) as late from events where user_id % 2 = 0 group by 1)
select c.c_custkey as id, coalesce(f.late, c.c_acctbal > 5000) as outcome from customer c left join f on f.id = c.c_custkey""")
def outcome_join(spark, d):
    rows = read_table(spark, d, "customer", F.col("c_custkey").alias("id"), (F.col("c_acctbal") > 5000).alias("outcome"))
    back = read_table(spark, d, "events", "user_id", "event_type", "event_id").where("user_id % 2 = 0")
    return R.latest_outcome(rows, back.select(F.col("user_id").alias("id"), (F.col("event_type") == "click").alias("outcome"), F.col("event_id").alias("at")))


@query("latest_per_key", "select user_id, arg_max(event_id, struct_pack(a := ts, b := event_id)) as event_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) as event_type from events group by 1")
def latest_per_key(spark, d):
    return G.latest_per_key(read_table(spark, d, "events", "user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("best_by_metric", "select p_partkey, p_retailprice from part order by p_retailprice desc, p_partkey desc limit 1")
def best_by_metric(spark, d):
    return G.best_by(read_table(spark, d, "part", "p_partkey", "p_retailprice"), "p_retailprice", "p_partkey")


@query("tail_n", "select event_id, user_id from (select * from events order by ts desc, event_id desc limit 20) order by ts")
def tail_n(spark, d):
    return G.tail(read_table(spark, d, "events", "event_id", "user_id", "ts"), ["ts", "event_id"], 20).select("event_id", "user_id")


@query("upsert_rows", "select c_custkey, case when c_custkey % 3 = 0 then 0.0 else c_acctbal end as c_acctbal from customer")
def upsert_rows(spark, d):
    c = read_table(spark, d, "customer", "c_custkey", "c_acctbal")
    return G.upsert(c, c.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.lit(0.0)), ["c_custkey"])


@query("insert_if_new", "select h, min(doc_id) as doc_id from (select sha256(text) as h, doc_id from documents) group by h having min(doc_id) % 2 = 1 and h not in (select sha256(text) from documents where doc_id % 2 = 0)")
def insert_if_new(spark, d):
    t = read_table(spark, d, "documents", F.sha2("text", 256).alias("h"), "doc_id")
    return G.insert_new(t.where("doc_id % 2 = 0"), t.where("doc_id % 2 = 1"), "h", "doc_id")


@query("stable_test_split", "select doc_id, cast('0x' || substr(sha256('17|' || doc_id), 1, 8) as bigint) % 1000000 < 50000 as test from documents")
def stable_test_split(spark, d):
    return G.stable_split(read_table(spark, d, "documents", "doc_id"), F.col("doc_id"), 0.05).select("doc_id", "test")


@query("eval_set_hash", "select lang, count(distinct source) as n from documents group by 1")
def eval_set_hash(spark, d):
    return read_table(spark, d, "documents", "lang", "source").groupBy("lang").agg(F.size(F.collect_set("source")).cast("long").alias("n"))


@query("lineage_recursive", """with recursive l as (select n_nationkey as id, case when n_nationkey > 0 then n_nationkey // 2 end as parent from nation),
 up as (select id, parent as ancestor, 1 as hops from l where parent is not null union all select up.id, l.parent, hops + 1 from up join l on l.id = up.ancestor where l.parent is not null) select * from up""")
def lineage_recursive(spark, d):
    n = read_table(spark, d, "nation", F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") > 0, F.floor(F.col("n_nationkey") / 2).cast("int")).alias("parent"))
    return G.lineage(n, "id", "parent")


@query("latest_price", "select p_brand, arg_max(p_retailprice, p_partkey) as price from part group by 1")
def latest_price(spark, d):
    return G.latest_per_key(read_table(spark, d, "part", "p_brand", "p_retailprice", "p_partkey"), ["p_brand"], ["p_partkey"]).select("p_brand", F.col("p_retailprice").alias("price"))


@query("asof_price", """with p as (select user_id as k, ts as since, value as price from events where event_type = 'purchase'), f as (select event_id, user_id as k, ts from events where event_type = 'view')
select f.event_id, p.price from f asof left join p on f.k = p.k and f.ts >= p.since""")
def asof_price(spark, d):
    e = read_table(spark, d, "events", "event_id", "user_id", "ts", "event_type", "value")
    prices = e.where("event_type = 'purchase'").select(F.col("user_id").alias("k"), F.col("ts").alias("since"), F.col("value").alias("price"))
    facts = e.where("event_type = 'view'").select("event_id", F.col("user_id").alias("k"), "ts")
    return G.price_at(facts, prices, ["k"], "ts", "since", "price").select("event_id", "price")


@query("full_outer_diff", """with a as (select user_id as k, count(*) filter (where event_type = 'click') as v from events where user_id % 3 <> 0 group by 1), b as (select user_id as k, count(*) filter (where event_type = 'view') as v from events where user_id % 3 <> 1 group by 1)
select coalesce(a.k, b.k) as k, a.v as left_value, b.v as right_value from a full join b on a.k = b.k where a.v is distinct from b.v""")
def full_outer_diff(spark, d):
    e = read_table(spark, d, "events", F.col("user_id").alias("k"), "event_type")
    n = lambda t: F.count(F.when(F.col("event_type") == t, 1)).alias("v")
    return G.differing(e.where("k % 3 <> 0").groupBy("k").agg(n("click")), e.where("k % 3 <> 1").groupBy("k").agg(n("view")), "k", "v")


@query("pivot_by_segment", """select user_id % 7 as cluster, count(*) filter (where event_type = 'click') as click, count(*) filter (where event_type = 'error') as error, count(*) filter (where event_type = 'view') as view from events group by 1""")
def pivot_by_segment(spark, d):
    e = read_table(spark, d, "events", (F.col("user_id") % 7).alias("cluster"), "event_type")
    return e.groupBy("cluster").pivot("event_type", ["click", "error", "view"]).agg(F.count(F.lit(1))).na.fill(0)


@query("weakest_segments", """with s as (select user_id % 7 as cluster, avg((event_type <> 'error')::int) filter (where day(ts) <= 15) as a, avg((event_type <> 'error')::int) filter (where day(ts) > 15) as b from events group by 1)
select cluster, round(b - a, 6) as delta from s order by b - a, cluster limit 5""")
def weakest_segments(spark, d):
    e = V.results(spark, d).groupBy("cluster").agg(*(F.avg(F.when(F.col("run") == r, F.col("success").cast("double"))).alias(r) for r in "AB"))
    delta = F.col("B") - F.col("A")
    return e.orderBy(delta, "cluster").limit(5).select("cluster", F.round(delta, 6).alias("delta"))


def _segments(spark, d):
    c = read_table(spark, d, "customer", F.col("c_nationkey").alias("k"), "c_acctbal")
    s = read_table(spark, d, "supplier", F.col("s_nationkey").alias("k"))
    return c.where("c_acctbal > 9000").select("k"), s


@query("set_intersect", "select c_nationkey as k from customer where c_acctbal > 9000 intersect select s_nationkey from supplier")
def set_intersect(spark, d):
    a, b = _segments(spark, d)
    return a.intersect(b)


@query("set_union", "select c_nationkey as k from customer where c_acctbal > 9000 union select s_nationkey from supplier")
def set_union(spark, d):
    a, b = _segments(spark, d)
    return a.unionByName(b).distinct()


@query("set_except", "select s_nationkey as k from supplier except select c_nationkey from customer where c_acctbal > 9000")
def set_except(spark, d):
    a, b = _segments(spark, d)
    return b.subtract(a)


def _centroids(spark, d):
    """The vectors with the four smallest ids, as centroids."""
    first = read_table(spark, d, "embeddings", "vec_id", "embedding").orderBy("vec_id").limit(4).collect()
    return [[float(x) for x in r.embedding] for r in first]


CENTROID = """c as (select row_number() over (order by vec_id) - 1 as cluster, embedding as c from (select * from embeddings order by vec_id limit 4)),
 x as (select e.vec_id, c.cluster, list_sum(list_transform(range(1, len(c.c) + 1), lambda i: pow(e.embedding[i]::double - c.c[i]::double, 2))) as q from embeddings e, c),
 n as (select vec_id, cast(arg_min(cluster, struct_pack(a := q, b := cluster)) as int) as cluster, min(q) as q from x group by 1)"""


@query("nearest_centroid", f"with {CENTROID} select vec_id, cluster, round(q, 4) as distance from n")
def nearest_centroid(spark, d):
    e = read_table(spark, d, "embeddings", "vec_id", "embedding")
    return K.nearest_centroid(e, "embedding", _centroids(spark, d)).select("vec_id", "cluster", F.round("distance", 4).alias("distance"))


@query("lloyd_step", f"with {CENTROID}, y as (select n.cluster, unnest(range(64)) as dim, unnest(e.embedding) as x from n join embeddings e on e.vec_id = n.vec_id) select cluster, cast(dim as int) as dim, round(avg(x::double), 5) as value from y group by all")
def lloyd_step(spark, d):
    e = read_table(spark, d, "embeddings", "vec_id", "embedding")
    return K.lloyd_step(K.nearest_centroid(e, "embedding", _centroids(spark, d)), "embedding", "cluster").select("cluster", "dim", F.round("value", 5).alias("value"))


def _rounds(n: int) -> str:
    """SQL of n rounds of Lloyd from the first four vectors; an empty cluster keeps its centroid."""
    out = ["v as materialized (select vec_id, embedding::double[] as x from embeddings where embedding is not null)", "r0 as materialized (select (row_number() over (order by vec_id) - 1)::int as cluster, x as c from (select * from v order by vec_id limit 4))"]
    for i in range(n):
        out.append(f"d{i} as (select vec_id, x, cluster, list_sum(list_transform(range(1, len(c) + 1), lambda k: pow(x[k] - c[k], 2))) as q from v, r{i}), a{i} as materialized (select vec_id, any_value(x) as x, arg_min(cluster, struct_pack(a := q, b := cluster)) as cluster from d{i} group by 1)")
        out.append(f"m{i} as (select cluster, dim, avg(y) as y from (select cluster, unnest(range(1, len(x) + 1)) as dim, unnest(x) as y from a{i}) group by 1, 2), n{i} as (select cluster, list(y order by dim) as c from m{i} group by 1)")
        out.append(f"r{i + 1} as materialized (select r{i}.cluster, coalesce(n{i}.c, r{i}.c) as c from r{i} left join n{i} on n{i}.cluster = r{i}.cluster)")
    return "with " + ",\n ".join(out)


@query("kmeans_ten_rounds", _rounds(10) + ", e as (select vec_id, arg_min(cluster, struct_pack(a := q, b := cluster)) as cluster from (select vec_id, cluster, list_sum(list_transform(range(1, len(c) + 1), lambda k: pow(x[k] - c[k], 2))) as q from v, r10) group by 1) select e.cluster, count(*) as n, md5(string_agg(vec_id::varchar, ',' order by vec_id)) as members from e group by 1")
def kmeans_ten_rounds(spark, d):
    """Clusters after ten rounds over the whole table from its first four vectors, each with a digest of its members."""
    e = read_table(spark, d, "embeddings", "vec_id", "embedding").where("embedding is not null")
    _, labelled = K.kmeans(e, "embedding", np.array(_centroids(spark, d)), most_rounds=10)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("vec_id")), lambda x: x.cast("string")), ",")
    return labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.md5(ids).alias("members"))


@query("kmeans_first_seed", """with u as (select vec_id, (('0x' || substr(sha256('0:0:' || vec_id), 1, 12))::bigint::double + 1) / (pow(2, 48) + 1) as u from embeddings where embedding is not null), a as (select arg_min(vec_id, -ln(u)) as s from u),
 x as (select e.vec_id, list_sum(list_transform(range(1, len(e.embedding) + 1), lambda i: pow(e.embedding[i]::double - c.embedding[i]::double, 2))) as q from embeddings e, embeddings c where c.vec_id = (select s from a) and e.embedding is not null),
 w as (select x.vec_id, q, (('0x' || substr(sha256('0:1:' || vec_id), 1, 12))::bigint::double + 1) / (pow(2, 48) + 1) as u from x where q > 0)
select 0 as round, s as vec_id from a union all select 1, arg_min(vec_id, -ln(u) / q) from w""")
def kmeans_first_seed(spark, d):
    """The first two seeds: one by hash alone, one drawn in proportion to the squared distance from it."""
    e = read_table(spark, d, "embeddings", "vec_id", "embedding")
    chosen = K.seeds(e, "vec_id", "embedding", 2)
    at = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(chosen)], "round int, x array<double>")
    met = e.select("vec_id", F.col("embedding").cast("array<double>").alias("x")).join(F.broadcast(at), "x")  # two rows
    return met.groupBy("round").agg(F.min("vec_id").alias("vec_id"))


@query("cosine_topk", """with q as (select embedding as q from embeddings order by vec_id limit 1), s as (select vec_id, list_sum(list_transform(range(1, len(q.q) + 1), lambda i: e.embedding[i]::double * q.q[i]::double)) as p,
  sqrt(list_sum(list_transform(e.embedding, lambda x: x::double * x::double))) * sqrt(list_sum(list_transform(q.q, lambda x: x::double * x::double))) as n from embeddings e, q)
select vec_id, round(p / (n + 1e-9), 5) as score from s order by p / (n + 1e-9) desc, vec_id limit 5""")
def cosine_topk(spark, d):
    e = read_table(spark, d, "embeddings", "vec_id", "embedding")
    q = F.array(*(F.lit(float(x)) for x in _centroids(spark, d)[0]))
    s = K.cosine(F.col("embedding"), q)
    return e.select("vec_id", s.alias("s")).orderBy(F.desc("s"), "vec_id").limit(5).select("vec_id", F.round("s", 5).alias("score"))


@query("hash_embed_norms", r"select conv_id, turn, case when regexp_matches(text, '[\p{L}\p{N}_]') then 1.0 else 0.0 end::double as norm from conversations")
def hash_embed_norms(spark, d):
    t = read_table(spark, d, "conversations", "conv_id", "turn", "text")
    return t.select("conv_id", "turn", F.round(F.sqrt(K.dot(K.hash_embedder()("text"), K.hash_embedder()("text"))), 6).alias("norm"))
