"""Sampling, embedding-input and subgraph queries (survey §2.C C3/C10/C11, §2.E E10, §2.F F5, §2.H H13-H21, §2.I I9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendnet.operators import features as FE
from lendnet.operators.graph import sampling as SA
from lendnet.operators.graph import spectral as SP
from lendnet.operators.graph import walks as WK
from lendnet.operators.graph.edges import undirected_edges
from lendnet.plans.catalog import query, rnd
from lendnet.sources import fixtures as FX
from lendnet.sources.fixtures import with_views


def hsql(expr: str) -> str:
    """DuckDB twin of ``hash_key``/``hash_unit``: first 13 hex digits of md5 as bigint."""
    return f"('0x' || substr(md5({expr}), 1, 13))::bigint"


US = """
us as (select src_customer_id as src, dst_customer_id as dst from edges where src_customer_id <> dst_customer_id
       union select dst_customer_id, src_customer_id from edges where src_customer_id <> dst_customer_id)"""


def sample_sql(seed: int, k: int, name: str) -> str:
    return f"""
{name} as (select src, dst from (select src, dst, row_number() over (partition by src order by
   {hsql(f"'{seed}|' || src || '|' || dst")}, dst) as rn from us) where rn <= {k})"""


@query("neighbor_sample", with_views(f"""with {US}, {sample_sql(42, 15, 's1')}, {sample_sql(43, 10, 's2')}
select src as root, 1 as hop, dst as node from s1
union all
select s1.src, 2, s2.dst from s1 join s2 on s2.src = s1.dst""", "edges"))
def neighbor_sample(spark, d):
    return SA.two_hop_sample(FX.edges(spark, d), (15, 10), 42)


NM_COLS = ["person_income", "loan_amnt"]


@query("neighbor_mean", with_views(f"""with {US},
uc as (select * from us where src in (select customer_id from customers) and dst in (select customer_id from customers)),
l1 as (select c.customer_id, coalesce(m.a, 0e0) as person_income, coalesce(m.b, 0e0) as loan_amnt
       from customers c left join (select u.src, avg(f.person_income) as a, avg(f.loan_amnt) as b
       from uc u join customers f on f.customer_id = u.dst group by u.src) m on m.src = c.customer_id),
l2 as (select c.customer_id, coalesce(m.a, 0e0) as person_income, coalesce(m.b, 0e0) as loan_amnt
       from customers c left join (select u.src, avg(f.person_income) as a, avg(f.loan_amnt) as b
       from uc u join l1 f on f.customer_id = u.dst group by u.src) m on m.src = c.customer_id)
select customer_id, round(person_income, 6) as person_income, round(loan_amnt, 6) as loan_amnt from l2""",
                                   "customers", "edges"))
def neighbor_mean(spark, d):
    r = SA.neighbor_mean(FX.edges(spark, d), FX.customers(spark, d), NM_COLS)
    return rnd(r, NM_COLS, 6)


@query("edge_remap", with_views("""
with idx as (select customer_id, row_number() over (order by row_ord, customer_id) - 1 as idx from customers)
select e.edge_ord, s.idx as src_idx, t.idx as dst_idx from edges e
join idx s on s.customer_id = e.src_customer_id join idx t on t.customer_id = e.dst_customer_id""",
                                "customers", "edges"))
def edge_remap(spark, d):
    return SA.edge_remap(FX.customers(spark, d), FX.edges(spark, d)).select("edge_ord", "src_idx", "dst_idx")


QB = """
e4 as (select list_distinct(list_sort([quantile_cont(person_income, 0e0), quantile_cont(person_income, 0.25e0),
         quantile_cont(person_income, 0.5e0), quantile_cont(person_income, 0.75e0),
         quantile_cont(person_income, 1e0)])) as edges from customers),
qb as (select customer_id, case when person_income is null then 0 else
  greatest(cast(len(list_filter((select edges from e4), lambda x: x < person_income)) as int) - 1, 0) end as bucket
  from customers)"""

U = "::double / 4503599627370496e0"

BUCKET_SQL = QB + f""",
c as (select cu.customer_id, cu.row_ord, cu.person_home_ownership, cu.loan_intent,
        concat_ws('|', cu.loan_intent, cast(qb.bucket as varchar)) as b from customers cu join qb using (customer_id)),
g as (select *, row_number() over (order by row_ord, customer_id) - 1 as gi from c),
gp as (select *, row_number() over (partition by b order by gi) - 1 as bp, count(*) over (partition by b) as n from g),
nl as (select *, {hsql("'42|' || customer_id || '|n'")}{U} as u0 from gp),
sl as (select *, unnest(range(1, (case when u0 < 0.2 then 1 when u0 < 0.6 then 2 when u0 < 0.9 then 3 else 4 end) + 1))
         as slot from nl),
dr as (select *, {hsql("'42|' || customer_id || '|' || cast(slot as varchar) || '|s'")}{U} < 0.7 and n > 1 as same,
         {hsql("'42|' || customer_id || '|' || cast(slot as varchar) || '|t'")}{U} as u from sl),
tg as (select d.customer_id, t.customer_id as tgt from dr d join gp t on t.b = d.b and t.bp = floor(d.u * d.n)
       where d.same
       union all
       select d.customer_id, t.customer_id from dr d join g t on t.gi = floor(d.u * (select count(*) from g))
       where not d.same),
pairs as (select distinct least(customer_id, tgt) as src_customer_id, greatest(customer_id, tgt) as dst_customer_id
          from tg where customer_id <> tgt)
select p.src_customer_id, p.dst_customer_id,
 case when a.person_home_ownership = b.person_home_ownership then 'co-borrower'
      when a.loan_intent = b.loan_intent then 'employer' else 'guarantor' end as edge_type
from pairs p join customers a on a.customer_id = p.src_customer_id join customers b on b.customer_id = p.dst_customer_id"""


@query("bucket_links", with_views("with " + BUCKET_SQL, "customers"))
def bucket_links(spark, d):
    from lendnet.operators.features_extra import quartile_bucket
    c = quartile_bucket(FX.customers(spark, d), "person_income")
    return SA.bucket_links(c, ["loan_intent", "bucket"], 42)


@query("skipgram_pairs", """
with t as (select conv_id, turn, list_filter(string_split(lower(text), ' '), lambda x: x <> '') as toks
           from conversations),
ex as (select conv_id, turn, toks, unnest(range(0, len(toks))) as center_pos from t),
pr as (select conv_id, turn, toks, center_pos, unnest([-2, -1, 1, 2]) as o from ex)
select conv_id, turn, center_pos::int as center_pos, toks[center_pos + 1] as center,
 toks[center_pos + o + 1] as context
from pr where center_pos + o >= 0 and center_pos + o < len(toks)""")
def skipgram_pairs(spark, d):
    conv = FX.read_table(spark, d, "conversations").select("conv_id", "turn", WK.tokens("text").alias("toks"))
    return WK.skipgram_pairs(conv, "toks", 2, ["conv_id", "turn"])


@query("neg_sampling", with_views(f"""with {US},
dg as (select c.customer_id as node, count(u.dst) as deg from customers c left join us u on u.src = c.customer_id
       group by 1)
select node, round(pow(deg + 1e0, 0.75) / (select sum(pow(deg + 1e0, 0.75)) from dg), 12) as prob from dg""",
                                  "customers", "edges"))
def neg_sampling(spark, d):
    und = undirected_edges(FX.edges(spark, d), keep_self_loops=False)
    deg = (FX.customers(spark, d).select(F.col("customer_id").alias("node"))
           .join(und.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("deg")), "node", "left")
           .select("node", F.coalesce("deg", F.lit(0)).alias("deg")))
    return rnd(WK.negative_sampling(deg), ["prob"], 12)


@query("norm_laplacian", with_views("""
with a as (select * from (select src_customer_id as i, dst_customer_id as j from edges
           union select dst_customer_id, src_customer_id from edges)
           where i in (select customer_id from customers) and j in (select customer_id from customers)),
dg as (select c.customer_id as i, count(a.j) as d from customers c left join a on a.i = c.customer_id group by 1)
select a.i, a.j, round(-1e0 / sqrt(di.d * dj.d * 1e0), 9) as value from a join dg di on di.i = a.i
  join dg dj on dj.i = a.j where a.i <> a.j
union all
select dg.i, dg.i, round(case when dg.d = 0 then 1e0 else 1e0 - (case when exists (select 1 from a where a.i = dg.i
  and a.j = dg.i) then 1 else 0 end) * 1e0 / dg.d end, 9) from dg""", "customers", "edges"))
def norm_laplacian(spark, d):
    return rnd(SP.norm_laplacian(FX.customers(spark, d), FX.edges(spark, d)), ["value"], 9)


@query("bind_embeddings", with_views("""
select c.customer_id, d.k::int as k, coalesce(round(e.embedding[d.k + 1]::double, 6), 0e0) as value
from customers c cross join (select unnest(range(0, (select max(len(embedding)) from embeddings))) as k) d
left join embeddings e on e.vec_id = c.row_ord""", "customers"))
def bind_embeddings(spark, d):
    emb = FX.read_table(spark, d, "embeddings")
    j = FE.bind_embeddings(FX.customers(spark, d), emb, "row_ord", "vec_id")
    ex = j.select("customer_id", F.posexplode("embedding").alias("k", "value"))
    return rnd(ex.withColumn("value", F.col("value").cast("double")), ["value"], 6).withColumn("k", F.col("k").cast("int"))


@query("first_n", with_views("select * from customers order by row_ord, customer_id limit 100", "customers"))
def first_n(spark, d):
    first, _ = FE.induced_subgraph(FX.customers(spark, d), FX.edges(spark, d), 100)
    return first


@query("induced_subgraph", with_views("""
with f as (select customer_id from customers order by row_ord, customer_id limit 100)
select * from edges where src_customer_id in (select customer_id from f)
  and dst_customer_id in (select customer_id from f)""", "customers", "edges"))
def induced_subgraph(spark, d):
    _, kept = FE.induced_subgraph(FX.customers(spark, d), FX.edges(spark, d), 100)
    return kept


@query("edge_typing", with_views("""
select e.src_customer_id, e.dst_customer_id,
 case when a.person_home_ownership = b.person_home_ownership then 'co-borrower'
      when a.loan_intent = b.loan_intent then 'employer' else 'guarantor' end as edge_type
from edges e join customers a on a.customer_id = e.src_customer_id
join customers b on b.customer_id = e.dst_customer_id""", "customers", "edges"))
def edge_typing(spark, d):
    e = FX.edges(spark, d).select("src_customer_id", "dst_customer_id")
    return FE.edge_typing(e, FX.customers(spark, d))


@query("run_summary", with_views("""
with h as (select p as score, sum(y) as pos, sum(1 - y) as neg from predictions group by p),
ac as (select pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding and 1 preceding), 0)
       as nb from h)
select (select count(*) from customers) as n_customers, (select count(*) from edges) as n_edges,
 round(sum(pos * (nb + neg / 2e0)) / (sum(pos) * 1e0 * sum(neg)), 9) as roc_auc from ac""",
                                 "customers", "edges", "predictions"))
def run_summary(spark, d):
    from lendnet.operators.metrics import roc_auc
    auc = roc_auc(FX.predictions(spark, d))
    return rnd(auc.select(FX.customers(spark, d).agg(F.count(F.lit(1))).scalar().alias("n_customers"),
                          FX.edges(spark, d).agg(F.count(F.lit(1))).scalar().alias("n_edges"), "roc_auc"),
               ["roc_auc"], 9)


# ------------------------------------------- jobs without an SQL twin (rows-only checks)

@query("random_walks")
def random_walks(spark, d):
    nodes = FX.customers(spark, d).select(F.col("customer_id").alias("node"))
    return WK.random_walks(FX.edges(spark, d), nodes, walks_per_node=2, length=10, p=1.0, q=0.5, seed=42)


@query("walk_embeddings")
def walk_embeddings(spark, d):
    from pyspark.ml.functions import vector_to_array
    v = WK.walk_embeddings(random_walks(spark, d), dim=32, window=3)
    return v.select(F.col("word").alias("customer_id"), vector_to_array("vector").alias("embedding"))


@query("spectral_embedding")
def spectral_embedding(spark, d):
    emb, _ = SP.spectral_embedding(FX.customers(spark, d), FX.edges(spark, d), dim=8)
    return emb
