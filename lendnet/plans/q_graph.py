"""Graph queries (survey §2.C, §2.D, §2.G, §2.H) over the fixture network."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lendnet.operators.graph import edges as GE
from lendnet.operators.graph import hops as GH
from lendnet.operators.graph.borrowers import network_borrowers
from lendnet.operators.graph.sampling import group_positions
from lendnet.plans.catalog import query, rnd
from lendnet.sources import fixtures as FX
from lendnet.session import ensure_checkpoint_dir
from lendnet.sources.files import file_states, path_exists
from lendnet.sources.fixtures import with_views

# Crisis window for the fixture's order dates (1997-01-01 .. 2000-01-01, unix seconds).
FIX_CRISIS_START, FIX_CRISIS_END = 852076800, 946684800


def edges_epoch(spark, d):
    e = FX.edges(spark, d)
    return e.withColumn("ts_epoch", F.unix_seconds(F.col("ts").cast("timestamp")))


DEG_CTE = """
deg as (
 select c.customer_id, cast(coalesce(i.n, 0) + coalesce(o.n, 0) as int) as degree,
  cast(coalesce(i.n, 0) as int) as in_degree, cast(coalesce(o.n, 0) as int) as out_degree
 from customers c
 left join (select dst_customer_id as id, count(*) as n from edges group by 1) i on i.id = c.customer_id
 left join (select src_customer_id as id, count(*) as n from edges group by 1) o on o.id = c.customer_id)"""

NORM_CTE = DEG_CTE + """,
ndeg as (
 select *, ln(1 + in_degree) / ln(1 + greatest((select max(in_degree) from deg), 1)) as norm_in_degree,
  ln(1 + out_degree) / ln(1 + greatest((select max(out_degree) from deg), 1)) as norm_out_degree
 from deg)"""

UND_CTE = """
und as (
 select src_customer_id as src, dst_customer_id as dst from edges
 union
 select dst_customer_id, src_customer_id from edges)"""

FLAG_CTE = """
flags as (select customer_id as node, case when cb_person_default_on_file = 'Y' then 1 else 0 end as d
          from customers)"""

HOP1_CTE = UND_CTE + "," + FLAG_CTE + """,
hop1 as (
 select c.customer_id, coalesce(s.share, 0e0) as neighbor_default_frac
 from customers c left join (
   select u.src, avg(coalesce(f.d, 0)) as share from und u left join flags f on f.node = u.dst group by u.src
 ) s on s.src = c.customer_id)"""

HOP2_CTE = """
pairs2 as (
 select distinct a.src as c, b.dst as x
 from und a join und b on b.src = a.dst
 where a.src in (select customer_id from customers) and a.dst in (select customer_id from customers)
   and b.dst <> a.src
   and not exists (select 1 from und h where h.src = a.src and h.dst = b.dst)),
hop2 as (
 select c.customer_id, coalesce(s.share, 0e0) as neighbor_default_frac_2hop
 from customers c left join (
   select p.c, avg(coalesce(f.d, 0)) as share from pairs2 p left join flags f on f.node = p.x group by p.c
 ) s on s.c = c.customer_id)"""


@query("degrees", with_views(f"with {DEG_CTE}\nselect * from deg", "customers", "edges"))
def degrees(spark, d):
    return GE.degrees(FX.customers(spark, d), FX.edges(spark, d))


@query("norm_degree", with_views(f"""with {NORM_CTE}
select customer_id, degree, in_degree, out_degree, round(norm_in_degree, 9) as norm_in_degree,
 round(norm_out_degree, 9) as norm_out_degree from ndeg""", "customers", "edges"))
def norm_degree(spark, d):
    deg = GE.degrees(FX.customers(spark, d), FX.edges(spark, d))
    return rnd(GE.norm_degree(deg), ["norm_in_degree", "norm_out_degree"], 9)


@query("degree_full_outer", with_views("""
select coalesce(i.id, o.id) as customer_id, coalesce(i.n, 0) as in_degree, coalesce(o.n, 0) as out_degree
from (select dst_customer_id as id, count(*) as n from edges group by 1) i
full outer join (select src_customer_id as id, count(*) as n from edges group by 1) o on o.id = i.id""",
                                       "edges"))
def degree_full_outer(spark, d):
    return GE.degree_full_outer(FX.edges(spark, d))


@query("net_ratio", with_views(f"""with {DEG_CTE}
select customer_id, round(greatest(least((out_degree - in_degree) / (degree + 1e0), 1e0), -1e0), 9) as net_ratio
from deg""", "customers", "edges"))
def net_ratio(spark, d):
    deg = GE.degrees(FX.customers(spark, d), FX.edges(spark, d))
    return rnd(GE.net_ratio(deg).select("customer_id", "net_ratio"), ["net_ratio"], 9)


@query("node_set", with_views("""
select src_customer_id as node from edges union select dst_customer_id from edges""", "edges"))
def node_set(spark, d):
    return GE.node_set(FX.edges(spark, d))


@query("undirected_edges", with_views(f"with {UND_CTE}\nselect src, dst from und", "edges"))
def undirected_edges(spark, d):
    return GE.undirected_edges(FX.edges(spark, d))


@query("canonical_edges", with_views("""
select least(src_customer_id, dst_customer_id) as a, greatest(src_customer_id, dst_customer_id) as b, edge_type
from edges""", "edges"))
def canonical_edges(spark, d):
    return GE.canonical_edges(FX.edges(spark, d))


@query("collapse_edges", with_views("""
select least(src_customer_id, dst_customer_id) as a, greatest(src_customer_id, dst_customer_id) as b,
 arg_max(edge_type, edge_ord) as edge_type, min(edge_ord) as first_ord
from edges group by 1, 2""", "edges"))
def collapse_edges(spark, d):
    return GE.collapse_edges(FX.edges(spark, d))


@query("adjacency", with_views(f"""with {UND_CTE}
select src as node, list_sort(list(distinct dst)) as neighbors from und group by src""", "edges"))
def adjacency(spark, d):
    return GE.adjacency(FX.edges(spark, d))


@query("adjacency_chunks", with_views(f"""with {UND_CTE},
placed as (select src, dst, row_number() over (partition by src order by dst) - 1 as pos from und)
select src as node, (pos // 4)::bigint as chunk, list_sort(list(dst)) as neighbors, count(*) as n
from placed group by 1, 2""", "edges"))
def adjacency_chunks(spark, d):
    # rows of four, so that ordinary customers have several
    return GE.adjacency_chunks(group_positions(GE.undirected_edges(FX.edges(spark, d)), "src", ["dst"]), 4)


@query("node_avg_time", with_views("""
select node, round(avg(t), 3) as avg_ts, count(*) as n_times from (
 select src_customer_id as node, cast(epoch(ts) as bigint) as t from edges
 union all
 select dst_customer_id, cast(epoch(ts) as bigint) from edges) group by node""", "edges"))
def node_avg_time(spark, d):
    return rnd(GE.node_avg_time(edges_epoch(spark, d)), ["avg_ts"], 3)


def _unit(purpose: str) -> str:
    return f"(('0x' || substr(md5('42|' || customer_id || '|{purpose}'), 1, 13))::bigint / 4503599627370496e0)"


def _normal(purpose: str) -> str:
    return f"sqrt(-2e0 * ln(1e0 - {_unit(purpose + '1')})) * cos(2e0 * pi() * {_unit(purpose + '2')})"


BORROWER_SQL = f"""
ends as (select src_customer_id as id, 0 as i, 1 as o, cast(epoch(ts) as bigint) as t from edges
         union all select dst_customer_id, 1, 0, cast(epoch(ts) as bigint) from edges),
n as (select id as customer_id, sum(i) as i, sum(o) as o, avg(t) as t from ends group by 1),
b as (select customer_id, ln(1 + i) / ln(1 + greatest(max(i) over (), 1)) as norm_in,
        greatest(least((o - i) / (o + i + 1e0), 1e0), -1e0) as net_ratio,
        case when t between {FIX_CRISIS_START} and {FIX_CRISIS_END} then 1e0 else 0e0 end as crisis_exposure from n),
p as (select *, greatest(least(0.1e0 + 0.15e0 * norm_in - 0.1e0 * net_ratio + 0.1e0 * crisis_exposure, 0.5e0), 0.02e0)
        as prior_default_prob,
        floor(least(greatest(exp(10.8e0 + 0.3e0 * net_ratio + 0.7e0 * {_normal('income')}), 15000e0), 500000e0)) as person_income
      from b),
l as (select *, floor(least(greatest(exp(ln(greatest(person_income * 0.15e0, 500e0)) + 0.6e0 * {_normal('loan')}), 500e0),
        35000e0)) as loan_amnt,
        (row_number() over (order by person_income, customer_id) - 1) * 1e0 / count(*) over () as income_pctile from p)"""


@query("network_borrowers", with_views(f"""with {BORROWER_SQL}
select customer_id, round(net_ratio, 9) as net_ratio, crisis_exposure, round(prior_default_prob, 9) as prior_default_prob,
 ({_unit('default')} < prior_default_prob)::int as cb_person_default_on_file, person_income, loan_amnt,
 round(least(greatest(loan_amnt / person_income, 0e0), 0.8e0), 2) as loan_percent_income,
 round(income_pctile, 9) as income_pctile,
 substr('ABCDEFG', cast(least(greatest(floor((income_pctile * 0.6e0 + (1e0 - norm_in) * 0.2e0
   + 0.2e0 * {_unit('grade')}) * 7), 0), 6) as int) + 1, 1) as loan_grade
from l""", "edges"))
def network_borrowers_view(spark, d):
    """Borrowers of the bare network: prior default with the crisis term from the edges' times."""
    rows = network_borrowers(edges_epoch(spark, d), crisis=(FIX_CRISIS_START, FIX_CRISIS_END))
    return rnd(rows, ["net_ratio", "prior_default_prob", "income_pctile"], 9)


@query("crisis_exposure", with_views(f"""
with t as (
 select node, avg(t) as avg_ts from (
  select src_customer_id as node, cast(epoch(ts) as bigint) as t from edges
  union all
  select dst_customer_id, cast(epoch(ts) as bigint) from edges) group by node)
select c.customer_id, round(coalesce(t.avg_ts, 1.2e9), 3) as avg_ts,
 case when coalesce(t.avg_ts, 1.2e9) between {FIX_CRISIS_START} and {FIX_CRISIS_END} then 1e0 else 0e0 end
   as crisis_exposure
from customers c left join t on t.node = c.customer_id""", "customers", "edges"))
def crisis_exposure(spark, d):
    r = GE.crisis_exposure(FX.customers(spark, d), edges_epoch(spark, d), FIX_CRISIS_START,
                           FIX_CRISIS_END, 1.2e9)
    return rnd(r, ["avg_ts"], 3)


@query("nbr_frac_1hop", with_views(f"""with {HOP1_CTE}
select customer_id, round(neighbor_default_frac, 9) as neighbor_default_frac from hop1""",
                                   "customers", "edges"))
def nbr_frac_1hop(spark, d):
    return rnd(GH.nbr_frac_1hop(FX.customers(spark, d), FX.edges(spark, d)), ["neighbor_default_frac"], 9)


@query("nbr_frac_2hop", with_views(f"""with {UND_CTE}, {FLAG_CTE}, {HOP2_CTE}
select customer_id, round(neighbor_default_frac_2hop, 9) as neighbor_default_frac_2hop from hop2""",
                                   "customers", "edges"))
def nbr_frac_2hop(spark, d):
    return rnd(GH.nbr_frac_2hop(FX.customers(spark, d), FX.edges(spark, d)), ["neighbor_default_frac_2hop"], 9)


# ------------------------------------------------------------- iterative jobs

from lendnet.operators.graph import bfs as GB  # noqa: E402
from lendnet.operators.graph import pagerank as GP  # noqa: E402
from lendnet.operators.graph import triangles as GT  # noqa: E402
from lendnet.operators.graph.features import graph_features as _graph_features  # noqa: E402

PR_ITERS = 20


def pagerank_ctes(iters: int = PR_ITERS, weighted: bool = False) -> str:
    """Unrolled power iterations as CTEs r0..r{iters} (closed form for the oracle)."""
    if weighted:
        e = "e as (select src_customer_id as src, dst_customer_id as dst, count(*) * 1e0 as w from edges group by 1, 2)"
    else:
        e = "e as (select distinct src_customer_id as src, dst_customer_id as dst, 1e0 as w from edges)"
    parts = [
        e,
        "od as (select src, sum(w) as wout from e group by src)",
        "es as (select e.src, e.dst, e.w / od.wout as share from e join od on od.src = e.src)",
        "nodes as (select customer_id as node from customers union select src from e union select dst from e)",
        "nn as (select count(*) * 1e0 as n from nodes)",
        "nd as (select nodes.node, od.wout is null as dangling from nodes left join od on od.src = nodes.node)",
        "r0 as materialized (select node, dangling, 1e0 / (select n from nn) as rank from nd)",
    ]
    for i in range(1, iters + 1):
        p = f"r{i-1}"
        parts.append(
            f"r{i} as materialized (select r.node, r.dangling, 0.85e0 * (coalesce(c.c, 0e0) + "
            f"(select coalesce(sum(rank), 0e0) from {p} where dangling) / (select n from nn)) "
            f"+ 0.15e0 / (select n from nn) as rank from {p} r left join "
            f"(select es.dst, sum(q.rank * es.share) as c from es join {p} q on q.node = es.src group by es.dst) c "
            f"on c.dst = r.node)")
    return ",\n".join(parts)


@query("pagerank", with_views(f"""with {pagerank_ctes()}
select c.customer_id, round(coalesce(r.rank, 0e0), 10) as pagerank
from customers c left join r{PR_ITERS} r on r.node = c.customer_id""", "customers", "edges"))
def pagerank(spark, d):
    r = GP.pagerank(FX.customers(spark, d), FX.edges(spark, d), iters=PR_ITERS)
    return rnd(r, ["pagerank"], 10)


@query("pagerank_weighted", with_views(f"""with {pagerank_ctes(weighted=True)}
select c.customer_id, round(coalesce(r.rank, 0e0), 10) as pagerank
from customers c left join r{PR_ITERS} r on r.node = c.customer_id""", "customers", "edges"))
def pagerank_weighted(spark, d):
    r = GP.pagerank(FX.customers(spark, d), FX.edges(spark, d), iters=PR_ITERS, weighted=True)
    return rnd(r, ["pagerank"], 10)


@query("degree_share", with_views(f"""with {DEG_CTE}
select customer_id, round(coalesce(degree * 1e0 / nullif((select sum(degree) from deg), 0), 0e0), 12) as pagerank
from deg""", "customers", "edges"))
def degree_share(spark, d):
    deg = GE.degrees(FX.customers(spark, d), FX.edges(spark, d))
    return rnd(GP.degree_share(deg), ["pagerank"], 12)


BFS_CTE = UND_CTE + """,
bfs(node, dist) using key (node) as (
 select customer_id, 0 from customers where cb_person_default_on_file = 'Y'
 union
 select u.dst, min(b.dist + 1) from bfs b join und u on u.src = b.node
 where u.dst not in (select node from recurring.bfs)
 group by u.dst),
dist as (select c.customer_id, cast(coalesce(b.dist, -1) as int) as distance_to_prior_default
 from customers c left join bfs b on b.node = c.customer_id)"""


@query("bfs_distance", with_views(f"with recursive {BFS_CTE}\nselect * from dist", "customers", "edges"))
def bfs_distance(spark, d):
    return GB.distance_to_prior_default(FX.customers(spark, d), FX.edges(spark, d))


CLUS_CTE = """
us as (select src, dst from und where src <> dst),
dg as (select src as node, count(*) as d from us group by src),
tri as (select a.src as node, count(*) as t from us a join us b on b.src = a.src and a.dst < b.dst
        join us c on c.src = a.dst and c.dst = b.dst group by a.src),
clus as (select c.customer_id,
  case when coalesce(dg.d, 0) < 2 then 0e0 else 2e0 * coalesce(tri.t, 0) / (dg.d * (dg.d - 1e0)) end
    as clustering_coefficient
 from customers c left join dg on dg.node = c.customer_id left join tri on tri.node = c.customer_id)"""


@query("clustering", with_views(f"""with {UND_CTE}, {CLUS_CTE}
select customer_id, round(clustering_coefficient, 9) as clustering_coefficient from clus""",
                                "customers", "edges"))
def clustering(spark, d):
    return rnd(GT.clustering(FX.customers(spark, d), FX.edges(spark, d)), ["clustering_coefficient"], 9)


@query("triangles", with_views(f"""with {UND_CTE}, {CLUS_CTE}
select node, t as triangles from tri""", "edges"))
def triangles(spark, d):
    und = GE.undirected_edges(FX.edges(spark, d), keep_self_loops=False)
    return GT.triangle_counts(und).select("node", "triangles")


GF_CTE = (f"{NORM_CTE}, {pagerank_ctes()}, {BFS_CTE}, {CLUS_CTE}, {FLAG_CTE},\n"
          + HOP1_CTE.split(FLAG_CTE + ",", 1)[1] + "," + HOP2_CTE + f""",
gf as (
 select n.customer_id, n.degree, n.in_degree, n.out_degree, n.norm_in_degree, n.norm_out_degree,
  coalesce(r.rank, 0e0) as pagerank, dist.distance_to_prior_default, clus.clustering_coefficient,
  hop1.neighbor_default_frac, hop2.neighbor_default_frac_2hop
 from ndeg n left join r{PR_ITERS} r on r.node = n.customer_id
 left join dist on dist.customer_id = n.customer_id
 left join clus on clus.customer_id = n.customer_id
 left join hop1 on hop1.customer_id = n.customer_id
 left join hop2 on hop2.customer_id = n.customer_id)""")

GF_ROUND = """select customer_id, degree, in_degree, out_degree, round(norm_in_degree, 9) as norm_in_degree,
 round(norm_out_degree, 9) as norm_out_degree, round(pagerank, 10) as pagerank, distance_to_prior_default,
 round(clustering_coefficient, 9) as clustering_coefficient,
 round(neighbor_default_frac, 9) as neighbor_default_frac,
 round(neighbor_default_frac_2hop, 9) as neighbor_default_frac_2hop"""

GF_DOUBLES9 = ["norm_in_degree", "norm_out_degree", "clustering_coefficient", "neighbor_default_frac",
               "neighbor_default_frac_2hop"]


_FEATURE_STORE: dict[tuple, str] = {}


def graph_features_view(spark, d):
    """The feature table of ``d`` from the feature store: computed and written to the shared folder at the
    first use in an application, read back by every later query of it while the input files stay the same
    (names, sizes, modification times)."""
    customers, edges = FX.customers(spark, d), FX.edges(spark, d)
    key = (spark.sparkContext.applicationId, d,
           file_states(spark, {*customers.inputFiles(), *edges.inputFiles()}))
    path = _FEATURE_STORE.get(key)
    if path is None or not path_exists(spark, path):
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/features-{uuid.uuid4().hex}"
        _graph_features(customers, edges).write.parquet(path)
        _FEATURE_STORE[key] = path
    return spark.read.parquet(path)


def round_gf(df):
    return rnd(rnd(df, GF_DOUBLES9, 9), ["pagerank"], 10)


@query("graph_features", with_views(f"with recursive {GF_CTE}\n{GF_ROUND} from gf", "customers", "edges"))
def graph_features(spark, d):
    return round_gf(_graph_features(FX.customers(spark, d), FX.edges(spark, d)))   # always computed anew
