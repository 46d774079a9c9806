"""Stress-cascade queries (survey §2.H H10-H12, §2.D D12, §2.F F2/F6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendnet.operators.graph import cascade as GC
from lendnet.plans.catalog import query, rnd
from lendnet.sources import fixtures as FX
from lendnet.sources.fixtures import with_views

SHOCK, DECAY, THRESHOLD, HOPS = 1.0, 0.6, 0.3, 5


def triggers(spark, d):
    """Every prior-default customer triggers its own cascade."""
    c = FX.customers(spark, d)
    return c.filter(F.col("cb_person_default_on_file") == "Y").select(
        F.col("customer_id").alias("trigger_id"), "customer_id")


def _cascade(spark, d, mode="first_visit"):
    return GC.cascade(FX.customers(spark, d), FX.edges(spark, d), triggers(spark, d), SHOCK, DECAY,
                      THRESHOLD, HOPS, mode=mode)


def cascade_sql(mode: str = "first_visit") -> str:
    """Unrolled hops 0..HOPS as CTEs; first-dequeued parent = smallest path (p1, p2, ...)."""
    parts = ["""
col as (select least(src_customer_id, dst_customer_id) as a, greatest(src_customer_id, dst_customer_id) as b,
        arg_max(edge_type, edge_ord) as edge_type, min(edge_ord) as first_ord from edges group by 1, 2)""", """
vul as (select customer_id as node,
          case when person_income is not null and loan_amnt is not null and person_income > 0 and loan_amnt <> 0
               then 0.5e0 + least(loan_amnt / person_income, 1e0) else 1e0 end as vuln from customers
        union all
        select n, 1e0 from (select src_customer_id as n from edges union select dst_customer_id from edges)
        where n not in (select customer_id from customers))""", """
adj as (select a as src, b as dst, edge_type, first_ord as adj_ord from col
        union all select b, a, edge_type, first_ord from col where a <> b)""", """
adjw as (select adj.*, case edge_type when 'co-borrower' then 1.0e0 when 'guarantor' then 0.7e0
           when 'employer' then 0.4e0 when 'loan' then 1.0e0 else 1.0e0 end as w, vul.vuln
         from adj join vul on vul.node = adj.dst)""", f"""
s0 as (select customer_id as trigger_id, customer_id as node, 0 as hop, {SHOCK}e0 as stress,
         {", ".join(f"cast(null as bigint) as p{i}" for i in range(1, HOPS + 1))},
         cast(null as varchar) as parent, cast(null as varchar) as edge_type
       from customers where cb_person_default_on_file = 'Y' and customer_id in (select node from vul))""",
             "v0 as (select trigger_id, node from s0)"]
    for h in range(1, HOPS + 1):
        prev = [f"f.p{i}" for i in range(1, h)]
        pcols = ", ".join(prev + ["a.adj_ord"])
        names = [f"p{i}" for i in range(1, h + 1)]
        sel = ", ".join(f"{e} as {n}" for e, n in zip(prev + ["a.adj_ord"], names))
        order = ", ".join(names)
        nulls = ", ".join(f"cast(null as bigint) as p{i}" for i in range(h + 1, HOPS + 1))
        parts.append(f"""
c{h} as (select f.trigger_id, a.dst as node, f.stress * {DECAY}e0 * a.w * a.vuln as stress, {sel},
           f.node as parent, a.edge_type
         from s{h-1} f join adjw a on a.src = f.node
         where f.stress >= {THRESHOLD}e0
           and not exists (select 1 from v{h-1} v where v.trigger_id = f.trigger_id and v.node = a.dst))""")
        stress = "sum(stress) over (partition by trigger_id, node)" if mode == "accumulate" else "stress"
        parts.append(f"""
s{h} as (select trigger_id, node, {h} as hop, stress, {order}{', ' + nulls if nulls else ''}, parent, edge_type
         from (select trigger_id, node, {stress} as stress, {order}, parent, edge_type,
                      row_number() over (partition by trigger_id, node order by {order}) as rn from c{h})
         where rn = 1)""")
        parts.append(f"v{h} as (select trigger_id, node from v{h-1} union all select trigger_id, node from s{h})")
    union = " union all ".join(f"select * from s{h}" for h in range(HOPS + 1))
    parts.append(f"allrows as ({union})")
    return "with " + ",".join(parts)


CASCADE_SELECT = f"""
select trigger_id, node as customer_id, hop, round(stress, 4) as stress, stress >= {THRESHOLD}e0 as fallen,
 parent, edge_type from allrows"""


@query("cascade", with_views(cascade_sql() + CASCADE_SELECT, "customers", "edges"))
def cascade(spark, d):
    return _cascade(spark, d).select("trigger_id", "customer_id", "hop", "stress", "fallen", "parent",
                                     "edge_type")


@query("cascade_accum", with_views(cascade_sql("accumulate") + CASCADE_SELECT, "customers", "edges"))
def cascade_accum(spark, d):
    return _cascade(spark, d, "accumulate").select("trigger_id", "customer_id", "hop", "stress", "fallen",
                                                   "parent", "edge_type")


@query("cascade_summary", with_views(cascade_sql() + f""",
res as ({CASCADE_SELECT})
select t.customer_id as trigger_id, coalesce(count(r.trigger_id), 0) as total_affected,
 coalesce(sum(case when r.fallen then 1 else 0 end), 0)::bigint as total_fallen,
 coalesce(max(r.hop), 0) as max_hop, round(coalesce(avg(r.stress), 0e0), 9) as avg_stress
from customers t left join res r on r.trigger_id = t.customer_id
where t.cb_person_default_on_file = 'Y'
group by t.customer_id""", "customers", "edges"))
def cascade_summary(spark, d):
    s = GC.cascade_summary(_cascade(spark, d), triggers(spark, d))
    return rnd(s.drop("cascade_by_hop"), ["avg_stress"], 9)


@query("cascade_by_hop", with_views(cascade_sql() + """
select trigger_id, hop, count(*) as n from allrows group by 1, 2""", "customers", "edges"))
def cascade_by_hop(spark, d):
    s = GC.cascade_summary(_cascade(spark, d), triggers(spark, d))
    return s.select("trigger_id", F.explode("cascade_by_hop").alias("hop", "n"))


@query("cascade_view", with_views(cascade_sql() + f""",
res as ({CASCADE_SELECT}),
shown as (select * from res where hop <= 2)
select s.trigger_id, s.parent, s.customer_id as child, s.edge_type, s.hop from shown s
where s.parent is not null and exists (select 1 from shown p where p.trigger_id = s.trigger_id
                                       and p.customer_id = s.parent)""", "customers", "edges"))
def cascade_view(spark, d):
    _, links = GC.cascade_view(_cascade(spark, d), 2)
    return links
