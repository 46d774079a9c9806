"""Golden cascades on tiny graphs (restating the reference's simulator tests) plus
semantics the reference leaves implicit: first-dequeued parent, parallel edges,
self-loops, nodes outside the customer table."""

from collections import deque

import pytest

from conftest import customers_df, edges_df
from lendnet.operators.graph.cascade import cascade, cascade_summary

CHAIN = [("A", "B"), ("B", "C"), ("C", "D"), ("D", "E")]
STAR = [("H", "S1"), ("H", "S2"), ("H", "S3"), ("H", "S4")]


def run(spark, pairs, trigger, types=None, customers=(), **kw):
    e = edges_df(spark, pairs, types)
    t = spark.createDataFrame([("t", trigger)], "trigger_id string, customer_id string")
    r = cascade(customers_df(spark, customers), e, t, **kw)
    return sorted(r.collect(), key=lambda x: (x.hop, -x.stress, x.pos))


def test_only_trigger_falls(spark):
    rows = run(spark, CHAIN, "A", initial_shock=0.5, decay=0.6, threshold=0.4)
    assert sum(r.fallen for r in rows) == 1 and rows[0].customer_id == "A"


def test_full_reach(spark):
    rows = run(spark, CHAIN, "A", decay=0.8, threshold=0.1, max_hops=10)
    assert len(rows) == 5


def test_decay_values(spark):
    rows = run(spark, CHAIN, "A", decay=0.6, threshold=0.1, max_hops=5)
    assert [r.stress for r in rows[:3]] == [1.0, 0.6, 0.36]


def test_stop_below_threshold(spark):
    rows = run(spark, CHAIN, "A", decay=0.5, threshold=0.3, max_hops=5)
    assert sum(r.fallen for r in rows) == 2


def test_max_hops(spark):
    rows = run(spark, CHAIN, "A", decay=0.9, threshold=0.1, max_hops=2)
    assert max(r.hop for r in rows) <= 2


def test_star(spark):
    rows = run(spark, STAR, "H", decay=0.7, threshold=0.1)
    assert len(rows) == 5 and sum(1 for r in rows if r.hop == 1) == 4


def test_unknown_trigger(spark):
    assert run(spark, CHAIN, "CUST_999") == []


def test_summary_of_unknown_trigger_is_zero(spark):
    e = edges_df(spark, CHAIN)
    t = spark.createDataFrame([("t", "CUST_999")], "trigger_id string, customer_id string")
    s = cascade_summary(cascade(customers_df(spark), e, t), t).collect()[0]
    assert (s.total_affected, s.total_fallen, s.max_hop, s.avg_stress, s.cascade_by_hop) == (0, 0, 0, 0.0, {})


def reference_queue(pairs, types, trigger, shock, decay, threshold, max_hops, vuln=None):
    """Independent FIFO traversal used as brute force."""
    weight = {"co-borrower": 1.0, "guarantor": 0.7, "employer": 0.4, "loan": 1.0}
    adj, etype = {}, {}
    for (a, b), t in zip(pairs, types):
        adj.setdefault(a, [])
        adj.setdefault(b, [])
        if b not in adj[a]:
            adj[a].append(b)
        if a not in adj[b]:
            adj[b].append(a)
        etype[frozenset((a, b))] = t
    if trigger not in adj:
        return []
    out, seen, q = [], {trigger}, deque([(trigger, 0, shock, None)])
    while q:
        n, hop, s, p = q.popleft()
        out.append((n, hop, round(s, 4), s >= threshold, p))
        if s >= threshold and hop < max_hops:
            for m in adj[n]:
                if m not in seen:
                    seen.add(m)
                    w = weight.get(etype[frozenset((n, m))] or "", 1.0)
                    q.append((m, hop + 1, s * decay * w * (vuln or {}).get(m, 1.0), n))
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_matches_queue_traversal(spark, seed):
    import random
    rnd = random.Random(seed)
    nodes = [f"N{i}" for i in range(14)]
    pairs, types = [], []
    for _ in range(30):
        a, b = rnd.choice(nodes), rnd.choice(nodes)
        pairs.append((a, b))
        types.append(rnd.choice(["co-borrower", "guarantor", "employer", "loan", "other"]))
    got = run(spark, pairs, types=types, trigger=pairs[0][0], decay=0.8, threshold=0.2, max_hops=6)
    got = sorted((r.customer_id, r.hop, r.stress, r.fallen, r.parent) for r in got)
    # the adjacency type is the last edge's type for a pair
    assert got == reference_queue(pairs, types, pairs[0][0], 1.0, 0.8, 0.2, 6)


def test_vulnerability_and_non_customer(spark):
    cust = [("A", 100.0, 50.0, "N"), ("B", 100.0, 200.0, "N")]   # B: 0.5 + 1.0
    rows = run(spark, [("A", "B"), ("B", "X")], "A", types=["guarantor", "co-borrower"], customers=cust,
               decay=0.5, threshold=0.1)
    by = {r.customer_id: r for r in rows}
    assert by["B"].stress == round(1.0 * 0.5 * 0.7 * 1.5, 4)
    assert by["X"].stress == round(1.0 * 0.5 * 0.7 * 1.5 * 0.5 * 1.0 * 1.0, 4)


def test_registered_cascades_go_five_hops(spark):
    from conftest import SF001
    from lendnet.operators.graph.cascade import node_table
    from lendnet.plans import q_cascade as Q
    customers, edges = Q.FX.customers(spark, SF001), Q.FX.edges(spark, SF001)
    vuln = {r.node: r.vuln for r in node_table(customers, edges).collect()}
    rows = sorted(tuple(r) for r in edges.select("edge_ord", "src_customer_id", "dst_customer_id", "edge_type").collect())
    pairs, types = [r[1:3] for r in rows], [r[3] for r in rows]
    want, stress = {}, {}
    for t in Q.triggers(spark, SF001).collect():
        found = reference_queue(pairs, types, t.customer_id, Q.SHOCK, Q.DECAY, Q.THRESHOLD, 5, vuln)
        found = found or [(t.customer_id, 0, Q.SHOCK, True, None)]     # a customer without edges is alone
        want |= {(t.trigger_id, n): (hop, fallen, parent) for n, hop, _, fallen, parent in found}
        stress |= {(t.trigger_id, n): s for n, _, s, _, _ in found}
    got = Q.cascade(spark, SF001).collect()
    assert {(r.trigger_id, r.customer_id): (r.hop, r.fallen, r.parent) for r in got} == want
    assert max(hop for hop, _, _ in want.values()) == 5
    assert all(abs(r.stress - stress[r.trigger_id, r.customer_id]) < 2e-4 for r in got)
