"""One- and two-hop default shares over de-duplicated undirected neighbour sets.

1-hop: for each customer, the share of its distinct neighbours (a self-loop makes a
node its own neighbour; non-customer neighbours count in the denominator) that have a
prior default; no neighbours -> 0.0.

2-hop: neighbours of neighbours, walking only through customer nodes, minus the node
itself and minus its 1-hop set; share of prior defaults; empty -> 0.0.

The 2-hop set is a wedge join keyed on the middle node, de-duplicated with map-side
partial aggregation before it shuffles; middles of a high degree are dealt over many
tasks by that degree (``skew.salted_join``). A hub that touches a large share of the
nodes makes no wedges at all: its neighbours are bitmaps over dense node numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.operators.graph.dense import numbered
from lendnet.operators.graph.edges import undirected_edges
from lendnet.operators.graph.skew import heavy_keys, salted_join
from lendnet.session import cut_lineage


def default_flags(customers: DataFrame, flag_col: str = "cb_person_default_on_file") -> DataFrame:
    """(node, d) with d = 1 for prior-default customers; the flag may be 'Y'/'N' or 0/1."""
    f = F.col(flag_col)
    is_def = (f.cast("string") == "Y") | (f.cast("string") == "1")
    return customers.select(F.col("customer_id").alias("node"),
                            F.when(is_def, 1).otherwise(0).alias("d"))


def nbr_frac_1hop(customers: DataFrame, edges: DataFrame,
                  flag_col: str = "cb_person_default_on_file", und: DataFrame | None = None) -> DataFrame:
    u = undirected_edges(edges) if und is None else und
    flags = default_flags(customers, flag_col).withColumnRenamed("node", "dst")
    share = (u.join(flags, "dst", "left")
             .groupBy(F.col("src").alias("customer_id"))
             .agg(F.avg(F.coalesce(F.col("d"), F.lit(0))).alias("share")))
    return (customers.select("customer_id").join(share, "customer_id", "left")
            .select("customer_id", F.coalesce("share", F.lit(0.0)).alias("neighbor_default_frac")))


def two_hop_pairs(customers: DataFrame, edges: DataFrame, hub_min_degree: int = 1000,
                  und: DataFrame | None = None) -> DataFrame:
    """Distinct (customer_id, x): x reachable in two steps through a customer, x not self, not 1-hop."""
    u = undirected_edges(edges) if und is None else und
    ids = customers.select(F.col("customer_id").alias("src"))
    rows = u.join(ids, "src", "left_semi")
    pairs = _wedges(rows, rows, _degrees(u), hub_min_degree)
    hop1 = u.select(F.col("src").alias("c"), F.col("dst").alias("x"))
    return pairs.join(hop1, ["c", "x"], "left_anti").withColumnRenamed("c", "customer_id")


def _degrees(und: DataFrame) -> DataFrame:
    return und.groupBy(F.col("src").alias("mid")).agg(F.count(F.lit(1)).alias("deg"))


def _hub_middles(deg: DataFrame, hub_min_degree: int) -> DataFrame:
    total = deg.agg(F.sum("deg").cast("double")).scalar()
    return heavy_keys(deg, "mid", "deg", total, min_threshold=hub_min_degree, with_degree=True)


def _wedges(first: DataFrame, second: DataFrame, deg: DataFrame, hub_min_degree: int) -> DataFrame:
    """Distinct (c, x), c <> x, over c - mid - x; hub middles are dealt over sub-keys by their degree."""
    wedges = salted_join(first.select(F.col("src").alias("c"), F.col("dst").alias("mid")),
                         second.select(F.col("src").alias("mid"), F.col("dst").alias("x")), "mid",
                         _hub_middles(deg, hub_min_degree), per_salt=hub_min_degree)
    return wedges.filter("c <> x").select("c", "x").distinct()


def nbr_frac_2hop(customers: DataFrame, edges: DataFrame,
                  flag_col: str = "cb_person_default_on_file", hub_min_degree: int = 1000,
                  und: DataFrame | None = None, bitmap_min_degree: int | None = None) -> DataFrame:
    """Share of prior defaults in the 2-hop set.

    Middles with a degree of at least ``bitmap_min_degree`` (by default a 64th of the nodes, so that there are few:
    at most 64 times the mean degree) make no wedges. Customers are grouped by the set of such hubs next to them;
    a group's hub neighbours are one bitmap per 32,768 node numbers (the hubs' bitmaps united), counted once whole
    and once under the default flags. What a customer's own count must not hold (itself, its neighbours) or holds
    already (nodes its other wedges reach) is looked up bit by bit: one row per edge and wedge of ordinary middles.
    """
    u = undirected_edges(edges) if und is None else und
    flags = default_flags(customers, flag_col)
    ids = customers.select(F.col("customer_id").alias("src"))
    rows = u.join(ids, "src", "left_semi")
    deg = _degrees(u)
    if bitmap_min_degree is None:
        least = F.greatest(deg.agg(F.count(F.lit(1))).scalar() / F.lit(64.0), F.lit(float(hub_min_degree)))
    else:
        least = F.lit(float(bitmap_min_degree))
    hubs = cut_lineage(deg.filter(F.col("deg") >= least).select("mid")
                       .join(ids.withColumnRenamed("src", "mid"), "mid", "left_semi"))
    if hubs.isEmpty():
        counts = _wedge_counts(rows, u, flags, deg, hub_min_degree)
    else:
        counts = _counts_with_hubs(rows, u, flags, deg, hubs, hub_min_degree)
    share = counts.filter("n > 0").select("c", (F.col("d") / F.col("n")).alias("share"))
    return (customers.select("customer_id").join(share, F.col("customer_id") == F.col("c"), "left")
            .select("customer_id", F.coalesce("share", F.lit(0.0)).alias("neighbor_default_frac_2hop")))


def _wedge_counts(rows: DataFrame, und: DataFrame, flags: DataFrame, deg: DataFrame, hub_min_degree: int) -> DataFrame:
    """(c, n, d): size of the 2-hop set and its prior defaults.

    A wedge brings the flag of its end along (met once an edge, not once a wedge), and the direct neighbours are
    rows of the same table, so one aggregate over (c, x) removes both repeats and neighbours."""
    marks = flags.groupBy(F.col("node").alias("x")).agg(F.count(F.lit(1)).alias("k"), F.sum("d").alias("s"))
    ends = (rows.select(F.col("src").alias("mid"), F.col("dst").alias("x")).join(marks, "x", "left")
            .select("mid", "x", F.coalesce("k", F.lit(1)).alias("k"), F.coalesce("s", F.lit(0)).alias("s")))
    wedges = salted_join(rows.select(F.col("src").alias("c"), F.col("dst").alias("mid")), ends, "mid",
                         _hub_middles(deg, hub_min_degree), per_salt=hub_min_degree).filter("c <> x")
    hop1 = und.select(F.col("src").alias("c"), F.col("dst").alias("x"), F.lit(0).cast("long").alias("k"),
                      F.lit(0).cast("long").alias("s"), F.lit(1).alias("near"))
    return (wedges.select("c", "x", "k", "s", F.lit(0).alias("near")).unionByName(hop1).groupBy("c", "x")
            .agg(F.max("near").alias("near"), F.max("k").alias("k"), F.max("s").alias("s")).filter("near = 0")
            .groupBy("c").agg(F.sum("k").alias("n"), F.sum("s").alias("d")))


def _counts_with_hubs(rows: DataFrame, und: DataFrame, flags: DataFrame, deg: DataFrame, hubs: DataFrame,
                      hub_min_degree: int) -> DataFrame:
    hub = F.broadcast(hubs.select(F.col("mid").alias("hub")))
    # dense numbers of all nodes with their flag
    number = cut_lineage(numbered(und.select(F.col("src").alias("node")).distinct()).join(flags, "node", "left")
                         .select("node", "id", F.coalesce("d", F.lit(0)).alias("d")))
    at = number.select(F.col("node").alias("x"), F.bitmap_bucket_number("id").alias("bucket"),
                       F.bitmap_bit_position("id").alias("bit"), "d")
    # groups of customers with the same hubs beside them
    sets = cut_lineage(rows.join(hub, F.col("dst") == F.col("hub")).groupBy(F.col("src").alias("c"))
                       .agg(F.array_sort(F.collect_list("hub")).alias("hubs")))
    groups = cut_lineage(numbered(sets.select("hubs").distinct()).withColumnRenamed("id", "g"))
    member = sets.join(groups, "hubs").select("c", "g")
    # a hub's neighbours as bitmaps (with and without the flags), united per group
    maps = cut_lineage(rows.join(hub, F.col("src") == F.col("hub")).select("hub", F.col("dst").alias("x")).join(at, "x")
                       .groupBy("hub", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"), F.bitmap_construct_agg(
                           F.when(F.col("d") == 1, F.col("bit"))).alias("marked")))
    united = cut_lineage(groups.select("g", F.explode("hubs").alias("hub")).join(maps, "hub").groupBy("g", "bucket")
                         .agg(F.bitmap_or_agg("bits").alias("bits"), F.bitmap_or_agg("marked").alias("marked")))
    whole = united.groupBy("g").agg(F.sum(F.bitmap_count("bits")).alias("n"), F.sum(F.bitmap_count("marked")).alias("d"))
    base = member.join(whole, "g").select("c", "n", "d")
    # (customer, x) to take out (self and neighbours: -1) or to add (ends of ordinary wedges: +1)
    plain = rows.join(hub, F.col("dst") == F.col("hub"), "left_anti")
    ends = _wedges(plain, rows.join(hub, F.col("src") == F.col("hub"), "left_anti"),
                   deg.join(hub, F.col("mid") == F.col("hub"), "left_anti"), hub_min_degree)
    own = (und.select(F.col("src").alias("c"), F.col("dst").alias("x"))
           .unionByName(member.select("c", F.col("c").alias("x"))).distinct())
    added = ends.join(own, ["c", "x"], "left_anti").withColumn("sign", F.lit(1))
    taken = own.join(member.select("c"), "c", "left_semi").withColumn("sign", F.lit(-1))
    look = (added.unionByName(taken).join(member, "c", "left").join(at, "x")
            .join(united.select("g", "bucket", "bits"), ["g", "bucket"], "left"))
    # the bit of x: byte bit / 8, place bit % 8
    held = F.expr("bits is not null and (cast(conv(hex(substring(bits, int(bit div 8) + 1, 1)), 16, 10) as int) "
                  "& shiftleft(1, int(bit % 8))) <> 0")
    change = look.select("c", "d", F.when((F.col("sign") == 1) & ~held, 1).when((F.col("sign") == -1) & held, -1)
                         .otherwise(0).alias("s"))
    moved = change.select("c", F.col("s").alias("n"), (F.col("s") * F.col("d")).alias("d"))
    return base.unionByName(moved).groupBy("c").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
