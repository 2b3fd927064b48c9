"""Cycles in a directed graph of (src, dst) edges.

Long chains are contracted first: a node with one edge in and one edge out is
passed by, and pointer doubling finds for all nodes of a chain at once where it
begins and how far they are from there, so a chain of n nodes takes log2 n rounds.
The same pass drops what nothing enters or nothing leaves. That goes on, level by
level, until only branching nodes are left; an edge of a level stands for a chain
of the level below and carries what later steps ask of it, so that nothing is
unfolded but the result. Rings are searched for between the branching nodes, one
for every edge that closes one.

Every round is a join of the edges with one row per node, written to the
shared folder so that a lost executor costs a round, not the run. Hubs are found
once, as contraction gives no node more edges; their rows stay in place and meet a
broadcast. The search for a ring keeps one shortest path per
closing edge and branching node; it goes no further than the ring found so far.
Its work grows with closing edges times the nodes as near as that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.known import is_known
from ..session import written
from .keyed import HOT_KEYS, MAX_BROADCAST_ROWS

# What a node is: nothing enters or nothing leaves it; one edge in and one out, to other nodes; the others.
DEAD, LINK, BRANCH = 0, 1, 2


def _kept(df: DataFrame) -> DataFrame:
    return written(df, "graph")


def clean_edges(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").where(is_known(F.col("src").cast("string"))
                                            & is_known(F.col("dst").cast("string"))).distinct()


def _hubs(degrees: DataFrame, edges: int) -> DataFrame | None:
    """Of ``node, degree`` the nodes with more than 1/HOT_KEYS of the edges; none of few edges."""
    if edges <= MAX_BROADCAST_ROWS:
        return None
    hubs = _kept(degrees.where(F.col("degree") * HOT_KEYS > edges).select("node").distinct())
    return hubs if hubs.limit(1).count() else None


def _at(rows: DataFrame, nodes: DataFrame, end: str, hubs: DataFrame | None) -> DataFrame:
    """``rows`` with the columns the node at one end has in ``nodes`` (one row per node). Rows at hubs stay in place."""
    nodes = nodes.withColumnRenamed("node", end)
    if hubs is None:
        return rows.join(nodes, end)
    hot = F.broadcast(hubs.withColumnRenamed("node", end))
    spread = rows.join(F.broadcast(nodes.join(hot, end)), end)
    return spread.unionByName(rows.join(hot, end, "left_anti").join(nodes.join(hot, end, "left_anti"), end))


def _plain(edges: DataFrame) -> DataFrame:
    """Edges as those of the lowest level: ``src, dst, via, hops, closes, least``. ``via`` is the first node after ``src``,
    so ``src, via`` tells edges apart; ``hops`` how many edges it stands for, ``closes`` if one of them leads to a smaller
    node, ``least`` the least node passed by."""
    return edges.select("src", "dst", F.col("dst").alias("via"), F.lit(1).cast("bigint").alias("hops"), (F.col("dst") < F.col("src")).alias("closes"),
                        F.lit(None).cast(edges.schema["src"].dataType).alias("least"))


def _nodes(edges: DataFrame) -> DataFrame:
    """``node, kind, n_in, n_out``; of links also the edge in (``before, via, hops, closes, least``) and out (``after, out_...``)."""
    marks = ["via", "hops", "closes", "least"]
    into = edges.select(F.col("dst").alias("node"), F.col("src").alias("before"), *marks)
    out = edges.select(F.col("src").alias("node"), F.col("dst").alias("after"), *(F.col(c).alias(f"out_{c}") for c in marks))
    columns = ["before", "after", *marks, *(f"out_{c}" for c in marks)]
    found = into.unionByName(out, allowMissingColumns=True).groupBy("node").agg(
        F.count("before").alias("n_in"), F.count("after").alias("n_out"), *(F.max(c).alias(c) for c in columns))
    kind = (F.when((F.col("n_in") == 0) | (F.col("n_out") == 0), DEAD)
            .when((F.col("n_in") == 1) & (F.col("n_out") == 1) & (F.col("before") != F.col("node")), LINK).otherwise(BRANCH))
    return found.withColumn("kind", kind)


def _ranked(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (``node, before, via, hops, closes, least, before_kind``) in their chains: ``node, src, via, hops, closes, least``, with the
    node and the edge that the chain begins with, and what lies between there and the node. Second, the nodes of rings
    without a beginning: ``node, low, hops``, the least of the ring and how far the node is behind it.

    Each round doubles the way that every pointer spans. A ring is spanned when its least node meets itself."""
    at = _kept(steps.select("node", F.col("before").alias("ptr"), F.col("before_kind").alias("kind"), "via", "hops", "closes", F.least("least", "node").alias("least"),
                            F.struct(F.col("before").alias("node"), "hops", F.lit(1).cast("bigint").alias("n")).alias("low")))
    going, span = F.col("kind") == LINK, 1
    while True:
        n = at.where(going).agg(F.count(F.lit(1)).alias("open"), F.sum(F.when(F.col("low.node") == F.col("node"), F.col("low.n"))).alias("spanned")).first()
        if n["open"] == (n["spanned"] or 0):
            break
        ahead = at.select(F.col("node").alias("ptr"), *(F.col(c).alias(f"_{c}") for c in ("ptr", "kind", "via", "hops", "closes", "least", "low")))
        further = F.struct(F.col("_low.node").alias("node"), (F.col("hops") + F.col("_low.hops")).alias("hops"), (F.col("_low.n") + F.lit(span)).alias("n"))
        moved = at.where(going).join(ahead, "ptr").select(
            "node", F.col("_ptr").alias("ptr"), F.col("_kind").alias("kind"), F.col("_via").alias("via"), (F.col("hops") + F.col("_hops")).alias("hops"),
            (F.col("closes") | F.col("_closes")).alias("closes"), F.least("least", "_least").alias("least"), F.least("low", further).alias("low"))
        at = _kept(at.where(~going).unionByName(moved))
        span *= 2
    chains = at.where(F.col("kind") == BRANCH).select("node", F.col("ptr").alias("src"), "via", "hops", "closes", "least")
    behind = F.when(F.col("low.node") == F.col("node"), 0).otherwise(F.col("low.hops"))
    return chains, at.where(going).select("node", F.col("low.node").alias("low"), behind.alias("hops"))


def _levels(edges: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]], DataFrame | None]:
    """``edges`` (as of ``_plain``) contracted, without what leads into no ring or out of none, until nothing changes. The
    edges left; for every level what was passed by (``src, via, node, pos, next``: ``pos`` hops behind ``src``, and ``next``
    the ``via`` of the edge out of it) and the nodes of rings that nothing enters or leaves (``low, pos, node, next``); hubs."""
    levels, hubs, first = [], None, True
    while True:
        nodes = _kept(_nodes(edges))
        n = nodes.agg(F.sum("n_in").alias("edges"), F.count_if(F.col("kind") == DEAD).alias("dead"), F.count_if(F.col("kind") == LINK).alias("links")).first()
        if first:
            hubs, first = _hubs(nodes.select("node", F.greatest("n_in", "n_out").alias("degree")), n["edges"] or 0), False
        if not n["dead"] and not n["links"]:
            return edges, levels, hubs
        branching = nodes.where(F.col("kind") == BRANCH).select("node")
        left = _at(_at(edges, branching, "src", hubs), branching, "dst", hubs).select(edges.columns)
        if n["links"]:
            kinds = nodes.select("node", "kind")
            links = _at(nodes.where(F.col("kind") == LINK).drop("kind", "n_in", "n_out"), kinds.withColumnRenamed("kind", "before_kind"), "before", hubs)
            links = _kept(_at(links, kinds.withColumnRenamed("kind", "after_kind"), "after", hubs))
            chains, rings = _ranked(links)
            ahead = links.select("node", "after", "after_kind", "out_via", "out_hops", "out_closes", "out_least")
            chains = _kept(chains.join(ahead, "node"))
            ends = chains.where(F.col("after_kind") == BRANCH).select(
                "src", F.col("after").alias("dst"), "via", (F.col("hops") + F.col("out_hops")).alias("hops"),
                (F.col("closes") | F.col("out_closes")).alias("closes"), F.least("least", "out_least").alias("least"))
            left = left.unionByName(ends)
            rings = rings.join(ahead, "node").select("low", F.col("hops").alias("pos"), "node", F.col("out_via").alias("next"))
            levels.append((chains.select("src", "via", "node", F.col("hops").alias("pos"), F.col("out_via").alias("next")), _kept(rings)))
        edges = _kept(left)


def _unfolded(parts: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Edges of the last level (``lead, first, pos, off, src, via``) as those of the lowest, ``off`` hops behind the place
    ``pos``; and the rings of all levels, of which ``lead`` is a node and ``first`` null."""
    none = F.lit(None).cast(parts.schema["first"].dataType)
    for passed, rings in reversed(levels):
        inside = parts.join(passed.withColumnRenamed("pos", "_pos"), ["src", "via"]).select(
            "lead", "first", "pos", (F.col("off") + F.col("_pos")).alias("off"), F.col("node").alias("src"), F.col("next").alias("via"))
        whole = rings.select(F.col("low").alias("lead"), none.alias("first"), F.lit(0).alias("pos"), F.col("pos").alias("off"),
                             F.col("node").alias("src"), F.col("next").alias("via"))
        parts = _kept(parts.unionByName(inside).unionByName(whole))
    return parts


def trim(edges: DataFrame) -> DataFrame:
    """Drop nodes that nothing enters or nothing leaves, until none is left.

    What remains is every ring and the paths between rings. Chains fall as a whole."""
    core, levels, _ = _levels(_kept(_plain(edges)))
    parts = core.select(F.col("src").alias("lead"), F.col("via").alias("first"), F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("off"), "src", "via")
    return _unfolded(parts, levels).select("src", F.col("via").alias("dst"))


def _spread_largest(edges: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """The largest node that reaches each node (node, color)."""
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    colors = _kept(nodes.select("node", F.col("node").alias("color")))
    while True:
        sent = _at(edges, colors, "src", hubs)
        best = sent.groupBy(F.col("dst").alias("node")).agg(F.max("color").alias("_c"))
        new = colors.join(best, "node", "left").select(
            "node", F.greatest("color", F.coalesce("_c", "color")).alias("color"),
            F.coalesce(F.col("_c") > F.col("color"), F.lit(False)).alias("_moved"))
        new = _kept(new)
        colors = new.select("node", "color")
        if new.where("_moved").limit(1).count() == 0:
            return colors


def components(edges: DataFrame, trimmed: bool = False) -> DataFrame:
    """Strongly connected components of at least two nodes (node, component).

    Forward: every node learns the largest node that reaches it. Backward from
    those largest nodes inside their colour: what reaches them is a component.
    Settled nodes leave and the rest goes round again.
    """
    rest = _kept(edges if trimmed else trim(edges))
    degrees = [rest.groupBy(F.col(end).alias("node")).agg(F.count(F.lit(1)).alias("degree")) for end in ("src", "dst")]
    hubs = _hubs(degrees[0].unionByName(degrees[1]), rest.count())
    found = None
    while rest.limit(1).count():
        colors = _spread_largest(rest, hubs)
        same = _at(rest, colors.withColumnRenamed("color", "_a"), "src", hubs)
        same = _at(same, colors.withColumnRenamed("color", "_b"), "dst", hubs)
        same = _kept(same.where(F.col("_a") == F.col("_b")).select("src", "dst"))
        reached = _kept(colors.where(F.col("node") == F.col("color")))
        fresh = reached
        while True:
            back = _at(same, fresh.select("node", "color"), "dst", hubs)
            fresh = _kept(back.select(F.col("src").alias("node"), "color").distinct()
                                .join(reached.select("node"), "node", "left_anti"))
            if fresh.limit(1).count() == 0:
                break
            reached = _kept(reached.unionByName(fresh))
        members = reached.groupBy("color").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("_n"))
        settled = reached.join(members.where(F.col("_n") > 1).drop("_n"), "color").select("node", "component")
        found = settled if found is None else found.unionByName(settled)
        open_ends = rest.join(reached.select(F.col("node").alias("src")), "src", "left_anti").join(
            reached.select(F.col("node").alias("dst")), "dst", "left_anti").select("src", "dst")
        rest = trim(_kept(open_ends))
    if found is None:
        return edges.select(F.col("src").alias("node"), F.col("src").alias("component")).limit(0)
    return _kept(found)


def _shortest(inner: DataFrame) -> DataFrame:
    """Per closing edge of ``inner`` (``src, dst, via, hops, closes``) the shortest ring through it, as the list of its
    edges (``path``: ``src, via``); of several the one whose nodes come first."""
    ring, step = ["_src", "_via"], F.struct("src", "via")
    front = _kept(inner.where("closes").select(
        F.col("src").alias("_src"), F.col("via").alias("_via"), F.col("dst").alias("node"), F.struct("hops", F.array(step).alias("path")).alias("way")))
    best = front
    while front.limit(1).count():
        home = best.where(F.col("node") == F.col("_src")).select(*ring, F.col("way.hops").alias("_found"))
        going = front.where(F.col("node") != F.col("_src")).join(home, ring, "left").where("_found IS NULL OR way.hops < _found")
        ahead = inner.join(going.select(*ring, F.col("node").alias("src"), F.col("way").alias("_way")), "src")
        new = ahead.groupBy(*ring, F.col("dst").alias("node")).agg(F.min(F.struct(
            (F.col("_way.hops") + F.col("hops")).alias("hops"), F.concat("_way.path", F.array(step)).alias("path"))).alias("way"))
        known = best.select(*ring, "node", F.col("way").alias("_known"))
        front = _kept(new.join(known, [*ring, "node"], "left").where("_known IS NULL OR way < _known").drop("_known"))
        best = _kept(best.join(front.select(*ring, "node"), [*ring, "node"], "left_anti").unionByName(front))
    return best.where(F.col("node") == F.col("_src")).select(*ring, F.col("way.path").alias("path"))


def _closed(nodes: Column) -> Column:
    """The ring that begins and ends at its least node."""
    at = F.array_position(nodes, F.array_min(nodes)).cast("int")
    turned = F.concat(F.slice(nodes, at, F.size(nodes)), F.slice(nodes, F.lit(1), at - 1))
    return F.concat(turned, F.slice(turned, 1, 1))


def find_rings(edges: DataFrame) -> DataFrame:
    """Every ring that an edge to a smaller node closes: the shortest one through that edge (of several the one whose
    nodes come first after it), once for the same nodes. ``component, members, ring``: the smallest node of the cyclic
    component and how many nodes that has; the ring begins and ends at its own smallest node. A node that points at
    itself is a ring of its own."""
    edges = clean_edges(edges)
    edges = _kept(_plain(edges))
    loops = edges.where(F.col("src") == F.col("dst")).select(
        F.col("src").alias("component"), F.lit(1).cast("bigint").alias("members"),
        F.array("src", "dst").alias("ring"))
    core, levels, hubs = _levels(edges.where(F.col("src") != F.col("dst")))

    members = components(core.where(F.col("src") != F.col("dst")).select("src", "dst").distinct(), trimmed=True)
    alone = core.where(F.col("src") == F.col("dst")).select(F.col("src").alias("node")).distinct().join(members, "node", "left_anti")
    members = _kept(members.unionByName(alone.select("node", F.col("node").alias("component"))))
    inner = _at(core, members.withColumnRenamed("component", "_a"), "src", hubs)
    inner = _at(inner, members, "dst", hubs)
    inner = _kept(inner.where(F.col("_a") == F.col("component")).drop("_a"))
    every = members.select("component", "node", F.lit(1).cast("bigint").alias("n")).unionByName(
        inner.select("component", F.col("least").alias("node"), (F.col("hops") - 1).alias("n")))
    sizes = every.groupBy("component").agg(F.min("node").alias("_least"), F.sum("n").alias("members"))

    found = _kept(_shortest(inner.select("src", "dst", "via", "hops", "closes")))
    ring = ["_src", "_via"]
    parts = found.select(F.col("_src").alias("lead"), F.col("_via").alias("first"), F.posexplode("path").alias("pos", "_e")).select(
        "lead", "first", "pos", F.lit(0).cast("bigint").alias("off"), "_e.src", "_e.via")
    listed = _kept(_unfolded(parts, levels).groupBy("lead", "first").agg(F.array_sort(F.collect_list(F.struct("pos", "off", "src"))).alias("l"))
                   .select(F.col("lead").alias("_src"), F.col("first").alias("_via"), _closed(F.transform("l", lambda x: x["src"])).alias("ring")))
    # Components that are one ring.
    plain = listed.where("_via IS NULL").select(F.col("ring")[0].alias("component"), (F.size("ring") - 1).cast("bigint").alias("members"), "ring")
    branched = listed.join(inner.select(F.col("src").alias("_src"), F.col("via").alias("_via"), "component"), ring)
    once = branched.groupBy("component", F.array_sort(F.array_distinct("ring")).alias("_set")).agg(F.min("ring").alias("ring"))
    branched = once.join(sizes, "component").select(F.col("_least").alias("component"), "members", "ring")
    return plain.unionByName(branched).unionByName(loops)


def find_cycles(edges: DataFrame) -> DataFrame:
    """Every cyclic component with its size and one ring, the shortest through its smallest node; a node that points
    at itself is a ring of its own (component, members, ring)."""
    through = find_rings(edges).where(F.col("ring")[0] == F.col("component")).withColumn("_loop", F.size("ring") == 2)
    return (through.groupBy("component", "members", "_loop").agg(F.min(F.struct(F.size("ring").alias("n"), "ring")).alias("_best"))
            .select("component", "members", F.col("_best.ring").alias("ring")))


def cycle_findings(edges: DataFrame, graph: str = "depends_on") -> DataFrame:
    """A ``ref.cycle`` finding for every ring (edges: src, dst as text)."""
    text = F.array_join(F.transform("ring", lambda n: n.cast("string")), " -> ")
    return find_rings(edges).select(
        F.lit("error").alias("level"), F.lit("ref.cycle").alias("code"),
        F.col("ring")[0].cast("string").alias("file"), F.lit("").alias("path"),
        F.concat(F.lit("dependency cycle: "), text).alias("message"),
        F.lit(f"{graph} must be acyclic").alias("fix"))
