"""Rings against a plain search, and how many rounds long chains take."""

import random

import pytest

from tallyloom.operators import graph as G


def plain_rings(edges: list[tuple]) -> set[tuple]:
    """The shortest ring through every edge to a smaller node, breadth first; once for the same nodes."""
    ahead: dict = {}
    for a, b in sorted(set(edges)):
        ahead.setdefault(a, []).append(b)
    found: dict[frozenset, tuple] = {}
    for a, b in set(edges):
        if a == b:
            found.setdefault(frozenset([a]), (a, a))
        if b >= a:
            continue
        level, seen, ring = [(b,)], {b}, None
        while level and ring is None:
            new = {}
            for path in sorted(level):
                for c in ahead.get(path[-1], []):
                    if c == a and ring is None:
                        ring = (*path, a)
                    if c not in seen and (c not in new or (*path, c) < new[c]):
                        new[c] = (*path, c)
            seen |= new.keys()
            level = list(new.values())
        if ring:
            k = ring.index(min(ring))
            turned = (*ring[k:], *ring[:k], ring[k])
            old = found.get(frozenset(ring))
            found[frozenset(ring)] = min(old, turned) if old else turned
    return set(found.values())


def strong(edges: list[tuple]) -> dict:
    """The members of the cyclic component of every node on a ring."""
    nodes = {x for e in edges for x in e}
    reach = {x: {b for a, b in edges if a == x} for x in nodes}
    changed = True
    while changed:
        changed = False
        for x in nodes:
            more = set().union(*(reach[y] for y in reach[x])) if reach[x] else set()
            if not more <= reach[x]:
                reach[x] |= more
                changed = True
    return {x: frozenset(y for y in reach[x] if x in reach[y]) for x in nodes if x in reach[x]}


@pytest.mark.parametrize("seed", range(1))
def test_rings_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = []
    for block in range(6):  # separate graphs of several densities, with chains and rings inside
        n, m = rng.choice([(5, 6), (8, 11), (12, 14), (12, 20)])
        edges += [(100 * block + rng.randrange(n), 100 * block + rng.randrange(n)) for _ in range(m)]
        at = 100 * block + rng.randrange(n)
        for k in range(rng.randrange(12)):
            edges.append((at, 100 * block + 50 + (k * 7) % 40))
            at = 100 * block + 50 + (k * 7) % 40
        edges.append((at, 100 * block + rng.randrange(n)))
    # A ring with a way in and a way out that leads nowhere: contracted, it is one node that points at itself.
    edges += [(2001, 2002), (2002, 2003), (2003, 2004), (2004, 2001), (2004, 2005), (2005, 2006), (2000, 2001)]
    got = G.find_rings(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert len(got) == len({tuple(r.ring) for r in got})
    assert {tuple(r.ring) for r in got} == plain_rings(edges)
    members = strong(edges)
    for r in got:
        if len(r.ring) > 2:
            assert (r.component, r.members) == (min(members[r.ring[0]]), len(members[r.ring[0]]))
    core = {(r.src, r.dst) for r in G.trim(G.clean_edges(spark.createDataFrame(edges, "src long, dst long")).where("src <> dst")).collect()}
    want = {e for e in edges if e[0] != e[1]}
    while True:
        kept = {e for e in want if e[0] in {b for _, b in want} and e[1] in {a for a, _ in want}}
        if kept == want:
            break
        want = kept
    assert core == want


def test_rings_that_share_nodes(spark):
    edges = [("m", "n"), ("n", "m"), ("m", "o"), ("o", "p"), ("p", "m"), ("p", "n"), ("q", "m"), ("p", "r"), ("s", "s"), (None, "m"), ("m", "unknown")]
    got = {tuple(r.ring): (r.component, r.members) for r in G.find_rings(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == {("m", "n", "m"): ("m", 4), ("m", "o", "p", "m"): ("m", 4), ("m", "o", "p", "n", "m"): ("m", 4), ("s", "s"): ("s", 1)}
    assert G.find_rings(spark.createDataFrame([], "src string, dst string")).collect() == []


def test_long_chains_take_few_rounds(spark, monkeypatch):
    n, rounds = 100_000, []
    ranked = G._ranked
    real = G._kept

    def counted(steps):
        seen = []
        monkeypatch.setattr(G, "_kept", lambda df: (seen.append(1), real(df))[1])
        out = ranked(steps)
        monkeypatch.setattr(G, "_kept", real)
        rounds.append(len(seen))
        return out

    monkeypatch.setattr(G, "_ranked", counted)
    chain = spark.range(n).selectExpr("id AS src", "id + 1 AS dst")
    assert G.find_rings(chain).count() == 0
    assert sum(rounds) <= 20
    rounds.clear()
    (ring,) = G.find_rings(chain.unionByName(spark.sql(f"SELECT {n}L AS src, 0L AS dst"))).collect()
    assert ring.members == n + 1 and ring.ring == [*range(n + 1), 0] and max(rounds) <= 20


def test_rounds_do_not_grow_with_the_number_of_short_rings(spark, monkeypatch):
    """Rings are spanned when their least node meets itself, not when a pointer could span all nodes there are."""
    rounds, real, ranked = [], G._kept, G._ranked

    def counted(steps):
        seen = []
        monkeypatch.setattr(G, "_kept", lambda df: (seen.append(1), real(df))[1])
        out = ranked(steps)
        monkeypatch.setattr(G, "_kept", real)
        rounds.append(len(seen))
        return out

    monkeypatch.setattr(G, "_ranked", counted)
    rings = spark.range(20_000).selectExpr("id AS src", "id - id % 4 + (id + 1) % 4 AS dst")
    got = G.find_rings(rings).collect()
    assert {tuple(r.ring) for r in got} == {(k, k + 1, k + 2, k + 3, k) for k in range(0, 20_000, 4)}
    assert {r.members for r in got} == {4} and sum(rounds) <= 4


def test_rings_through_hubs(spark, monkeypatch):
    monkeypatch.setattr(G, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(G, "HOT_KEYS", 8)
    rng = random.Random(5)
    edges = [(0, k) for k in range(1, 30)] + [(k, 0) for k in range(5, 25)] + [(rng.randrange(1, 60), rng.randrange(1, 60)) for _ in range(40)]
    got = G.find_rings(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {tuple(r.ring) for r in got} == plain_rings(edges) and len(got) == len(plain_rings(edges))
    members = strong(edges)
    assert all((r.component, r.members) == (min(members[r.ring[0]]), len(members[r.ring[0]])) for r in got if len(r.ring) > 2)


@pytest.mark.parametrize("seed", range(2))
def test_chains_of_several_levels(spark, seed):
    """Dead ends that hang on rings and on each other: nodes become links only after others have gone."""
    rng = random.Random(seed)
    edges = [(k, k + 1) for k in range(40)] + [(40, 0), (17, 3), (30, 22)]
    for at in range(100, 160):
        edges.append((at, rng.choice([*range(41), *range(100, at)])) if rng.random() < 0.5 else (rng.choice([*range(41), *range(100, at)]), at))
    edges += [(200 + k, 200 + (k + 1) % 9) for k in range(9)] + [(203, 100), (300, 204), (301, 300)]
    turn = {n: i for i, n in enumerate(rng.sample(range(1000), 400))}
    names = sorted({n for e in edges for n in e})
    edges = [(list(turn)[names.index(a)], list(turn)[names.index(b)]) for a, b in edges]
    got = G.find_rings(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {tuple(r.ring) for r in got} == plain_rings(edges)
    members = strong(edges)
    assert all((r.component, r.members) == (min(members[r.ring[0]]), len(members[r.ring[0]])) for r in got)
