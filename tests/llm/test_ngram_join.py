import random
from collections import defaultdict

import pytest

from tallyloom.llm import ngram_join

from . import cases


def brute_force(rows):
    low = lambda t: t.encode().lower().decode()
    sets = []
    for i, t, *_ in rows:
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", low(t or "")) if x]
        sets.append((i, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, (i, s) in enumerate(sets):
        find(i)
        for j, t in sets[:a]:
            if s and t and i is not None and j is not None and 100 * len(s & t) >= 80 * len(s | t):
                up[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i, _ in sets:
        groups[find(i)].append(i)
    return sorted(((i, len(s), find(i)) for i, s in sets), key=str)


def got(spark, rows):
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, cases.DOCS)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_edge_cases(spark):
    rows = cases.documents()
    assert got(spark, rows) == brute_force(rows)
    assert got(spark, []) == []


@pytest.mark.parametrize("block", [256, 8])
def test_families_chains_and_passages(spark, monkeypatch, block):
    """Copies with different numbers of edits, some of which link only through others, and a passage in half of all rows."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(4)
    rows, passage = [], cases.words(77, 50)
    for family in range(6):
        base = cases.words(100 + family, 160 + 40 * family)
        rows += [(len(rows) + 1, edited(rng, base, rng.randrange(0, 8)), "en", "a", 0) for _ in range(40)]
    rows += [(1000 + i, cases.words(500 + i, 60) + " " + passage + " " + cases.words(900 + i, 60), "en", "a", 0) for i in range(150)]
    rng.shuffle(rows)
    assert got(spark, rows) == brute_force(rows)


def test_repeated_ids_join_their_texts(spark):
    rows = [(1, cases.words(1, 50), "", "", 0), (2, cases.words(1, 50), "", "", 0), (2, cases.words(2, 50), "", "", 0),
            (3, cases.words(2, 50), "", "", 0)]
    assert {r[2] for r in got(spark, rows)} == {1}


def test_one_document_of_each_group_stays(spark):
    df = cases.clashing(cases.frame(spark))
    kept = ngram_join.one_of_each(df)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert kept.columns == df.columns
    assert 1 in ids and not {2, 3, 8} & set(ids) and {4, 5, 6, 9, 10, None} <= set(ids)
    assert ids.count(7) == 1
