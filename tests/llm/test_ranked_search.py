"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import pytest

from tallyloom.llm import ranked_search

from . import cases

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, items, k=50) -> set[tuple]:
    docs = [(r[0], Counter(TERMS.findall((r[1] or "").translate(ASCII)))) for r in rows]
    docs = [(i, tf) for i, tf in docs if tf]
    all_docs, all_terms = len(docs), sum(sum(tf.values()) for _, tf in docs)
    df = Counter(t for _, tf in docs for t in tf)
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERMS.findall((text or "").translate(ASCII)))
    out = set()
    for item, terms in wanted.items():
        scores = []
        for doc_id, tf in docs:
            m = 50 + (50 * sum(tf.values()) * all_docs) // all_terms
            score = sum(math.floor(1000 * math.log((2 * all_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in terms if t in tf)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.add((item, rank, None if null else doc_id, -score))
    return out


def corpus() -> tuple[list, list]:
    rng = random.Random(4)
    rows = [(1000 + k, cases.words(k, rng.choice([5, 5, 5, 9, 40, 200]), 60), "en", "a", 0) for k in range(400)]
    rows += [(2000 + k, "W1 w2, w3 the same", "en", "a", 0) for k in range(150)]  # more copies than places in the result
    items = [(k, cases.words(90 + k, 12, 60)) for k in range(15)]
    items += [(3, "w1 w2"), (3, "w1 w2"), (20, "W1 W2 w3"), (21, None), (22, " .,; "), (23, "no such term 日本語 ünïcode Ü"), (None, "w5 w6")]
    return cases.documents() + rows, items


@pytest.mark.parametrize(("block", "stretch"), [(ranked_search.BLOCK_TERMS, ranked_search.STRETCH), (20, 500)])
def test_ranks_are_those_of_the_plain_version(spark, monkeypatch, block, stretch):
    monkeypatch.setattr(ranked_search, "STRETCH", stretch)
    rows, items = corpus()
    index = ranked_search.build_index(cases.clashing(cases.frame(spark, rows)))
    got = ranked_search.search(index, cases.clashing(spark.createDataFrame(items, "item_id bigint, text string")), block_terms=block)
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, items)


def test_one_length_is_cut_into_pieces(spark):
    rows = [(k, f"a b c d{k % 7}", "en", "a", 0) for k in range(3000)]
    index, n = ranked_search.build_index(cases.frame(spark, rows))
    found = index.collect()
    assert n == 3000 and {r.m for r in found} == {100} and len(found) > 4 and sum(len(r.ids) for r in found) == 3000


def test_nothing_to_search(spark):
    items = spark.createDataFrame([("x", "a b")], "item_id string, text string")
    assert ranked_search.search(ranked_search.build_index(cases.frame(spark, [])), items).collect() == []
    assert ranked_search.search(ranked_search.build_index(cases.frame(spark)), items.limit(0)).collect() == []
    assert ranked_search.search(ranked_search.build_index(cases.frame(spark, [(1, None, "", "", 0)])), items).collect() == []
