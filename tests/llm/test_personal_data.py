"""Base spans against the plain patterns, the field against brute force and on passages held out."""

import itertools
import random
import re

import numpy as np
import pytest

from tallyloom.llm import personal_data as pii

from . import cases

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text: str) -> list[tuple]:
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            doubled = [int(d) * 2 - 9 if int(d) > 4 else int(d) * 2 for d in digits[-2::-2]]
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0
                    or kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    bits = ["@", ".", "-", " ", "a", "Z9", "+", "(", ")", "255", "256", "007", "4994226020900891", "1", "x@y.z", "é", "_", "%", "\n", "1.2.3.4", "+1 (743) 555-3824"]
    for _ in range(30_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
    for text in ("9" * 400_000 + ".1", "a" * 400_000 + "@", "a@" * 50_000 + "b.c", "+1" + " " * 400_000, "1." * 100_000):
        pii.base_spans(text)  # in linear time


def passage(rng: random.Random, kind: str) -> tuple[str, list]:
    """A base span of a kind in some words, with the spans of the whole."""
    if kind == "email":
        said = f"{cases.words(rng.randrange(10**6), 1)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"
    elif kind == "ip":
        said = ".".join(str(rng.randrange(1, 256)) for _ in range(4))
    elif kind == "card":
        digits = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
        said = next(digits + d for d in "0123456789" if pii.luhn(digits + d))
    else:
        said = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(10_000):04}"
    letters = lambda n: " ".join("".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    lead = letters(rng.randrange(2, 9)) + rng.choice([" ", ": ", " (", "\n"])
    text = lead + said + rng.choice([" ", ". ", ", ", ") ", "%%% "]) + letters(8)
    return text, [(kind, len(lead), len(lead) + len(said))]


def examples(seed: int, each: int) -> list[tuple[str, list]]:
    rng, out = random.Random(seed), []
    for kind in pii.KINDS:
        for _ in range(each):
            text, spans = passage(rng, kind)
            out.append((text, spans))
            for _ in range(3):
                (k, s, e), = spans
                new, good = pii.rewritten(k, text[s:e], rng.randrange(10**6))
                out.append((text[:s] + new + text[e:], [(k, s, s + len(new))] if good else []))
    return out


@pytest.fixture(scope="module")
def field():
    rows = []
    for text, spans in examples(1, 150):
        tokens = pii.Tokens(text, 0, len(text))
        rows.append((tokens.features(), pii.tags_of(tokens, spans)))
    return pii.fit_field(rows)


def test_spans_of_passages_held_out(field):
    held = examples(2, 60)
    found = pii.decoded(field, [t for t, _ in held])
    want = {(k, *s) for k, (_, spans) in enumerate(held) for s in spans}
    got = {(k, *s) for k, spans in enumerate(found) for s in spans}
    assert len(want & got) / len(want) > 0.95 and len(want & got) / max(1, len(got)) > 0.95
    assert pii.decoded(field, ["in 1999 there were 12,000 of [3] (see 4.5.6), 2024-01-02 10:20:30", "no digits at all", ""]) == [[], [], []]


def test_viterbi_is_the_best_of_all_taggings(field):
    rng = np.random.default_rng(0)
    small = pii.Field({"f": 0}, rng.normal(size=(2, pii.N)), field.moves + rng.normal(size=field.moves.shape), field.begins)
    sequences = [np.array([[k % 2, 1 - k % 2]] * n, np.int32) for k, n in enumerate([1, 2, 3, 4, 4])]
    for ids, tags in zip(sequences, small.decode(sequences), strict=True):
        def score(t, ids=ids):
            return (small.begins[t[0]] + small.weights[ids].sum(axis=1)[range(len(t)), list(t)].sum()
                    + sum(small.moves[a, b] for a, b in zip(t, t[1:], strict=False)))
        assert np.isclose(score(tuple(tags)), max(map(score, itertools.product(range(pii.N), repeat=len(ids)))))


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    moves, begins = pii._allowed()
    field = pii.Field({"a": 0, "b": 1}, rng.normal(size=(3, pii.N)), moves, begins)
    field.weights[-1] = 0
    rows = [(np.array([[0, 1], [1, 2], [0, 0]]), np.array([0, 1, 2])), (np.array([[1, 0]]), np.array([3]))]

    def loss() -> float:
        total = 0.0
        for ids, tags in rows:
            u = field.weights[ids].sum(axis=1)
            every = [field.begins[t[0]] + sum(u[k, x] for k, x in enumerate(t)) + sum(field.moves[a, b] for a, b in zip(t, t[1:], strict=False))
                     for t in [tuple(tags), *itertools.product(range(pii.N), repeat=len(tags))]]
            total += np.logaddexp.reduce(every[1:]) - every[0]
        return total / len(rows)

    weights, pairs, first = pii._gradient(field, rows)
    for table, grad, spot in ((field.weights, weights, (0, 1)), (field.weights, weights, (1, 0)), (field.moves, pairs, (0, 1)),
                              (field.moves, pairs, (1, 2)), (field.begins, first, (0,)), (field.begins, first, (3,))):
        table[spot] += 1e-5
        up = loss()
        table[spot] -= 2e-5
        down = loss()
        table[spot] += 1e-5
        assert abs((up - down) / 2e-5 - grad[spot]) < 1e-4


def test_long_texts_are_decoded_in_stretches(field, monkeypatch):
    parts = [passage(random.Random(k), "phone")[0].replace("+1 ", "") for k in range(60)]
    whole = " ".join(parts)
    want = pii.decoded(field, [whole])
    assert len(want[0]) > 50
    monkeypatch.setattr(pii, "LONG", 200)
    monkeypatch.setattr(pii, "OVERLAP", 60)
    assert pii.decoded(field, [whole]) == want


def test_find_keeps_base_spans_and_adds(spark, field):
    rows = cases.documents()
    rows += [(100, "write to ann.5@mail3.example.com or (743) 555-3824 soon, not +1 (743) 555-3824", "", "", 0),
             (101, "bob 12 (at) mail.example.com and 1.2.3.999, 8.8.8.8.", "", "", 0)] * 2
    got = pii.find(cases.clashing(cases.frame(spark, rows)), field).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        base, spans = pii.parsed(r.base), pii.parsed(r.spans)
        assert base == plain_spans(texts[r.doc_id]) and set(base) <= set(spans)
        assert r.spans == pii.written(spans)
    added = {texts[r.doc_id][s:e] for r in got for _, s, e in set(pii.parsed(r.spans)) - set(pii.parsed(r.base))}
    assert "(743) 555-3824" in added


def test_labelled_table_and_training(spark, field):
    rng = random.Random(9)
    rows = [(k, passage(rng, pii.KINDS[k % 4])[0], "", "", 0) for k in range(400)] + cases.documents()
    table = pii.labelled_from(cases.frame(spark, rows), sample=300, limit=700)
    assert 500 < table.count() <= 700
    trained = pii.train(table)
    again = pii.train(table)
    assert trained.to_bytes() == again.to_bytes()
    held = examples(3, 20)
    found = pii.decoded(trained, [t for t, _ in held])
    want = {(k, *s) for k, (_, spans) in enumerate(held) for s in spans}
    got = {(k, *s) for k, spans in enumerate(found) for s in spans}
    assert len(want & got) / len(want) > 0.8 and len(want & got) / max(1, len(got)) > 0.8
    empty = cases.frame(spark, [])
    assert pii.train(pii.labelled_from(empty)) is None and pii.find(empty, None).collect() == []
    assert [r.spans for r in pii.find(cases.frame(spark, [(1, None, "", "", 0)]), None).collect()] == [""]
