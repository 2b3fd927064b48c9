"""The closest words against all pairs."""

import random

from tallyloom.operators.nearest import nearest_words


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _brute(values, words, cutoff=0.6):
    out = {}
    for v in values:
        scored = [(_edits(v, w) / max(len(v), len(w)), w) for w in words if v and w]
        best = min((s for s in scored if 1 - s[0] >= cutoff), default=None)
        if best:
            out[v] = best[1]
    return out


def _run(spark, values, words):
    rows = nearest_words(spark.createDataFrame([(v,) for v in values], "v string"), spark.createDataFrame([(w,) for w in words], "w string")).collect()
    assert len(rows) == len({r["value"] for r in rows})
    return {r["value"]: r["near"] for r in rows}


def test_same_as_all_pairs(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abc-1", k=rnd.randint(1, 14)))
    words, values = sorted({word() for _ in range(150)}), sorted({word() for _ in range(100)})
    for w in words[:40]:
        letters = list(w * 3)
        for _ in range(rnd.randint(1, len(letters) // 3 + 1)):
            letters[rnd.randrange(len(letters))] = rnd.choice(["", "x", "ab"])
        values.append("".join(letters))
        words.append(w * 3)
    assert _run(spark, values, words) == _brute(values, words)


def test_two_edits_ties_and_order(spark):
    words = ["payment-core", "payments", "billing-b", "billing-a", "a", "longish-name-of-a-service"]
    got = _run(spark, ["paymnt-cor", "billing-x", "zzzzzzzz", "b", "longish-nme-f-a-srvic"], words)
    assert got == {"paymnt-cor": "payment-core", "billing-x": "billing-a", "longish-nme-f-a-srvic": "longish-name-of-a-service"}


def test_null_empty_and_repeated(spark):
    assert _run(spark, [None, "", "abcd", "abcd"], ["abce", "abce", None, ""]) == {"abcd": "abce"}
    assert _run(spark, ["abc"], []) == {}
    assert _run(spark, [], ["abc"]) == {}
