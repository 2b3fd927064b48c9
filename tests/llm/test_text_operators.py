import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, fingerprints, language_id, quotes, substring_dedup, toxicity
from tallyloom.llm.common import Words, buffers, shingles

from . import cases


# --- hashed words ------------------------------------------------------------------------------------------------

def test_words_follow_their_definition_whatever_the_pieces(monkeypatch):
    kind = Words([*range(97, 123), *range(65, 91), *range(128, 256)])
    texts = ["Abc abc,ABC", None, "", "x" * 5000 + " y", "é é", "z", "abc"]
    data, bounds = buffers(pa.array(texts))
    whole, firsts = kind.hashes(data, bounds)
    assert np.diff(firsts).tolist() == [3, 0, 0, 2, 2, 1, 1]
    assert whole[0] == whole[1] == whole[2] == whole[-1] and whole[5] == whole[6] and len(set(whole.tolist())) == 5
    monkeypatch.setattr("tallyloom.llm.common.PIECE", 7)
    assert (kind.hashes(data, bounds)[0] == whole).all()


def test_shingles_of_short_texts_are_their_whole_sequence():
    kind = Words(range(33, 127))
    data, bounds = buffers(pa.array(["a b", "", "a b c d e f", "a b", "a"]))
    grams, firsts = shingles(*kind.hashes(data, bounds), 5)
    assert np.diff(firsts).tolist() == [1, 0, 2, 1, 1] and grams[0] == grams[3] and len(set(grams.tolist())) == 4


# --- decontamination ---------------------------------------------------------------------------------------------

BENCH = "item_id bigint, text string"


def test_contamination_against_brute_force(spark):
    rows = cases.documents()
    bench = [(1, "junk " + cases.words(2, 60)), (2, "two words"), (3, None), (4, ""), (None, cases.words(3, 80)), (2, cases.words(8, 12)),
             (5, cases.words(7, 20_000, 100_000)[:400]), (6, "a a a"), (7, "... !")]
    term = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower().decode())
    want = []
    for i, t, *_ in rows:
        w, hit, items = term(t), set(), set()
        for item, text in bench:
            b = term(text)
            n = min(10, len(b))
            windows = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if b else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    items.add("null" if item is None else str(item))
        want.append((i, len(w), len(hit), ",".join(sorted(items))))
    index = decontaminate.build_index(cases.clashing(cases.frame(spark)))
    for block in (1 << 22, 500):
        found = decontaminate.search(index, spark.createDataFrame(bench, BENCH), block_bytes=block)
        got = decontaminate.contamination(index, found).select("doc_id", "n_words", "n_hit", F.array_join("items", ",")).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_proximity_allows_words_in_between_and_keeps_their_order(spark):
    bench = spark.createDataFrame([(1, "one two three four")], BENCH)
    texts = ["one two x three four", "one x two y three z four", "four three two one", "one two three four", "one two three", "one one two x three four"]
    index = decontaminate.build_index(spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], cases.DOCS))
    near = {(r.doc_id, r.start, r.end) for r in decontaminate.search(index, bench, slop=1).collect()}
    assert near == {(0, 0, 5), (3, 0, 4), (5, 1, 6)}
    assert {r.doc_id for r in decontaminate.search(index, bench, slop=3).collect()} == {0, 1, 3, 5}
    assert {r.doc_id for r in decontaminate.search(index, bench).collect()} == {3}


def test_empty_tables(spark):
    docs, bench = cases.frame(spark, []), spark.createDataFrame([], BENCH)
    index = decontaminate.build_index(docs)
    assert decontaminate.contamination(index, decontaminate.search(index, bench)).count() == 0
    full = cases.frame(spark)
    assert decontaminate.clean(full, bench).count() == full.count()
    assert decontaminate.clean(full, spark.createDataFrame([(1, "two words")], BENCH)).count() == full.count() - 3


# --- fingerprints ------------------------------------------------------------------------------------------------

def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_next_rows_and_edits_across_ranges(spark):
    rows = [(i * 3, cases.words(i, 3 + i % 7), "", "", 0) for i in range(60)]
    got = fingerprints.with_next(spark.createDataFrame(rows, cases.DOCS).repartition(5), carry=("text",), rows_per_range=7).toPandas()
    texts = [t for _, t, *_ in sorted(rows, reverse=True)]
    assert got.sort_values("doc_id", ascending=False).next_text.tolist() == texts[1:] + texts[:1]
    one = fingerprints.with_next(spark.createDataFrame([(5, "only", "", "", 0)], cases.DOCS)).first()
    assert one.next_text == "only"
    assert fingerprints.with_next(cases.frame(spark, [])).count() == 0
    assert fingerprints.with_next(cases.frame(spark)).count() == len(cases.documents())


def test_likeness_estimates_jaccard(spark):
    base = cases.words(1, 400).split(" ")
    rows = []
    for k in range(80):
        other = base[:5 * k] + cases.words(50 + k, 400).split(" ")[5 * k:]
        rows.append((" ".join(base), " ".join(other)))
    rows += [("", ""), ("x", ""), ("one two", "one two"), ("one two", "one three"), (None, " ")]
    df = spark.createDataFrame(rows, "a string, b string")
    prints = df.select("a", "b", *[fingerprints.fingerprint(F.col(c)).alias(f"p{c}") for c in "ab"])
    got = prints.select(fingerprints.likeness(F.col("pa"), F.col("pb")).alias("x")).toPandas().x.tolist()
    want = [len(x & y) / len(x | y) if x | y else 1.0 for x, y in ((shingle_set(a), shingle_set(b)) for a, b in rows)]
    errors = np.array(got[:80]) - np.array(want[:80])
    assert abs(errors.mean()) < 0.02 and errors.std() < 0.06
    assert got[80:83] == [1.0, 0.0, 1.0] and got[83] < 0.3 and got[84] == 1.0


def test_edited_text(spark):
    df = spark.createDataFrame([("abcde", "xyz"), ("ab", ""), ("", "q"), ("😀é", "日本")], "t string, d string")
    got = [r[0] for r in df.select(fingerprints.edited(F.col("t"), F.col("d"))).collect()]
    assert got == ["abcxy", "a", "", "😀日"]
    assert hashlib.sha256(got[3].encode()).hexdigest() == df.select(F.sha2(fingerprints.edited(F.col("t"), F.col("d")).cast("binary"), 256)).collect()[3][0]


# --- substring dedup ---------------------------------------------------------------------------------------------

def test_exact_repeats_are_covered_and_nothing_else_is(spark):
    rows = cases.documents()
    hot = cases.words(300, 55)
    rows += [(100 + i, f"{cases.words(400 + i, 30)} {hot} {cases.words(600 + i, 30)}", "", "", 0) for i in range(80)]
    short = cases.words(301, 40)  # too short to count, in many documents
    rows += [(300 + i, f"{cases.words(800 + i, 30)} {short} {cases.words(1200 + i, 30)}", "", "", 0) for i in range(60)]
    near = cases.words(302, 120).split(" ")
    for k in range(3):
        rows.append((500 + k, " ".join(w if j not in (40 + 9 * k,) else "edit" for j, w in enumerate(near)), "", "", 0))
    got = substring_dedup.repeated_passages(cases.clashing(cases.frame(spark, rows))).toPandas()
    assert set(got.doc_id) == {1, 2, 3, 9, 10, *range(100, 180), 500, 501, 502}
    assert (got.end_word - got.start_word >= 50).all() and (got.similarity >= 0.8).all()
    for i in range(100, 180):
        spans = got[got.doc_id == i]
        assert any(a <= 30 and b >= 85 for a, b in zip(spans.start_word, spans.end_word, strict=True))
    assert substring_dedup.repeated_passages(cases.frame(spark, [])).count() == 0


def test_minima_are_the_wide_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(3)
    firsts = np.array([0, 60, 60, 61, 200, 400])
    values = rng.integers(0, 2**63, 400).astype(np.uint64)
    values[300:400] = np.tile(values[300:304], 25)  # ties
    got = {tuple(map(int, x)) for x in zip(*substring_dedup.minima(values, firsts), strict=True)}
    order = (values >> np.uint64(24)).astype(np.int64)
    want = set()
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        for c in range(a, b):
            lo = hi = c
            while lo > a and order[lo - 1] > order[c]:
                lo -= 1
            while hi + 1 < b and order[hi + 1] >= order[c]:
                hi += 1
            if hi - lo + 1 >= substring_dedup.LENGTH:
                reach = substring_dedup.LENGTH - 1
                want.add((c, max(lo, c - reach), min(hi, c + reach)))
    assert got == want


# --- toxicity ----------------------------------------------------------------------------------------------------

def toxic_corpus(n=600):
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = cases.words(i, 80, 300)
        if toxic:
            text += f" you horrib{'le' if i % 8 else 'ly'} muslim"
        elif i % 50 == 1:
            text += " muslim"
        docs.append((i, text, "", "", 0))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_learns_insults_and_not_the_group(spark):
    docs, labels = toxic_corpus()
    df, lf = spark.createDataFrame(docs, cases.DOCS), spark.createDataFrame([*labels, (5, 1, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(df, toxicity.teachable(lf))
    got = toxicity.with_scores(df, model).withColumn("held", toxicity.held_out()).toPandas()
    held = got[got.held]
    assert ((held.score >= 0.5) == (held.doc_id % 4 == 0)).mean() > 0.97
    plain = toxicity.fit(df, toxicity.teachable(lf), penalty=0.0)
    neutral = cases.words(9999, 80, 300)
    shift = lambda m: abs(m.logit(set((neutral + " muslim").split())) - m.logit(set(neutral.split())))
    assert shift(model) < 0.5 * shift(plain) and model.score(neutral + " muslim") < 0.5


def test_counterfactuals_swap_every_term():
    assert toxicity.counterfactual({"gay", "x"}, "7").isdisjoint({"gay"}) and "x" in toxicity.counterfactual({"gay", "x"}, "7")
    assert len(toxicity.counterfactual({"x"}, "7")) == 2


def test_toxicity_edge_cases(spark):
    df = cases.clashing(cases.frame(spark))
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = toxicity.with_scores(df, toxicity.fit(df, none)).toPandas()
    assert len(got) == len(cases.documents()) and set(got.score) == {0.5}
    one_class = toxicity.fit(df, spark.createDataFrame([(1, 0), (2, 0)], "doc_id bigint, toxic int"))
    assert toxicity.with_scores(df, one_class).where("score < 0.5").count() == df.count()
    assert toxicity.with_scores(df.limit(0), one_class).count() == 0


# --- language ----------------------------------------------------------------------------------------------------

def test_language_evidence(spark):
    en, de = "the water and the house with this thing that", "das wasser und der garten mit diesem ding nicht"
    texts = spark.createDataFrame([(en * 3, "en"), (de * 3, "de"), (None, "en"), ("x", None)], "text string, lang string")
    model = language_id.train(texts)
    assert model[0] == ["de", "en"]
    page = lambda lang, body: f"<html lang='{lang}'><script>the the</script><body>{body}</body></html>"
    pages = [(i, f"http://a{i % 3}.site.de/x", page("en", de)) for i in range(30)]
    pages += [(30 + i, f"http://b{i % 3}.site.org/x", page("en", en)) for i in range(30)]
    pages += [(60, "http://a1.site.de/y", page("en", "")), (61, "http://b1.site.org/y", ""), (62, None, None), (63, "nonsense", "<html lang=xx>")]
    rows = language_id.page_evidence(spark.createDataFrame(pages, "page_id bigint, url string, html string"), model[0])
    got = language_id.identify(rows, model, ["page_id"], declared="declared", suffix="suffix", host="host", domain="domain").toPandas().set_index("page_id").sort_index()
    assert set(got.lang.loc[:29]) == {"de"} and set(got.lang.loc[30:59]) == {"en"} and len(got) == 64
    assert got.lang[60] == "de" and got.lang[61] == "en" and got.text_lang.isna()[60]
    assert got.confidence.between(0.49, 1.0001).all()
    empty = language_id.identify(rows.limit(0), model, ["page_id"], declared="declared", host="host")
    assert empty.count() == 0
    untrained = language_id.train(texts.limit(0))
    assert language_id.identify(rows, untrained, ["page_id"]).where("lang is null").count() == 64


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.where("doc_id % 5 <> 0"))
    got = language_id.identify(docs.where("doc_id % 5 = 0").select("doc_id", "text", "source", "lang").withColumnRenamed("lang", "truth"),
                               model, ["doc_id", "truth"], host="source").toPandas()
    assert (got.lang == got.truth).mean() > 0.97


# --- quotes ------------------------------------------------------------------------------------------------------

MESSAGES = "conv_id bigint, turn bigint, role string, text string"


def test_nested_quotes_find_their_sources(spark):
    rows = [(1, 0, "u", "Hello there\nSecond line"), (1, 1, "a", "> hello   THERE\n\nAn answer"),
            (1, 2, "u", "> > Hello there\n>An answer\nMore\n"), (1, 3, "a", "> Second line\ntext"), (1, 4, "u", "> nobody said this\nbody"),
            (1, 5, "a", "no quote"), (2, 0, "u", "> Hello there\nother conversation"), (2, 7, "u", None), (2, 7, "a", ""),
            (None, 1, "u", "> x\ny"), (3, None, "u", "z")]
    got = {(r.conv_id, r.turn, r.role): r for r in quotes.link(cases.clashing(spark.createDataFrame(rows, MESSAGES))).collect()}
    assert len(got) == len(rows)
    replies = {k[1]: v.reply_to for k, v in got.items() if k[0] == 1}
    assert replies == {0: None, 1: 0, 2: 1, 3: 0, 4: 3, 5: 4}
    assert got[1, 2, "u"].text == "More" and got[1, 2, "u"].n_quoted == 2 and got[1, 2, "u"].n_linked == 2
    assert got[1, 4, "u"].n_linked == 0 and got[2, 0, "u"].reply_to is None
    assert [got[2, 7, r].position for r in "au"] == [1, 2] and got[2, 7, "u"].reply_to == 0
    assert got[None, 1, "u"].text == "y" and got[3, None, "u"].position is None
    assert all(v.reply_to is None or v.reply_to < k[1] for k, v in got.items())
    assert quotes.link(spark.createDataFrame([], MESSAGES)).count() == 0


def test_a_long_conversation_with_one_common_line(spark):
    """Ranges of turns are joined up: the latest earlier message is found across them."""
    rows = [(1, t, "u", "same line" if t % 700 == 0 else f"line {t}") for t in range(1500)] + [(1, 1600, "u", "> same line\n> line 3"), (1, 1700, "u", "> line 3")]
    got = {r.turn: r for r in quotes.link(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got[1600].reply_to == 1400 and got[1700].reply_to == 3 and got[1024].reply_to == 1023
    assert sorted(r.position for r in got.values()) == list(range(len(rows)))


@pytest.mark.parametrize("text,want", [("a\n> b\nc", "a\nc"), ("> a", ""), (">> a\n b ", "b"), ("x > y", "x > y")])
def test_own_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(quotes.own_text(quotes._lines(F.col("text")))).first()[0] == want
