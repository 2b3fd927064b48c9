import random

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import token_counts
from tallyloom.llm.common import buffers

from . import cases

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def machines():
    path = token_counts.vocabulary_file()
    with open(path, "rb") as f:
        return token_counts.Counter(f.read()), tokenizers.Tokenizer.from_file(path)


def same(machines, texts):
    counter, library = machines
    data, bounds = buffers(pa.array(texts, pa.string()))
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert token_counts.text_counts(counter, data, bounds).tolist() == want


def test_counts_are_those_of_the_library(machines):
    same(machines, ["it'll 'sx 're'rex ''s  \n\n x\n", "a<|endoftext|>b", "  <|endoftext|>  ", "'", "s", "x 's", "\n's", "!'s", "", None, "   "])
    rng = random.Random(1)
    letters = ["  ", "\n", "\t", "'", "aàé1½stre", "vmld", "l.!?", "٣你", "　", "😀", "<|endoftext|>", "\x1c", "\x85", "s", "ll"]
    same(machines, ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)])
    same(machines, ["a" * 5000, " " * 3000, "-" * 4000 + "ab" * 700, cases.words(1, 5000)])


def test_every_code_point(machines):
    same(machines, [f"a{chr(c)}b {chr(c)}1" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000])


def test_chunk_maps_compose(monkeypatch, machines):
    monkeypatch.setattr(token_counts, "CHUNK", 3)
    same(machines, ["don't  stop\n\n 12 ab!! 'll", "x" * 50, " " * 31])


def test_edge_cases(spark, machines):
    got = token_counts.with_token_counts(cases.clashing(cases.frame(spark))).toPandas()
    assert len(got) == len(cases.documents()) and got[got.doc_id == 4].n_tokens.item() == 0
    assert got[got.doc_id == 13].n_bytes.item() == len("Ünïcode — ’s 日本語 　 text".encode())
    assert token_counts.with_token_counts(cases.frame(spark, [])).count() == 0


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f, pytest.raises(ValueError):
        token_counts.Counter(f.read())


def test_tables_stay_bounded(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    with open(path, "rb") as f:
        counter = token_counts.Counter(f.read())
    plain = __import__("tokenizers").Tokenizer.from_file(path)
    monkeypatch.setattr(token_counts, "KNOWN_STEPS", 300)
    monkeypatch.setattr(token_counts, "KNOWN_BYTES", 5_000)
    rng = __import__("random").Random(1)
    for _ in range(400):
        word = "".join(rng.choice("abcdefXYZ019_ёж") for _ in range(rng.randrange(1, 40)))
        data = word.encode()
        text = " " + word if rng.random() < 0.5 else word
        got = token_counts.text_counts(counter, np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        assert got.tolist() == [len(plain.encode(text).ids)], data
        assert counter.made <= 300 and len(counter.states) <= 301 and counter.held <= 5_000 + 200
    long = "xq7" * 5_000  # one word longer than the tables
    assert counter.count(long.encode()[:3_000].replace(b"7", b"z")) > 0 and counter.made <= 300
