"""Alignment of two tokenizers against a plain version that lays every text out byte by byte."""

import random
from collections import Counter
from hashlib import sha256

import pytest

from tallyloom.llm import alignment

from . import cases


@pytest.fixture(scope="module")
def both():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))


def bytes_a(tokenizer, i: int) -> bytes:
    table = alignment._letters()
    return bytes(table[c] for c in tokenizer.id_to_token(i))


def bytes_b(piece, i: int) -> bytes:
    word = piece.id_to_piece(i)
    return bytes([int(word[3:5], 16)]) if piece.is_byte(i) else word.replace("▁", " ").encode()


def plain(both, rows) -> list[tuple]:
    a, b = both
    found, counts = [], Counter()
    for doc_id, text, *_ in rows:
        if not text:
            found.append((doc_id, [], [], [], []))
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        words_a, words_b = [bytes_a(a, i) for i in ids_a], [bytes_b(b, i) for i in ids_b]
        if not b"".join(words_a) == b"".join(words_b) == (" " + text).encode():
            found.append((doc_id, [], [], [], []))
            continue
        own_a = [k for k, w in enumerate(words_a) for _ in w]
        own_b = [k for k, w in enumerate(words_b) for _ in w]
        linked = sorted(set(zip(own_a, own_b, strict=True)))
        groups, k, m = [], 0, 0
        ends_a, ends_b = ([sum(map(len, w[:n + 1])) for n in range(len(w))] if len(w) < 300 else None for w in (words_a, words_b))
        if ends_a is None or ends_b is None:
            ends = []
            for w in (words_a, words_b):
                total, out = 0, []
                for x in w:
                    total += len(x)
                    out.append(total)
                ends.append(out)
            ends_a, ends_b = ends
        for end in sorted(set(ends_a) & set(ends_b)):
            one, two = ends_a.index(end, k) + 1, ends_b.index(end, m) + 1
            groups.append((ids_a[k:one], ids_b[m:two]))
            k, m = one, two
        pairs = [(ids_a[i], ids_b[j]) for i, j in linked]
        counts.update(pairs)
        found.append((doc_id, ids_a, ids_b, groups, pairs))
    most: dict[int, int] = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for doc_id, ids_a, ids_b, groups, pairs in found:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(pairs), sum(counts[p] == most[p[1]] for p in pairs),
                    sum(counts[p] for p in pairs), sha256(said.encode()).hexdigest() if said else ""))
    return out


def texts() -> list[tuple]:
    rng = random.Random(3)
    odd = ["▁ in the text", "<|endoftext|> as text", "<unk> <s> </s>", "\n\n\t  two  gaps \n", "naïve café — 日本語 🙂🙂", "aaaaaaaaaaaaaaaab",
           " " * 700 + "x", "it's we'll DON'T", "a\u0000b", "​﻿", "0123456789" * 20, "é ẛ̣", "<0x41>A", "aa" * 50]
    rows = [(100 + k, t, "en", "a", 0) for k, t in enumerate(odd)]
    alphabet = "abcdefghij  .,'ÄéΩж中🙂\n"
    rows += [(200 + k, "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))), "en", "a", 0) for k in range(60)]
    return cases.documents() + rows


@pytest.mark.parametrize("block", [alignment.BLOCK_PAIRS, 100])
def test_alignment_is_that_of_the_plain_version(spark, both, block):
    rows = texts()
    got = alignment.aligned(cases.clashing(cases.frame(spark, rows)), block_pairs=block).collect()
    order = lambda r: (r[0] is None, *map(str, r))
    assert sorted((tuple(r) for r in got), key=order) == sorted(plain(both, rows), key=order)


def test_tasks_that_sum_often_count_the_same(spark, both, monkeypatch):
    rows = texts()
    want = alignment.aligned(cases.frame(spark, rows)).collect()
    monkeypatch.setattr(alignment, "HELD", 50)
    assert sorted(map(str, alignment.aligned(cases.frame(spark, rows)).collect())) == sorted(map(str, want))


def test_the_quick_encoder_gives_the_ids_of_the_library(both):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    files = [open(public_tokenizers.path(n), "rb").read() for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    loaded = alignment.Tokenizers(*files)
    assert loaded.quick is not None
    for c in range(0, 0x30000, 7):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}1{chr(c)} {chr(c)}'s{chr(c)}?"
            assert loaded.ids_a(text).tolist() == both[0].encode(" " + text, add_special_tokens=False).ids


def test_no_rows(spark):
    assert alignment.aligned(cases.frame(spark, [])).collect() == []
