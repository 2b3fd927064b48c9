"""Which tokens of two tokenizers stand for the same text, counted over a corpus.

Both tokenizers read ``" " + text`` (the piece model adds its space itself). Byte
offsets where tokens of both end cut a text into groups; two tokens whose byte
ranges overlap are linked. Inside a group no two ends meet, so every end, of
either side, closes exactly one link: the links of a text are the union of both
lists of ends, found by two binary searches and without a loop over groups.

Identity map as the fast path: an array gives for each id of A the id of B that
has the same bytes. A group of one token on either side that the array foretells
is counted in a vector as long as A's vocabulary, one vector a task. Only the
links of all other groups become (a, b) pairs; a task sums them before they are
shuffled. A pair of the array can also occur in an irregular group, at shifted
offsets, so both counts are added.

Texts are encoded once. What the corpus-wide counts are needed for again, the
links of each text, lies packed next to its row in the shared folder. The table
of pairs then goes over these rows in blocks of ``BLOCK_PAIRS`` pairs, each
broadcast by itself; sums over blocks add up.

Null or empty texts, and those whose tokens do not give ``" " + text`` back on
either side, have no tokens: zeros and ''. Rows that repeat an id or a text are
counted one by one. Other columns are not looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, staged
from .token_counts import vocabulary_file

HELD = 2_000_000  # different pairs that a task sums before it writes them
BLOCK_PAIRS = 2_000_000  # pairs broadcast at once: 8 bytes of key, 8 of count, 1 of "is best"
GAP = re.compile(r"\s{500}")
# Fixed value: how byte-level vocabularies of this kind split text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    # Printable bytes are written as they are, the others from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(sorted({*range(256)} - {*plain}))}


class Tokenizers:
    """A byte-level BPE (A) and a piece model with byte fallback (B): ids of texts, bytes of ids."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(a)
        self.library.encode_special_tokens = True
        spec, letters = json.loads(a), _letters()
        of_a = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in letters for c in t)}
        self.quick = self._quick(spec, of_a)
        self.piece = sentencepiece.SentencePieceProcessor(model_proto=b)
        of_b = {i: (bytes([int(self.piece.id_to_piece(i)[3:5], 16)]) if self.piece.is_byte(i)
                    else self.piece.id_to_piece(i).replace("▁", " ").encode())
                for i in range(self.piece.get_piece_size()) if not (self.piece.is_control(i) or self.piece.is_unknown(i))}
        self.n_a, self.n_b = max(of_a, default=0) + 1, self.piece.get_piece_size()
        self.a, self.b = _Bytes(of_a, self.n_a), _Bytes(of_b, self.n_b)
        # Pieces come before the byte tokens of the same byte, as encoding prefers them.
        first: dict[bytes, int] = {}
        for i in sorted(of_b, key=lambda i: (self.piece.is_byte(i), i)):
            first.setdefault(of_b[i], i)
        self.same = np.full(self.n_a, -1)
        for i, word in of_a.items():
            self.same[i] = first.get(word, -1)

    @staticmethod
    def _quick(spec: dict, of_a: dict[int, bytes]):
        """An encoder three times as fast that gives the same ids, for vocabularies it can express: the plain
        split, every pair of tokens that makes a token is a merge, and merges in the order of ids."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
                 and not spec.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "ignore_merges",
                                                                                   "continuing_subword_prefix", "end_of_word_suffix")))
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ids = [model["vocab"][m] for m in merged]
        if not plain or ids != sorted(set(ids)) or len(ids) + 256 != len(of_a.keys() - {t["id"] for t in spec.get("added_tokens") or []}):
            return None
        import tiktoken

        special = {t["id"] for t in spec.get("added_tokens") or []}
        return tiktoken.Encoding("a", pat_str=SPLIT, special_tokens={},
                                 mergeable_ranks={w: i for i, w in of_a.items() if i not in special})

    def ids_a(self, text: str) -> np.ndarray:
        # Very long gaps are beyond the quick encoder's matcher.
        if self.quick is None or GAP.search(text):
            return np.array(self.library.encode(" " + text, add_special_tokens=False).ids, np.int64)
        return np.array(self.quick.encode_ordinary(" " + text), np.int64)

    def ids_b(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.piece.encode(texts, num_threads=1)]


class _Bytes:
    def __init__(self, words: dict[int, bytes], n: int):
        self.length = np.array([len(words.get(i, b"")) for i in range(n)])
        self.first = np.cumsum(self.length) - self.length
        self.every = np.frombuffer(b"".join(words.get(i, b"") for i in range(n)), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        begin = np.cumsum(length) - length
        return self.every[np.repeat(self.first[ids] - begin, length) + np.arange(int(length.sum()))]


_loaded: dict[int, Tokenizers] = {}


def _tokenizers(files: tuple[bytes, bytes]) -> Tokenizers:
    """Loaded once per worker."""
    key = hash(files)
    if key not in _loaded:
        _loaded[key] = Tokenizers(*files)
    return _loaded[key]


class Piece:
    """Texts of a piece, aligned: ids of both sides, groups, and links (indices into the ids)."""

    def __init__(self, both: Tokenizers, raw: list[bytes]):
        texts = [r.decode(errors="replace") for r in raw]
        a, b = [both.ids_a(t) if t else np.zeros(0, np.int64) for t in texts], both.ids_b(texts)
        keep = [bool(r) and self._spells(both.a, i, r) and self._spells(both.b, j, r) for r, i, j in zip(raw, a, b, strict=True)]
        empty = np.zeros(0, np.int64)
        a, b = [x if k else empty for x, k in zip(a, keep, strict=True)], [x if k else empty for x, k in zip(b, keep, strict=True)]
        self.firsts_a, self.firsts_b = (np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64) for side in (a, b))
        self.a, self.b = np.concatenate([*a, empty]), np.concatenate([*b, empty])
        ends_a, ends_b = np.cumsum(both.a.length[self.a]), np.cumsum(both.b.length[self.b])
        sizes = np.array([len(r) + 1 if k else 0 for r, k in zip(raw, keep, strict=True)], np.int64)
        behind = np.concatenate([[0], np.cumsum(sizes)])
        at = np.searchsorted(ends_b, ends_a)
        cut_a = np.zeros(len(ends_a), bool)
        if len(ends_b):
            cut_a = ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a
        cut_b = np.zeros(len(ends_b), bool)
        cut_b[at[cut_a]] = True
        self.group_a, self.group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        ends = np.union1d(ends_a, ends_b)
        self.link_a, self.link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.links = np.searchsorted(ends, behind, "right")  # number of the first link of each text, one more at the end
        self.groups = np.searchsorted(ends_a[cut_a], behind, "right")
        in_a, in_b = np.bincount(self.group_a, minlength=1), np.bincount(self.group_b, minlength=1)
        alone = (in_a == 1) & (in_b == 1) if len(self.a) else np.zeros(1, bool)
        group = self.group_a[self.link_a]
        self.regular = alone[group] & (both.same[self.a[self.link_a]] == self.b[self.link_b])

    @staticmethod
    def _spells(side: _Bytes, ids: np.ndarray, raw: bytes) -> bool:
        return int(side.length[ids].sum()) == len(raw) + 1 and side.joined(ids).tobytes() == b" " + raw

    def written(self) -> list[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        n = len(self.a) + len(self.b)
        ids, mark = np.empty(n, np.int64), np.empty(n, np.int64)
        new_a, new_b = (np.diff(g, prepend=-1) > 0 for g in (self.group_a, self.group_b))
        behind_b = np.searchsorted(self.group_b, np.arange(len(self.groups) and (self.groups[-1] + 1)))  # tokens of B before each group
        behind_a = np.searchsorted(self.group_a, np.arange(len(behind_b)), "right")  # tokens of A up to each group
        to_a, to_b = np.arange(len(self.a)) + behind_b[self.group_a], np.arange(len(self.b)) + behind_a[self.group_b]
        ids[to_a], mark[to_a], ids[to_b], mark[to_b] = self.a, new_a, self.b, 2 * new_b
        base = int(ids.max(initial=0)) + 1
        words = [s + str(i) for s in (",", ";", "|") for i in range(base)] if n > base else None
        codes = (mark * base + ids).tolist()
        said = words.__getitem__ if words else lambda c: ",;|"[c // base] + str(c % base)
        firsts = self.firsts_a + self.firsts_b
        return ["".join(map(said, codes[lo:hi]))[1:].encode() for lo, hi in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]


ROWS = ("kind int, row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "same binary, pairs binary, counts binary")
TEXT, REGULAR, IRREGULAR = range(3)


def _packed(values: np.ndarray) -> bytes:
    return values.astype(np.uint32).tobytes()


def links(docs: DataFrame, files: tuple[bytes, bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's figures and packed links, and each task's sums of them, written to the shared folder.

    ``kind`` TEXT: a text; ``same`` has the ids of A in regular links, ``pairs`` the other links. REGULAR: ``same``
    ids of A and how often each is in a regular link. IRREGULAR: ``pairs`` and how often each occurs. A pair is two
    unsigned 32-bit numbers; counts are 64-bit."""
    shared = docs.sparkSession.sparkContext.broadcast(files)
    schema = pa.schema([("kind", pa.int32()), *((n, pa.int64()) for n in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")),
                        ("groups_sha256", pa.string()), *((n, pa.binary()) for n in ("same", "pairs", "counts"))])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, row = _tokenizers(shared.value), TaskContext.get().partitionId() << 33
        regular = np.zeros(both.n_a, np.int64)
        keys, counts, waiting, waits = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([keys, *(k for k, _ in waiting)])
            found, which = np.unique(every, return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, which, np.concatenate([counts, *(c for _, c in waiting)]))
            return found, sums

        def totals(kind: int, same: np.ndarray, pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            pairs = np.stack([pairs // both.n_b, pairs % both.n_b], axis=1)
            return pa.RecordBatch.from_pylist([{"kind": kind, "same": _packed(same), "pairs": _packed(pairs), "counts": n.tobytes()}], schema)

        for rows, data, bounds in pieces(batches, "text"):
            part = Piece(both, [data[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)])
            ids_a, ids_b = part.a[part.link_a], part.b[part.link_b]
            regular += np.bincount(ids_a[part.regular], minlength=both.n_a)
            waiting.append(np.unique(ids_a[~part.regular] * both.n_b + ids_b[~part.regular], return_counts=True))
            waits += len(waiting[-1][0])
            if waits > HELD:
                keys, counts = summed()
                waiting, waits = [], 0
                if len(keys) > HELD:
                    yield totals(IRREGULAR, keys[:0], keys, counts)
                    keys, counts = keys[:0], counts[:0]
            pairs = np.stack([ids_a, ids_b], axis=1).astype(np.uint32)
            same, other = [], []
            for lo, hi in zip(part.links[:-1].tolist(), part.links[1:].tolist(), strict=True):
                kept = part.regular[lo:hi]
                same.append(pairs[lo:hi, 0][kept].tobytes())
                other.append(pairs[lo:hi][~kept].tobytes())
            n = rows.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, TEXT, np.int32)), pa.array(row + np.arange(n)), rows.column("doc_id"),
                 *(pa.array(np.diff(x)) for x in (part.firsts_a, part.firsts_b, part.groups, part.links)),
                 pa.array([sha256(w).hexdigest() if w else "" for w in part.written()]),
                 pa.array(same, pa.binary()), pa.array(other, pa.binary()), pa.nulls(n, pa.binary())], schema=schema)
            row += n
        yield totals(IRREGULAR, np.zeros(0, np.int64), *summed())
        seen = np.flatnonzero(regular)
        yield totals(REGULAR, seen, np.zeros(0, np.int64), regular[seen])

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return staged(narrow.mapInArrow(aligned, ROWS), "links", compression="zstd")


def pair_counts(links: DataFrame, same: np.ndarray) -> DataFrame:
    """``a, b, n, best``: how many links of the corpus hold the pair, and whether no pair of ``b`` has more."""
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, ids, pairs, n in zip(*(batch.column(c).to_pylist() for c in ("kind", "same", "pairs", "counts")), strict=True):
                n = np.frombuffer(n, np.int64)
                if kind == REGULAR:
                    a = np.frombuffer(ids, np.uint32).astype(np.int64)
                    b = same[a]
                else:
                    a, b = np.frombuffer(pairs, np.uint32).reshape(-1, 2).astype(np.int64).T
                for lo in range(0, len(n), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + (1 << 16)]) for x in (a, b, n)], ["a", "b", "n"])

    sums = (links.where(F.col("kind") != TEXT).select("kind", "same", "pairs", "counts").mapInArrow(unpacked, "a bigint, b bigint, n bigint")
            .groupBy("a", "b").agg(F.sum("n").alias("n")))
    sums = staged(sums, "pair-counts")
    most = sums.groupBy("b").agg(F.max("n").alias("most"))  # no more rows than B has ids
    return sums.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(texts: DataFrame, block: DataFrame, twins: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """``row, n_best, count_sum`` over the links of each text that ``block`` knows, and, with ``twins``, over its
    regular links: ``twins`` gives by id of A whether its pair is best, and the pair's count."""
    table = block.select(F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("key"), "n", F.col("best").cast("bigint").alias("best")).toArrow().sort_by("key")
    shared = texts.sparkSession.sparkContext.broadcast((*(table.column(c).to_numpy() for c in ("key", "best", "n")), twins))

    def sums(listed: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        ends = np.concatenate([[0], np.cumsum([len(x) // (4 * width) for x in listed])]).astype(np.int64)
        return np.frombuffer(b"".join(listed), np.uint32).astype(np.int64), ends

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, best, n, twins = shared.value
        for batch in batches:
            pairs, ends = sums(batch.column("pairs").to_pylist(), 2)
            wanted, which = np.unique(pairs[::2] << 32 | pairs[1::2], return_inverse=True)
            found = np.zeros((2, len(wanted)), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                found = np.where(keys[at] == wanted, (best[at], n[at]), 0)
            total = [np.diff(np.concatenate([[0], np.cumsum(v[which])])[ends]) for v in found]
            if twins is not None:
                ids, ends = sums(batch.column("same").to_pylist(), 1)
                total = [t + np.diff(np.concatenate([[0], np.cumsum(v[ids])])[ends]) for t, v in zip(total, twins, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, total)], ["row", "n_best", "count_sum"])

    return texts.select("row", "same", "pairs").mapInArrow(score, "row bigint, n_best bigint, count_sum bigint")


def aligned(docs: DataFrame, a: str | None = None, b: str | None = None, doc_id: str = "doc_id", text: str = "text",
            block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row; ``a`` and ``b`` are
    files the driver can read. ``n_best``: links whose pair no other pair of its B id exceeds; ``count_sum``: sum of
    the corpus-wide counts of the links."""
    with open(a or vocabulary_file("byte_bpe_50k.json"), "rb") as f, open(b or vocabulary_file("piece_bpe_32k.model"), "rb") as g:
        files = f.read(), g.read()
    same = _tokenizers(files).same
    found = links(docs, files, doc_id, text)
    counts = staged(pair_counts(found, same), "pairs")
    texts = found.where(F.col("kind") == TEXT)
    # Pairs of the identity map: no more than A has ids.
    ids = docs.sparkSession.createDataFrame([(i, int(t)) for i, t in enumerate(same) if t >= 0], "a bigint, b bigint")
    twins = np.zeros((2, len(same)), np.int64)
    for r in counts.join(F.broadcast(ids), ["a", "b"], "left_semi").toLocalIterator():
        twins[:, r.a] = r.best, r.n
    n_blocks = 1 + counts.count() // block_pairs
    sums = None
    for k in range(n_blocks):
        part = _scored(texts, counts.where(F.pmod(F.xxhash64("a", "b"), F.lit(n_blocks)) == k), twins if k == 0 else None)
        sums = part if sums is None else sums.unionByName(part)
    if n_blocks > 1:
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return (texts.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
