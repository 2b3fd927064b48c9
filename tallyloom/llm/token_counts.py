"""Token counts by compiled finite-state transducers.

A byte-level BPE vocabulary is compiled into two deterministic transducers whose
transitions carry the tokens they emit.

* The splitter reads classes of code points and marks where a new word begins.
  Text is cut into chunks of equal length wherever that falls. For a chunk,
  the map from each state it could be entered in to the state it ends in is
  worked out for all chunks at once; the maps are composed by a parallel prefix
  scan, which gives every chunk its true entry state, and a second pass emits.
* The counter reads the bytes of a word. Its state is all that the rest of the
  word can depend on: each place from which a token may still be running, where
  it is in the trie of tokens, the last token before it, and the count there
  relative to now. A sequence of tokens is what BPE yields exactly if each pair
  of neighbours is, so one running token at most ends validly at any byte; the
  difference in counts is what the transition emits. States are made when first
  met and then looked up.

The vocabulary is a file for the ``tokenizers`` library. Only what these two
machines express is accepted (ByteLevel splitting, BPE without dropout, no
normaliser, added tokens without flags); anything else raises ``ValueError``.
Added tokens inside texts are matched, as the library does by default.

Null text counts as empty: 0 bytes, 0 tokens. Every row is counted by itself, so
repeated rows and ids need nothing; other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, pieces, seeds

CHUNK = 256
KNOWN_BYTES = 64 << 20  # of words whose counts a worker keeps, and
KNOWN_STEPS = 600_000  # transitions of the counter; when either is full, it is forgotten and learned anew

# White_Space of Unicode.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Classes of code points, and symbols that also know what follows.
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
SHORT, LONG, BEFORE_GAP, BLANK_END, SPACE_END, ADDED, ADDED_REST = 3, 4, 5, 6, 7, 8, 9
SYMBOLS = 10
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACES, ONE_LEFT, TWO_LEFT = range(8)
STATES = 8


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a word begins here" by symbol (those that begin a text come second) and state."""
    move = np.zeros((2 * SYMBOLS, STATES), np.uint8)
    emit = np.ones((2 * SYMBOLS, STATES), bool)
    for symbol, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS), (SHORT, IN_OTHERS), (LONG, IN_OTHERS)):
        move[symbol] = state
        for joins in (state, AFTER_BLANK):
            emit[symbol, joins] = False
    # An apostrophe where a word may begin takes the one or two letters of a contraction along.
    for symbol, state in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
        for begin in (FRESH, IN_LETTERS, IN_NUMBERS, IN_SPACES, ONE_LEFT, TWO_LEFT):
            move[symbol, begin] = state
    for state, after in ((TWO_LEFT, ONE_LEFT), (ONE_LEFT, FRESH)):
        move[LETTER, state], emit[LETTER, state] = after, False
    # White space before white space runs on; the last one is a word, or joins what follows if it is a blank.
    move[BEFORE_GAP] = IN_SPACES
    emit[BEFORE_GAP, IN_SPACES] = False
    move[BLANK_END], move[SPACE_END] = AFTER_BLANK, FRESH
    move[ADDED] = move[ADDED_REST] = FRESH
    emit[ADDED_REST] = False
    move[SYMBOLS:], emit[SYMBOLS:] = move[:SYMBOLS, FRESH:FRESH + 1], emit[:SYMBOLS, FRESH:FRESH + 1]
    return move, emit


MOVE, EMIT = _splitter()


_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point, made on first use."""
    if not _classes:
        _classes.append(_all_classes())
    return _classes[0]


def _all_classes() -> np.ndarray:
    import regex

    every = "".join(map(chr, [c if not 0xD800 <= c < 0xE000 else 0 for c in range(sys.maxunicode + 1)]))
    out = np.full(len(every), OTHER, np.uint8)
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(name, every):
            out[run.start():run.end()] = kind
    out[SPACES] = SPACE
    out[0x20] = BLANK
    return out


def entry_states(symbols: np.ndarray) -> np.ndarray:
    """The state in which each row of ``symbols`` (chunks of one stream, in order) is entered."""
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (len(symbols), 1))
    table, wide = MOVE.ravel(), symbols.astype(np.intp) * STATES
    together = False
    for k in range(symbols.shape[1]):
        maps = table[wide[:, k:k + 1] + maps]
        # Once every entry state of every chunk leads to one state, one column stands for all.
        if not together and k % 4 == 3 and (maps == maps[:, :1]).all():
            maps, together = maps[:, :1], True
    maps = np.broadcast_to(maps, (len(symbols), STATES)).copy()
    step = 1
    while step < len(maps):  # after each round a map spans twice as many chunks
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
        step *= 2
    return np.concatenate([np.zeros(1, np.uint8), maps[:-1, FRESH]])


def word_starts(symbols: np.ndarray) -> np.ndarray:
    """Where the splitter begins a word."""
    rows = -(-len(symbols) // CHUNK)
    padded = np.full(rows * CHUNK, SYMBOLS, np.uint8)
    padded[:len(symbols)] = symbols
    chunks = padded.reshape(rows, CHUNK)
    state, wide = entry_states(chunks), chunks.astype(np.intp) * STATES
    begins = np.empty((rows, CHUNK), bool)
    move, emit = MOVE.ravel(), EMIT.ravel()
    for k in range(CHUNK):
        at = wide[:, k] + state
        begins[:, k] = emit[at]
        state = move[at]
    return begins.ravel()[:len(symbols)]


class Counter:
    """The byte transducer of a BPE vocabulary."""

    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        added = spec.get("added_tokens") or []
        if (model["type"] != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel"
                or split.get("add_prefix_space") or not split.get("use_regex", True)
                or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                              "byte_fallback", "ignore_merges"))
                or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))):
            raise ValueError("only plain byte-level BPE vocabularies can be compiled")
        self.added = re.compile(b"|".join(re.escape(a["content"].encode()) for a in
                                          sorted(added, key=lambda a: -len(a["content"]))) or rb"(?!)")
        # Byte-level vocabularies write the printable bytes as they are, the others from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(sorted({*range(256)} - {*plain}))}
        number = model["vocab"]
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in number.items() if all(c in letters for c in t)}
        self.single = {t: i for i, t in self.bytes.items() if len(t) == 1}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(number[a], number[b]): (n, number[a + b]) for n, (a, b) in enumerate(pairs)}
        self.children, self.token = [{}], [-1]
        for i, word in self.bytes.items():
            node = 0
            for b in word:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = i
        self.known: dict[bytes, int] = {}
        self.held = 0
        self._forget()

    def _forget(self) -> None:
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states: dict[tuple, int] = {}
        self.content: list[tuple] = []
        self.steps: list[dict[int, tuple[int, int]]] = []
        self.start = self._state(((0, -1, 0),))
        self.made = 0

    def _state(self, content: tuple) -> int:
        found = self.states.get(content)
        if found is None:
            found = self.states[content] = len(self.content)
            self.content.append(content)
            self.steps.append({})
        return found

    def _merged(self, word: bytes) -> list[int]:
        parts = [self.single[bytes([b])] for b in word]
        while len(parts) > 1:
            best = min((self.rank[p] for p in zip(parts, parts[1:]) if p in self.rank), default=None)
            if best is None:
                break
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and self.rank.get((parts[k], parts[k + 1])) == best:
                    out.append(best[1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def _neighbours(self, left: int, right: int) -> bool:
        """BPE leaves these two tokens side by side (left -1: at the beginning)."""
        ok = self.pairs.get((left, right))
        if ok is None:
            want = [right] if left < 0 else [left, right]
            ok = self.pairs[left, right] = self._merged(b"".join(self.bytes[t] for t in want)) == want
        return ok

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        going, last, emitted = [], None, 0
        for node, left, behind in self.content[state]:
            nxt = self.children[node].get(byte)
            if nxt is None:
                continue
            token = self.token[nxt]
            if last is None and token >= 0 and self._neighbours(left, token):
                last, emitted = token, behind + 1
            if self.children[nxt]:
                going.append((nxt, left, behind))
        if last is None:
            raise ValueError("the vocabulary has no token for a byte")
        content = (*((n, t, c - emitted) for n, t, c in going), (0, last, 0))
        out = self.steps[state][byte] = (self._state(content), emitted)
        self.made += 1
        return out

    def count(self, word: bytes) -> int:
        total = self.known.get(word)
        if total is None:
            state, total, steps = self.start, 0, self.steps
            for byte in word:
                step = steps[state].get(byte)
                if step is None:
                    if self.made >= KNOWN_STEPS:  # a state is its content: it goes on in new tables
                        content = self.content[state]
                        self._forget()
                        state, steps = self._state(content), self.steps
                    step = self._step(state, byte)
                state = step[0]
                total += step[1]
            if self.held >= KNOWN_BYTES:
                self.known.clear()
                self.held = 0
            self.known[word] = total
            self.held += len(word) + 100
        return total


_counters: dict[int, Counter] = {}


def _counter(vocabulary: bytes) -> Counter:
    """Compiled once per worker."""
    key = hash(vocabulary)
    if key not in _counters:
        _counters[key] = Counter(vocabulary)
    return _counters[key]


def text_counts(counter: Counter, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Tokens of each text of a buffer, text ``k`` from ``bounds[k]`` to ``bounds[k + 1]``."""
    lo = int(bounds[0])
    raw, bounds = data[lo:int(bounds[-1])].tobytes(), bounds - lo
    if not raw:
        return np.zeros(len(bounds) - 1, np.int64)
    part = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((part & 0xC0) != 0x80)  # first byte of each code point
    kind = classes()[np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)]

    begins_text = np.zeros(len(at) + 1, bool)
    begins_text[np.searchsorted(at, bounds)] = True
    added = [m.span() for m in counter.added.finditer(raw)]
    if added:
        inner = np.searchsorted(bounds, [s for s, _ in added], "right") == np.searchsorted(bounds, [e for _, e in added])
        added = np.searchsorted(at, np.array(added)[inner])
        begins_text[added.ravel()] = True
    symbols = _symbols(part[at], kind, begins_text)
    for s, e in added:
        symbols[s:e] = ADDED_REST
        symbols[s] = ADDED
    starts = np.flatnonzero(word_starts(symbols + SYMBOLS * begins_text[:-1].astype(np.uint8)))
    first, ends = at[starts], np.append(at[starts[1:]], len(part))

    # Each different word is counted once.
    power = np.multiply.accumulate(np.full(len(part), 0x9E3779B97F4A7C15, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(seeds(256, 3)[part] * power)])
    inverse = np.multiply.accumulate(np.full(len(part), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
    key = mix((total[ends] - total[first]) * inverse[first] + (ends - first).astype(np.uint64))
    _, sample, which = np.unique(key, return_index=True, return_inverse=True)
    count = counter.count
    counts = np.array([count(raw[s:e]) for s, e in zip(first[sample].tolist(), ends[sample].tolist(), strict=True)], np.int64)
    counts = counts[which]
    counts[symbols[starts] == ADDED] = 1
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    return np.diff(sums[np.searchsorted(first, bounds)])


def _symbols(byte: np.ndarray, kind: np.ndarray, begins_text: np.ndarray) -> np.ndarray:
    n = len(kind)
    space = kind >= BLANK
    goes_on = np.zeros(n, bool)  # the next code point is text of the same document, and no white space
    goes_on[:-1] = ~space[1:]
    goes_on &= ~begins_text[1:n + 1]
    out = kind.copy()
    out[space] = np.where(goes_on, np.where(kind == BLANK, BLANK_END, SPACE_END), BEFORE_GAP)[space]
    apostrophes = np.flatnonzero(byte == 0x27)
    if len(apostrophes):
        padded, edge = np.append(byte, np.zeros(2, np.uint8)), np.append(begins_text, [True, True])
        for k in apostrophes:
            if edge[k + 1]:
                continue
            if padded[k + 1] in b"stmd":
                out[k] = SHORT
            elif not edge[k + 2] and bytes(padded[k + 1:k + 3]) in (b"re", b"ve", b"ll"):
                out[k] = LONG
    return out


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def with_token_counts(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row; ``vocabulary`` is a file the driver can read.

    Nothing moves but ids and counts; a task holds about a megabyte of text at a time."""
    with open(vocabulary or vocabulary_file(), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for rows, data, bounds in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(text_counts(counter, data, bounds))],
                ["doc_id", "n_bytes", "n_tokens"])

    return (docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint"))
