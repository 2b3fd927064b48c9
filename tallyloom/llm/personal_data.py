"""Personal data in text: exact patterns, and a conditional random field for how people write the same things otherwise.

``base_spans`` finds e-mail addresses, IP addresses, card and phone numbers by
pattern and check. The linear-chain CRF adds what the patterns leave out:
"name (at) host (dot) org", numbers without a plus, cards in dotted groups,
defanged addresses. It reads tokens (runs of letters, runs of digits, single
signs) by shape: case and length, neighbours, gaps, and what holds of the whole
number or word around a token (digits in it, Luhn sum, dotted parts, place of the
at sign). Tags are begin/inside of each kind, or outside.

``labelled_from`` makes the small labelled table: passages around base spans of a
bounded number of documents (``SAMPLE``, those of least text hash), each also
rewritten in other notations, and rewritten so that it is no personal data any
more (a digit of a card changed, a part over 255, a number cut short). ``train``
fits weights and transitions on it in one task by forward-backward and adaptive
gradient steps; any table ``text, spans`` of that form will do.

``find`` decodes by Viterbi, sequences of like length together in numpy. A token
more than ``REACH`` characters away from every digit, at sign, plus and opening
bracket can be no part of a span; such stretches are passed over and the others
are one sequence each, whole texts long if need be (beyond ``LONG`` tokens in
overlapping stretches). A decoded span counts if it passes the check of its kind
and overlaps no base span; base spans always stay.

Null text counts as empty; a text without spans has an empty list. Every row is
read by itself, so repeated rows and ids need nothing; other columns are kept out.
Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

KINDS = ("email", "ip", "card", "phone")
TAGS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
N = len(TAGS)
SAMPLE = 2_000  # documents that the labelled table is taken from
PASSAGES = 4_000  # passages in it
REACH = 60
LONG, OVERLAP = 4096, 128
BATCH = 100_000  # tokens decoded together
NEVER = -1e4

Span = tuple[str, int, int]

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can begin only where a run of digits does: from inside it the same continuation fails again.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
MARK = re.compile(r"[0-9@+(\[{]")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
DIGITS = re.compile(r"[0-9]")
AT = re.compile(r"@|[(\[{] ?at ?[)\]}]", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = (ord(d) - 48) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind and start."""
    out: list[Span] = []
    if not ANY.search(text):
        return out
    at, behind = text.find("@"), 0
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            behind = host.end()
            out.append(("email", start, behind))
        at = text.find("@", max(at + 1, behind))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def passages(text: str) -> list[tuple[int, int]]:
    """The stretches of a text within REACH of a mark."""
    out: list[list[int]] = []
    for m in MARK.finditer(text):
        lo, hi = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _shape(token: str) -> str:
    c = token[0]
    if c in "0123456789":
        return f"d{min(len(token), 20)}"
    if not c.isalpha():
        return c
    case = "a" if token.islower() else "A" if token.isupper() else "Aa" if token[1:].islower() else "aA"
    n = len(token)
    return f"{case}{n if n < 4 else 4 if n < 6 else 6 if n < 9 else 9}"


class Tokens:
    """Tokens of a stretch of text and their features."""

    def __init__(self, text: str, lo: int, hi: int):
        self.spans = [m.span() for m in TOKEN.finditer(text, lo, hi)]
        self.words = [text[s:e] for s, e in self.spans]
        self.text = text

    def features(self) -> list[list[str]]:
        n, text = len(self.words), self.text
        shape = ["<", "<", *map(_shape, self.words), ">", ">"]
        gap = ["|"] * (n + 1)
        for k in range(1, n):
            between = text[self.spans[k - 1][1]:self.spans[k][0]]
            gap[k] = "" if not between else "n" if "\n" in between else "_" if between == " " else "__"
        number, word = self._numbers(gap), self._words(gap)
        out = []
        for k in range(n):
            a, b, c, d, e = shape[k:k + 5]
            out.append(["0" + c, "-1" + b, "+1" + d, "-2" + a, "+2" + e, f"-0{b} {c}", f"+0{c} {d}", f"-0+{b} {c} {d}",
                        f"-2-1{a} {b}", f"+1+2{d} {e}", f"g{gap[k]} {c} {gap[k + 1]}", f"g-{b} {gap[k]} {c}", f"g+{c} {gap[k + 1]} {d}",
                        "n" + number[k], f"n0{number[k]} {c}", f"n-{number[k]} {b}", "w" + word[k], f"w0{word[k]} {c}"])
        return out

    def _numbers(self, gap: list[str]) -> list[str]:
        """Of the number (digits, and signs that stand inside numbers) around each token: how it begins, digits, Luhn, parts."""
        n, words = len(self.words), self.words
        inside = [w[0] in "0123456789" or w in "+()-./[]" for w in words]
        out, k = ["-"] * n, 0
        while k < n:
            if not inside[k]:
                k += 1
                continue
            end = k
            while end < n and inside[end] and (end == k or gap[end] in ("", "_")):
                end += 1
            parts = [w for w in words[k:end] if w[0] in "0123456789"]
            digits = sum(map(len, parts))
            if digits:
                head = words[k] if words[k] in "+(" else "0" if parts[0].startswith("00") else ""
                good = luhn("".join(parts)) if 13 <= digits <= 19 else None
                octets = len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
                said = f"{head}{min(digits, 20)} {'' if good is None else good} {octets} {min(len(parts), 7)}"
                out[k:end] = [said] * (end - k)
            k = end
        return out

    def _words(self, gap: list[str]) -> list[str]:
        """Of the run without gaps around each token: at signs before it and behind it, dots, digits."""
        n, out, k = len(self.words), [], 0
        while k < n:
            end = k + 1
            while end < n and gap[end] == "":
                end += 1
            part = self.words[k:end]
            ats, dots = part.count("@"), part.count(".")
            seen = 0
            for w in part:
                out.append(f"{min(seen, 2)} {min(ats - seen - (w == '@'), 2)} {min(dots, 3)}")
                seen += w == "@"
            k = end
        return out


def tags_of(tokens: Tokens, spans: Iterable[Span]) -> list[int]:
    out = [0] * len(tokens.words)
    for kind, start, end in spans:
        own = [k for k, (s, e) in enumerate(tokens.spans) if s >= start and e <= end]
        for k in own:
            out[k] = TAGS.index(("B-" if k == own[0] else "I-") + kind)
    return out


class Field:
    """The trained field: a weight for each feature and tag, and for each pair of tags."""

    def __init__(self, number: dict[str, int], weights: np.ndarray, moves: np.ndarray, begins: np.ndarray):
        self.number, self.weights, self.moves, self.begins = number, weights, moves, begins

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, names=np.array(list(self.number), dtype=str), weights=self.weights, moves=self.moves, begins=self.begins)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Field:
        z = np.load(io.BytesIO(data), allow_pickle=False)
        return cls({str(f): i for i, f in enumerate(z["names"])}, z["weights"], z["moves"], z["begins"])

    def ids(self, features: list[list[str]]) -> np.ndarray:
        """Numbers of the features of each token; those that training did not meet go to a row of zeros at the end."""
        none, get = len(self.number), self.number.get
        return np.array([[get(f, none) for f in row] for row in features], np.int32).reshape(len(features), -1)

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The likeliest tags of each sequence of ``ids``, by Viterbi, sequences of like length at once."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted((k for k in range(len(sequences)) if len(sequences[k])), key=lambda k: len(sequences[k]))
        while order:
            longest = len(sequences[order[-1]])
            take = max(1, BATCH // longest)
            part, order = order[-take:], order[:-take]
            lengths = np.array([len(sequences[k]) for k in part])
            unary = np.zeros((len(part), longest, N))
            for row, k in enumerate(part):
                unary[row, :lengths[row]] = self.weights[sequences[k]].sum(axis=1)
            best, back = unary[:, 0] + self.begins, np.zeros((longest, len(part), N), np.int8)
            for t in range(1, longest):
                ways = best[:, :, None] + self.moves
                back[t] = ways.argmax(axis=1)
                moved = ways.max(axis=1) + unary[:, t]
                best = np.where((t < lengths)[:, None], moved, best)
            tag = best.argmax(axis=1)
            tags = np.zeros((longest, len(part)), np.int64)
            rows = np.arange(len(part))
            for t in range(longest - 1, -1, -1):
                tags[t] = tag
                inside = (t > 0) & (t < lengths)
                tag = np.where(inside, back[t, rows, tag], tag)
            for row, k in enumerate(part):
                out[k] = tags[:lengths[row], row]
        return out


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """NEVER for an inside tag that follows no begin or inside of its kind, else 0: by pair, and at the beginning."""
    begins = np.array([NEVER if t.startswith("I") else 0.0 for t in TAGS])
    moves = np.tile(begins, (N, 1))
    for k in KINDS:
        for p in "BI":
            moves[TAGS.index(f"{p}-{k}"), TAGS.index(f"I-{k}")] = 0.0
    return moves, begins


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def fit_field(examples: list[tuple[list[list[str]], list[int]]], epochs: int = 12, batch: int = 128, rate: float = 0.4,
              ridge: float = 1e-5) -> Field:
    """Log likelihood of the tags given the tokens, by AdaGrad over batches in a fixed order."""
    seen: dict[str, int] = {}
    for features, _ in examples:
        for row in features:
            for f in row:
                seen[f] = seen.get(f, 0) + 1
    number = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
    weights = np.zeros((len(number) + 1, N))
    fixed_moves, fixed_begins = _allowed()
    field = Field(number, weights, fixed_moves.copy(), fixed_begins.copy())
    rows = sorted(((field.ids(f), np.array(t)) for f, t in examples if t), key=lambda x: len(x[1]))
    groups = [rows[k:k + batch] for k in range(0, len(rows), batch)]
    size = [np.full_like(w, 1e-2) for w in (weights, field.moves, field.begins)]
    turn = np.random.default_rng(5)
    for _ in range(epochs):
        for g in turn.permutation(len(groups)):
            grads = _gradient(field, groups[g])
            for w, grad, s in zip((weights, field.moves, field.begins), grads, size, strict=True):
                grad = grad + ridge * np.where(w > NEVER / 2, w, 0.0)
                s += grad * grad
                w -= rate * grad / np.sqrt(s)
            weights[-1] = 0.0
    return field


def _gradient(field: Field, rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the negative log likelihood of a batch, a sequence."""
    n, longest = len(rows), max(len(t) for _, t in rows)
    lengths = np.array([len(t) for _, t in rows])
    width = rows[0][0].shape[1]
    ids = np.full((n, longest, width), len(field.number), np.int64)
    tags = np.zeros((n, longest), np.int64)
    for k, (i, t) in enumerate(rows):
        ids[k, :len(t)], tags[k, :len(t)] = i, t
    unary = field.weights[ids].sum(axis=2)
    ahead = np.zeros((longest, n, N))
    ahead[0] = unary[:, 0] + field.begins
    for t in range(1, longest):
        ahead[t] = _sum(ahead[t - 1][:, :, None] + field.moves, 1) + unary[:, t]
    behind = np.zeros((longest, n, N))
    total = _sum(ahead[lengths - 1, np.arange(n)], 1)
    moves = np.zeros((N, N))
    for t in range(longest - 2, -1, -1):
        onward = field.moves + (unary[:, t + 1] + behind[t + 1])[:, None, :]
        going = (t + 1 < lengths)
        behind[t] = np.where(going[:, None], _sum(onward, 2), 0.0)
        pairs = np.exp(ahead[t][:, :, None] + onward - total[:, None, None])
        moves += pairs[going].sum(axis=0)
        np.add.at(moves, (tags[going, t], tags[going, t + 1]), -1.0)
    share = np.exp(ahead + behind - total[None, :, None]).transpose(1, 0, 2)
    share[np.arange(n)[:, None], np.arange(longest), tags] -= 1.0
    share[np.arange(longest)[None, :] >= lengths[:, None]] = 0.0
    flat, error = ids.reshape(-1, width), share.reshape(-1, N)
    weights = np.stack([np.bincount(flat.ravel(), np.repeat(error[:, y], width), len(field.weights)) for y in range(N)], axis=1)
    return weights / n, moves / n, share[:, 0].sum(axis=0) / n


# How the same thing is written otherwise, and what only looks like it (no label).
def rewritten(kind: str, said: str, draw: int) -> tuple[str, bool]:
    """Another notation of a span, and whether it still is personal data; ``draw`` chooses."""
    digits = _digits(said)
    if kind == "email":
        name, _, host = said.partition("@")
        at, dot = (("(at)", "."), (" (at) ", "."), (" [at] ", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"))[draw % 6]
        if draw % 13 == 12:
            return f"{name}@{host.partition('.')[0]} ", False
        return name + at + host.replace(".", dot), True
    if kind == "ip":
        parts = said.split(".")
        ways = ("[.]".join(parts), ".".join(parts[:3]) + "[.]" + parts[3], ".".join([str(int(parts[0]) + 256), *parts[1:]]),
                ".".join([*parts, "7"]), ".".join(parts[:3]), f"({parts[0]}.{parts[1]})")
        return ways[draw % 6], draw % 6 < 2
    if kind == "card":
        fours = [digits[k:k + 4] for k in range(0, len(digits), 4)]
        bad = digits[:5] + str((int(digits[5]) + 1 + draw % 8) % 10) + digits[6:]
        ways = (".".join(fours), " - ".join(fours), "/".join(fours), bad, " ".join(bad[k:k + 4] for k in range(0, len(bad), 4)), digits[:12], "-".join(fours[:3]))
        return ways[draw % 7], draw % 7 < 3
    last = digits[-10:]
    a, b, c = last[:-7], last[-7:-4], last[-4:]
    ways = (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"001 {a} {b} {c}", f"({a}) {b} {c}", f"00{digits}", f"{b}", f"+{digits[:5]}",
            f"20{c[:2]}-0{int(c[2]) % 9 + 1}-1{c[3]}", f"{b},{c[:3]}.{c[2:]}", f"({b})", f"{a}-{c}")
    return ways[draw % 12], draw % 12 < 6


def labelled_from(docs: DataFrame, text: str = "text", sample: int = SAMPLE, limit: int = PASSAGES) -> DataFrame:
    """``text, spans`` of at most ``limit`` passages: what base spans and other digits of ``sample`` documents stand in,
    as they are and rewritten. ``spans`` is written as ``find`` writes it."""
    hashed = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("hash")).where(F.col("text").rlike(r"[0-9@]"))
    last = hashed.select("hash").distinct().orderBy("hash").limit(sample).agg(F.max("hash")).first()[0]
    chosen = hashed.where(F.col("hash") <= F.lit(last)).groupBy("hash").agg(F.min("text").alias("text"))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for code, whole in zip(batch.column("hash").to_pylist(), batch.column("text").to_pylist(), strict=True):
                spans = base_spans(whole)
                for number, (lo, hi) in enumerate(passages(whole)):
                    if hi - lo > 10 * REACH:
                        continue
                    own = [(k, s - lo, e - lo) for k, s, e in spans if lo <= s and e <= hi]
                    said = whole[lo:hi]
                    out.append((said, written(own)))
                    for extra in range(3 if len(own) == 1 else 0):
                        (kind, s, e), draw = own[0], (code >> (8 * extra + 3)) % 5039 + number
                        new, good = rewritten(kind, said[s:e], draw)
                        out.append((said[:s] + new + said[e:], written([(kind, s, s + len(new))] if good else [])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], ["text", "spans"])

    made = chosen.mapInArrow(examples, "text string, spans string")
    return staged(made.orderBy(F.xxhash64("text", "spans"), "text").limit(limit), "labelled")


def parsed(spans: str | None) -> list[Span]:
    return [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in (spans or "").split(",") if x)]


def train(labelled: DataFrame, limit: int = PASSAGES) -> Field | None:
    """The field, from at most ``limit`` rows ``text, spans``; None without a span to learn from."""
    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                tokens = Tokens(text or "", 0, len(text or ""))
                examples.append((tokens.features(), tags_of(tokens, parsed(spans))))
        if any(any(t) for _, t in examples):
            yield pa.RecordBatch.from_arrays([pa.array([fit_field(examples).to_bytes()], pa.binary())], ["field"])

    rows = labelled.select("text", "spans").orderBy("text", "spans").limit(limit).coalesce(1).mapInArrow(fitted, "field binary").collect()
    return Field.from_bytes(rows[0].field) if rows else None


def plausible(kind: str, said: str) -> bool:
    """What a decoded span must have."""
    digits = _digits(said)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "ip":
        parts = re.findall(r"[0-9]+", said)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return AT.search(said) is not None and len(re.findall(r"[^\W_]+", said)) >= 3


def decoded(field: Field, texts: list[str]) -> list[list[Span]]:
    """What the field finds in each text."""
    owners, tokens, edges, sequences = [], [], [], []
    out: list[list[Span]] = [[] for _ in texts]

    def close() -> None:
        for owner, part, (lo, hi), tags in zip(owners, tokens, edges, field.decode(sequences), strict=True):
            k = 0
            while k < len(tags):
                if TAGS[tags[k]][0] != "B":
                    k += 1
                    continue
                end, kind = k + 1, TAGS[tags[k]][2:]
                while end < len(tags) and TAGS[tags[end]] == "I-" + kind:
                    end += 1
                start, behind = part[k][0], part[end - 1][1]
                if lo <= k < hi and plausible(kind, texts[owner][start:behind]):
                    out[owner].append((kind, start, behind))
                k = end
        for held in (owners, tokens, edges, sequences):
            held.clear()

    size = 0
    for owner, text in enumerate(texts):
        for lo, hi in passages(text):
            found = Tokens(text, lo, hi)
            n = len(found.words)
            for first in range(0, n, LONG):
                # A stretch reaches over its own part at both ends, and a span counts where it begins.
                begin, end = max(0, first - OVERLAP), min(n, first + LONG + OVERLAP)
                part = Tokens(text, found.spans[begin][0], found.spans[end - 1][1]) if (begin, end) != (0, n) else found
                owners.append(owner)
                tokens.append(part.spans)
                edges.append((first - begin, min(n, first + LONG) - begin))
                sequences.append(field.ids(part.features()))
                size += end - begin
                if size > BATCH:
                    close()
                    size = 0
    close()
    return out


def find(docs: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, spans`` of every row: base spans, and these with what the field adds, as ``kind:start:end``
    by kind and start, comma-joined."""
    shared = docs.sparkSession.sparkContext.broadcast(field.to_bytes() if field else None)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field.from_bytes(shared.value) if shared.value else None
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added = decoded(field, texts) if field else [[] for _ in texts]
            every = [own + [x for x in more if all(x[2] <= s or x[1] >= e for _, s, e in own)] for own, more in zip(base, added, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(map(written, x), pa.string()) for x in (base, every))],
                                             ["doc_id", "base", "spans"])

    return (docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id bigint, base string, spans string"))
