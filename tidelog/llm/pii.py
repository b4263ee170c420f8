"""Personal data: exact patterns, and a linear-chain conditional random field for what they miss.

Tokens end at blanks, at quotes, brackets and other separators (tokens of their own) and where the
script changes. The field labels them by features of their shape and of their neighbours'. It is
trained here on a small labelled table and decodes whole texts by Viterbi in numpy batches. Its
spans are added where no pattern's span lies.

Most tokens are outside any span whatever their neighbours are: their emission for that outweighs
all that the moves to and from another tag can give. Such a token lies on the best path for
certain, so the path is found between neighbouring ones separately, with the same result.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: What the field may add, after the patterns' kinds.
FIELD_KINDS = (*KINDS, "secret")
TAGS = ["O"] + [f"{p}-{k}" for k in FIELD_KINDS for p in "BI"]
#: Characters of texts, and padded tokens of stretches, that are decoded at a time; distinct tokens
#: whose vectors a worker keeps. They bound memory, not what is read.
CHARS, PADDED, CACHED = 2_000_000, 20_000, 100_000
#: Rounds of narrowing; more rounds leave fewer tokens to Viterbi, the result is the same.
ROUNDS = 4

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_MARK = re.compile(r"[0-9@]+")
_SEPARATOR = r"""["'{}\[\]<>,;:=|&]"""
_TOKEN = re.compile(_SEPARATOR + r"|[!#-%(-+\--9?-Z\\^-z~\u00c0-\u024f]+|[^\s!-~\u00c0-\u024f]+")
_RUN = re.compile(r"(?P<d>[0-9]+)|(?P<x>[a-z]+)|(?P<X>[A-Z]+)|(?P<u>[^\W\d_a-zA-Z]+)"
                  r"|(?P<same>[@.\-+()=\":/_])|(?P<p>.)", re.S)
_LEFT, _RIGHT = "([{<\"'`*#&$|", ")]}>\"'`.,;:!?%*#&$|"

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from their at signs: linear in the text."""
    at, done = text.find("@"), 0
    while at >= 0:
        head = text[done:at]
        first = done + len(head.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if first < at else None
        if found:
            yield "email", first, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by kind and start."""
    out = list(_emails(text))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def shape(token: str) -> str:
    """Runs of digits, capitals, small letters and other letters as one sign each; of a token with
    many runs the signs only."""
    out: list[str] = []
    for m in _RUN.finditer(token):
        sign = m[0] if m.lastgroup == "same" else m.lastgroup or ""
        if not out or out[-1] != sign:
            out.append(sign)
    return "".join(out) if len(out) <= 12 else "~" + "".join(sorted(set(out)))


_CUES = {
    "mail": ("mail", "email", "e-mail", "contact", "write"), "net": ("ip", "host", "address", "server"),
    "pay": ("card", "visa", "credit", "pay"), "call": ("phone", "tel", "call", "fax", "mobile"),
    "key": ("token", "key", "secret", "password", "apikey", "api_key"),
    "about": ("page", "year", "version", "in", "chapter", "no", "about", "since", "v"),
}
_CUE = {w: k for k, words in _CUES.items() for w in words}


def token_features(token: str) -> list[str]:
    """Features of one token: shape, digits, length, and whether it is a cue."""
    core = token.strip(_LEFT + _RIGHT) or token
    digits = sum(map(str.isdigit, core))
    mixed = len(core) >= 16 and 0 < digits < len(core) and core.isalnum()
    bucket = next(k for k, most in enumerate((0, 2, 3, 4, 6, 8, 12, 19, 10**9)) if digits <= most)
    return [f"s:{shape(core)}", f"d:{bucket}", f"n:{min(len(core).bit_length(), 7)}",
            f"m:{int(mixed)}", f"q:{_CUE.get(core.lower().rstrip(':='), '')}",
            f"l:{token[:1] if token[:1] in '(+[' else ''}"]


def labelled_table(size: int = 400, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: token lists with tags, written by rule from a seed."""
    rng = random.Random(seed)
    syllables = "an ber ka lo mi ter sen du fra go hel is".split()

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def number(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def email() -> list[str]:
        name, host, end = word(), word(), rng.choice(("com", "org", "net", "example"))
        return rng.choice(([f"{name}@{host}.{end}"], [name, "@", f"{host}.{end}"],
                           [f"{name}.{number(2)}@{host}{number(1)}.{word()}.{end}"],
                           [f"{name}@{host}", f".{end}"]))

    def address() -> list[str]:
        return [".".join(str(rng.randint(0, 255)) for _ in range(4))]

    def card() -> list[str]:
        return rng.choice(([number(16)], [number(4) for _ in range(4)],
                           [".".join(number(4) for _ in range(4))],
                           ["-".join(number(4) for _ in range(4))]))

    def phone() -> list[str]:
        return rng.choice(([f"({number(3)})", f"{number(3)}-{number(4)}"],
                           ["+1", f"({number(3)})", f"{number(3)}-{number(4)}"],
                           [f"{number(3)}-{number(3)}-{number(4)}"], [f"+{number(11)}"],
                           [f"00{number(2)}", number(3), number(7)]))

    def secret() -> list[str]:
        small, numerals = "abcdefghijklmnopqrstuvwxyz", "0123456789"
        signs = rng.choice((numerals + "abcdef", numerals + small.upper(),
                            numerals + small + small.upper()))
        key = "".join(rng.choice(signs) for _ in range(rng.choice((16, 18, 20, 24, 32, 40, 64))))
        return [rng.choice((f'"{key}"', key))]

    def other() -> list[str]:
        return rng.choice((
            [f'{{"{word()}":"{word()}",'], [f'"{word()}":{number(3)},'], [f"{word()}={number(2)};"],
            [str(rng.randint(1900, 2030))], [f"{rng.randint(1, 9)}.{rng.randint(0, 9)}"],
            [number(rng.randint(1, 3))], [f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.2021"],
            [f"2021-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}"], [f"v{rng.randint(1, 9)}"],
            [f"{rng.randint(1, 23)}:{number(2)}"], [f"{number(3)},{number(3)}"], [number(6)],
            [f"https://{word()}.example.org/{number(3)}"], [f"{number(2)}%"], [f"p.{number(2)}"],
            [f"{word()}{number(1)}"], [f"{number(1)}", f"{number(2)}", number(1)], ["@" + word()],
            [f"{rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}"], [number(9)]))

    makers = {"email": email, "ip": address, "card": card, "phone": phone, "secret": secret}
    cues = {"email": "mail", "ip": "net", "card": "pay", "phone": "call", "secret": "key"}
    out = []
    for k in range(size):
        tokens = [word() for _ in range(rng.randint(1, 4))]
        tags = ["O"] * len(tokens)
        for _ in range(rng.randint(1, 2)):
            kind = rng.choice((*FIELD_KINDS, "O", "O", "O"))
            made = makers[kind]() if kind != "O" else other()
            if kind != "O" and rng.random() < (0.8 if kind == "secret" else 0.4):
                cue = rng.choice(_CUES[cues[kind]])
                lead = [cue] if kind != "secret" else rng.choice(([cue, "="], [f"{cue}="], [f'{{"{cue}":']))
                tokens += lead
                tags += ["O"] * len(lead)
            if rng.random() < 0.3:
                made[-1] += rng.choice(".,;")
            tokens += made
            tags += ["O"] * len(made) if kind == "O" else [f"B-{kind}"] + [f"I-{kind}"] * (
                len(made) - 1)
            more = [word() for _ in range(rng.randint(0, 3))]
            tokens += more
            tags += ["O"] * len(more)
        out.append(_cut(tokens, tags))
    return out


def _cut(words: list[str], tags: list[str]) -> tuple[list[str], list[str]]:
    """Tags of words as tags of the words' tokens; separators at a word's edges are outside."""
    out: tuple[list[str], list[str]] = ([], [])
    for word, tag in zip(words, tags):
        parts = _TOKEN.findall(word)
        inner = [k for k, x in enumerate(parts) if not re.fullmatch(_SEPARATOR, x)] or [0]
        for k, part in enumerate(parts):
            inside = tag != "O" and inner[0] <= k <= inner[-1]
            out[0].append(part)
            out[1].append("O" if not inside else tag if k == inner[0] else "I" + tag[1:])
    return out


@dataclass
class Field:
    """Weights of the chain: (features x tags), (tags x tags) and the first tag's."""

    names: dict[str, int]
    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray

    def rows(self, tokens: list[str]) -> list[list[int]]:
        """Numbers of the known features at each token: its own and its neighbours'."""
        own = [token_features(t) for t in tokens]
        edge = ["s:^", "q:"]
        out = []
        for k, mine in enumerate(own):
            before = own[k - 1] if k else edge
            after = own[k + 1] if k + 1 < len(own) else edge
            names = ["b", *mine, *("<" + f for f in before), *(">" + f for f in after)]
            out.append([self.names[f] for f in names if f in self.names])
        return out

    def vectors(self, features: list[str]) -> np.ndarray:
        """What a token's features add to its own emission, its successor's and its predecessor's."""
        return np.stack([self.emit[[self.names[mark + f] for f in features
                                    if mark + f in self.names]].sum(axis=0) for mark in ("", "<", ">")])


class Decoder:
    """Viterbi over whole texts, with the vectors of tokens met before."""

    def __init__(self, field: Field) -> None:
        self.field = field
        move = field.move
        # The most that a tag gains over O by the move from the tag before, and by the one to the
        # tag after (none after the last), for every set of tags possible there: sets as bits.
        sets = (np.arange(1 << len(TAGS))[:, None] >> np.arange(len(TAGS)) & 1).astype(bool)
        self.into = np.where(sets[:, :, None], move - move[:, [0]], -np.inf).max(axis=1)
        onward = np.where(sets[:, None, :], move - move[[0]], -np.inf).max(axis=2)
        self.onward = np.maximum(onward, 0) + 1e-9
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.kinds: dict[tuple[str, ...], int] = {}
        edge = self.field.vectors(["s:^", "q:"])
        self.known, self.table = [edge], edge[None]

    def kind(self, token: str) -> int:
        """The number of the token's features; those that the training did not meet add nothing."""
        names = self.field.names
        features = tuple(f for f in token_features(token) if f in names)
        k = self.kinds.get(features)
        if k is None:
            k = self.kinds[features] = len(self.known)
            vectors = self.field.vectors([*features])
            vectors[0] += self.field.emit[names["b"]]
            self.known.append(vectors)
        return k

    def numbers(self, texts: list[list[str]]) -> np.ndarray:
        """The kinds of all tokens, with 0 before, between and after the texts."""
        if len(self.number) > CACHED:
            self.number = {}
        number, out = self.number, [0]
        for tokens in texts:
            for t in tokens:
                k = number.get(t)
                if k is None:
                    k = number[t] = self.kind(t)
                out.append(k)
            out.append(0)
        if len(self.table) < len(self.known):
            self.table = np.stack(self.known)
        return np.array(out)

    def emission(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Emissions of the tokens at the given places; an edge is outside."""
        table = self.table
        return table[ids[at], 0] + table[ids[at - 1], 1] + table[ids[np.minimum(
            at + 1, len(ids) - 1)], 2]

    def open_places(self, ids: np.ndarray) -> np.ndarray:
        """Whether a token's tag depends on others: the first of a text, and those not outside for
        certain.

        A tag is impossible if its emission falls short of O's by more than it can gain from any
        possible tags around it (nothing after a text's last token). What is found impossible at a
        token narrows its neighbours' in the next round.
        """
        possible = np.where(ids == 0, 1, (1 << len(TAGS)) - 1)
        inner = np.flatnonzero(ids[1:-1] * ids[:-2]) + 1  # tokens with one before
        bits = 1 << np.arange(len(TAGS))
        for _ in range(ROUNDS):
            for k in range(0, len(inner), PADDED):
                at = inner[k:k + PADDED]
                emit = self.emission(ids, at)
                reach = self.into[possible[at - 1]] + self.onward[possible[at + 1]]
                possible[at] &= (emit[:, :1] - emit <= reach) @ bits
            inner = inner[possible[inner] > 1]
        return possible > 1

    def decode(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The best path of each text."""
        ids = self.numbers(texts)
        tags = np.zeros(len(ids), np.int8)
        free = np.diff(self.open_places(ids).astype(np.int8), append=0)
        starts, ends = np.flatnonzero(free == 1) + 1, np.flatnonzero(free == -1) + 1
        order = np.argsort(ends - starts, kind="stable")
        sizes = (ends - starts)[order].tolist()
        first = 0
        while first < len(order):  # stretches of like length together, bounded padding
            last = first + 1
            while last < len(order) and (last + 1 - first) * sizes[last] <= PADDED:
                last += 1
            some = order[first:last]
            self._stretches(ids, tags, starts[some], ends[some])
            first = last
        edges = np.flatnonzero(ids == 0)
        return [tags[a + 1:b] for a, b in zip(edges, edges[1:])]

    def _stretches(self, ids: np.ndarray, tags: np.ndarray, starts: np.ndarray,
                   ends: np.ndarray) -> None:
        """Viterbi over stretches between certain tokens (tag O) or edges; writes their tags."""
        move, sizes = self.field.move, ends - starts
        longest = int(sizes.max())
        back = np.zeros((len(starts), longest, len(TAGS)), np.int8)
        opening = np.where((ids[starts - 1] == 0)[:, None], self.field.first, move[0])
        best = opening + self.emission(ids, starts)
        for t in range(1, longest):
            step = best[:, :, None] + move
            back[:, t] = step.argmax(axis=1)
            new = step.max(axis=1) + self.emission(ids, np.minimum(starts + t, ends - 1))
            best = np.where((t < sizes)[:, None], new, best)
        tag = (best + np.where((ids[ends] == 0)[:, None], 0, move[:, 0])).argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            inside = np.flatnonzero(t < sizes)
            tags[starts[inside] + t] = tag[inside]
            if t:
                tag[inside] = back[inside, t, tag[inside]]


def train(table: list[tuple[list[str], list[str]]], rounds: int = 100, rate: float = 0.1,
          decay: float = 1e-3) -> Field:
    """Maximum likelihood with forward and backward sums over the whole table, by Adam."""
    names: dict[str, int] = {}
    field = Field(names, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    for tokens, _ in table:
        own = [token_features(t) for t in tokens]
        for mine in own + [["s:^", "q:"]]:
            for f in ("b", *mine):
                for mark in ("", "<", ">"):
                    names.setdefault(mark + f, len(names))
    s, n = len(TAGS), len(table)
    sizes = np.array([len(t) for t, _ in table])
    longest = sizes.max()
    rows = [field.rows(tokens) for tokens, _ in table]
    where = [(k, t, f) for k, r in enumerate(rows) for t, at in enumerate(r) for f in at]
    wk, wt, wf = map(np.array, zip(*where))
    gold = np.zeros((n, longest, s))
    for k, (_, tags) in enumerate(table):
        for t, tag in enumerate(tags):
            gold[k, t, TAGS.index(tag)] = 1
    gold_move = np.einsum("kts,ktr->sr", gold[:, :-1], gold[:, 1:])
    weights = np.zeros(len(names) * s + s * s + s)
    first_m, second_m = np.zeros_like(weights), np.zeros_like(weights)

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)

    for k in range(1, rounds + 1):
        emit_w = weights[:len(names) * s].reshape(-1, s)
        move = weights[len(names) * s:-s].reshape(s, s)
        emit = np.zeros((n, longest, s))
        np.add.at(emit, (wk, wt), emit_w[wf])
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0] + weights[-s:]
        for t in range(1, longest):
            new = log_sum(alpha[:, t - 1][:, :, None] + move, 1) + emit[:, t]
            alpha[:, t] = np.where((t < sizes)[:, None], new, alpha[:, t - 1])
        total = log_sum(alpha[:, -1], 1)
        expected_move = np.zeros((s, s))
        for t in range(longest - 2, -1, -1):
            ahead = emit[:, t + 1] + beta[:, t + 1]
            inside = (t + 1 < sizes)[:, None]
            new = log_sum(move[None] + ahead[:, None, :], 2)
            beta[:, t] = np.where(inside, new, 0)
            pair = np.exp(alpha[:, t][:, :, None] + move + ahead[:, None, :]
                          - total[:, None, None])
            expected_move += (pair * inside[:, :, None]).sum(axis=0)
        mask = (np.arange(longest) < sizes[:, None])[:, :, None]
        gap = np.where(mask, np.exp(alpha + beta - total[:, None, None]), 0) - gold
        grad_emit = np.zeros((len(names), s))
        np.add.at(grad_emit, wf, gap[wk, wt])
        grad = np.concatenate([grad_emit.ravel(), (expected_move - gold_move).ravel(),
                               gap[:, 0].sum(axis=0)]) / n + decay * weights
        first_m, second_m = 0.9 * first_m + 0.1 * grad, 0.99 * second_m + 0.01 * grad**2
        weights -= rate * first_m / (1 - 0.9**k) / (np.sqrt(second_m / (1 - 0.99**k)) + 1e-8)
    return Field(names, weights[:len(names) * s].reshape(-1, s),
                 weights[len(names) * s:-s].reshape(s, s), weights[-s:])


def _field_spans(text: str, path: np.ndarray, places: list[tuple[int, int]]) -> Iterator[Span]:
    done = 0
    for k in np.flatnonzero(path).tolist():
        if k < done:
            continue
        kind, done = TAGS[path[k]][2:], k + 1
        while done < len(path) and TAGS[path[done]] == "I-" + kind:
            done += 1
        first, last = places[k][0], places[done - 1][1]
        part = text[first:last]
        first += len(part) - len(part.lstrip(_LEFT.replace("(", "")))
        last -= len(part) - len(part.rstrip(_RIGHT))
        digits = _NOT_DIGIT.sub("", text[first:last])
        # An address has an at sign; a number is a card's only if its check digit is right.
        if last - first > 3 and _MARK.search(text, first, last) and (
                kind != "email" or "@" in text[first:last]) and (
                kind != "card" or 13 <= len(digits) <= 19 and _luhn(digits)):
            yield kind, first, last


def all_spans(texts: list[str], decoder: Decoder) -> Iterator[tuple[list[Span], list[Span]]]:
    """The patterns' spans of each text, and the field's that touch none of them.

    A span of the field holds a digit or an at sign, so a text without any has none.
    """
    marked = [k for k, text in enumerate(texts) if _MARK.search(text)]
    paths = dict(zip(marked, decoder.decode([_TOKEN.findall(texts[k]) for k in marked])))
    for k, text in enumerate(texts):
        base, more = base_spans(text), []
        if k in paths and paths[k].any():
            taken = sorted((a, b) for _, a, b in base)
            starts = [a for a, _ in taken]
            longest = np.maximum.accumulate([b for _, b in taken]) if taken else []
            places = [m.span() for m in _TOKEN.finditer(text)]
            for kind, a, b in _field_spans(text, paths[k], places):
                n = int(np.searchsorted(starts, b)) - 1  # spans that begin before b
                if n < 0 or longest[n] <= a:
                    more.append((kind, a, b))
        yield base, more


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about CHARS characters."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(
        spans, key=lambda s: (FIELD_KINDS.index(s[0]), s[1], s[2])))


def _run(field: Field):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(field)
        for batch in batches:
            rows = []
            for some in _portions([x or "" for x in batch.column(1).to_pylist()]):
                for base, more in all_spans(some, decoder):
                    counts = [sum(s[0] == kind for s in base) for kind in KINDS]
                    rows.append((*counts, sha256(_joined(base).encode()).hexdigest(),
                                 _joined(base + more)))
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return over


def find_personal_data(docs: DataFrame, table=None) -> DataFrame:
    """Contract of op5, one row per document: doc_id, n_email, n_ip, n_card, n_phone (the
    patterns' spans), base_sha256, spans (all, the field's too).

    ``table`` is the labelled table, by default labelled_table(). A null text is empty and has no
    spans; repeated rows are scanned each; an empty table gives an empty result.
    """
    field = train(labelled_table() if table is None else table)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _run(field), "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string")
