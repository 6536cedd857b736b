"""Operator 2, personal data by a semi-Markov conditional random field.

Plain patterns find the base spans. Beside them, runs of up to SPAN tokens around digits, at-signs and written ats and dots
are segments; features of a whole segment score it as each kind, a transition scores two kinds that touch, and dynamic
programming chooses boundaries and kinds together. What a segment looks like is for the features to say, not a condition:
only what can be no kind is left out, namely less than 7 characters, and words other than dot without an at among them. The
weights are fitted by conditional likelihood on generated contexts and on a bounded sample of documents, in which base
spans are also rewritten in other common forms.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
from bisect import bisect_left
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
#: Tokens of a segment at most, characters at least; segments that are scored at once.
SPAN, SHORT, SCORED = 24, 7, 1 << 15
#: Documents that contexts for fitting are taken from, those with the least hashes; base spans of a kind, and other runs of
#: digits, that a document gives at most; contexts generated.
SAMPLE, EACH, MADE = 2000, 2, 900

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_DIGITS = re.compile("[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def base(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start. Each search is linear in the text."""
    out = []
    at, low = text.find("@"), 0
    while at >= 0:
        i = at
        while i > low and text[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(text, at + 1) if i < at else None
        low = m.end() if m else at + 1
        if m:
            out.append((0, i, low))
        at = text.find("@", low)
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(d) <= 19 and luhn(d):
                    out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


_TOKEN = re.compile(r"[^\W_]+|\S")
_CUE = re.compile(r"[0-9]+|@|[\[(]at[\])]|\bdot\b", re.I)
#: Signs that may stand within a segment.
_INSIDE = "+().-@[]_%:"


def _upto(x: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(x)))


class Tokens:
    """A text's tokens, with sums of what they are up to each, so that a feature of any run of them is a difference."""

    def __init__(self, text: str):
        spans = [m.span() for m in _TOKEN.finditer(text)]
        self.words = words = [text[a:b] for a, b in spans]
        self.start, self.end = (np.array(x, np.int64) for x in (zip(*spans) if spans else ((), ())))
        size = self.end - self.start
        is_ = lambda test: np.fromiter(map(test, words), bool, len(words))
        self.alnum = is_(lambda w: w[0].isalnum())
        self.group = is_(lambda w: w.isascii() and w.isdigit())
        digits = np.where(self.group, size, [0 if w.isalpha() else len(_DIGIT.findall(w)) for w in words]).astype(np.int64)
        at, dot = is_(lambda w: w == "@" or w.lower() == "at"), is_(lambda w: w == "." or w.lower() == "dot")
        said = (at | dot) & self.alnum
        bracket = is_(lambda w: w in "()[]")
        self.gap = np.concatenate(([9], self.start[1:] - self.end[:-1])) if len(words) else np.zeros(0, np.int64)
        before = lambda x: np.concatenate(([False], x[:-1])) if len(x) else x
        spaced = self.gap == 1
        loose = spaced & ~(said | bracket | before(said | bracket))
        byte = self.group & is_(lambda w: len(w.lstrip("0")) <= 3 and (not w.strip("0") or int(w.lstrip("0")) <= 255) if w.isascii() and w.isdigit() else False)
        joined = np.flatnonzero([c.isdigit() and c.isascii() for w in words for c in w]) if len(words) else ()
        plain = np.frombuffer("".join(_DIGIT.findall("".join(words))).encode(), np.uint8).astype(np.int64) - 48
        assert len(joined) == len(plain)
        twice = 2 * plain - 9 * (plain > 4)
        even = np.arange(len(plain)) % 2 == 0
        #: Sums for the check digit, by the parity of the last digit's place.
        self.luhn = [_upto(np.where(even == (p == 0), plain, twice)) for p in (0, 1)]
        self.sums = {
            "digits": digits, "letters": np.where(self.alnum & ~said, size - digits, 0), "groups": self.group, "four": self.group & (size == 4), "two": self.group & (size == 2),
            "to4": self.group & (size <= 4), "to1": self.group & (size == 1), "byte": byte, "at": at, "dot": dot, "hyphen": is_(lambda w: w == "-"), "colon": is_(lambda w: w == ":"),
            "paren": is_(lambda w: w in "()"), "square": is_(lambda w: w in "[]"), "plus": is_(lambda w: w == "+"), "spaced": spaced, "loose": loose,
        }
        self.sums = {k: _upto(v) for k, v in self.sums.items()}
        self.size = size
        self.first = np.array([w[0] for w in words], "<U1") if words else np.zeros(0, "<U1")
        self.nought = is_(lambda w: w[0] == "0")
        self.noughts = is_(lambda w: w[:2] == "00")
        self.suffix = is_(lambda w: w.isascii() and w.isalpha() and len(w) >= 2)
        self.cue = (digits > 0) | (at & ~self.alnum) | is_(lambda w: w.lower() == "dot") | (at & self.alnum & before(bracket))
        self.fit = self.alnum | is_(lambda w: w in _INSIDE)
        # Digits that touch, or stand a space or a sign away.
        joiner = is_(lambda w: w in ".-/:,")
        near = np.concatenate((self.gap[1:] <= 1, [False])) if len(words) else np.zeros(0, bool)
        after = np.concatenate((self.group[1:], [False])) if len(words) else np.zeros(0, bool)
        tight = np.concatenate((self.gap[1:] == 0, [False])) if len(words) else np.zeros(0, bool)
        after2, tight2 = (np.concatenate((x[1:], [False])) if len(words) else x for x in (after, tight))
        joiner_after = np.concatenate((joiner[1:], [False])) if len(words) else joiner
        self.more_right = (near & after) | (tight & joiner_after & tight2 & after2)
        b1 = before(self.group)
        self.more_left = ((self.gap <= 1) & b1) | ((self.gap == 0) & before(joiner) & before(self.gap == 0) & before(b1))

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """(first token, token after the last) of every segment."""
        n = len(self.words)
        cues = np.flatnonzero(self.cue)
        if not len(cues):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        i = np.arange(n)
        breaks = np.append(np.flatnonzero(~self.fit | (self.gap > 1)), n)
        stop = np.minimum(breaks[np.searchsorted(breaks, i, "right")], i + SPAN)
        place = np.searchsorted(cues, i)
        cue = np.where(place < len(cues), cues[np.minimum(place, len(cues) - 1)], n)
        inside = (self.gap == 0) & np.concatenate(([False], self.alnum[:-1] | np.isin(self.first[:-1], ["@", "_", "."])))
        open_ = self.fit & (self.alnum | np.isin(self.first, ["+", "("])) & ~inside
        many = np.where(open_, np.maximum(0, stop - cue), 0)
        a = np.repeat(i, many)
        b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(cue, many) + 1
        s = self.sums
        of = lambda k: s[k][b] - s[k][a]
        keep = self.alnum[b - 1] & (self.end[b - 1] - self.start[a] >= SHORT) & ((of("letters") == 0) | (of("at") > 0))
        return a[keep], b[keep]

    def features(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of whole segments, a row each."""
        s = self.sums
        v = {k: x[b] - x[a] for k, x in s.items()}
        for k in ("spaced", "loose"):
            v[k] = s[k][b] - s[k][a + 1]
        d, g, letters = v["digits"], v["groups"], v["letters"]
        parity = (s["digits"][b] - 1) % 2
        luhn = np.where(parity == 0, self.luhn[0][s["digits"][b]] - self.luhn[0][s["digits"][a]], self.luhn[1][s["digits"][b]] - self.luhn[1][s["digits"][a]]) % 10 == 0
        ats = np.append(np.flatnonzero(np.diff(s["at"])), len(self.words) - 1)
        at = ats[np.searchsorted(ats[:-1], a)]
        dots_after = np.where(v["at"] > 0, s["dot"][b] - s["dot"][np.minimum(at + 1, b)], 0)
        last = b - 1
        bare = letters == 0
        signs = v["colon"] + v["plus"] + v["paren"]
        mail = (v["at"] == 1) & (dots_after >= 1) & (v["loose"] == 0) & self.suffix[last] & self.alnum[a] & (v["colon"] == 0)
        quad = bare & (g == 4) & (v["byte"] == 4) & (v["dot"] == 3) & (v["hyphen"] + signs + v["at"] == 0)
        grouped = (g >= 2) & (v["four"] - (self.size[last] == 4) == g - 1)
        only = bare & (v["at"] == 0) & (v["dot"] < 2 + (g > 2))
        blocks = v["to4"] == g
        kinds_of_signs = (v["dot"] > 0).astype(int) + (v["hyphen"] > 0) + (v["spaced"] > 0) + (v["colon"] > 0)
        cols = [
            np.ones(len(a)), mail, mail & (d == 0), mail & (letters > d), v["at"] == 1, v["at"] > 1, dots_after >= 1, v["loose"] > 0, ~bare, ~bare & ~mail,
            quad, bare & (v["dot"] == 3) & ~quad, quad & (v["square"] == 0) & (v["spaced"] > 0),
            luhn & (d >= 13) & (d <= 19) & bare, luhn & (d >= 16) & (d <= 19) & bare & (g == 1), luhn & (d >= 13) & (d <= 19) & only & grouped, (d >= 13) & (d <= 19) & ~luhn, d == 16,
            d < 7, (d >= 7) & (d <= 8), (d >= 9) & (d <= 10) & only, (d == 10) & only, (d == 11) & only, (d >= 12) & (d <= 15) & only, d > 15, d > 19,
            only & (g == 1), only & (g == 2), only & (g == 3), only & (g == 4), only & (g == 5), only & (g > 5), only & blocks & (d >= 9) & (d <= 15), only & blocks & (g >= 3) & (d >= 9) & (d <= 15),
            only & (self.first[a] == "+"), only & (self.first[a] == "+") & (d >= 8) & (d <= 15), only & (self.first[a] == "("), only & (self.first[a] == "(") & (d >= 9) & (d <= 12), only & self.nought[a], only & self.nought[a] & (d >= 9) & (d <= 11),
            only & self.noughts[a] & (d >= 10), only & (v["two"] >= g - 1) & (g >= 4), only & (v["two"] == g) & (g == 5) & self.nought[a], only & (v["to1"] > 1), v["colon"] > 0, v["plus"] > 1, kinds_of_signs > 1,
            only & (v["hyphen"] == g - 1) & (g > 2), only & (v["spaced"] == g - 1) & (g > 2), only & (v["dot"] == g - 1) & (g > 2), only & (v["paren"] == 2), only & (self.size[last] == 4) & (g > 2),
            self.more_left[a], self.more_right[last], np.minimum(b - a, SPAN) / 10.0, np.minimum(d, 24) / 10.0,
        ]
        return np.stack(cols, axis=1).astype(np.float32)


#: Weights: of features by kind, and of kinds by what touches them on the left (0 for nothing, then the kinds).
Weights = tuple[np.ndarray, np.ndarray]


def scored(t: Tokens, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments (first, after the last) and their scores by kind."""
    a, b = t.segments()
    out = [t.features(a[x : x + SCORED], b[x : x + SCORED]) @ weights[0] for x in range(0, len(a), SCORED)]
    return a, b, np.concatenate(out) if out else np.zeros((0, len(KINDS)))


def best(a: np.ndarray, b: np.ndarray, scores: np.ndarray, touch: np.ndarray) -> list[tuple[int, int, int]]:
    """The best choice of segments that do not overlap, as (first, after the last, kind): Viterbi, state the kind that ends here.

    A token outside scores nothing, so a segment that gains nothing, whatever it touches, is passed over at once.
    """
    room = 2 * max(0.0, float(touch.max()))
    some = np.flatnonzero(scores.max(axis=1) + room > 0) if len(scores) else ()
    ends: list[int] = []  # ascending, with the best total of all that ends there or before
    tops: list[tuple] = []
    at: dict[int, dict[int, tuple]] = {}  # end: kind: (total, chain)
    for x in sorted(some, key=lambda x: (b[x], a[x])):
        i, j = int(a[x]), int(b[x])
        free = bisect_left(ends, i)  # what ends before i leaves a token outside
        outside = tops[free - 1] if free else (0.0, None)
        for k in range(len(KINDS)):
            total, chain = outside[0] + scores[x, k] + touch[0, k], outside[1]
            for p, (own, link) in at.get(i, {}).items():
                if own + scores[x, k] + touch[1 + p, k] > total:
                    total, chain = own + scores[x, k] + touch[1 + p, k], link
            here = at.setdefault(j, {})
            if k not in here or total > here[k][0]:
                here[k] = (total, (i, j, k, chain))
        top = max(at[j].values(), key=lambda y: y[0])
        if tops and tops[-1][0] >= top[0]:
            top = tops[-1]
        if ends and ends[-1] == j:
            tops[-1] = top
        else:
            ends.append(j)
            tops.append(top)
    out, link = [], tops[-1][1] if tops and tops[-1][0] > 0 else None
    while link:
        i, j, k, link = link
        out.append((i, j, k))
    return out[::-1]


def decode(text: str, weights: Weights) -> list[tuple[int, int, int]]:
    """The best segmentation: (kind, start, end)."""
    t = Tokens(text)
    return [(k, int(t.start[i]), int(t.end[j - 1])) for i, j, k in best(*scored(t, weights), weights[1])]


def find(text: str, weights: Weights) -> tuple[list, list]:
    """Base spans, and all spans: base ones and those of the field that overlap none of them; by kind, then start."""
    own = base(text)
    if not _CUE.search(text):
        return own, own
    taken = sorted((s, e) for _, s, e in own)
    starts, reach = [s for s, _ in taken], np.maximum.accumulate([e for _, e in taken]) if taken else []
    more = []
    for k, s, e in decode(text, weights):
        x = bisect_left(starts, e)
        if not x or reach[x - 1] <= s:
            more.append((k, s, e))
    return own, sorted(own + more)


def _forms(kind: int, value: str, rng: random.Random) -> str:
    """The value in another form that people use."""
    if kind == 0:
        at, dot = rng.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), (" [at] ", ".")])
        return value.replace("@", at).replace(".", dot)
    if kind == 1:
        return value.replace(".", rng.choice(["[.]", "(.)", " dot ", "[dot]"]))
    d = "".join(_DIGIT.findall(value))
    if kind == 2:
        return rng.choice([".", "-", " ", ""]).join(d[i : i + 4] for i in range(0, len(d), 4))
    d = d[-10:].rjust(10, "5")
    if rng.random() < 0.5:
        return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}){}-{}", "{} {} {}"]).format(d[:3], d[3:6], d[6:])
    sign = rng.choice(" .- ")
    pairs = [d[i : i + 2] for i in range(2, 10, 2)]
    return rng.choice(
        [
            "0" + d[1] + sign + sign.join(pairs), f"0{d[1:4]}{sign}{d[4:7]}{sign}{d[6:]}", f"(0{d[1:4]}) {d[4:7]} {d[6:]}", f"0{d[1:4]} {d[4:]}", f"00{d[:2]}{sign}{d[2:4]}{sign}{d[4:7]}{sign}{d[6:]}",
            f"+{d[:2]} {d[2:4]} {d[4:7]} {d[6:]}", f"00{d[:2]} {d[2]} {' '.join(pairs)}",
        ]
    )


def _value(kind: int, rng: random.Random) -> str:
    if kind == 0:
        return "".join(rng.choice("abcdeimnorst") for _ in range(rng.randint(3, 8))) + rng.choice(["", ".x", "_q", "7", ".42"]) + "@" + rng.choice(["mail", "post", "corp"]) + str(rng.randint(1, 9)) + rng.choice([".example.com", ".org", ".net"])
    if kind == 1:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        head = "".join(rng.choice("0123456789") for _ in range(15))
        return next(head + c for c in "0123456789" if luhn(head + c))
    return f"+{rng.randint(1, 99)} ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"


def _unchecked(digits: str) -> str:
    """Digits that fail the check."""
    return digits if not luhn(digits) else digits[:-1] + str((int(digits[-1]) + 1) % 10)


def _other(rng: random.Random) -> str:
    """Numbers and signs that are nobody's."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return rng.choice(
        [
            f"20{n(2)}-0{rng.randint(1, 9)}-1{n(1)}", f"{n(2)}:{n(2)}:{n(2)}", f"{n(1)},{n(3)}.{n(2)}", f"{n(1)}.{n(1)}.{n(2)}", f"{n(4)} {n(4)}", f"v{n(1)}.{n(1)}.{n(1)}.rc{n(1)}", n(6), n(12), f"{n(3)} {n(3)}",
            f"{n(4)} {n(4)} {n(4)} {n(4)} {n(4)} {n(2)}", " ".join(str(rng.randint(1900, 2030)) for _ in range(rng.randint(2, 5))), " ".join(str(rng.randint(1, 99)) for _ in range(rng.randint(3, 7))), ", ".join(n(3) for _ in range(4)),
            f"20{n(2)}-0{rng.randint(1, 9)}-1{n(1)} {n(2)}:{n(2)}:{n(2)}", f"0.{n(3)} 0.{n(3)} 0.{n(4)}", f"{n(5)}-{n(5)}-{n(5)}", f"10.{n(4)}/{n(3)}", f"{n(7)}", f"{n(9)}", _unchecked(n(16)), f"section {n(1)}.{n(1)}.{n(1)}.{n(1)}{n(3)}",
            "".join(rng.choice("0123456789abcdef") for _ in range(24)), f"{rng.randint(256, 999)}.{n(3)}.{n(3)}.{n(3)}", f"{n(4)}.{n(2)}.{n(2)}", f"meet at {n(2)} dot", f"@{rng.choice(['team', 'all', 'home'])}", f"{n(2)} at {n(2)}", f"isbn 978-{n(1)}-{n(4)}-{n(3)}-{n(1)}",
        ]
    )


Context = tuple[str, list[tuple[int, int, int]]]


def _put(before: str, kind: int | None, value: str, after: str) -> Context:
    return before + value + after, [] if kind is None else [(kind, len(before), len(before) + len(value))]


def taken(text: str, seed: int) -> list[Context]:
    """Contexts of a document: around base spans, also in other forms, and around other numbers where it has none."""
    rng, out = random.Random(seed), []
    spans, left = base(text), [EACH] * len(KINDS)
    for k, s, e in spans:
        if left[k] and sum(a < e and s < b for _, a, b in spans) == 1 and not _CUE.search(text[max(0, s - 40) : s]) and not _CUE.search(text[e : e + 40]):
            left[k] -= 1
            before, after = text[max(0, s - 40) : s], text[e : e + 40]
            out += [_put(before, k, text[s:e], after), _put(before, k, _forms(k, text[s:e], rng), after)]
    for m in islice(_DIGITS.finditer(text), 0 if spans else EACH):
        out.append(_put(text[max(0, m.start() - 40) : m.start()], None, text[m.start() : m.end() + 40], ""))
    return out


def generated(seed: int = 11) -> list[Context]:
    rng, out = random.Random(seed), []
    word = lambda: "".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 7)))

    def prose() -> str:
        """Words, some of them an at or at the end of a sentence."""
        n = rng.choice([2, 2, 3, 6, 14])
        return " ".join(rng.choice(["at", word() + ".", word() + ",", f"{rng.randint(1, 9)}.{rng.randint(0, 9)}"]) if n > 3 and rng.random() < 0.2 else word() for _ in range(n))

    for i in range(MADE):
        before, after = prose() + " " + word() + " ", rng.choice(["", ",", "."]) + " " + word() + " " + prose()
        if i % 3 == 0:
            out.append(_put(before, None, _other(rng), after))
        else:
            k = rng.randrange(4)
            v = _value(k, rng)
            out.append(_put(before, k, _forms(k, v, rng) if i % 3 == 1 else v, after))
    return out


def contexts(texts: list[str], seed: int = 11) -> list[Context]:
    """Texts with their true spans: taken from documents, and generated."""
    return [c for n, t in enumerate(texts) for c in taken(t, seed + n)] + generated(seed)


class Chains:
    """Contexts side by side: their segments and features, and sums over all segmentations, forward and backward, of all at once."""

    def __init__(self, made: list[Context]):
        rows, self.nodes, self.base, self.length = [], 0, [], []
        a, b, own, of = [], [], [], []
        for text, gold in made:
            t = Tokens(text)
            i, j = t.segments()
            true = {(s, e): k for k, s, e in gold}
            kinds = [true.get((int(t.start[x]), int(t.end[y - 1])), -1) for x, y in zip(i, j)]
            if not len(i) or (gold and max(kinds) < 0):
                continue
            rows.append(t.features(i, j))
            a.append(i + self.nodes)
            b.append(j + self.nodes)
            own += kinds
            of += [len(self.base)] * len(i)
            self.base.append(self.nodes)
            self.length.append(len(t.words))
            self.nodes += len(t.words) + 1
        self.base, self.length, self.of = np.array(self.base, np.int64), np.array(self.length, np.int64), np.array(of, np.int64)
        self.a, self.b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        self.x = np.concatenate(rows).astype(float) if rows else np.zeros((0, Tokens("0").features(np.zeros(1, int), np.ones(1, int)).shape[1]), np.float32)
        self.gold = np.array(own, np.int64)

    def sums(self, scores: np.ndarray, touch: np.ndarray):
        """ahead and behind (nodes x states; state 0 outside, then the kinds) of the scores, and each context's total."""
        e, t = np.exp(np.clip(scores, -30, 30)), np.exp(touch)
        ahead, behind = np.zeros((self.nodes, 1 + len(KINDS))), np.zeros((self.nodes, 1 + len(KINDS)))
        ahead[self.base, 0], behind[self.base + self.length] = 1, 1
        till, since = self.b - self.base[self.of], self.a - self.base[self.of]
        by_end, by_start = np.argsort(till, kind="stable"), np.argsort(since, kind="stable")
        most = int(self.length.max(initial=0))
        ends, starts = np.searchsorted(till[by_end], np.arange(most + 2)), np.searchsorted(since[by_start], np.arange(most + 2))
        for k in range(1, most + 1):
            here = self.base[self.length >= k] + k
            ahead[here, 0] = ahead[here - 1].sum(axis=1)
            s = by_end[ends[k] : ends[k + 1]]
            np.add.at(ahead[:, 1:], self.b[s], e[s] * (ahead[self.a[s]] @ t))
        for k in range(most - 1, -1, -1):
            here = self.base[self.length > k] + k
            behind[here] = behind[here + 1, :1]
            s = by_start[starts[k] : starts[k + 1]]
            np.add.at(behind, self.a[s], (e[s] * behind[self.b[s], 1:]) @ t.T)
        return ahead, behind, ahead[self.base + self.length].sum(axis=1)


def learn(made: list[Context], rounds: int = 100) -> Weights:
    """Weights of greatest conditional likelihood, by gradient steps."""
    c = Chains(made)
    w, touch = np.zeros((c.x.shape[1], len(KINDS))), np.zeros((1 + len(KINDS), len(KINDS)))
    w[0] = -2.0
    gold = np.zeros((len(c.gold), len(KINDS)))
    gold[np.flatnonzero(c.gold >= 0), c.gold[c.gold >= 0]] = 1
    seen_w, seen_t = np.full(w.shape, 1e-6), np.full(touch.shape, 1e-6)
    for _ in range(rounds):
        scores = c.x @ w
        ahead, behind, total = c.sums(scores, touch)
        e = np.exp(np.clip(scores, -30, 30)) * behind[c.b, 1:] / total[c.of][:, None]
        grad = c.x.T @ (gold - e * (ahead[c.a] @ np.exp(touch))) - 0.02 * w
        # No context has two kinds that touch: their transitions are what the sums say against them.
        grad_t = -(ahead[c.a].T @ e) * np.exp(touch) - 0.02 * touch
        grad_t[0] = 0
        seen_w, seen_t = seen_w + grad**2, seen_t + grad_t**2
        w, touch = w + 0.8 * grad / np.sqrt(seen_w), touch + 0.8 * grad_t / np.sqrt(seen_t)
    return w, touch


def fit(texts: list[str]) -> Weights:
    return learn(contexts(texts))


def fitted(docs: DataFrame) -> Weights:
    """learn() in one task, from generated contexts and those of SAMPLE documents, which are taken where the documents lie."""
    import pyarrow as pa

    rows = docs.select("text", F.xxhash64("doc_id", "text").alias("h")).filter(F.col("text").rlike("[0-9@]"))
    least = common.collect(rows.select("h").distinct().orderBy("h").limit(SAMPLE).agg(F.max("h")))[0][0]

    def take(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([json.dumps(taken(t, h)) for t, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], pa.string())], ["h", "made"])

    def run(batches):
        made = sorted((h, m) for b in batches for h, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        w, touch = learn([(t, [tuple(x) for x in gold]) for _, m in made for t, gold in json.loads(m)] + generated())
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes(), touch.tobytes()], pa.binary())], ["raw"])

    if least is None:
        return learn(generated())
    made = rows.filter(F.col("h") <= least).mapInArrow(take, "h bigint, made string").dropDuplicates(["h"])
    w, touch = (np.frombuffer(r["raw"]).reshape(-1, len(KINDS)) for r in common.collect(made.repartition(1).mapInArrow(run, "raw binary")))
    return w, touch


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """A row a document: doc_id, n_email, n_ip, n_card, n_phone of the base spans, base and spans as text, and n_more.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. Rows are independent of each other, so
    equal texts give equal spans; only doc_id and text are read. An empty table gives no rows.
    """
    import pyarrow as pa

    weights = fitted(docs) if weights is None else weights
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for b in common.sliced(batches):
            counts, first, every, more = [[] for _ in KINDS], [], [], []
            for text in b.column(1).to_pylist():
                own, spans = find(text or "", weights)
                for k, c in enumerate(counts):
                    c.append(sum(x[0] == k for x in own))
                first.append(_written(own))
                every.append(_written(spans))
                more.append(len(spans) - len(own))
            cols = [b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(first, pa.string()), pa.array(every, pa.string()), pa.array(more, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans", "n_more"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string, n_more bigint")


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs).withColumn("base_sha256", F.sha2(F.col("base").cast("binary"), 256)).drop("base")


def blank(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; spans that overlap are one, named by the first."""
    out, at = [], 0
    for s, k, e in sorted((s, k, e) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced, all columns kept; n_chars, if there, counts the new text.

    Null texts stay null, empty ones empty; equal texts are blanked alike; an empty table gives no rows.
    """
    import pyarrow as pa

    weights = fitted(docs)
    place = docs.columns.index("text")

    def run(batches):
        for b in common.sliced(batches):
            texts = [None if t is None else blank(t, find(t, weights)[1]) for t in b.column(place).to_pylist()]
            yield b.set_column(place, "text", pa.array(texts, pa.string()))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def sha(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
