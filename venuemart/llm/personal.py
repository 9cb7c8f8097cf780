"""Personal data by a semi-Markov conditional random field over the places where it can be.

Four kinds: e-mail addresses, IP addresses, card numbers and telephone numbers. Plain writings are found by their
patterns (the base). The field adds other writings: addresses with "at" and "dot" in words or brackets, defanged IP
addresses, cards in unusual groups, telephone numbers without a plus.

A text is first cut into zones, runs of digits and separators or the words around an at sign; nothing outside can
be in a span, so what happens in a zone decides itself. A zone is a row of atoms (digit runs, words, separators).
Every run of atoms up to `LONGEST` that could be an entity at all is a candidate, scored as a whole: its groups and
separators, checksums, prefixes, the words before it, its neighbours. Together with a weight for each pair of
successive labels this is the field; dynamic programming over ends and labels finds the best row of segments, so
boundaries and kinds are chosen jointly.

The weights are fitted by maximum likelihood on zones whose labels are known: base spans of a bounded sample of
documents rewritten in other ways where they stood, numbers of the sample that are no base span, and made-up
examples of both.
"""

from __future__ import annotations

import hashlib
import random
import re
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.llm.common import bounded, packed, stored, text_of, with_fields

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]
#: Atoms of the longest span.
LONGEST = 24
#: Documents that examples are taken from, and examples of each kind among them.
SAMPLE, EXAMPLES = 20_000, 80
#: Rounds of the fit, its step, and the weight of the squared weights.
ROUNDS, STEP, RIDGE = 40, 0.3, 0.02

_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Every base span but e-mail lies in one such run, and so does every candidate.
_ZONE = re.compile(r"[0-9+(][0-9 .()+\-/\[\]\xa0]{6,}")
_NUMBER_ATOM = re.compile(r"\[\.\]|\(\.\)|[0-9]+|.", re.S)
_AT_WORDS = "at|arroba|chez|ät"
_DOT_WORDS = "dot|punkt|punto|point"
_TRIGGER = re.compile(rf"@|[\[({{<] ?(?:{_AT_WORDS}) ?[\])}}>]|(?<![a-z])(?:{_DOT_WORDS})(?![a-z])", re.I)
_MAIL_ATOM = re.compile(
    rf"(?P<at>[\[({{<] ?(?:{_AT_WORDS}|@) ?[\])}}>]|@|(?<![^\W_])(?:{_AT_WORDS})(?![^\W_]))"
    rf"|(?P<dot>[\[({{<] ?(?:{_DOT_WORDS}|\.) ?[\])}}>]|\.|(?<![^\W_])(?:{_DOT_WORDS})(?![^\W_]))"
    r"|(?P<word>[A-Za-z0-9_+%-]+)|(?P<other>\S)",
    re.I,
)
#: How far a mail zone reaches to both sides of its trigger.
_REACH = 120
_WORD = re.compile(r"[^\W\d_]+")

CUES = {
    "phone": "tel phone telephone telefon téléphone teléfono telefono fax mobile mobil handy móvil portable call ring dial whatsapp ruf anrufen llame appelez".split(),
    "card": "card cards visa mastercard amex karte kreditkarte tarjeta carte credit debit pay".split(),
    "ip": "ip host server node router gateway dns ping adresse".split(),
    "email": "mail email contact write reach kontakt correo courriel send an".split(),
    "count": "order invoice isbn issn page pages year years no nr number id ref version section chapter total sum code date from to seite año página numéro nummer bestellung pedido commande".split(),
}
_CUE_OF = {w: kind for kind, words in CUES.items() for w in words}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that do not overlap; each character is looked at a bounded number of times."""
    end, before, at = 0, 0, text.find("@")
    while at >= 0:
        floor = max(end, before)
        start = floor + len(text[floor:at].rstrip(_LOCAL))
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            end = host.end()
        before, at = at + 1, text.find("@", max(at + 1, end))


def _digits(text: str) -> int:
    return sum(map(text.count, "0123456789"))


def base_in_zone(zone: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the plain writings in a zone."""
    found = []
    for m in _IP.finditer(zone):
        if _octets(m.group().split(".")):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(zone):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    if "+" in zone:
        for m in _PHONE.finditer(zone):
            if 9 <= _digits(m.group()) <= 15:
                found.append((m.start(), m.end(), 3))
    return found


@dataclass
class Row:
    """A row of atoms: where each starts and ends, and the candidates (first atom, last atom + 1, label, value).

    The value is what the reader makes of a candidate's label and features: themselves, or its score.
    """

    starts: list[int]
    ends: list[int]
    arcs: list[tuple[int, int, int, object]]


Reader = Callable[[int, list[str]], object]


def as_they_are(label: int, features: list[str]) -> list[str]:
    return features


def _before(text: str, at: int) -> list[str]:
    """Features of the words before a place."""
    words = _WORD.findall(text[max(0, at - 40) : at].lower())[-3:]
    cues = {_CUE_OF[w] for w in words if w in _CUE_OF}
    return [f"cue {c}" for c in sorted(cues)] or ["no cue"]


def number_row(text: str, start: int, end: int, read: Reader = as_they_are) -> Row | None:
    """Atoms and candidates of text[start:end], a part of a zone without base spans."""
    atoms = [(m.start() + start, m.end() + start) for m in _NUMBER_ATOM.finditer(text[start:end])]
    parts = [text[a:b] for a, b in atoms]
    number = [p[0] in "0123456789" for p in parts]
    arcs, n = [], len(parts)
    cues = _before(text, start)
    for i in range(n):
        if not (number[i] or (parts[i] in "+(" and i + 1 < n and (number[i + 1] or parts[i + 1] == "("))):
            continue
        groups, gaps, gap, digits = [], [], "", 0
        for j in range(i, min(n, i + LONGEST)):
            if not number[j]:
                gap += parts[j]
                if len(gap) > 4:
                    break
                continue
            gaps.append(gap)
            gap = ""
            groups.append(parts[j])
            digits += len(parts[j])
            if digits > 19 or len(groups) > 7:
                break
            if digits >= 4:
                arcs += [(*x[:3], read(x[2], x[3])) for x in _number_arcs(text, atoms, i, j + 1, groups, gaps, digits, cues)]
    return Row([a for a, _ in atoms], [b for _, b in atoms], arcs) if arcs else None


def _number_arcs(text, atoms, i, j, groups, gaps, digits, cues):
    """The candidates that atoms i to j can be, with their features."""
    inner, lead = gaps[1:], gaps[0]
    kinds = []
    if len(groups) == 4 and all("." in g and g.strip(" ") in (".", "[.]", "(.)") for g in inner) and not lead and _octets(groups):
        kinds.append(1)
    if 12 <= digits <= 19 and not lead:
        kinds.append(2)
    if 7 <= digits <= 15:
        kinds.append(3)
    if not kinds:
        return []
    start, end = atoms[i][0], atoms[j - 1][1]
    marks = {c for g in inner for c in g}
    shape = "-".join(str(len(g)) for g in groups)
    before, after = text[start - 1 : start] if start else "", text[end : end + 1]
    near = re.search(r"[0-9][ .()\-/\[\]\xa0]{0,2}$", text[max(0, start - 3) : start]), re.match(r"[ .()\-/\[\]\xa0]{0,2}[0-9]", text[end : end + 3])
    common = [
        f"shape {shape}" if len(groups) > 1 else f"one run of {digits}",
        f"groups {min(len(groups), 6)}",
        "marks " + "".join(sorted(marks)),
        f"lead {lead}{groups[0][:1] if groups[0][0] == '0' else ''}",
        "bracket" if "(" in lead or "(" in "".join(inner) else "no bracket",
        "even groups" if len({len(g) for g in groups}) == 1 else "uneven groups",
        "digits before" if near[0] else "starts alone",
        "digits after" if near[1] else "ends alone",
        "letter beside" if (before.isalnum() or after.isalnum()) else "free",
        "spans more" if any(len(g) > 2 for g in inner) else "close",
        *cues,
    ]
    whole = "".join(groups)
    checked = {1: ["octets"], 2: ["luhn" if luhn(whole) else "no luhn", f"first {whole[0]}"], 3: [f"digits {digits}", "zeros" if whole.startswith("00") else "no zeros"]}
    if re.fullmatch(r"(19|20)\d\d", groups[0]) or re.fullmatch(r"(19|20)\d\d", groups[-1]):
        common.append("year")
    return [(i, j, k + 1, common + checked[k]) for k in kinds]


def mail_row(text: str, start: int, end: int, read: Reader = as_they_are) -> Row | None:
    """Atoms and candidates around at signs; text[start:end] holds no base span."""
    found = [(m.lastgroup, m.start() + start, m.end() + start) for m in _MAIL_ATOM.finditer(text[start:end])]
    kind = [k for k, _, _ in found]
    for k, (name, a, b) in enumerate(found):
        # A full stop with a blank on one side only ends a sentence.
        if name == "dot" and text[a:b] == "." and text[a - 1 : a].isspace() != text[b : b + 1].isspace():
            kind[k] = "other"
    arcs, n = [], len(found)
    for at in range(1, n - 3):
        if kind[at] != "at" or kind[at - 1] != "word":
            continue
        # Host: a word, then dots and words by turns.
        lasts, k = [], at + 1
        while k + 2 < n and k - at < LONGEST - 2 and kind[k] == "word" and kind[k + 1] == "dot" and kind[k + 2] == "word":
            lasts.append(k + 3)
            k += 2
        firsts, k = [at - 1], at - 1
        while k >= 2 and at - k < LONGEST // 2 and kind[k - 1] == "dot" and kind[k - 2] == "word":
            k -= 2
            firsts.append(k)
        for i in firsts:
            cues = _before(text, found[i][1])
            for j in lasts:
                if j - i <= LONGEST:
                    arcs.append((i, j, 1, read(1, _mail_features(text, found, i, at, j, j == lasts[-1], i == firsts[-1]) + cues)))
    return Row([a for _, a, _ in found], [b for _, _, b in found], arcs) if arcs else None


def _mail_features(text, found, i, at, j, last, first):
    sign = text[found[at][1] : found[at][2]].lower()
    dots = [text[a:b].lower() for k, a, b in found[at:j] if k == "dot"]
    tail = text[found[j - 1][1] : found[j - 1][2]]
    spaced = text[found[at][1] - 1] == " " or text[found[at][2] : found[at][2] + 1] == " "
    local = text[found[i][1] : found[at][1]].strip()
    return [
        "at " + ("sign" if sign == "@" else "bracket" if sign[0] in "[({<" else "word"),
        "dots " + " ".join(sorted({"sign" if d == "." else "bracket" if d[0] in "[({<" else "word" for d in dots})),
        "at spaced" if spaced else "at close",
        "dots spaced" if any(text[found[k][2] : found[k][2] + 1] == " " for k in range(at, j) if found[k][0] == "dot" and text[found[k][1] : found[k][2]] == ".") else "dots close",
        f"tail {min(len(tail), 6)}" if tail.isalpha() else "tail odd",
        "tail capital" if tail[:1].isupper() and not tail.isupper() else "tail plain",
        "last" if last else "not last",
        "first" if first else "not first",
        f"parts {min((j - at) // 2, 4)}",
        "local digits" if any(c.isdigit() for c in local) else "local plain",
        "local capital" if local[:1].isupper() and not local.isupper() else "local small",
        f"host {min(found[at + 1][2] - found[at + 1][1], 4)}",
    ]


def _gaps(start: int, end: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of start..end that no span covers."""
    at = start
    for a, b, _ in sorted(spans):
        if b > at:
            if a > at:
                yield at, min(a, end)
            at = b
        if at >= end:
            return
    if at < end:
        yield at, end


def rows_of(text: str, base: list[tuple[int, int, int]] | None = None, read: Reader = as_they_are) -> Iterator[Row]:
    """Every row of the text that has a candidate. `base` receives the base spans."""
    spans = [] if base is None else base
    mails = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    spans += mails
    ends = [b for _, b, _ in mails]
    for m in _ZONE.finditer(text):
        own = [(a + m.start(), b + m.start(), k) for a, b, k in base_in_zone(m.group())]
        spans += own
        inside, k = own, bisect_right(ends, m.start())
        while k < len(mails) and mails[k][0] < m.end():
            inside, k = [*inside, mails[k]], k + 1
        for a, b in _gaps(m.start(), m.end(), inside) if inside else [m.span()]:
            if b - a > 6 and _digits(text[a:b]) >= 4:
                row = number_row(text, a, b, read)
                if row:
                    yield row
    taken, zones = sorted(spans), []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - _REACH), min(len(text), m.end() + _REACH)
        if zones and a <= zones[-1][1]:
            zones[-1][1] = b
        else:
            zones.append([a, b])
    k = 0
    for a, b in zones:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        held, j = [], k
        while j < len(taken) and taken[j][0] < b:
            held.append(taken[j])
            j += 1
        for x, y in _gaps(a, b, held):
            row = mail_row(text, x, y, read)
            if row:
                yield row


class Field:
    """The field: a weight for each (label, feature) and for each pair of successive labels."""

    def __init__(self, names: dict[str, int], weights: np.ndarray):
        self.names, self.weights = names, weights
        size = len(LABELS)
        self.pairs = weights[: size * size].reshape(size, size)
        self._list, self._pairs = weights.tolist(), self.pairs.tolist()

    def score(self, label: int, features: list[str]) -> float:
        get, held = self.names.get, self._list
        return sum(held[k] for f in features if (k := get(f"{label} {f}")) is not None)

    def best(self, row: Row) -> list[tuple[int, int, int]]:
        """(first atom, last atom + 1, label) of the segments of the best labelling, by the scores of the arcs."""
        n, size, low = len(row.starts), len(LABELS), float("-inf")
        into: dict[int, list] = {}
        for i, j, label, own in row.arcs:
            into.setdefault(j, []).append((i, label, own))
        total, start, past = array("d", [low]) * (size * (n + 1)), array("i", [0]) * (size * (n + 1)), array("b", [0]) * (size * (n + 1))
        total[0] = 0.0
        pairs = self._pairs
        for j in range(1, n + 1):
            at = size * j
            for i, label, own in [(j - 1, 0, 0.0), *into.get(j, ())]:
                for before in range(size):
                    value = total[size * i + before] + pairs[before][label] + own
                    if value > total[at + label]:
                        total[at + label], start[at + label], past[at + label] = value, i, before
        label, j, out = max(range(size), key=lambda k: total[size * n + k]), n, []
        while j:
            k = size * j + label
            if label:
                out.append((start[k], j, label))
            j, label = start[k], past[k]
        return out[::-1]

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans and added spans: (start, end, kind)."""
        base: list[tuple[int, int, int]] = []
        added = [(row.starts[i], row.ends[j - 1], label - 1) for row in rows_of(text, base, self.score) for i, j, label in self.best(row)]
        # No candidate touches a base span. A mail and a number may claim the same characters: the earlier stays, then the longer.
        kept, end = [], -1
        for a, b, k in sorted(added, key=lambda s: (s[0], -s[1])):
            if a >= end:
                kept.append((a, b, k))
                end = b
        return base, kept


def likelihood(weights: np.ndarray, rows: list, names: dict[str, int]) -> tuple[float, np.ndarray]:
    """Log likelihood of the labelled rows (arcs as (i, j, label, features' numbers), gold segments), and its slope."""
    size = len(LABELS)
    pairs, slope, total = weights[: size * size].reshape(size, size), np.zeros_like(weights), 0.0
    moved = slope[: size * size].reshape(size, size)
    for n, arcs, gold in rows:
        own = [float(weights[f].sum()) for _, _, _, f in arcs]
        ending, starting = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
        for a, (i, j, label, _) in enumerate(arcs):
            ending[j].append((i, label, own[a]))
            starting[i].append((j, label, own[a]))
        ahead, back = np.full((n + 1, size), -np.inf), np.full((n + 1, size), -np.inf)
        ahead[0, 0] = 0.0
        for j in range(1, n + 1):
            ahead[j, 0] = np.logaddexp.reduce(ahead[j - 1] + pairs[:, 0])
            for i, label, score in ending[j]:
                ahead[j, label] = np.logaddexp(ahead[j, label], np.logaddexp.reduce(ahead[i] + pairs[:, label]) + score)
        back[n] = 0.0
        for i in range(n - 1, -1, -1):
            back[i] = back[i + 1, 0] + pairs[:, 0]
            for j, label, score in starting[i]:
                back[i] = np.logaddexp(back[i], pairs[:, label] + score + back[j, label])
        whole = float(np.logaddexp.reduce(ahead[n]))
        # Expected segments leave the slope, true ones enter it.
        for j in range(1, n + 1):
            moved[:, 0] -= np.exp(ahead[j - 1] + pairs[:, 0] + back[j, 0] - whole)
        for a, (i, j, label, f) in enumerate(arcs):
            share = np.exp(ahead[i] + pairs[:, label] + own[a] + back[j, label] - whole)
            moved[:, label] -= share
            slope[f] -= share.sum()
        held, at, past, true = {(arcs[a][0]): a for a in gold}, 0, 0, 0.0
        while at < n:
            if at in held:
                _, end, label, f = arcs[held[at]]
                true += own[held[at]]
                slope[f] += 1.0
            else:
                end, label = at + 1, 0
            true += pairs[past, label]
            moved[past, label] += 1.0
            at, past = end, label
        total += true - whole
    return total, slope


def fit_field(examples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = ROUNDS) -> Field:
    """Fit to (text, true spans), on the rows that the text's candidates make."""
    size = len(LABELS)
    names: dict[str, int] = {}
    rows = []
    for text, spans in examples:
        true = set(spans)
        for row in rows_of(text):
            arcs, gold = [], []
            for i, j, label, features in row.arcs:
                numbers = [names.setdefault(f"{label} {f}", size * size + len(names)) for f in features]
                if (row.starts[i], row.ends[j - 1], label - 1) in true:
                    gold.append(len(arcs))
                arcs.append((i, j, label, np.array(numbers)))
            rows.append((len(row.starts), arcs, gold))
    weights = np.zeros(size * size + len(names))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for k in range(1, rounds + 1):
        slope = likelihood(weights, rows, names)[1] - RIDGE * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights = weights + STEP * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return Field(names, weights)


# Examples


def _card_digits(rng: random.Random, size: int) -> str:
    body = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(size - 2))
    return next(body + c for c in "0123456789" if luhn(body + c))


def _number(rng: random.Random, size: int) -> str:
    return rng.choice("123456789") + "".join(rng.choice("0123456789") for _ in range(size - 1))


def rewritten(rng: random.Random, kind: int, plain: str | None = None) -> str:
    """Another writing of a base span, or of a made-up one, that the patterns do not find."""
    if kind == 0:
        local, _, host = (plain or f"{rng.choice(['ana', 'jo.lee', 'info', 'm_king', 'p7'])}@{rng.choice(['mail', 'example', 'uni-x'])}.{rng.choice(['com', 'org', 'co.uk', 'de', 'net'])}").partition("@")
        at, dot = rng.choice([(" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", "."), ("[at]", "[dot]"), (" AT ", " DOT "), ("{at}", "{dot}"), (" @ ", " . "), (" arroba ", " punto "), ("(at)", ".")])
        local = local.strip("._%+-") or "info"
        return local.replace(".", dot if " dot" in dot and rng.random() < 0.5 else ".") + at + host.replace(".", dot)
    if kind == 1:
        parts = plain.split(".") if plain else [str(rng.randrange(256)) for _ in range(4)]
        return rng.choice(["[.]", "(.)", " . "]).join(parts)
    if kind == 2:
        digits = re.sub(r"\D", "", plain) if plain else _card_digits(rng, 16)
        groups = [digits[:4], digits[4:10], digits[10:]] if len(digits) == 15 else [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return rng.choice([".", "/", "\xa0", "  ", " - "]).join(groups)
    digits = re.sub(r"\D", "", plain)[-10:] if plain else _number(rng, 10)
    digits = digits.rjust(10, "2")
    a, b, c = digits[:3], digits[3:6], digits[6:]
    forms = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"({a}) {b} {c}", f"001 {a} {b} {c}", f"0049 {a} {b}{c}", f"{a}.{b}.{c}", f"0{a[:2]}/{b}{c}", f"0{a[0]} {a[1:]} {b[:2]} {c[:2]} {c[2:]}", f"(0{a}) {b}{c}"]
    return rng.choice(forms)


def distractor(rng: random.Random) -> str:
    """Numbers and words that are no personal data."""
    d = rng.randrange
    number = _number(rng, d(7, 20))
    while 12 <= len(number) <= 19 and luhn(number):
        number = _number(rng, d(7, 20))
    return rng.choice(
        [
            number,
            number,
            f"{d(1900, 2030)}-{d(1, 13):02}-{d(1, 29):02}",
            f"{d(1, 29):02}.{d(1, 13):02}.{d(1900, 2030)}",
            f"{d(1, 13):02}/{d(1, 29):02}/{d(1900, 2030)} {d(24):02}",
            f"{d(1900, 2030)}-{d(1, 13):02}-{d(1, 29):02} {d(24):02}.{d(60):02}",
            f"{d(1900, 2000)}-{d(2000, 2030)}",
            " ".join(str(d(1900, 2030)) for _ in range(d(2, 6))),
            " ".join(str(d(100)) for _ in range(d(4, 12))),
            f"{d(100)}.{_number(rng, 6)} {d(100)}.{_number(rng, 6)}",
            f"{d(10)}.{_number(rng, d(6, 14))}",
            f"978-{d(1, 9)}-{_number(rng, 2)}-{_number(rng, 6)}-{d(10)}",
            f"{_number(rng, 8)} {_number(rng, 6)}",
            f"({d(1900, 2030)}) {d(10, 99)}-{d(100, 999)}",
            f"{_number(rng, 3)} {_number(rng, 3)} {_number(rng, 3)}",
            f"{d(300, 900)} . {d(300)} . {d(300)}",
            "meet at noon. Dot com",
            "we look at dot matrix prints",
            f"{d(10)} apples @ {d(90)} . each",
            "they point at it. then stop",
            "all at home. Then out",
        ]
    )


_FILLER = "the of and in to was or la de el und der le les thing ion ando".split()


def made_examples(rng: random.Random, seen: list[tuple[str, str, str, int]], each: int = EXAMPLES) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled texts. `seen` are (before, span, after, kind) of the corpus, kind -1 for numbers of no kind.

    Spans of the corpus are written anew where they stood; made-up ones fill up each kind.
    """
    out = []

    def put(before: str, span: str, after: str, kind: int) -> None:
        text = f"{before}{span}{after}"
        # The neighbours keep what they are: only the new span is labelled.
        out.append((text, [(len(before), len(before) + len(span), kind)] if kind >= 0 else []))

    for kind in range(len(KINDS)):
        own = [s for s in seen if s[3] == kind][:each]
        for before, span, after, _ in own:
            left = before if not before or before[-1] in " \n" else before + " "
            put(left, rewritten(rng, kind, span), after if after[:1] in (" ", "\n", "") else " " + after, kind)
        for _ in range(each):
            cue = rng.choice(CUES[KINDS[kind]]) + rng.choice([": ", " "]) if rng.random() < 0.6 else ""
            left = " ".join(rng.choices(_FILLER, k=4)) + rng.choice([" ", ". ", "\n"]) + cue
            after = rng.choice([" ", ". ", "\n", ", "]) + " ".join(rng.choices(_FILLER, k=4))
            if kind == 3 and rng.random() < 0.3:
                # With other numbers behind it the plain pattern runs on and fails.
                d = _number(rng, 10)
                put(left, rng.choice([f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}", f"+49 {d[:3]} {d[3:]}", f"+44-{d[:4]}-{d[4:]}"]), f" {rng.choice([_number(rng, 16), rewritten(rng, 1).replace('[', '').replace(']', '')])}{after}", kind)
                continue
            put(left, rewritten(rng, kind), after, kind)
    for before, span, after, _ in [s for s in seen if s[3] < 0][: 2 * each]:
        put(before, span, after, -1)
    for _ in range(4 * each):
        cue = rng.choice(CUES["count"]) + " " if rng.random() < 0.5 else ""
        put(" ".join(rng.choices(_FILLER, k=4)) + " " + cue, distractor(rng), " " + " ".join(rng.choices(_FILLER, k=4)), -1)
    return out


def _seen(text: str) -> Iterator[tuple[str, str, str, int]]:
    """Base spans with what stands around them, and numbers of no kind."""
    base: list[tuple[int, int, int]] = []
    rows = [r for r in rows_of(text, base) if r.arcs]
    for a, b, k in base:
        yield text[max(0, a - 40) : a], text[a:b], text[b : b + 40], k
    for r in rows:
        a, b = r.starts[0], r.ends[-1]
        if b - a < 80 and re.fullmatch(r"[0-9]+", text[a:b].strip()):
            yield text[max(0, a - 40) : a], text[a:b], text[b : b + 40], -1


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, each: int = EXAMPLES, seed: int = 47) -> Field:
    """The field, fitted to examples from at most `sample` documents and to made-up ones.

    From the sample at most 2 x `each` places of each kind go to the driver, those with the smallest hashes.
    """
    base = docs.select(F.xxhash64(F.col(id_col), text_of(text_col)).alias("key"), text_of(text_col).alias("text"))
    kept = bounded(base, "key", sample)

    def run(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held = list(_seen(text))
                if held:
                    columns = list(zip(*held, strict=True))
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in columns[:3]], pa.array(columns[3], pa.int32())], ["a", "span", "b", "kind"])

    places = stored(kept.mapInArrow(run, "a string, span string, b string, kind int"), "places")
    seen: list = []
    for kind in range(-1, len(KINDS)):
        few = places.where(F.col("kind") == kind).distinct().orderBy(F.xxhash64("a", "span", "b"), "a", "span", "b").limit(2 * each)
        seen += [(r.a, r.span, r.b, r.kind) for r in few.collect()]
    return fit_field(made_examples(random.Random(seed), seen, each))


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def find(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """Rows of docs as struct `row`, with n_email, n_ip, n_card, n_phone (base), base_sha256, spans and `found`.

    `found` has all spans as structs (kind, start, end, base) in code points; `spans` is the same as text, by
    start, then kind. Null and empty texts have none. Added spans overlap neither base spans nor each other. Rows
    are independent, so repeated rows, null ids and other columns, whatever their names, change nothing.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)
    base = packed(docs, text=text_of(text_col))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])
    fields = [*[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("found", T.ArrayType(span))]
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches):
        own = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                counts, marks, written, found = [[] for _ in KINDS], [], [], []
                for text in part.column("text").to_pylist():
                    plain, added = own.spans(text)
                    for k, held in enumerate(counts):
                        held.append(sum(s[2] == k for s in plain))
                    marks.append(hashlib.sha256(_written(plain).encode()).hexdigest())
                    written.append(_written(plain + added))
                    both = sorted([(*s, True) for s in plain] + [(*s, False) for s in added], key=lambda s: (s[0], s[2], s[1]))
                    found.append([{"kind": KINDS[k], "start": a, "end": b, "base": p} for a, b, k, p in both])
                columns = [part.column("row"), *[pa.array(c, pa.int64()) for c in counts], pa.array(marks), pa.array(written, pa.string()), pa.array(found, arrow)]
                yield pa.RecordBatch.from_arrays(columns, ["row", *[f.name for f in fields]])

    return base.mapInArrow(run, with_fields(T.StructType([base.schema["row"]]), *fields))
