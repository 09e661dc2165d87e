"""Verbatim measures to numbers in common units.

A measure is a text such as ``49d22m0s S``, ``1,263 km`` or ``409 - 429 ft``. Its
numbers are cut out; what stands between them are *unit strings*. Each unit string is
segmented by dynamic programming over a trie of qualifiers, prefixes, roots and
exponents, and every segmentation is scored with the prior of the field's dimension
(a bare ``m`` is a metre in an elevation and a minute in a latitude). The best joint
reading of all unit strings of a value is its plan. Plans depend on the shape of the
text only (digits do not matter), so they are cached by shape.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

# --- fixed values: unit vocabulary -------------------------------------------------
#: prefix -> factor
PREFIXES = {"k": 1000.0, "kilo": 1000.0, "h": 100.0, "hecto": 100.0, "d": 0.1, "deci": 0.1, "c": 0.01, "centi": 0.01, "m": 0.001, "milli": 0.001, "µ": 1e-6, "micro": 1e-6}
#: root -> [(dimension, factor, takes a prefix)]
ROOTS = {
    "m": [("length", 1.0, True), ("minute", 1.0, False)],
    "metre": [("length", 1.0, True)], "metres": [("length", 1.0, True)], "meter": [("length", 1.0, True)], "meters": [("length", 1.0, True)],
    "metern": [("length", 1.0, True)], "metro": [("length", 1.0, True)], "metros": [("length", 1.0, True)], "mètre": [("length", 1.0, True)], "mètres": [("length", 1.0, True)],
    "mtr": [("length", 1.0, False)], "mtrs": [("length", 1.0, False)], "mts": [("length", 1.0, False)],
    "kilómetro": [("length", 1000.0, False)], "kilómetros": [("length", 1000.0, False)], "kilomètre": [("length", 1000.0, False)], "kilomètres": [("length", 1000.0, False)],
    "ft": [("length", 0.3048, False)], "foot": [("length", 0.3048, False)], "feet": [("length", 0.3048, False)], "fuß": [("length", 0.3048, False)], "fuss": [("length", 0.3048, False)],
    "pie": [("length", 0.3048, False)], "pies": [("length", 0.3048, False)], "pied": [("length", 0.3048, False)], "pieds": [("length", 0.3048, False)],
    "yd": [("length", 0.9144, False)], "yds": [("length", 0.9144, False)], "yard": [("length", 0.9144, False)], "yards": [("length", 0.9144, False)],
    "in": [("inch", 0.0254, False)], "inch": [("inch", 0.0254, False)], "inches": [("inch", 0.0254, False)],
    "°": [("degree", 1.0, True)], "º": [("degree", 1.0, True)], "˚": [("degree", 1.0, True)], "â°": [("degree", 1.0, False)], "âº": [("degree", 1.0, False)],
    "d": [("degree", 1.0, False)], "deg": [("degree", 1.0, True)], "degs": [("degree", 1.0, False)], "degree": [("degree", 1.0, True)], "degrees": [("degree", 1.0, True)],
    "grad": [("gon", 0.9, False)], "grads": [("gon", 0.9, False)], "gon": [("gon", 0.9, True)], "gons": [("gon", 0.9, True)], "gr": [("gon", 0.9, False)], "grade": [("gon", 0.9, False)], "grades": [("gon", 0.9, False)],
    "'": [("minute", 1.0, False), ("length", 0.3048, False)],
    "min": [("minute", 1.0, False)], "mins": [("minute", 1.0, False)], "minute": [("minute", 1.0, False)], "minutes": [("minute", 1.0, False)],
    "''": [("second", 1.0, False)], '"': [("second", 1.0, False)], "s": [("second", 1.0, False), ("south", -1.0, False)], "sec": [("second", 1.0, False)], "secs": [("second", 1.0, False)], "second": [("second", 1.0, False)], "seconds": [("second", 1.0, False)],
    "n": [("north", 1.0, False)], "north": [("north", 1.0, False)], "south": [("south", -1.0, False)],
    "e": [("east", 1.0, False)], "east": [("east", 1.0, False)], "w": [("west", -1.0, False)], "west": [("west", -1.0, False)],
    ":": [("colon", 1.0, False)], "-": [("dash", 1.0, False)], "to": [("dash", 1.0, False)], "bis": [("dash", 1.0, False)], "à": [("dash", 1.0, False)], "hasta": [("dash", 1.0, False)],
}
#: words that say nothing of the unit
QUALIFIERS = ("ca", "ca.", "c.", "c", "circa", "about", "approx", "approx.", "approximately", "around", "etwa", "env", "env.", "environ", "aprox", "aprox.", "~", "≈", "±", "elev", "elev.", "elevation", "alt", "alt.", "altitude", "height", "höhe", "lat", "lat.", "latitude", "long", "long.", "lon", "lon.", "longitude", "a.s.l.", "a.s.l", "asl", "above sea level", "ü.m.", "ü. m.", "ü.nn", "ü. nn", "snm", "s.n.m.", "s.n.m", "s. n. m.", "s.l.m.", "s.m.", "s. l. m.", ".", ",", ";", "(", ")", "[", "]", " ")
#: exponent -> power
EXPONENTS = {"²": 2, "³": 3, "^2": 2, "^3": 3, "2": 2, "3": 3}
#: field -> dimension -> prior (log weight)
ANGLE = {"degree": 0.0, "gon": -0.5, "minute": 0.0, "second": 0.0, "colon": 0.0, "dash": -0.5, "length": -9.0, "inch": -9.0}
PRIORS = {
    "latitude": ANGLE | {"north": 0.0, "south": -0.2, "east": -6.0, "west": -6.0},
    "longitude": ANGLE | {"east": 0.0, "west": -0.2, "north": -6.0, "south": -6.0},
    "elevation": {"length": 0.0, "inch": -2.0, "dash": 0.0, "minute": -9.0, "second": -9.0, "degree": -9.0, "gon": -9.0, "colon": -9.0, "north": -9.0, "south": -9.0, "east": -9.0, "west": -9.0},
}
#: factors of the units that a provider may declare
PROVIDER_UNITS = {"degree": 1.0, "microdegree": 1e-6, "gon": 0.9, "metre": 1.0, "foot": 0.3048}
LIMITS = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0), "elevation": (-500.0, 9000.0)}
# -----------------------------------------------------------------------------------

SIDES = {"north", "south", "east", "west"}
_QUOTES = str.maketrans({"′": "'", "’": "'", "‘": "'", "´": "'", "`": "'", "ʹ": "'", "″": '"', "”": '"', "“": '"', "–": "-", "—": "-", "−": "-", "‐": "-", "‑": "-", "μ": "µ", " ": " ", " ": " ", " ": " ", "\t": " "})
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
_DIGITS = re.compile(r"\d+")
_SPACES = re.compile(r"\s+")


class Trie:
    """Words with their entries; ``ends(text, at)`` gives each (end, entry)."""

    def __init__(self, words: dict):
        self.root: dict = {}
        for word, entry in words.items():
            node = self.root
            for ch in word:
                node = node.setdefault(ch, {})
            node.setdefault("", []).append(entry)

    def ends(self, text: str, at: int):
        node = self.root
        for i in range(at, len(text)):
            node = node.get(text[i])
            if node is None:
                return
            for entry in node.get("", ()):
                yield i + 1, entry


PREFIX_TRIE, ROOT_TRIE = Trie(PREFIXES), Trie(ROOTS)
QUALIFIER_TRIE, EXPONENT_TRIE = Trie({q: q for q in QUALIFIERS}), Trie(EXPONENTS)


@dataclass(frozen=True)
class Unit:
    dimension: str
    factor: float


@lru_cache(maxsize=20_000)
def segmentations(text: str, field: str, keep: int = 6) -> tuple:
    """The best ``keep`` readings of a unit string as (score, units), best first.

    best[i] holds the best readings of text[:i]. A step is a qualifier, or a root with
    an optional prefix before and exponent behind. Each step costs 1, so that few long
    pieces win over many short ones; letters that belong to no piece cost 4 each (a word
    of another language), and a piece may not begin or end within a word unless what
    stands beside it is another piece.
    """
    n = len(text)
    best: list[list] = [[] for _ in range(n + 1)]
    best[0] = [(0.0, ())]
    prior = PRIORS[field]

    def add(i: int, score: float, units: tuple) -> None:
        if all(u != units or s < score for s, u in best[i]):
            best[i] = sorted([*(x for x in best[i] if x[1] != units), (score, units)], key=lambda x: -x[0])[:keep]

    for i in range(n):
        for score, units in list(best[i]):
            for j, q in QUALIFIER_TRIE.ends(text, i):
                word = q[0].isalpha()
                if not word or ((i == 0 or not text[i - 1].isalpha() or units) and (j == n or not text[j].isalpha())):
                    add(j, score - (1.0 if word else 0.01), units)
            starts = [(i, 1.0, False), *((j, f, True) for j, f in PREFIX_TRIE.ends(text, i))]
            for at, factor, prefixed in starts:
                for j, entries in ROOT_TRIE.ends(text, at):
                    for dimension, size, takes in entries:
                        if prefixed and not takes:
                            continue
                        ends = [(j, 1), *EXPONENT_TRIE.ends(text, j)]
                        for end, power in ends:
                            cost = 1.0 + 0.5 * prefixed + 6.0 * (power != 1) - prior.get(dimension, -9.0)
                            if end < n and text[end].isalpha() and text[end - 1].isalpha():
                                cost += 2.0  # glued to further letters
                            add(end, score - cost, (*units, Unit(dimension, (factor * size) ** power)))
            add(i + 1, score - (4.0 if text[i].isalpha() else 2.0), units)
    return tuple(best[n])


@dataclass(frozen=True)
class Plan:
    """How the numbers of one shape are read. parts: (number index, factor) to add up;
    kind: 'sum', 'range', 'packed', 'bare'; sign: of the side or the minus."""

    kind: str
    parts: tuple
    sign: int
    sexagesimal: bool


def _angle_plan(readings, count: int, minus: bool) -> tuple[float, Plan] | None:
    """Score and plan of one joint reading of the strings between the numbers of a
    coordinate; readings[k] stands before number k, the last behind all."""
    sides = [u for units in readings for u in units if u.dimension in SIDES]
    if len(sides) > 1:
        return None
    sign = (-1 if minus else 1) * (int(sides[0].factor) if sides else 1)
    if any(u.dimension not in SIDES for u in readings[0]):
        return None
    marks = []
    for units in readings[1:]:
        own = [u for u in units if u.dimension not in SIDES]
        if len(own) > 1:
            return None
        marks.append(own[0] if own else None)
    kinds = [m.dimension if m else "" for m in marks]
    if count == 1:
        if kinds[0] in ("degree", "gon"):
            return 0.0, Plan("sum", ((0, marks[0].factor),), sign, False)
        return (0.0, Plan("packed" if sides else "bare", ((0, 1.0),), sign, False)) if kinds[0] == "" else None
    if count > 3:
        return None
    want = ("degree", "minute", "second")[:count]
    explicit = all(k == w for k, w in zip(kinds[:-1], want)) and kinds[-1] in (want[-1], "")
    plain = all(k == kinds[0] for k in kinds[:-1]) and kinds[0] in ("colon", "dash", "") and kinds[-1] == ""
    if not (explicit or plain):
        return None
    return (-0.5 if kinds[-1] == "" and explicit else 0.0) + 0.7 * bool(sides), Plan("sum", tuple((k, 60.0**-k) for k in range(count)), sign, True)


def _length_plan(readings, count: int, minus: bool) -> tuple[float, Plan] | None:
    """The same of an elevation: one number, or a range of two."""
    if count > 2 or readings[0] and any(u.dimension != "dash" for u in readings[0]):
        return None
    marks = []
    for k, units in enumerate(readings[1:]):
        own = [u for u in units if u.dimension == "length"]
        dashes = [u for u in units if u.dimension == "dash"]
        if len(own) > 1 or len(own) + len(dashes) != len(units) or len(dashes) != (1 if k < count - 1 else 0):
            return None
        marks.append(own[0].factor if own else None)
    if count == 1:
        sign = -1 if minus else 1
        return 0.0, Plan("bare" if marks[0] is None else "sum", ((0, marks[0] or 1.0),), sign, False)
    last = marks[1]
    first = marks[0] if marks[0] is not None else last
    last = last if last is not None else first
    return 0.0, Plan("range" if last is not None else "bare range", ((0, first or 1.0), (1, last or 1.0)), -1 if minus else 1, False)


@lru_cache(maxsize=50_000)
def plan(shape: str, field: str) -> Plan | None:
    """The best joint reading of a shape (its numbers are ``0``); None if there is none."""
    pieces = shape.split("0")
    count = len(pieces) - 1
    if count < 1 or count > 4:
        return None
    head = pieces[0].rstrip()
    minus = head.endswith("-") and not head[:-1].rstrip().endswith(tuple("nsew"))
    if minus:
        pieces[0] = head[:-1]
    if field != "elevation":  # a dash between a side and the number is no minus
        pieces[0] = pieces[0].rstrip(" -")
    options = [segmentations(p.strip(), field) for p in pieces]
    best = None
    make = _length_plan if field == "elevation" else _angle_plan
    for joint in product(*options):
        made = make([units for _, units in joint], count, minus)
        if made:
            score = made[0] + sum(s for s, _ in joint)
            if best is None or score > best[0]:
                best = (score, made[1])
    return best[1] if best else None


def tidy(text: str) -> str:
    """Lower case, one kind of quote and dash, no bracketed second value."""
    text = text.replace("Â°", "°").replace("Âº", "º").translate(_QUOTES)
    text = _SPACES.sub(" ", text.replace("''", '"').lower()).strip()
    cut = re.sub(r"[(\[][^)\]]*\d[^)\]]*[)\]]?", " ", text)
    return (cut if any(c.isdigit() for c in cut) else text).strip()


def read_measure(text: str | None, field: str, unit: str | None = None, mark: str | None = None) -> float | None:
    """The value of a measure in degrees or metres, or None if it is not readable.

    unit and mark are the provider's unit and decimal mark for numbers without a unit
    (None: degree or metre, and a decimal point). Null, empty and blank texts, texts
    without a number, minutes or seconds of 60 or more and values outside the limits of
    the field give None.
    """
    if not text:
        return None
    text = tidy(text)
    numbers = _NUMBER.findall(text)
    if not numbers:
        return None
    made = plan(_NUMBER.sub("0", text), field)
    if made is None:
        return None
    try:
        if field == "elevation":
            group = "," if (mark or ".") == "." else "."
            values = [float(x.replace(group, "").replace(",", ".")) for x in numbers]
        else:
            values = [float(x.replace(",", ".")) for x in numbers]
    except ValueError:
        return None
    own = PROVIDER_UNITS.get(unit or "", 1.0)
    if made.kind == "packed":
        # a side without any mark: whole numbers of five digits or more are packed degrees, minutes, seconds
        digits = numbers[0]
        if digits.isdigit() and len(digits) >= 5:
            d, m, s = float(digits[:-4]), float(digits[-4:-2]), float(digits[-2:])
            if m >= 60 or s >= 60:
                return None
            value = d + m / 60 + s / 3600
        else:
            value = values[0]  # a side is only written with degrees, whatever the provider's bare numbers mean
    elif made.kind == "bare":
        value = values[0] * own
    elif made.kind in ("range", "bare range"):
        a, b = (values[k] * f for k, f in made.parts)
        value = (made.sign * a + b) / 2 * (own if made.kind == "bare range" else 1.0)
        low, high = LIMITS[field]
        return value if low <= value <= high else None
    else:
        if made.sexagesimal and any(v >= 60 for v in values[1:]):
            return None
        value = sum(values[k] * f for k, f in made.parts)
    value *= made.sign
    low, high = LIMITS[field]
    return value if low <= value <= high else None
