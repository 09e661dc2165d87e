"""Spellings of collectors, persons and organisations, linked to one entity each."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.edits import alike, deletes, fold, undo_encoding, weighted_distance
from stemma.llm.metric import damaged, radius_join, swapped
from stemma.operators.components import components
from stemma.sources.tables import broadcast_checked, cut

# --- fixed values: words around names that belong to nobody --------------------------
TITLES = frozenset("prof dr mr mrs mme mlle ms miss sir rev fr herr frau don dona leg coll det legit collector collected by et and the".split())
PARTICLES = frozenset("van von de la du dos del der den di da le al zu zur ten ter vom las los".split())
FILLERS = frozenset("of the studies study for and".split())
# -----------------------------------------------------------------------------------
_TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*\.?|,|\(|\)|&")
_GLUED = re.compile(r"\b(van|von|du|dos|de la|dela|de|del|der)(?=[A-ZÀ-Þ][a-zà-ÿ])")
#: A word is common, not a surname or place, if it stands beside at least PARTNERS * log2(spellings)
#: different words (the most variants that a surname has grow like that) and in more than one spelling.
PARTNERS = 1.1
#: A word beside at least FORM_PARTNERS others is a form of a more frequent common word if at least
#: FORM_PLACES surnames or places, and FORM_SHARE of all that it stands beside, have both, and the
#: two share hardly any spelling (TOGETHER of these places). Surnames with more than CROWDED such
#: words have many two of them by chance: what chance gives there is taken off, and what is left must be
#: CLEAR times its root. So it is at all places for a word in less than one of FEW spellings, which by
#: chance shares some with one of many names; if it is a common word damaged, ``find`` knows that.
FORM_PARTNERS, FORM_PLACES, FORM_SHARE, TOGETHER, CROWDED, CLEAR, FEW = 4, 2, 0.2, 0.1, 20, 4, 20_000
#: Words up to which a driver and its tasks hold a lexicon; more are looked up by joins.
HELD = 5_000


def plain(word: str) -> str:
    """Folded letters of a word; digits within as the letters they look like."""
    w = fold(word)
    if any(c.isdigit() for c in w) and any(c.isalpha() for c in w):
        w = w.translate(str.maketrans("0158", "olsb"))
    return "".join(c for c in w if c.isalnum())


def typed(word: str, w: str) -> float | None:
    """The cost of a folded word as the word ``w`` with typing or scanning errors; None if it is
    too far from it."""
    shorter, longer = sorted((len(word), len(w)))
    most = 2.0 if shorter >= 6 else 1.0 if longer >= 4 else 0.0
    if not most or longer - shorter > most:
        return None
    c = weighted_distance(word, w, most + 1)
    return c + 0.01 * (w[0] != word[0]) if c <= most else None


def _left(word: str) -> set[str]:
    """What deletions leave of a word, by which it meets those that it may stand for."""
    return deletes(word, 1 + (len(word) >= 6))


class Lexicon:
    """Words with their other forms; ``find`` allows for typing and scanning errors by a
    symmetric-delete dictionary."""

    def __init__(self, forms: dict[str, str]):
        self.words = dict(forms)
        self.near: dict[str, list[str]] = {}
        self.longest = max(map(len, self.words), default=0) + 2
        for w in self.words:
            if len(w) >= 3:
                for d in _left(w):
                    self.near.setdefault(d, []).append(w)
        self.find = lru_cache(maxsize=200_000)(self._find)

    def __reduce__(self):
        return Lexicon, (self.words,)

    def _find(self, word: str, dotted: bool = False) -> tuple[str | None, float]:
        """(entry, cost) of a folded word; (None, 9) if there is none."""
        if word in self.words:
            return self.words[word], 0.0
        n = len(word)
        if n < 3 or n > self.longest:
            return None, 9.0
        if dotted:
            starts = {e for w, e in self.words.items() if w.startswith(word)}
            if len(starts) == 1:
                return starts.pop(), 0.3
        best = (9.0, None)
        for w in {w for d in _left(word) for w in self.near.get(d, ())}:
            cost = typed(word, w)
            if cost is not None:
                best = min(best, (cost, self.words[w]))
        return best[1], best[0]


class Findings:
    """What ``look_up`` found of the words of one spelling, with the ``find`` of a Lexicon."""

    def __init__(self, found: dict[tuple[str, bool], tuple[str, float]]):
        self.found = found

    def find(self, word: str, dotted: bool = False) -> tuple[str | None, float]:
        return self.found.get((word, dotted), (None, 9.0))


@dataclass
class Lexicons:
    """The common words of a table: of persons (given names) and of organisations."""

    given: Lexicon | Findings
    bodies: Lexicon | Findings


def common_words(name: str | None) -> list[str]:
    """The distinct words of a spelling that may be names: without titles, particles and initials."""
    if not name:
        return []
    text = _GLUED.sub(r"\1 ", undo_encoding(name))
    words = (plain(t) for t in _TOKEN.findall(text))
    return sorted({w for w in words if len(w) >= 3 and w not in TITLES and w not in PARTICLES and w not in FILLERS and not w.isdigit()})


def asked_words(name: str) -> list[tuple[str, bool]]:
    """The (word, dotted) that ``parse`` may look up of a spelling."""
    tokens = _TOKEN.findall(_GLUED.sub(r"\1 ", undo_encoding(name)))
    return sorted({(w, dotted) for t in tokens if (w := plain(t)) for dotted in (False, t.endswith("."))})


def look_up(asked: DataFrame, words: DataFrame) -> DataFrame:
    """(word, dotted, body, entry, cost): what ``Lexicon.find`` gives for each asked (word, dotted)
    in the lexicon of each ``body``, by joins, whatever the size of the lexicons. Words
    without an entry are left out.

    words: (body, word, entry). The word itself comes first, then the only entry with such a
    start if it is dotted, then the nearest word by an equi-join on what deletions leave.
    """
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0

    def leave(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 1_000):
                yield pd.DataFrame([(k, w) for w in b["word"].iloc[lo : lo + 1_000] for k in _left(w)], columns=["left", "word"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cost = [typed(x, w) for x, w in zip(b["word"], b["like"])]
            near = [c is not None for c in cost]
            yield b.assign(cost=pd.Series(cost, index=b.index, dtype=float))[near]

    keyed = lambda df: df.where(F.length("word").between(3, longest + 2)).select("word").distinct().mapInPandas(leave, "left string, word string")
    met = keyed(asked).join(keyed(words).withColumnRenamed("word", "like"), "left").select("word", "like").distinct()
    near = met.mapInPandas(measure, "word string, like string, cost double").join(words.withColumnRenamed("word", "like"), "like")
    starts = words.where(F.length("word") >= 3).select("body", "entry", "word", F.explode(F.sequence(F.lit(3), F.length("word"))).alias("n")).groupBy("body", F.expr("left(word, n)").alias("word"))
    starts = starts.agg(F.min("entry").alias("entry"), F.max("entry").alias("last")).where("entry = last")
    ways = [words.select("word", "body", "entry", F.lit(0.0).alias("cost"), F.lit(0).alias("way")), starts.select("word", "body", "entry", F.lit(0.3).alias("cost"), F.lit(1).alias("way")), near.select("word", "body", "entry", "cost", F.lit(2).alias("way"))]
    found = [asked.join(w, "word") if k != 1 else asked.where("dotted").join(w, "word") for k, w in enumerate(ways)]
    first = found[0].unionByName(found[1]).unionByName(found[2]).groupBy("word", "dotted", "body").agg(F.min(F.struct("way", "cost", "entry")).alias("f"))
    return first.select("word", "dotted", "body", "f.entry", "f.cost")


def learned_words(names: DataFrame, name: str) -> DataFrame:
    """(body, word, entry): given names, nicknames and short forms, and the words of
    organisations (body), from the spellings alone.

    A common word is one with many partners (PARTNERS). It belongs to organisations if it
    mostly stands beside another common word. Two common words are forms of one if many
    surnames or places have both: nicknames share no letters with names, but the
    same persons' surnames stand beside them. Each form points to its likeliest more frequent
    word; the entry is where this ends. All spellings, words and places count, however many or
    crowded they are; all is done by joins.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(w,) for w in map(common_words, b["_name"]) if len(w) > 1], columns=["words"])

    rows = cut(names.where(F.col(name).isNotNull()).select(F.col(name).alias("_name")).distinct().mapInPandas(split, "words array<string>"))
    pairs = cut(rows.select("words", F.explode("words").alias("word")).select("word", F.explode("words").alias("other")).where("word <> other").groupBy("word", "other").agg(F.count(F.lit(1)).alias("n")))
    n = rows.count()
    partners = max(FORM_PARTNERS, round(PARTNERS * float(np.log2(max(n, 2)))))
    counts = rows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("partners")).where(F.col("partners") >= FORM_PARTNERS).join(counts, "word").where("n > 1")
    known = cut(known.select("word", "n", (F.col("partners") >= partners).alias("common"), (F.col("n") * FEW < n).alias("few")))
    common = known.where("common").select("word")
    is_common = broadcast_checked(common.withColumn("m", F.lit(1)))
    # organisations' words mostly stand beside another common word
    tagged = rows.withColumn("k", F.monotonically_increasing_id()).select("k", F.explode("words").alias("word")).join(is_common, "word", "left")
    per = cut(tagged.groupBy("k").agg(F.sum("m").alias("m"), F.collect_list(F.when(F.col("m") == 1, F.col("word"))).alias("words")).where("m > 0"))
    bodies = cut(per.select("m", F.explode("words").alias("word")).groupBy("word").agg(F.avg((F.col("m") > 1).cast("int")).alias("beside")).where("beside >= 0.5").select("word", F.lit(True).alias("body")))
    # words beside each surname or place, damaged common words left out
    others = pairs.select(F.col("other").alias("word")).distinct()
    if common.count() <= HELD:
        held = [r.word for r in common.collect()]

        def no_damage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            near = Lexicon({w: w for w in held})
            for b in batches:
                yield b[[near.find(w)[0] is None for w in b["word"]]]

        rare = others.mapInPandas(no_damage, "word string")
    else:
        rare = others.join(look_up(others.withColumn("dotted", F.lit(False)), common.select(F.lit(False).alias("body"), "word", F.col("word").alias("entry"))), "word", "left_anti")
    rare = cut(rare)
    places = cut(pairs.join(broadcast_checked(known.select("word")), "word").join(rare.withColumnRenamed("word", "other"), "other").select("other", "word"))
    # pairs of words by the places that they share, and how many of the crowded ones chance gives
    crowds = places.join(places.groupBy("other").agg(F.count(F.lit(1)).alias("crowd")), "other")
    own = cut(crowds.groupBy("word").agg(F.count(F.lit(1)).alias("own"), F.sum(F.when(F.col("crowd") > CROWDED, F.col("crowd") - 1).otherwise(0)).alias("beside"), F.sum(F.col("crowd") - 1).alias("all")))
    every = own.agg(F.sum("own")).first()[0] or 1
    facts = known.join(own, "word").join(bodies, "word", "left").withColumn("body", F.coalesce("body", F.lit(False)))
    named = lambda x: facts.select(F.col("word").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "common", "few", "body", "own", "beside", "all")))
    sure = known.where("common or not few").select("word").union(known.where("few and not common").select("word").join(rare, "word", "left_semi"))
    forms = places.join(own.where(F.col("own") >= FORM_PARTNERS).join(sure, "word").select("word"), "word", "left_semi").select("other", F.col("word").alias("a"))
    both = forms.join(places.join(is_common, "word").select("other", F.col("word").alias("b")), "other").where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"))
    met = both.where(F.col("both") >= FORM_PLACES).join(named("a"), "a").join(named("b"), "b").where("(n_b > n_a or n_b = n_a and b > a) and (not common_a or body_a = body_b)")
    met = met.withColumn("chance", F.round(F.col("beside_a") * F.col("own_b") / F.lit(every))).withColumn("shared", F.col("both") - F.col("chance"))
    clear = (F.col("shared") >= FORM_PLACES) & (F.col("shared") >= FORM_SHARE * F.col("own_a")) & (F.col("shared") * F.col("shared") >= CLEAR**2 * F.col("chance"))
    by_all = F.col("all_a") * F.col("own_b") / F.lit(every)
    clear &= ~F.col("few_a") | (F.col("both") >= by_all + CLEAR * F.sqrt(by_all))
    together = pairs.select(F.col("word").alias("a"), F.col("other").alias("b"), F.col("n").alias("together"))
    likely = met.where(clear).join(together, ["a", "b"], "left").where(F.coalesce("together", F.lit(0)) <= TOGETHER * F.col("both"))
    best = cut(likely.groupBy("a").agg(F.max_by("b", F.struct("shared", F.expr("startswith(b, a)"), "n_b", "b")).alias("b")))
    while True:  # to a more frequent word each time, so this ends
        further = best.select(F.col("a").alias("b"), F.col("b").alias("next"))
        moved = cut(best.join(further, "b", "left").select("a", F.coalesce("next", "b").alias("b"), F.col("next").isNotNull().alias("moved")))
        best = moved.select("a", "b")
        if not moved.where("moved").limit(1).count():
            break
    words = common.union(best.select("a")).distinct()
    ends = words.join(best.withColumnRenamed("a", "word"), "word", "left").select("word", F.coalesce("b", "word").alias("entry"))
    return cut(ends.join(bodies.withColumnRenamed("word", "entry"), "entry", "left").select(F.coalesce("body", F.lit(False)).alias("body"), "word", "entry"))


def _held(words: DataFrame) -> Lexicons:
    """Learned words as lexicons in memory."""
    both: tuple[dict, dict] = {}, {}
    for r in words.collect():
        both[r.body][r.word] = r.entry
    return Lexicons(*map(Lexicon, both))


def learn_lexicons(names: DataFrame, name: str) -> Lexicons:
    """The ``learned_words`` of a table as lexicons in memory."""
    return _held(learned_words(names, name))


@dataclass
class Parsed:
    """A spelling taken apart. family is the surname or the place; given the entry of the
    first name, or the last two words of an organisation; first and middle are initials (of an
    organisation: of these two words, and of the one before). listed: is given a known word?"""

    kind: str
    family: str
    given: str | None
    first: str | None
    middle: str | None
    listed: bool = True


def _organisation(tokens: list[str], text: str, known: Lexicons) -> Parsed | None:
    """An organisation's parts: its place, its last two words, the initial of the one before."""
    m = re.match(r"^\s*([A-Z0-9]{3,5})\s*[(,]\s*([^()]+?)\)?\s*$", text)
    if m and not m.group(2).isdigit():
        letters = m.group(1).lower()
        body = letters[:-1]
        return Parsed("org", plain(m.group(2)), None, "".join(sorted(body[-2:])), body[0] if len(body) > 2 else None)
    words, rest = [], []
    for t in tokens:
        w = plain(t)
        if not w or w in FILLERS or w in TITLES:
            continue
        found, cost = known.bodies.find(w, t.endswith("."))
        if found and cost <= 2.0 and found not in words:
            words.append(found)
        elif len(w) > 2 and all(weighted_distance(w, f, 2) >= 2 for f in FILLERS if len(f) > 4):
            rest.append(w)
    if len(words) < 2 or not rest:
        return None
    last = words[-2:]
    return Parsed("org", max(rest, key=len), "|".join(sorted(last)), "".join(sorted(w[0] for w in last)), words[-3][0] if len(words) > 2 else None)


def parse(name: str | None, known: Lexicons) -> Parsed | None:
    """The parts of a collector's name; None for a null, blank or wordless one."""
    if not name or not name.strip():
        return None
    text = _GLUED.sub(r"\1 ", undo_encoding(name))
    tokens = _TOKEN.findall(text)
    org = _organisation(tokens, text, known)
    if org:
        return org
    text = re.sub(r"\([^)]*\)?", " ", text)
    tokens = [t for t in _TOKEN.findall(text) if t not in "()&"]
    tokens = [t for t in tokens if t == "," or plain(t) not in TITLES or len(plain(t)) == 1]
    while tokens and tokens[-1] == ",":
        tokens.pop()
    while tokens and tokens[0] == ",":
        tokens.pop(0)
    if not tokens:
        return None
    if "," in tokens:
        at = tokens.index(",")
        family, given = tokens[:at], [t for t in tokens[at + 1 :] if t != ","]
        tail = [t for t in given if plain(t) in PARTICLES and len(plain(t)) > 1 and t.islower()]
        given = [t for t in given if t not in tail]
        family = [t for t in family if plain(t) not in PARTICLES] or family
    else:
        family, given = _split(tokens, known)
    family_word = "".join(plain(t) for t in family if len(plain(t)) > 3) or "".join(map(plain, family))
    first = middle = entry = None
    listed = False
    for k, t in enumerate(given):
        w = plain(t)
        if not w or w in PARTICLES and t.islower() and k:
            continue
        if len(w) <= 3 and t.rstrip(".").isupper() and not (t.endswith(".") and len(w) > 1) and known.given.find(w, False)[1] > 0:
            for c in w:  # initials
                if first is None:
                    first = c
                elif middle is None:
                    middle = c
        elif len(w) == 1:
            first, middle = (w, middle) if first is None else (first, middle or w)
        elif first is None:
            found, cost = known.given.find(w, t.endswith("."))
            entry, listed = found or w, found is not None
            first = entry[0]
        elif middle is None and len(w) > 3:
            middle = w[0]
    return Parsed("person", family_word, entry, first, middle, listed) if family_word else None


def _split(tokens: list[str], known: Lexicons) -> tuple[list[str], list[str]]:
    """(surname, given names) of a name without a comma, in either order."""
    words = [t for t in tokens if not (plain(t) in PARTICLES and (t.islower() or len(t) < 4) and len(tokens) > 1)]
    words = words or tokens
    if len(words) == 1:
        return words, []
    initials = lambda t: len(plain(t)) == 1 or len(plain(t)) <= 3 and t.isupper() and not t.endswith(".")
    if initials(words[-1]) and not initials(words[0]):
        n = next(i for i in range(len(words)) if all(initials(t) for t in words[i:]))
        return words[:n][:1] if n == 1 else words[:n], words[n:]
    if initials(words[0]):
        n = next(i for i in range(len(words)) if not initials(words[i]))
        # what stands before the last long word is a middle name or a damaged particle
        return [words[-1]], words[:-1] if n < len(words) else []
    costs = [known.given.find(plain(t), t.endswith("."))[1] for t in words]
    if costs[-1] < costs[0] and costs[-1] <= 1.0:
        return [words[0]], [*words[-1:], *words[1:-1]]
    return [words[-1]], words[:-1]


#: Years between the known years of one collector at most, and what a changed letter of the
#: surname or another collection counts for, in years, when the nearest bearer is looked for.
MOST_GAP, LETTER_YEARS, PLACE_YEARS = 30, 10, 4
#: Letters of a surname from which on two damages are allowed, and the years then between
#: the known years of its bearers at most.
LONG, FAR_GAP = 9, 10


def _with_findings(src: DataFrame, words: DataFrame) -> DataFrame:
    """The rows with lists of what ``look_up`` finds of their name's words."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(n, w, dotted) for n in b["_name"] for w, dotted in asked_words(n)], columns=["_name", "word", "dotted"])

    asked = cut(src.where("_name is not null").select("_name").distinct().mapInPandas(ask, "_name string, word string, dotted boolean"))
    found = asked.join(look_up(asked.select("word", "dotted").distinct(), words), ["word", "dotted"])
    found = found.groupBy("_name").agg(F.collect_list(F.struct("word", "dotted", "body", "entry", "cost")).alias("f"))
    return src.join(found.select("_name", *(F.col(f"f.{c}").alias(c) for c in ("word", "dotted", "body", "entry", "cost"))), "_name", "left")


def parsed_names(names: DataFrame, key: str, name: str, known: Lexicons | DataFrame) -> DataFrame:
    """(id, fam, apart, given, listed, first, middle) of each name that has words; in ``fam``
    'rn' is read as 'm', in ``apart`` it is kept as two letters. Lexicons are held by each
    task, a table of learned words meets the words of the names by joins."""
    joined = isinstance(known, DataFrame)
    lexicons = None if joined else known

    def of(found: list) -> Lexicons:
        both: tuple[dict, dict] = {}, {}
        for w, dotted, body, entry, cost in zip(*found) if found[0] is not None else ():
            both[bool(body)][w, bool(dotted)] = entry, float(cost)
        return Lexicons(*map(Findings, both))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            each = (lexicons for _ in b["_id"]) if lexicons else map(of, zip(*(b[c] for c in ("word", "dotted", "body", "entry", "cost"))))
            for i, n, k in zip(b["_id"], b["_name"], each):
                p = parse(n, k)
                if p:
                    given = p.given if p.given and (p.listed or len(p.given) > 3) else None
                    out.append((i, f"{p.kind[0]}:{p.family.replace('rn', 'm')}", f"{p.kind[0]}:{p.family}", given, p.listed, p.first, p.middle))
            yield pd.DataFrame(out, columns=["id", "fam", "apart", "given", "listed", "first", "middle"])

    src = names.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_id"), F.col(name).alias("_name"))
    src = _with_findings(src, known) if joined else src
    return src.mapInPandas(work, "id long, fam string, apart string, given string, listed boolean, first string, middle string")


def _nearest(rows: DataFrame, bearers: DataFrame, families: DataFrame, by_first: bool) -> DataFrame:
    """(id, node): of each row the bearer of its surname, or one a letter away, who was
    active nearest in time; none if all are further than MOST_GAP years or contradict an initial."""
    met = rows.join(families, rows["fam"] == families["fam_a"]).join(bearers, [F.col("fam_b") == bearers["b_fam"], *([F.col("first") == bearers["b_first"]] if by_first else [])])
    gap = F.greatest(F.coalesce(F.col("b_y0") - F.coalesce("y1", "y0"), F.lit(0)), F.coalesce(F.coalesce("y0", "y1") - F.col("b_y1"), F.lit(0)), F.lit(0))
    met = met.withColumn("gap", gap).where((F.col("gap") <= MOST_GAP) & (F.col("middle").isNull() | (F.size("b_middles") == 0) | F.array_contains("b_middles", F.col("middle"))))
    cost = F.col("gap") + LETTER_YEARS * F.col("far") + F.when(F.array_contains("b_places", F.col("place")), 0).otherwise(PLACE_YEARS)
    return met.groupBy("id").agg(F.min_by("node", F.struct(cost, F.col("node"))).alias("node"))


def _damaged_families(rows: DataFrame) -> DataFrame:
    """(a, b, far), a < b: surnames one damage apart while 'rn' is two letters, and long ones
    two apart under either form."""
    forms = cut(rows.select(F.col("fam").alias("word"), "fam", F.lit("m").alias("form")).union(rows.select("apart", "fam", F.lit("rn"))).distinct())
    near = damaged(forms.select("word").distinct(), LONG, 2)
    one, two = (forms.select(F.col("word").alias(w), F.col("fam").alias(f"fam_{w}"), "form") for w in "ab")
    met = near.join(one, "a").join(two, ["b", "form"]).where("fam_a <> fam_b and (d = 2 or form = 'rn')")
    return met.groupBy(F.least("fam_a", "fam_b").alias("a"), F.greatest("fam_a", "fam_b").alias("b")).agg(F.min("d").alias("far"))


def _distant(left: DataFrame, right: DataFrame, distant: DataFrame) -> DataFrame:
    """Bearers of ``left`` and ``right`` with surnames two damages apart who share a
    collection and agree in years and middle initials; their given names are to be compared."""
    side = lambda rows, x: rows.select(F.col("node").alias(x), F.col("b_fam").alias(f"fam_{x}"), *(F.col(f"b_{c}").alias(f"{c}_{x}") for c in ("given", "listed", "first", "middles", "y0", "y1", "places") if f"b_{c}" in rows.columns))
    gap = F.greatest(F.coalesce(F.col("y0_b") - F.col("y1_a"), F.lit(0)), F.coalesce(F.col("y0_a") - F.col("y1_b"), F.lit(0)), F.lit(0))
    met = side(left, "a").join(distant, "fam_a").join(side(right, "b"), "fam_b").withColumn("gap", gap)
    free = (F.size("middles_a") == 0) | (F.size("middles_b") == 0) | F.arrays_overlap("middles_a", "middles_b")
    return met.where(F.arrays_overlap("places_a", "places_b") & (F.col("gap") <= FAR_GAP) & free)


def _bearers(rows: DataFrame, tag: str, by: list[str]) -> DataFrame:
    ends = rows.groupBy("fam", *by).agg(F.min("first").alias("b_first"), F.collect_set("middle").alias("b_middles"), F.min(F.coalesce("y0", "y1")).alias("b_y0"), F.max(F.coalesce("y1", "y0")).alias("b_y1"), F.collect_set("place").alias("b_places"))
    return ends.select(F.concat_ws("|", F.lit(tag), "fam", *(F.col(c).cast("string") for c in by)).alias("node"), F.col("fam").alias("b_fam"), *(F.col(c).alias(f"b_{c}") for c in by if c != "first"), "b_first", "b_middles", "b_y0", "b_y1", "b_places")


def link_names(names: DataFrame, key: str = "name_id", name: str = "collectorname", place: str = "collectioncode", first_year: str = "first_year", last_year: str = "last_year", lexicons: Lexicons | None = None) -> DataFrame:
    """(id, entity): one row per spelling with the class of its collector.

    Spellings are taken apart; surnames (of organisations: places) one edit apart are found by
    ``radius_join`` and ``swapped``, and by ``damaged`` where 'rn' is two letters or a long one
    is two damages apart; the latter link only bearers who share given name or initial,
    collection and years. Spellings with a given name (field and kind) of one
    surname and given name are one bearer; spellings with initials, then those with the
    surname alone, join the bearer active nearest in time who does not contradict them, and make bearers
    of their own if there is none. Components of these links are the entities; the entity
    is named by its least id. Null, blank and wordless names are left out; repeated
    spellings are one entity; unknown years and places count as no contradiction.
    """
    facts = names.select(F.col(key).cast("long").alias("id"), F.col(first_year).alias("y0"), F.col(last_year).alias("y1"), F.col(place).alias("place"))
    known = lexicons or learned_words(names, name)
    if lexicons is None and known.count() <= HELD:
        known = _held(known)
    rows = cut(parsed_names(names, key, name, known).join(facts, "id"))
    words = rows.select(F.col("fam").alias("word")).distinct()
    pairs = radius_join(words).unionByName(swapped(words)).distinct()
    # a person's surname and an organisation's place begin with other signs
    pairs = pairs.where("substr(a, 1, 2) = substr(b, 1, 2)")
    more = cut(_damaged_families(rows))
    pairs = cut(pairs.union(more.where("far = 1").select("a", "b")).distinct())
    turned = lambda p: p.select(F.col("a").alias("fam_a"), F.col("b").alias("fam_b")).union(p.select("b", "a"))
    both = turned(pairs).withColumn("far", F.lit(1))
    distant = cut(turned(more.where("far = 2").select("a", "b").join(pairs, ["a", "b"], "left_anti")))
    families = cut(both.unionByName(words.select(F.col("word").alias("fam_a"), F.col("word").alias("fam_b"), F.lit(0).alias("far"))))

    full = rows.where("given is not null")
    cores = _bearers(full, "c", ["given", "listed"])
    other = cores.select(F.col("node").alias("b"), F.col("b_fam").alias("fam_b"), F.col("b_given").alias("given_b"), F.col("b_listed").alias("listed_b"))
    met = cores.select(F.col("node").alias("a"), F.col("b_fam").alias("fam_a"), F.col("b_given").alias("given_a"), F.col("b_listed").alias("listed_a")).join(families.where("far = 1"), "fam_a").join(other, "fam_b")
    close = (F.col("given_a") == F.col("given_b")) | (~F.col("listed_a") & ~F.col("listed_b") & (F.levenshtein("given_a", "given_b") <= 1))
    links = met.where(close).select("a", "b").unionByName(_distant(cores, cores, distant).where(close).select("a", "b"))
    placed = full.select("id", F.concat_ws("|", F.lit("c"), "fam", "given", F.col("listed").cast("string")).alias("node"))

    short = rows.where("given is null and first is not null")
    known = cut(_nearest(short, cores, families, True))
    rest = short.join(known, "id", "left_anti")
    # a spelling two letters off its bearer, but one off a spelling that has joined it
    joined = _bearers(short.join(known, "id"), "", ["node", "first"]).drop("node").withColumnRenamed("b_node", "node")
    more = cut(_nearest(rest, joined, families, True))
    known = known.unionByName(more)
    rest = rest.join(more, "id", "left_anti")
    initials = _bearers(rest, "i", ["first"])
    other = initials.select(F.col("node").alias("b"), F.col("b_fam").alias("fam_b"), F.col("b_first").alias("b_first"))
    links = links.unionByName(initials.select(F.col("node").alias("a"), F.col("b_fam").alias("fam_a"), "b_first").join(families.where("far = 1"), "fam_a").join(other, ["fam_b", "b_first"]).select("a", "b"))
    # of several bearers two damages off, the nearest in time
    met = _distant(initials, cores.select(*initials.columns).unionByName(initials), distant).where(F.col("first_a") == F.col("first_b"))
    links = links.unionByName(met.groupBy("a").agg(F.min_by("b", F.struct("gap", "b")).alias("b")))
    placed = placed.unionByName(known).unionByName(rest.select("id", F.concat_ws("|", F.lit("i"), "fam", "first").alias("node")))

    bare = rows.where("given is null and first is null")
    columns = ["node", "b_fam", "b_first", "b_middles", "b_y0", "b_y1", "b_places"]
    known = cut(_nearest(bare, cores.select(columns).unionByName(initials.select(columns)), families, False))
    rest = bare.join(known, "id", "left_anti")
    alone = rest.select(F.concat_ws("|", F.lit("s"), "fam").alias("node"), "fam").distinct()
    links = links.unionByName(alone.select(F.col("node").alias("a"), F.col("fam").alias("fam_a")).join(families.where("far = 1"), "fam_a").join(alone.select(F.col("node").alias("b"), F.col("fam").alias("fam_b")), "fam_b").select("a", "b"))
    placed = cut(placed.unionByName(known).unionByName(rest.select("id", F.concat_ws("|", F.lit("s"), "fam").alias("node"))))
    classes = components(placed.select("node"), links)
    classed = placed.join(classes, "node").select("id", "component")
    named = classed.groupBy("component").agg(F.min("id").alias("entity"))
    return classed.join(named, "component").select("id", "entity")
