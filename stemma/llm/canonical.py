"""Free-entered values to the entries of a reference list."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.edits import deletes, fold, skeleton, weighted_distance
from stemma.sources.tables import broadcast_checked, cut

#: Edits that are looked for at most, and the shortest aliases for one and for two.
MOST_EDITS = 2
ONE_EDIT_FROM, TWO_EDITS_FROM = 3, 7
#: What edits of a long alias may cost beyond their number, where a lost letter and swapped ones meet.
LONG_FROM, LONG_COST = 10, 0.75
#: What edits of a whole value may cost that has signs or words of a list.
WHOLE_COST = 1.0
#: The id of a value that means no entry, or more than one.
NO_ENTRY = -1

# --- fixed values: articles, and words of direction with their short forms -------------
ARTICLES = ("the",)
DIRECTIONS = {"north": ("n", "no", "nth", "northern", "north"), "south": ("s", "so", "sth", "southern", "south"), "east": ("e", "eastern", "east"), "west": ("w", "western", "west"), "upper": ("u", "up", "upr", "upper"), "lower": ("l", "lo", "lwr", "low", "lower")}
# -----------------------------------------------------------------------------------
#: A word of names is common if at least two entries, and one in COMMON_ONE_IN of a field, have it.
COMMON_ONE_IN = 200
#: A name's one telling word stands for it from this length on, if it has at most so many words.
TELLING_FROM, TELLING_OF = 6, 4
_BRACKETS = re.compile(r"[(\[{][^)\]}]*[)\]}]")
_LIST = re.compile(r"\s*[/;|&+]\s*|\s+(?:or|and|und|et|ou|oder)\s+", re.I)
_TOKEN = re.compile(r"[^\s,]+")


def core(name: str, common: frozenset | set = frozenset()) -> str:
    """The telling part of a name: what stands behind 'of', without articles, and of several
    words the longest that few entries have; after a word of direction all."""
    words = _TOKEN.findall(name)
    low = [fold(w).strip(".'") for w in words]
    if "of" in low[:-1]:
        at = len(low) - 1 - low[::-1].index("of")
        words, low = (words[at + 1 :], low[at + 1 :]) if at < len(low) - 1 else (words, low)
    elif low[-1:] == ["of"]:
        words, low = words[:1], low[:1]
    kept = [k for k, w in enumerate(low) if w not in ARTICLES]
    if not kept:
        return name
    words, low = [words[k] for k in kept], [low[k] for k in kept]
    if len(words) == 1 or low[0] in DIRECTIONS:
        return " ".join(words)
    rare = [k for k, w in enumerate(low) if w not in common] or list(range(len(low)))
    best = max(rare, key=lambda k: (len(low[k]), k))
    return words[best] if len(low[best]) >= TELLING_FROM and len(words) <= TELLING_OF else " ".join(words)


def aliases(name: str, others: list[str], codes: list[str], common: frozenset | set = frozenset()) -> Iterator[tuple[str, bool]]:
    """(skeleton, is a code) of all spellings under which an entry is known."""
    for n in (name, *others):
        yield skeleton(n), False
        c = core(n, common)
        yield skeleton(c), False
        words = fold(c).split()
        if len(words) > 1 and words[0] in DIRECTIONS:
            rest = "".join(words[1:])
            for d in (*DIRECTIONS[words[0]], words[0] + "ern"):
                yield skeleton(d + rest), False
                yield skeleton(rest + d), False
            yield skeleton(rest), False  # shared by several entries, so it will mean none
    for c in codes:
        yield skeleton(c), True


def common_words(refs: DataFrame) -> dict[str, set]:
    """The words that many entries of a field have, such as forms of government: at most
    COMMON_ONE_IN for each word of a name."""

    def split(batches):
        for b in batches:
            rows = {(f, i, fold(w).strip(".'")) for f, i, n, o in zip(b.field_name, b.ref_id, b["name"], b.others) if n for x in (n, *(o if o is not None else ())) if x and len(ws := _TOKEN.findall(x)) > 1 for w in ws}
            yield pd.DataFrame(sorted(rows), columns=["field_name", "ref_id", "word"])

    words = refs.select("field_name", "ref_id", "name", "others").mapInPandas(split, "field_name string, ref_id long, word string")
    counts = words.groupBy("field_name", "word").agg(F.count_distinct("ref_id").alias("n")).join(refs.groupBy("field_name").agg(F.count(F.lit(1)).alias("all")), "field_name")
    out: dict[str, set] = {}
    for r in counts.where((F.col("n") >= 2) & (F.col("n") * COMMON_ONE_IN >= F.col("all"))).collect():
        out.setdefault(r.field_name, set()).add(r.word)
    return out


def probes(value: str, common: frozenset | set = frozenset(), several: bool = False) -> list[tuple[str, bool]]:
    """(skeleton, may have edits) to look a value up by, best first; of a value of ``several``
    parts only the whole."""
    plain = _BRACKETS.sub(" ", value)
    tries = [value, plain if any(c.isalnum() for c in plain) else value]
    tries += [core(fold(t).strip(" .,;:?!'\"[](){}"), common) for t in tries if not several]
    return [(s, len(s) >= ONE_EDIT_FROM) for s in dict.fromkeys(map(skeleton, tries)) if s]


def edits_allowed(word: str) -> int:
    return 0 if len(word) < ONE_EDIT_FROM else 1 if len(word) < TWO_EDITS_FROM else MOST_EDITS


def delete_dictionary(refs: DataFrame, common: dict[str, set]) -> DataFrame:
    """(field_name, key, alias, is_code, ref_id): the symmetric-delete dictionary of
    refs(field_name, ref_id, name, others array, codes array). An alias of several entries has NO_ENTRY."""

    def spell(batches):
        for b in batches:
            rows = [(f, i, a, k) for f, i, n, o, c in zip(b.field_name, b.ref_id, b.name, b.others, b.codes) if n for a, k in aliases(n, [x for x in (o if o is not None else ()) if x], [x for x in (c if c is not None else ()) if x], common.get(f, frozenset())) if a]
            yield pd.DataFrame(rows, columns=["field_name", "ref_id", "alias", "is_code"])

    def spread(batches):
        for b in batches:
            rows = [(f, d, a, k, i) for f, a, k, i in zip(b.field_name, b.alias, b.is_code, b.ref_id) for d in deletes(a, 0 if k else edits_allowed(a))]
            yield pd.DataFrame(rows, columns=["field_name", "key", "alias", "is_code", "ref_id"])

    known = refs.mapInPandas(spell, "field_name string, ref_id long, alias string, is_code boolean")
    one = known.groupBy("field_name", "alias").agg(F.min("ref_id").alias("a"), F.max("ref_id").alias("b"), F.min("is_code").alias("is_code"))
    one = one.select("field_name", "alias", "is_code", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.lit(NO_ENTRY)).alias("ref_id"))
    return one.mapInPandas(spread, "field_name string, key string, alias string, is_code boolean, ref_id long")


def canonical_values(values: DataFrame, refs: DataFrame) -> DataFrame:
    """(field_name, value, ref_id): the entry that each distinct value means.

    values: (field_name, value, n), distinct, n the rows that hold it; refs: see
    ``delete_dictionary``. Lookup is by equi-join of deletes of both sides (values up to two
    edits from an alias share one), ranking by weighted Damerau-Levenshtein distance, then by
    the rows that name the entry letter for letter. The
    whole value is looked up first, then its parts. A value of several parts that mean
    different entries, and one near no alias, gets NO_ENTRY: the report of misses. The
    dictionary is broadcast if its counted size allows it, else the join shuffles.
    """

    common = common_words(refs)

    def spread(batches):
        for b in batches:
            rows = []
            for f, v in zip(b.field_name, b.value):
                parts = [p for p in _LIST.split(v) if any(c.isalnum() for c in p)]
                # the whole value first; what lies between signs of a list only if that is no entry
                for part, text in enumerate([v, *(parts if len(parts) > 1 else [])]):
                    for rank, (s, fuzzy) in enumerate(probes(text, common.get(f, frozenset()), len(parts) > 1 and not part)):
                        rows += [(f, v, len(parts), part, rank, s, d) for d in (deletes(s, MOST_EDITS if len(s) >= TWO_EDITS_FROM - MOST_EDITS else 1) if fuzzy else {s})]
            yield pd.DataFrame(rows, columns=["field_name", "value", "parts", "part", "rank", "probe", "key"])

    def score(batches):
        for b in batches:
            b["cost"] = [0.0 if p == a else 9.0 if k else weighted_distance(p, a) for p, a, k in zip(b.probe, b.alias, b.is_code)]
            b["most"] = [WHOLE_COST if n > 1 and not p else edits_allowed(a) + LONG_COST * (len(a) >= LONG_FROM) for a, n, p in zip(b.alias, b.parts, b.part)]
            yield b[b.cost <= b.most][["field_name", "value", "parts", "part", "rank", "ref_id", "cost"]]

    keys = values.select("field_name", "value").mapInPandas(spread, "field_name string, value string, parts int, part int, rank int, probe string, key string")
    dictionary = broadcast_checked(cut(delete_dictionary(refs, common)))
    met = keys.join(dictionary, ["field_name", "key"]).select("field_name", "value", "parts", "part", "rank", "probe", "alias", "is_code", "ref_id").distinct()
    scored = met.mapInPandas(score, "field_name string, value string, parts int, part int, rank int, ref_id long, cost double")
    exact = values.join(refs.select("field_name", F.col("name").alias("value"), "ref_id"), ["field_name", "value"]).groupBy("field_name", "ref_id").agg(F.sum("n").alias("weight"))
    ranked = scored.join(broadcast_checked(exact), ["field_name", "ref_id"], "left")
    # the whole text before what is left of it after titles; an ambiguous alias only if nothing is nearer
    order = F.struct(F.col("cost") + F.when(F.col("rank") > 0, 0.05 * F.col("rank")).otherwise(0.0), -F.coalesce("weight", F.lit(0)), F.col("ref_id"))
    best = ranked.groupBy("field_name", "value", "parts", "part").agg(F.min_by("ref_id", order).alias("ref_id"))
    as_one = F.min(F.when(F.col("part") == 0, F.col("ref_id")))
    whole = best.groupBy("field_name", "value").agg(F.coalesce(as_one, F.min("ref_id")).alias("a"), F.coalesce(as_one, F.max("ref_id")).alias("b"))
    found = whole.select("field_name", "value", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.lit(NO_ENTRY)).alias("ref_id"))
    return values.select("field_name", "value").join(found, ["field_name", "value"], "left").withColumn("ref_id", F.coalesce("ref_id", F.lit(NO_ENTRY)))


def canonicalise(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """(field_name, row_key, value, ref_id) of rows(field_name, row_key, value).

    Null and blank values give no row. Values are counted before anything is shuffled, so a
    value that fills a third of the table is one row of the lookup; the answer is joined
    back to the rows, by broadcast if the counted number of distinct values allows it.
    Repeated rows each get their answer.
    """
    rows = rows.where("value rlike '\\\\S'")
    values = cut(rows.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n")))
    return rows.join(broadcast_checked(cut(canonical_values(values, refs))), ["field_name", "value"]).select("field_name", "row_key", "value", "ref_id")
