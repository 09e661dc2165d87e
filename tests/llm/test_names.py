import random

import numpy as np
import pytest

from stemma.llm.edits import coded, half_edit_pairs, half_edits
from stemma.llm.metric import damaged, radius_join, swapped
from stemma.llm.names import Lexicon, Lexicons, learn_lexicons, link_names, look_up, parse

KNOWN = Lexicons(
    Lexicon({"katharina": "katharina", "kathi": "katharina", "gregory": "gregory", "leopold": "leopold", "susanne": "susanne", "christina": "christina", "tina": "christina", "robert": "robert", "bob": "robert", "heinrich": "heinrich", "harry": "heinrich", "francisco": "francisco", "yevgenia": "yevgenia", "margaret": "margaret", "pauline": "pauline", "ursula": "ursula", "ignacio": "ignacio"}),
    Lexicon({"provincial": "provincial", "survey": "survey", "zoological": "zoological", "royal": "royal", "roy": "royal", "marine": "marine", "mar": "marine", "institute": "institute", "inst": "institute"}),
)


def lev(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def words(n, seed=4):
    rng = random.Random(seed)
    base = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 5))) for _ in range(n)]
    out = set(base)
    for w in base:
        k = rng.randrange(len(w))
        out |= {w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + w[k : k + 2][::-1] + w[k + 2 :]}
    return sorted(out - {""})


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_radius_join_against_brute_force(spark, radius, monkeypatch):
    from stemma.llm import metric

    monkeypatch.setattr(metric, "GROUP", 40)  # many blocks a cell
    w = words(120)
    w += [w[5].replace("l", "i"), w[9].replace("f", "t")]
    w = sorted(set(w))
    want = {(a, b) for i, a in enumerate(w) for b in w[i + 1 :] if half_edits(a, b) <= radius}
    got = [tuple(r) for r in radius_join(spark.createDataFrame([(x,) for x in [*w, None, ""]], "word string"), radius).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_swapped_letters(spark):
    w = words(60)
    want = {(a, b) for i, a in enumerate(w) for b in w[i + 1 :] if any(a[:k] + a[k + 1] + a[k] + a[k + 2 :] == b for k in range(len(a) - 1))}
    assert {tuple(r) for r in swapped(spark.createDataFrame([(x,) for x in w], "word string")).collect()} == want


def test_half_edits_are_a_metric():
    w = [*words(30), "", "hill", "bill", "tall", "fall", "x" * 70, "x" * 30 + "y" + "x" * 39]
    c, n = coded(w), len(w)
    d = half_edit_pairs(c, np.repeat(np.arange(n), n), c, np.tile(np.arange(n), n)).reshape(n, n)
    assert d.tolist() == [[half_edits(a, b) for b in w] for a in w]
    assert (d == d.T).all() and ((d == 0) == np.eye(n, dtype=bool)).all() and (d[:, None] <= d[:, :, None] + d[None]).all()
    assert half_edits("hill", "bill") == 1 and half_edits("hill", "hall") == 2 and half_edits("abc", "ac") == 2


def test_long_words_are_compared_whole(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("aeioudkrst") for _ in range(60))
    w = [long, long[:10] + long[11:], long[:-1] + "x", long[:50], "gaibogairnen", long[:55] + "zz" + long[57:]]
    want = {tuple(sorted((a, b))) for a in w for b in w if a != b and half_edits(a, b) <= 2}
    assert len(want) == 2 and {tuple(r) for r in radius_join(spark.createDataFrame([(x,) for x in w], "word string")).collect()} == want


@pytest.mark.parametrize("name,family,given,first,middle", [
    ("Lebrisubros, Kathi", "lebrisubros", "katharina", "k", None), ("det. & leg. E. Kewaraivi", "kewaraivi", None, "e", None), ("Tuleziwök Gregory", "tuleziwok", "gregory", "g", None), ("Soletitik OK", "soletitik", None, "o", "k"), ("J. B.  vanThouzidakru ", "thouzidakru", None, "j", "b"),
    ("Gegastomál, Leop. M. (1988)", "gegastomal", "leopold", "l", "m"), ("5usanne Thoutaífukrurd", "thoutaifukrurd", "susanne", "s", None), ("PZSB (Bouzagobai)", "bouzagobai", None, "sz", "p"), ("Robert Müller-Lüdenscheidt", "mullerludenscheidt", "robert", "r", None), ("Provincial Survey of Zoological Studies of Bouzagobai", "bouzagobai", "survey|zoological", "sz", "p"), ("Pokepalan", "pokepalan", None, None, None),
])
def test_parse(name, family, given, first, middle):
    p = parse(name, KNOWN)
    assert (p.family, p.given, p.first, p.middle) == (family, given, first, middle)


def test_wordless_names_are_nobody():
    assert all(parse(x, KNOWN) is None for x in (None, "", "  ", "?", "-", ",", "()"))


def test_linking(spark):
    groups = [
        [("Christina Gastogemal", "K", 1910, 1920), ("Gastogemal, Tina", "K", 1913, 1919), ("GASTOGEMAL, C.", "K", 1915, None), ("Chrisitna Gastogemal", "K", None, 1918), ("Gastogemal", "K", 1912, 1914), ("Christina Gastoegmal", "H", 1911, None)],
        [("Robert Gastogemal", "Z", 1980, 1990), ("Bob Gastogemal", "Z", 1985, None), ("R. Gastogemal", "Z", 1982, 1984)],
        [("Royal Marine Institute of Vonakroudai", "Z", 1917, 1920), ("Roy. Mar. Inst. Vonakroudai", "Z", None, None), ("RMIV (Vonakroudai)", "Z", 1918, 1919), ("Vonakroudai, Royal Marine Institute", "Z", 1919, None)],
        [("N. Pimirepesk", "T", 1920, 1921), ("Pimirepesk, N.", "T", None, None), ("N. Pimirepeskk", "T", 1922, None)],
        [("Soletitik", "A", 1900, 1901)],
    ]
    rows = [(100 * g + k, *r) for g, group in enumerate(groups) for k, r in enumerate(group)] + [(900, None, None, None, None), (901, "?", None, None, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "name_id long, collectorname string, collectioncode string, first_year int, last_year int, id string")
    got = {r.id: r.entity for r in link_names(df, lexicons=KNOWN).collect()}
    assert got == {100 * g + k: 100 * g for g, group in enumerate(groups) for k in range(len(group))}


def test_empty_table(spark):
    df = spark.createDataFrame([], "name_id long, collectorname string, collectioncode string, first_year int, last_year int")
    assert link_names(df).count() == 0


def damages_apart(a, b):
    """Edits and swaps of neighbours, by a search over what they make of a word."""
    if a == b:
        return 0
    signs = sorted(set(b))
    one = lambda w: {w[:k] + w[k + 1 :] for k in range(len(w))} | {w[:k] + c + w[k + n :] for k in range(len(w) + 1) for c in signs for n in (0, 1)} | {w[:k] + w[k + 1] + w[k] + w[k + 2 :] for k in range(len(w) - 1)}
    near = one(a)
    # the second damage may not lie within a swap, which the measure counts as one step
    return 1 if b in near else 2 if any(lev(x, b) <= 1 for x in near) or any(b in one(x) for x in near) else 3


def test_damaged_words_against_brute_force(spark):
    from stemma.llm.edits import damages

    base = ["nitehtoutaird", "kroumoulizos", "gaibogairnen", "lekofurun", "betrukubai", "abcd"]
    w = {*base, "nthetoutaird", "krouumouhzos", "gaibogairnien", "gaibogarinen", "lekofubrn", "belukubai", "abdc", "acbde", "lekofru", "lekofur", "krouhmouzo"}
    w = sorted(f"{k}:{x}" for x in w for k in "po")
    apart = {(a, b): damages_apart(a[2:], b[2:]) for i, a in enumerate(w) for b in w[i + 1 :] if a[:2] == b[:2]}
    want = {(a, b, d) for (a, b), d in apart.items() if d == 1 or d == 2 and max(len(a), len(b)) >= 11}
    assert {tuple(r) for r in damaged(spark.createDataFrame([(x,) for x in [*w, None, "", "p:"]], "word string"), 9, 2).collect()} == want
    assert damages("ab", "ba") == 1 and damages("", "ab") == 2 and damages("nitehtou", "nthetou") == 2


def test_long_surnames_two_damages_apart(spark):
    groups = [
        [("Francisco Krouhmouzo", "E", 2016, 2033), ("Francisco V. Kroulimouzo", "E", 2010, None)],
        [("Y. Nitehtoufaird", "K", 1950, 1960), ("Yevgenia van Nthetoufaird", "K", 1955, None)],
        [("Heinrich Gaibogairnen", "T", 1902, 1908), ("Harry Gaibogairenn", "I", 1905, None)],  # 'rn' and a swap beside it
        [("Margaret Vonakroudai", "Z", 1910, 1920)], [("Margaret Vonokroudei", "H", 1910, 1920)],  # another collection
        [("Robert Thoukipabair", "Z", 1910, 1920)], [("Robert Thoukopabeir", "Z", 1990, 1995)],  # other years
        [("Pauline Stebrizokan", "Z", 1910, 1920)], [("Ursula Stibrezokan", "Z", 1910, 1920)],  # another given name
        [("Ignacio Mukapid", "Z", 1910, 1920)], [("Ignacio Mokapud", "Z", 1910, 1920)],  # short
    ]
    rows = [(100 * g + k, *r) for g, group in enumerate(groups) for k, r in enumerate(group)]
    df = spark.createDataFrame(rows, "name_id long, collectorname string, collectioncode string, first_year int, last_year int")
    assert {r.id: r.entity for r in link_names(df, lexicons=KNOWN).collect()} == {100 * g + k: 100 * g for g, group in enumerate(groups) for k in range(len(group))}


def test_forms_are_learned_from_the_surnames_that_share_them(spark):
    rng = random.Random(5)
    people = [("margaret", "peggy"), ("robert", "bob"), ("ursula", "uschi")]
    surnames = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(4)) for _ in range(90)]
    names = [f"{g.title()} {w.title()}" for k, w in enumerate(surnames) for g in people[k % 3]] + [f"{w.title()}, {people[k % 3][0].upper()}" for k, w in enumerate(surnames)]
    names += [f"{a} {b} Institute of {w.title()}" for k, w in enumerate(surnames[:40]) for a, b in [(("Royal", "Coastal")[k % 2], "Marine")]] + [f"Roy. Mar. Inst. {w.title()}" for w in surnames[:40:2]]
    names += [f"{people[0][0].title()} {w.title()}" for w in surnames[1:4:3]]  # another person of a surname
    df = spark.createDataFrame([(n,) for n in [*names, None, "", "?"]], "n string")
    known = learn_lexicons(df, "n")
    assert {w: known.given.words.get(w) for pair in people for w in pair} == {w: pair[0] for pair in people for w in pair}
    assert {"royal", "coastal", "marine", "institute"} <= set(known.bodies.words) and known.bodies.words["mar"] in ("marine",) and known.bodies.words["inst"] == "institute"
    assert not set(surnames) & (set(known.given.words) | set(known.bodies.words))
    assert learn_lexicons(df.where("false"), "n").given.words == {}


def test_a_form_in_few_spellings_of_a_large_table(spark):
    surnames = ["".join(a + b for a, b in zip(w[::2], w[1::2])) for w in ("gaibogai", "lekofuru", "mukapido", "tulezito", "nifoduke")]
    names = [f"Margaret {w.title()}" for w in surnames] + [f"Peggy {w.title()}" for w in surnames[:4]]
    others = ["Robert", "Ursula", "Francisco", "Heinrich", "Ignacio", "Pauline", "Katharina", "Yevgenia", "Theodor"]
    partners = [f"{g} {g[:2]}{c}{d}{c}ozu" for g in ["Margaret", *others] for c in "bdfgklmnprst" for d in "aeiou"]
    names += [f"{g} {w.title()[:-1]}k" for g in others[:2] for w in surnames] + ["Margarte Xuzebo", "Margarte Xitako"]
    filler = spark.range(110_000).selectExpr("translate(concat('Q', id, 'w Z', id * 7 + 1, 'w'), '0123456789', 'abcdefghij') AS n")
    df = filler.union(spark.createDataFrame([(n,) for n in names + partners], "n string"))
    assert learn_lexicons(df, "n").given.words == {"margaret": "margaret", "peggy": "margaret"} | {g.lower(): g.lower() for g in others}


def crowded_names():
    """Pairs of a name and its other form, and spellings of surnames that 26 names share each."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(n))
    people = [(word(3), word(3)) for _ in range(40)]
    surnames = [word(5) for _ in range(120)]
    names = [f"{g.title()} {w.title()}" for w in surnames for p in rng.sample(people, 13) for g in p]
    return people, names + [f"{p[0].title()} {word(5).title()}" for p in people for _ in range(3)]


def test_crowded_surnames_tell_forms_and_no_others(spark, monkeypatch):
    from stemma.llm import names

    monkeypatch.setattr(names, "PARTNERS", 3)  # as in a table where surnames have as many partners
    people, spellings = crowded_names()
    found = learn_lexicons(spark.createDataFrame([(n,) for n in spellings], "n string"), "n").given.words
    same = [p for p in people if set(p) <= set(found)]
    assert len(same) >= 38 and set(found) == {w for p in same for w in p}
    assert all(found[b] == found[a] for a, b in same) and len(set(found.values())) == len(same)


def test_words_are_looked_up_by_joins_as_in_a_lexicon(spark):
    rng = random.Random(8)
    w = [x for x in words(60, 9) if len(x) < 12]
    entries = [(k % 3 == 0, x, w[k - k % 4]) for k, x in enumerate(w[::2])] + [(False, "margaret", "margaret"), (False, "margit", "margaret"), (True, "margin", "margin"), (False, "al", "al")]
    asked = {(x[: rng.randint(1, len(x))] if rng.random() < 0.3 else x, rng.random() < 0.5) for x in w} | {(x, d) for x in ("marg", "marga", "margarte", "nargin", "al", "ab", "q" * 300) for d in (True, False)}
    held = {body: Lexicon({x: e for b, x, e in entries if b == body}) for body in (True, False)}
    want = {(x, d, body, *held[body].find(x, d)) for x, d in asked for body in held if held[body].find(x, d)[0]}
    got = look_up(spark.createDataFrame(sorted(asked), "word string, dotted boolean"), spark.createDataFrame(entries, "body boolean, word string, entry string"))
    assert {tuple(r) for r in got.collect()} == want and {c for *_, c in want} >= {0.0, 0.3, 1.0}


def test_names_are_linked_alike_by_joins(spark, monkeypatch):
    from stemma.llm import names

    monkeypatch.setattr(names, "PARTNERS", 3)
    spellings = [*crowded_names()[1], "Roy. Mar. Inst. (Bouzagobai)", "K. von Lekofuru", "det. J. Mukapid (1988)", None, "", "?"]
    rows = [(k, n, "Z", 1900 + k % 9, None) for k, n in enumerate(spellings)]
    df = spark.createDataFrame(rows, "name_id long, collectorname string, collectioncode string, first_year int, last_year int")
    want = {tuple(r) for r in link_names(df).collect()}
    monkeypatch.setattr(names, "HELD", 0)
    assert {tuple(r) for r in link_names(df).collect()} == want and len({e for _, e in want}) < len(want)
