"""String queries over whole tables, against models with another regular expression engine."""

import os
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.plans import text_queries

D = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


def rows(name, *columns):
    return list(zip(*(c.to_pylist() for c in pq.read_table(f"{D}/{name}.parquet", columns=list(columns)).select(list(columns)).columns)))


def title(s):
    return re.sub(r"\w[A-Z]+\b[^.]|\w[A-Z]+\Z", lambda m: m[0][0] + m[0][1:].lower(), s, flags=re.A)


def shortened(s):
    s = " ".join(re.split(r"[\s\ufeff]+", s or "")).strip(" ")
    s = re.sub(r"([^,@&]+),\s+[^,@&]+", r"\1@", s).replace("@&", " &").replace("@", "")
    return title(s) if len(s) >= 2 else s


AUTHORS = [None, "", " ", "X", "SMITH, A. & JONES, B.", "Smith, A. & Jones, B. & BROWN, C.", "  Smith,  John ", "DE LA BINE, O.", "Müller, É. & ÉCOLE", "BOÜHUTOU, B. B.", "a@b, c", "R. & S.", "ROÉ", "AB. CD EF.", "A, B, C & D, E"]


def test_shorten_authors(spark):
    df = spark.createDataFrame(list(enumerate(AUTHORS)), "k int, a string").select("k", T.shorten_authors("a").alias("s"))
    assert dict(map(tuple, df.collect())) == {k: shortened(a) for k, a in enumerate(AUTHORS)}


@tables
def test_shorten_authors_of_all_rows(spark):
    want = {k: shortened(a) for k, a in rows("materials", "row_id", "collectorname")}
    got = text_queries.QUERIES["shorten_authors"](spark, D).collect()
    assert len(got) == len(want) and dict(map(tuple, got)) == want and any("&" in x for x in want.values())


def shouted(s):
    return title(s) if s is not None and len(s) >= 2 and not re.search("[a-z]", s) else s


SHOUTED = [None, "", "A", "AB", "ab", "DE LA BINE, O.", "BOÜHUTOU-BAIRD, B. B.", "ROÉ", "Elisabeth Z. MÖDOU", "O'NEIL & KING", "AB.", "AB. CD", "AB\nCD", "7UP 7UP", "ÄÖÜ", "MC_NAB X1Y", " XY "]


def test_title_case(spark):
    df = spark.createDataFrame(list(enumerate(SHOUTED)), "k int, a string")
    assert dict(map(tuple, df.select("k", T.title_case_shouted(df.a)).collect())) == {k: shouted(a) for k, a in enumerate(SHOUTED)}


@tables
def test_title_case_of_whole_names(spark):
    want = {k: shouted(a) for k, a in rows("collector_names", "name_id", "collectorname")}
    got = text_queries.QUERIES["title_case"](spark, D).collect()
    assert len(got) == len(want) and dict(map(tuple, got)) == want


def space(s):
    return re.sub(r"[\s\ufeff]+", " ", s or "").strip(" ")


def normal(s):
    r = re.sub(r"\s*,*\s*(\(?[0-9]{4})[^)]*(\)?).*\Z", r", \1\2", space(s), count=1).replace('"', "").replace("'", "")
    out, at = "", 0  # initials, without a class of capital letters in this engine
    while at < len(r):
        m = re.compile(r"(?:(?a:\b)\w\.\s*)+((?a:\w)+)").match(r, at)
        if m and all(c.isupper() for c in re.findall(r"(\w)\.", m[0])):
            out, at = out + m[1], m.end()
        else:
            out, at = out + r[at], at + 1
    r = re.sub(r"\s+[Ee][Tt]\s+([^a])", r" & \1", re.sub(r"(?i)\s+and\s+", " & ", out))
    r = re.sub(r"^\(\(", "(", re.sub(r"\)\)\Z", ")", r))
    r = re.sub(r"\s*[,:;]+\s*\Z", "", re.sub(r"^\s*[,:;]+\s*", "", r)).strip()
    if r.count("&") > 1:
        parts = [p.strip() for p in r.split("&")]
        r = ", ".join(parts[:-1]) + " & " + parts[-1]
    return r + ")" if r.rfind("(") > r.rfind(")") else r


def named(s, year, date, defining, brackets):
    s = re.sub(r"\bin\b[^0-9]*", "", s, count=1, flags=re.A)
    s = shouted("Linnaeus" if s == "L." else s)
    if brackets and re.search("[()]", s):
        inside = next((m[0] for m in (re.search(p, s) for p in (r"\(.*\)", r"\(.*\Z", r"^.*\)")) if m), "")
        if re.search("[a-zA-Z]", inside) and inside != s:
            s = s.replace(inside, "", 1).strip()
    if year is not None:
        return f"{s}, {year}"
    return f"{s}, {date or 'null'}" if defining and not re.search("[0-9]", s) else s


def authority(a, author=None, date=None, defining=False):
    base, own = "", ""
    if a.get("baseAuthorityName"):
        base = normal("(" + named(a["baseAuthorityName"], a.get("baseAuthorityYear"), None, False, True) + ")")
    if a.get("authorityName"):
        own = normal(named(a["authorityName"], a.get("authorityYear"), date, defining, True))
        if base:
            own = re.sub(r"\(?@@@\)?[,:;\s]*", "", own.replace(base, "@@@"))
        own = space(own)
    if base and own:
        return base if a.get("kingdom") == "Animalia" else f"{base} {own}"
    if base or own:
        return base or own
    if a.get("authority"):
        return normal(named(a["authority"], a.get("authorityYear"), date, defining, False))
    return normal(f"{shortened(author)}, {date or 'null'}") if defining else "INVALID"


KEYS = ("authorityName", "authorityYear", "baseAuthorityName", "baseAuthorityYear", "authority", "kingdom")
PARTS = ["Smith", "JONES", "L.", "A. B. Brown", "É. Simon", "Müller", "(Smith", "Brown)", "(Brown)", "&", " & ", " and ", " et ", " et al.", " in ", ", ", ";", "1999", "(1901)", " ", '"', "de la", "DC.", "O'NEIL", "MC-NAB"]


@pytest.mark.parametrize("defining", [False, True])
def test_full_authority(spark, defining):
    rng, cases = random.Random(5), []
    text = lambda: rng.choice([None, "", "L.", "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 5)))])
    year = lambda: rng.choice([None, None, "", "1999", "1999a", "[1888]", "1901-1902"])
    for k in range(600):
        cases.append((k, text(), year(), rng.choice([None, text()]), year(), text(), rng.choice(["Animalia", "Plantae", None]), rng.choice(AUTHORS), rng.choice([None, "2001"])))
    df = spark.createDataFrame(cases, f"k int, {', '.join(f'{k} string' for k in KEYS)}, author string, date string")
    got = dict(map(tuple, df.select("k", T.full_authority({k: F.col(k) for k in KEYS}, F.col("author"), F.col("date"), defining)).collect()))
    wrong = [(c, got[c[0]], w) for c in cases if got[c[0]] != (w := authority(dict(zip(KEYS, c[1:7])), c[7], c[8], defining))]
    assert not wrong, wrong[:5]


@tables
def test_full_authority_of_all_rows(spark):
    want = {k: authority({"authorityName": n, "authorityYear": y, "kingdom": g}) for k, n, y, g in rows("taxon_names", "name_row_id", "authorityname", "authorityyear", "kingdom")}
    got = text_queries.QUERIES["full_authority"](spark, D).collect()
    assert len(got) == len(want) and dict(map(tuple, got)) == want
