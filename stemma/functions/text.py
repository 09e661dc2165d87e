"""String functions of the document graph, as Column expressions of built-ins.

All of them stay in generated code; none calls Python per row. White space, word
boundaries and ends of text are spelled out, because regular expression dialects differ in them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: character classes and address forms ------------------------------
WS = r"[\t\n\x0B\f\r    -     　﻿]"
B = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
RESERVED = (("%3B", ";"), ("%2C", ","), ("%2F", "/"), ("%3F", "?"), ("%3A", ":"), ("%40", "@"), ("%26", "&"), ("%3D", "="), ("%2B", "+"), ("%24", "$"), ("%21", "!"), ("%7E", "~"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%23", "#"))
RANK_MARK = r"(?i)^[^A-Za-z0-9_]*(var|subsp|f)[^A-Za-z0-9_]*\z"
NAME_MARK = r"(?i)^[^A-Za-z0-9_]*(var|subsp|f|\.)[^A-Za-z0-9_]*\z"
DEFAULT_HOST = "example.org"
# -----------------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: a lambda's variable stands for it, so that
    nested functions don't multiply the size of the expression."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def present(c: Column | str) -> Column:
    """Neither null nor empty."""
    return F.coalesce(_c(c), F.lit("")) != ""


def normalize_space(c: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends; null gives ''."""
    return F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), WS + "+", " "))


def partial_uri(c: Column | str) -> Column:
    """A part of an address: reserved signs become blanks, then as normalize_space."""
    return normalize_space(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"[;/?:@&=+$,#]+", " "))


def encode_uri(c: Column | str) -> Column:
    """Percent-encoding of all but unreserved and reserved signs; '%' is encoded again."""
    out = F.regexp_replace(F.url_encode(_c(c)), r"\+", "%20")
    for code, sign in RESERVED:
        out = F.replace(out, F.lit(code), F.lit(sign))
    return out


def uri(c: Column | str, blank: str = "") -> Column:
    """<address>, white space replaced by ``blank`` and the rest encoded; '[]' for null or ''."""
    tidy = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, f"^{WS}+", ""), f"{WS}+\\z", ""), WS + "+", blank)
    return let(_c(c), lambda x: F.when(present(x), F.concat(F.lit("<"), encode_uri(tidy(x)), F.lit(">"))).otherwise(F.lit("[]")))


def string_literal(c: Column | str) -> Column:
    """A quoted, escaped literal; null and '' give '""'."""
    quoted = F.to_json(F.array(F.coalesce(_c(c), F.lit(""))))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def substring_before(c: Column | str, sign: str) -> Column:
    """What stands before the first ``sign``; all if there is none."""
    return F.substring_index(_c(c), sign, 1)


def substring_after(c: Column | str, sign: str) -> Column:
    """What stands after the last ``sign``; all if there is none."""
    return F.substring_index(_c(c), sign, -1)


def remove_punctuation(c: Column | str) -> Column:
    """Without separators, symbols and punctuation other than '-'."""
    return F.regexp_replace(_c(c), r"[\p{Z}\p{S}\p{P}&&[^-]]", "")


def first_year(c: Column | str) -> Column:
    """The first run of digits, else ''."""
    return F.regexp_extract(F.coalesce(_c(c), F.lit("")), "[0-9]+", 0)


def replace_first(c: Column, pattern: str, by: str) -> Column:
    """Only the first match replaced (the built-in replaces all)."""
    head = f"(?s)^.*?(?:{pattern})"
    return let(c, lambda x: F.when(x.rlike(pattern), F.concat(F.regexp_extract(x, f"(?s)^(.*?)(?:{pattern})", 1), F.lit(by), F.regexp_replace(x, head, ""))).otherwise(x))


def title_case(c: Column) -> Column:
    """Words in capitals with the first letter kept and the rest lowered."""
    marked = F.regexp_replace(c, rf"[A-Za-z0-9_][A-Z]+{B}[^.]|[A-Za-z0-9_][A-Z]+\z", "\u0001$0\u0002")
    parts = F.split(marked, "\u0001")
    low = lambda p: F.concat(F.substring(p, 1, 1), F.lower(F.substring_index(F.substring(p, F.lit(2), F.length(p)), "\u0002", 1)), F.substring_index(p, "\u0002", -1))
    return F.array_join(F.transform(parts, lambda p: F.when(F.contains(p, F.lit("\u0002")), low(p)).otherwise(p)), "")


def title_case_shouted(c: Column) -> Column:
    """title_case of texts of two letters or more that have no small one."""
    return let(c, lambda x: F.when((F.length(x) >= 2) & ~x.rlike("[a-z]"), title_case(x)).otherwise(x))


def strip_in(c: Column) -> Column:
    """Without the first 'in ...' up to a digit; a lone 'L.' is spelled out."""
    return let(replace_first(c, rf"{B}in{B}[^0-9]*", ""), lambda x: F.when(x == "L.", F.lit("Linnaeus")).otherwise(x))


def bracketed(c: Column) -> Column:
    """The bracketed part that is to go: null unless it has a letter and isn't all."""
    inside = F.coalesce(*(F.nullif(F.regexp_extract(c, p, 0), F.lit("")) for p in (r"\(.*\)", r"\(.*\z", r"^.*\)")), F.lit(""))
    return let(inside, lambda x: F.when(c.rlike(r"[()]") & x.rlike("[a-zA-Z]") & (x != c), x))


def remove_bracketed(c: Column) -> Column:
    cut = lambda x, i: F.trim(F.concat(F.substring(x, F.lit(1), F.instr(x, i) - 1), F.substring(x, F.instr(x, i) + F.length(i), F.length(x))))
    return let(c, lambda x: let(bracketed(x), lambda i: F.when(i.isNotNull(), cut(x, i)).otherwise(x)))


def normalize_authority(c: Column | str) -> Column:
    """One form of an authority: initials and quotes gone, year at the end, '&' before the
    last of several names, brackets closed. Null and '' give ''."""
    return let(normalize_space(c), _normal)


def _normal(source: Column) -> Column:
    tail = r" *,* *(\(?[0-9]{4})[^)]*(\)?).*$"
    year = F.concat(F.lit(", "), F.regexp_extract(source, tail, 1), F.regexp_extract(source, tail, 2))
    r = F.when(source.rlike(tail), F.concat(F.regexp_replace(source, tail, ""), year)).otherwise(source)
    r = F.replace(F.replace(r, F.lit('"'), F.lit("")), F.lit("'"), F.lit(""))
    r = F.regexp_replace(r, rf"(?:{B}\p{{Lu}}\. *)+([A-Za-z0-9_]+)", "$1")
    r = F.regexp_replace(r, r"(?i) +and +", " & ")
    r = F.regexp_replace(r, r" +[Ee][Tt] +([^a])", " & $1")
    r = F.regexp_replace(r, r"\)\)\z", ")")
    r = F.regexp_replace(r, r"^\(\(", "(")
    r = F.regexp_replace(r, r"^ *[,:;]+ *", "")
    r = F.trim(F.regexp_replace(r, r" *[,:;]+ *\z", ""))

    def joined(parts: Column) -> Column:
        n = F.size(parts)
        return F.when(n > 2, F.concat(F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(" & "), F.element_at(parts, -1)))

    def closed(x: Column) -> Column:
        last = lambda s: F.length(F.substring_index(F.concat(F.lit(s), x), s, -1))  # noqa: E731  # signs behind the last one
        open_after = F.contains(x, F.lit("(")) & (~F.contains(x, F.lit(")")) | (last("(") < last(")")))
        return F.when(open_after, F.concat(x, F.lit(")"))).otherwise(x)

    return let(let(r, lambda x: F.coalesce(joined(F.transform(F.split(x, "&"), lambda p: F.trim(p))), x)), closed)


def shorten_authors(c: Column | str) -> Column:
    """Surnames of an author list, title-cased."""
    r = F.regexp_replace(normalize_space(c), r"([^,@&]+), +[^,@&]+", "$1@")
    r = F.replace(F.replace(r, F.lit("@&"), F.lit(" &")), F.lit("@"), F.lit(""))
    return let(r, lambda x: F.when(F.length(x) >= 2, title_case(x)).otherwise(x))


def authority_for_uri(c: Column | str) -> Column:
    """The last name of the first author: an opening bracket before it is kept."""
    a = substring_after(substring_before(substring_before(substring_before(c, ")"), " &"), ","), " ")
    return let(a, lambda x: partial_uri(F.coalesce(F.nullif(F.regexp_extract(x, r"\(?\p{L}+", 0), F.lit("")), x)))


def _named(name: Column, year: Column, date: Column, defining: Column, has_year: Column, brackets: bool) -> Column:
    a = title_case_shouted(strip_in(name))
    a = remove_bracketed(a) if brackets else a
    return let(a, lambda x: F.when(has_year, F.concat(x, F.lit(", "), year)).when(defining & ~x.rlike("[0-9]"), F.concat(x, F.lit(", "), F.coalesce(date, F.lit("null")))).otherwise(x))


def full_authority(attrs: dict[str, Column], doc_author: Column, doc_date: Column, defining: bool | Column = True) -> Column:
    """The readable authority of a taxon; 'INVALID' if there is none.

    attrs: authorityName, authorityYear, baseAuthorityName, baseAuthorityYear, authority,
    kingdom (nullable). With ``defining`` the document's author and date stand in. A kingdom
    of animals keeps the base authority alone, others get both.
    """
    get = lambda k: attrs.get(k, F.lit(None).cast("string"))
    never = defining is False
    defining = F.lit(defining) if isinstance(defining, bool) else F.coalesce(defining, F.lit(False))
    name, year, base_name, base_year, other, kingdom = (get(k) for k in ("authorityName", "authorityYear", "baseAuthorityName", "baseAuthorityYear", "authority", "kingdom"))
    base = let(remove_bracketed(title_case_shouted(strip_in(base_name))), lambda x: F.when(base_year.isNotNull(), F.concat(x, F.lit(", "), base_year)).otherwise(x))
    base = F.when(present(base_name), normalize_authority(F.concat(F.lit("("), base, F.lit(")"))))
    named = F.when(present(name), normalize_authority(_named(name, year, doc_date, defining, year.isNotNull(), True)))
    single = normalize_authority(_named(other, year, doc_date, defining, year.isNotNull(), False))
    fallback = F.lit("INVALID") if never else F.when(defining, normalize_authority(F.concat(shorten_authors(doc_author), F.lit(", "), F.coalesce(doc_date, F.lit("null"))))).otherwise("INVALID")

    def chosen(x: Column) -> Column:
        b, o = x["base"], x["own"]
        both = F.when(kingdom == "Animalia", b).otherwise(F.concat(b, F.lit(" "), o))
        return F.when(present(b) & present(o), both).when(present(b), b).when(present(o), o).when(present(other), single).otherwise(fallback)

    def without_base(x: Column) -> Column:
        own = F.when(present(x["base"]), F.regexp_replace(F.replace(x["own"], x["base"], F.lit("@@@")), r"\(?@@@\)?[,:; ]*", "")).otherwise(x["own"])
        return F.struct(x["base"].alias("base"), F.when(present(name), normalize_space(own)).alias("own"))

    return let(let(F.struct(base.alias("base"), named.alias("own")), without_base), chosen)


def authority_notes(attrs: dict[str, Column], defining: Column) -> Column:
    """What is noted of a taxon's authority: (base, own: the bracketed parts that go; year: the
    document's date stands in for its year; document: its author and date for all of it)."""
    get = lambda k: attrs.get(k, F.lit(None).cast("string"))
    name, year, base_name, other = (get(k) for k in ("authorityName", "authorityYear", "baseAuthorityName", "authority"))
    part = lambda c: F.when(present(c), bracketed(title_case_shouted(strip_in(c))))
    undated = lambda c: present(c) & year.isNull() & ~F.coalesce(c.rlike("[0-9]"), F.lit(False))
    late = defining & (undated(remove_bracketed(title_case_shouted(strip_in(name)))) | (~present(name) & ~present(base_name) & undated(strip_in(other))))
    return F.struct(part(base_name).alias("base"), part(name).alias("own"), late.alias("year"), (defining & ~present(name) & ~present(base_name) & ~present(other)).alias("document"))


def rank_group(get) -> Column:
    """The group of the lowest rank that a taxon has; get(rank) is its nullable epithet."""
    groups = (("species", ("species",)), ("genus", ("genus",)), ("tribe", ("tribe", "subTribe")), ("family", ("family", "subFamily")), ("order", ("order", "subOrder")), ("class", ("class", "subClass")), ("phylum", ("phylum", "subPhylum")), ("kingdom", ("kingdom",)))
    out = None
    for group, ranks in groups:
        has = None
        for r in ranks:
            has = present(get(r)) if has is None else has | present(get(r))
        out = F.when(has, F.lit(group)) if out is None else out.when(has, F.lit(group))
    return out.otherwise(F.lit("INVALID"))


def taxon_relation(cited, treated, in_group: Column, has_treated: Column) -> Column:
    """CITES, SAME, NONE or DEPRECATES of a cited against the treated taxon; cited(attr)
    and treated(attr) are nullable attributes. The first rule that holds decides."""
    cg, tg = rank_group(cited), rank_group(treated)
    same = lambda k: cited(k).eqNullSafe(treated(k))
    match = lambda y, n: cited(y).isNotNull() & same(y) & same(n)
    authority = match("authorityYear", "authorityName") | match("baseAuthorityYear", "baseAuthorityName")
    alike = authority
    for k in ("rank", "genus", "subGenus", "species", "subSpecies", "variety"):
        alike = alike & same(k)
    is_rank = lambda who, r: F.coalesce(who("rank") == r, F.lit(False))
    return (
        F.when(~F.coalesce(has_treated, F.lit(False)) | ~F.coalesce(in_group, F.lit(False)), "CITES")
        .when((cg == "INVALID") | (tg == "INVALID"), "NONE")
        .when(cg != tg, "CITES")
        .when(~present(treated("genus")) | ~present(cited("genus")), "CITES")
        .when(is_rank(cited, "genus") & ~is_rank(treated, "genus") & same("genus"), "CITES")
        .when(is_rank(cited, "species") & ~is_rank(treated, "species") & same("genus") & same("species"), "CITES")
        .when(alike, "SAME")
        .otherwise("DEPRECATES")
    )


def publication_uri(doi: Column, source: Column, master: Column, host: str = DEFAULT_HOST) -> Column:
    """The address of a document's publication, from its DOI, else its source, else its master id."""
    tidy = lambda c: uri(replace_first(replace_first(c, "https://", "http://"), r"http://dx\.doi\.org/", "http://doi.org/"))
    made = F.concat(F.lit("http://doi.org/"), doi)
    return (
        F.when(~present(doi), uri(F.concat(F.lit(f"http://publication.{host}/id/"), partial_uri(master))))
        .when(F.contains(doi, F.lit("doi.org")), tidy(doi))
        .when(~F.startswith(doi, F.lit("http")), tidy(made))
        .when(F.contains(F.coalesce(source, F.lit("")), F.lit("doi.org")), tidy(source))
        .otherwise(tidy(made))
    )


def material_uri(mc_id: Column, occurrence: Column, http_uri: Column, specimen: Column, doc_id: Column, host: str = DEFAULT_HOST, base: str | None = None) -> Column:
    """The address of a cited material: id, else occurrence, else link, else treatment and
    specimen code; null (no subject, a warning instead) if it has none of id, link and code. ``base`` is what
    stands before the document in an address made of an id."""
    return F.when(present(mc_id) | present(http_uri) | present(specimen), F.when(present(mc_id), uri(F.concat(F.lit(base or f"http://material.{host}/id/"), doc_id, F.lit(".mc."), mc_id))).when(present(occurrence), uri(F.concat(F.lit("https://www.gbif.org/occurrence/"), occurrence))).when(present(http_uri), uri(http_uri)).otherwise(uri(F.concat(F.lit(f"http://treatment.{host}/id/"), doc_id, F.lit("/"), partial_uri(specimen)), "_")))


def figure_uri(http_uri: Column, doi: Column) -> Column:
    """The address of a figure from its link or DOI; null if it has neither."""
    link = F.coalesce(http_uri, F.lit(""))
    number = substring_after(substring_before(F.replace(link, F.lit(" "), F.lit("")), "/files/"), "/record/")
    return (
        F.when(F.contains(link, F.lit("10.5281/zenodo.")), uri(link))
        .when(F.contains(link, F.lit("zenodo.")), uri(F.concat(F.lit("http://dx.doi.org/10.5281/zenodo."), number)))
        .when(F.contains(F.coalesce(doi, F.lit("")), F.lit("doi.org/10.")), uri(doi))
        .when(present(doi), uri(F.concat(F.lit("http://dx.doi.org/"), doi)))
        .when(link != "", uri(link))
    )


def figure_representation(http_uri: Column) -> Column:
    """The address of a figure's picture; null without a link."""
    link = F.replace(F.coalesce(http_uri, F.lit("")), F.lit(" "), F.lit(""))
    record = F.concat(F.lit("https://zenodo.org/record/"), substring_after(link, "10.5281/zenodo."), F.lit("/files/figure.png"))
    return F.when(F.contains(link, F.lit("10.5281/zenodo.")), uri(record)).when(link != "", uri(link))


def fold_error(c: Column | str) -> Column:
    """A message as comment lines."""
    return F.replace(_c(c), F.lit("\n"), F.lit("\n# "))


def target_path(c: Column | str) -> Column:
    """The output path of a source path: its last four signs replaced by '.ttl'."""
    c = _c(c)
    return F.concat(F.substring(c, F.lit(1), F.length(c) - 4), F.lit(".ttl"))


def directory(c: Column | str) -> Column:
    """What stands before the last '/'; '' if there is none."""
    return F.regexp_replace(F.when(F.contains(_c(c), F.lit("/")), _c(c)).otherwise(F.lit("")), r"/[^/]*\z", "")


def rooted(c: Column | str) -> Column:
    """A path with exactly its leading '/'."""
    return F.when(F.startswith(_c(c), F.lit("/")), _c(c)).otherwise(F.concat(F.lit("/"), _c(c)))
