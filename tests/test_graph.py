"""Small documents, each written for a rule, and models of the order-dependent rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators import tree
from stemma.operators.graph import TEXT_TAGS, citation_sets, comments, diagnostics, document_status, events, statements
from stemma.operators.hierarchy import RANKS, SPECIES_GROUP, ancestors, levels
from stemma.operators.turtle import documents_turtle
from stemma.sources.tables import cut

NAME = '<taxonomicName kingdom="Animalia" family="Aidae" genus="Bus" species="cus" rank="species" authorityName="{a}" authorityYear="{y}"/>'


def doc(body, attrs='docId="D1" docTitle="T &amp; &quot;q&quot;" docDate="2001" docAuthor="Smith, A. &amp; JONES, B."', nomenclature=NAME.format(a="Smith", y="1999")):
    return f'<document {attrs}><mods:mods><mods:titleInfo><mods:title>Paper</mods:title></mods:titleInfo><mods:name><mods:role><mods:roleTerm>Author</mods:roleTerm></mods:role><mods:namePart> Smith, A. </mods:namePart></mods:name><mods:classification>journal article</mods:classification><mods:relatedItem type="host"><mods:titleInfo><mods:title>J</mods:title></mods:titleInfo><mods:part><mods:detail type="volume"><mods:number>7</mods:number></mods:detail><mods:extent><mods:start>1</mods:start><mods:end>9</mods:end></mods:extent></mods:part></mods:relatedItem></mods:mods><treatment><subSubSection type="nomenclature">{nomenclature}</subSubSection>{body}</treatment></document>'


GROUP = '<subSubSection type="reference_group">{}</subSubSection>'
CITED = '<treatmentCitationGroup><treatmentCitation><taxonomicName kingdom="Animalia" family="Aidae" genus="{g}" species="{s}" rank="species" {a}/></treatmentCitation></treatmentCitationGroup>'
FIXTURES = {
    "cites": doc(GROUP.format(CITED.format(g="Bus", s="cus", a='authorityName="Smith" authorityYear="1999"') + CITED.format(g="Old", s="ous", a='authorityName="Brown" authorityYear="1901"') + CITED.format(g="Old", s="pus", a=""))),
    "material": doc('<materialsCitation id="M1" specimenCode="S 1" collectorName="X &quot;y&quot;"/><materialsCitation specimenCode="S:2"/><materialsCitation collectorName="nobody"/><materialsCitation ID-GBIF-Occurrence="5" httpUri="http://a/b c"/>'),
    "figure": doc('<figureCitation httpUri="https://doi.org/10.5281/zenodo.77" captionText="Fig"/><figureCitation httpUri="https://zenodo.org/record/88/files/f.png"/><figureCitation figureDoi="10.1/x"/><figureCitation/>'),
    "vernacular": doc('<vernacularName language="deu">Roter  Vogel</vernacularName><vernacularName language="qqq">Zork</vernacularName>'),
    "no_taxon": doc("", nomenclature=""), "bad_epithet": doc("", nomenclature='<taxonomicName kingdom="Animalia" genus="Bus" species="c9!" rank="species"/>'),
    "no_kingdom": doc("", nomenclature='<taxonomicName genus="Bus" rank="genus" authorityName="L." authorityYear="1758"/>'), "defining": doc("", nomenclature='<taxonomicName kingdom="Animalia" genus="Bus" rank="genus"/><taxonomicNameLabel>gen. nov.</taxonomicNameLabel>'),
    "dubious": doc("", nomenclature='<taxonomicName kingdom="Plantae" genus="Bus" rank="genus" status="nomen dubium" authorityName="DC" authorityYear="1800" baseAuthorityName="Smith"/>'),
    "no_document": "<other/>", "broken": "<document>", "blank": " ", "null": None,
}


@pytest.fixture(scope="module")
def graph(spark):
    src = spark.createDataFrame(list(FIXTURES.items()), "doc_path string, content string")
    n = cut(tree.nodes(src))
    s = cut(statements(n))
    return src, n, s, {(r.doc_path, r.predicate, r.object) for r in s.collect()}


def said(graph, path, predicate):
    return {o for p, q, o in graph[3] if p == path and q == predicate}


def test_citations(graph):
    base = "<http://taxon-concept.example.org/id/Animalia/"
    assert said(graph, "cites", "trt:augmentsTaxonConcept") == {base + "Bus_cus_Smith_1999>"}
    assert said(graph, "cites", "trt:deprecates") == {base + "Old_ous_Brown_1901>"}
    assert said(graph, "cites", "trt:citesTaxonName") == {"<http://taxon-name.example.org/id/Animalia/Old_pus>"}
    assert said(graph, "cites", "trt:hasParentName") >= {"<http://taxon-name.example.org/id/Animalia/Bus>", "<http://taxon-name.example.org/id/Animalia/Aidae>", "<http://taxon-name.example.org/id/Animalia>"}


def test_document_and_publication(graph):
    assert said(graph, "cites", "dc:title") == {'"T & \\"q\\""', '"Paper"'} and said(graph, "cites", "dc:creator") == {'"Smith, A."'}
    assert said(graph, "cites", "bibo:journal") == {'"J"'} and said(graph, "cites", "bibo:volume") == {'"7"'} and said(graph, "cites", "bibo:startPage") == {'"1"'} and said(graph, "cites", "bibo:endPage") == {'"9"'}
    assert "fabio:JournalArticle" in said(graph, "cites", "a")


def test_materials_and_figures(graph):
    assert said(graph, "material", "dwc:recordedBy") == {'"X \\"y\\""'} and said(graph, "material", "dwc:catalogNumber") == {'"S 1"', '"S:2"'}
    assert said(graph, "material", "dwc:basisOfRecord") == {"<http://material.example.org/id/D1.mc.M1>, <http://treatment.example.org/id/D1/S_2>, <https://www.gbif.org/occurrence/5>"}
    assert said(graph, "figure", "fabio:hasRepresentation") == {"<https://zenodo.org/record/77/files/figure.png>", "<https://zenodo.org/record/88/files/f.png>"}
    assert said(graph, "figure", "cito:cites") == {"<https://doi.org/10.5281/zenodo.77>, <http://dx.doi.org/10.5281/zenodo.88>, <http://dx.doi.org/10.1/x>"}


def test_names_labels_and_authorities(graph):
    assert said(graph, "vernacular", "dwc:vernacularName") == {'"Roter Vogel"@de', '"Zork"'}
    assert said(graph, "defining", "trt:definesTaxonConcept") == {"<http://taxon-concept.example.org/id/Animalia/Bus_Smith_2001>"}
    assert said(graph, "dubious", "trt:deprecates") == {"<http://taxon-concept.example.org/id/Plantae/Bus_(Smith_1800>"}
    assert said(graph, "dubious", "dwc:scientificNameAuthorship") == {'"(Smith) Dc, 1800"'}
    assert said(graph, "no_kingdom", "dwc:scientificNameAuthorship") == {'"Linnaeus, 1758"'}
    assert len(said(graph, "bad_epithet", "# Warning: Could not add treatment taxon because")) == 1


def test_status_and_turtle(graph):
    src, n, s, _ = graph
    got = dict(map(tuple, document_status(n, src).collect()))
    assert {k for k, v in got.items() if v == 3} == {"no_document", "broken", "blank", "null"}
    assert got["no_taxon"] == 2 and got["bad_epithet"] == 1 and got["no_kingdom"] == 1 and got["material"] == 1 and got["cites"] == 0
    text = dict(map(tuple, documents_turtle(s, src).collect()))
    assert set(text) == set(FIXTURES)
    assert text["broken"].endswith("missing <document>")
    for t in text.values():
        assert re.fullmatch(r'(?s)(@prefix \w+: <[^>]*> \.\n){9}(# Error[^\n]*|(\n<[^>]*>\n(    [^\n]+( [;.]|(?<=\n|.)))(\n    [^\n]+)*\n?)+)', t)
    one = text["cites"]
    assert one.index("treatment.example.org/id/D1>\n") < one.index("publication.example.org") < one.index("taxon-concept.example.org/id/Animalia/Bus_cus_Smith_1999>\n")


def test_same_result_for_any_partitioning(spark, graph):
    src = graph[0]
    for k in (1, 7):
        again = statements(cut(tree.nodes(src.repartition(k))))
        assert {(r.doc_path, r.predicate, r.object) for r in again.collect()} == graph[3]


def model_names(attrs):
    """A sequential model of a name and its parents: the list of (rank written, address)."""
    mark = re.compile(r"^\W*(var|subsp|f)\W*$", re.I)

    def address(limit):
        ranks, rank = [r for r in RANKS if r in attrs], attrs.get("rank")
        if limit and limit in ranks and ranks.index(limit) > 0:
            ranks = ranks[: ranks.index(limit)]
            rank = ranks[-1]
        if rank == "kingdom":
            return ""
        if rank in SPECIES_GROUP:
            several = [attrs.get("genus"), *([attrs.get("species")] if "species" in ranks else [attrs.get(k) for k in SPECIES_GROUP[:4]]), *(attrs.get(k) for k in ("undef-species", "subSpecies", "variety", "form") if k in ranks)]
            return "/" + "_".join(x for x in several if x and not re.match(r"^\W*(var|subsp|f|\.)\W*$", x, re.I))
        return "/" + attrs[rank].replace(".", "") if attrs.get(rank) else None

    out, limit = [], None
    while True:
        ranks, rank = [r for r in RANKS if r in attrs], attrs.get("rank")
        if limit and limit in ranks:
            ranks = ranks[: ranks.index(limit)]
            rank = ranks[-1] if ranks else None
        if rank and rank not in ranks:
            ranks = [*ranks, rank]
        ranks = [r for r in ranks if attrs.get(r) and not mark.match(attrs[r])]
        out.append((ranks[-1] if ranks else None, address(limit)))
        if not ranks or ranks[-1] == "kingdom" or ranks[-1] == limit:
            return out
        limit = ranks[-1]


def test_levels_against_a_sequential_model(spark):
    rng, rows = random.Random(8), []
    for k in range(400):
        attrs = {r: rng.choice(["Abc", "Defg", "xyz", "", "var."]) if rng.random() < 0.25 else r.replace("-", "").title() for r in RANKS if rng.random() < 0.4}
        if rng.random() < 0.9:
            attrs["rank"] = rng.choice([*attrs, "species", "genus"])
        rows.append((k, attrs))
    df = levels(spark.createDataFrame(rows, "k int, attrs map<string,string>"))
    got = {}
    for r in df.select("k", "level", "level_rank", "name_uri").collect():
        got.setdefault(r.k, {})[r.level] = (r.level_rank, r.name_uri)
    for k, attrs in rows:
        want = model_names(attrs)
        mine = [got[k][i] for i in sorted(got[k])]
        kingdom = attrs.get("kingdom") or "INVALID"
        for (rank, end), (level_rank, uri) in zip(want, mine):
            assert level_rank == rank, (attrs, want, mine)
            assert uri == (None if end is None else f"<http://taxon-name.example.org/id/{kingdom}{end}>"), (attrs, want, mine)


def test_citation_sets_against_a_sequential_model(spark):
    rng, rows, want = random.Random(9), [], set()
    for d in range(300):
        events = [(-1, rng.choice("TX"), f"n{rng.randrange(3)}", "")] + [(i, rng.choice("RICSDFCD"), f"n{rng.randrange(3)}", rng.choice(["", "1900"])) for i in range(rng.randrange(7))]
        seen, cites, gone, t_uri = set(), set(), set(), None
        for o, kind, name, year in events:
            uri = None if kind == "I" else f"{name}-{year}"
            rows.append((str(d), o, kind, name, uri, year, "ABSENT", False))
            if kind == "T":
                t_uri = uri
                want.add((str(d), "trt:augmentsTaxonConcept", uri))
                seen |= {uri, name}
            elif kind == "I" and name not in seen:
                want.add((str(d), "trt:citesTaxonName", name))
                seen.add(name)
            elif kind == "C":
                if uri not in seen and (name not in seen or year):
                    cites.add(uri)
                    seen.add(uri)
                seen.add(name)
            elif kind == "D" and uri != t_uri:
                gone.add(uri)
                seen |= {uri, name}
        want |= {(str(d), "trt:deprecates", u) for u in gone} | {(str(d), "cito:cites", u) for u in cites - gone}
    e = spark.createDataFrame(rows, "doc_path string, ord int, class string, tnuri string, uri string, year string, taxon_status string, defining boolean")
    got = {(r.doc_path, r.predicate, r.object) for r in citation_sets(e).collect()}
    assert got == want


def test_html_is_read_leniently(spark):
    html = "<html><body><p>one<p>two<br><a href='x'>l</a></b><ul><li>1<li>2</ul>"
    df = spark.createDataFrame([("h", html), ("n", None), ("e", "")], "doc_path string, content string")
    rows = tree.nodes(df, form="html").collect()
    assert [r.tag for r in rows] == ["html", "body", "p", "p", "br", "a", "ul", "li", "li"] and {r.doc_path for r in rows} == {"h"}


@pytest.mark.parametrize("text,want", [
    ("Smith and Jones, 1999", "Smith & Jones, 1999"), ('A. B. "Smith" et al. 1999a', "Smith et al., 1999"), ("Smith & Brown & Jones", "Smith, Brown & Jones"), ("(Smith, 1900", "(Smith, 1900)"), ("(Smith, 1900) xx", "(Smith, 1900)"), ("É. Simon", "É. Simon"), ("", ""), (None, ""), ("Smith et Jones;", "Smith & Jones"),
])
def test_normalize_authority(spark, text, want):
    assert spark.createDataFrame([(text,)], "a string").select(T.normalize_authority("a")).first()[0] == want


def test_text_functions_against_models(spark):
    from urllib.parse import quote

    rng = random.Random(1)
    texts = [None, "", " ﻿a  b ", *("".join(rng.choice("aZ9 %é日+/?#[]{}'()*~\"\\\n\t;,:@&=$-_.!🙂") for _ in range(rng.randrange(12))) for _ in range(200))]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r.k: r for r in df.select("k", T.normalize_space("t").alias("n"), T.encode_uri("t").alias("e"), T.string_literal("t").alias("s"), T.title_case_shouted(F.col("t")).alias("c")).collect()}
    import json

    for k, t in enumerate(texts):
        assert got[k].n == re.sub(r"[\s﻿]+", " ", t or "").strip(" ")
        assert got[k].e == (None if t is None else quote(t, safe=";,/?:@&=+$-_.!~*'()#"))
        assert json.loads(got[k].s) == (t or "")
    same = df.select(T.normalize_space("t").alias("a"), T.normalize_space(T.normalize_space("t")).alias("b")).where("a <> b")
    assert same.count() == 0


TAXON = '<taxonomicName kingdom="Animalia" genus="{g}" rank="genus" {more}/>'
REMARKS = {
    "invalid_authority": (doc("", nomenclature=TAXON.format(g="Bus", more="")), {(1, "authority")}, 1),
    "invalid_rank": (doc("", nomenclature='<taxonomicName kingdom="" genus="" superFamily="Xoidea" rank="superFamily" authorityName="Smith" authorityYear="1900"/>'), {(1, "kingdom"), (2, "rank"), (1, "name")}, 2),
    "abbreviated": (doc("", nomenclature='<taxonomicName kingdom="Animalia" genus="B." species="cus" rank="species" authorityName="Smith" authorityYear="1900"/>'), {(1, "name"), (1, "punctuation")}, 1),
    "no_parent": (doc("", nomenclature='<taxonomicName genus="Bus" rank="genus" authorityName="Smith" authorityYear="1900"/>'), {(1, "kingdom"), (1, "name")}, 1),
    "ignored": (doc("", nomenclature='<taxonomicName kingdom="Animalia" genus="Bus" species="cus" variety="var." rank="species" authorityName="Smith" authorityYear="1900"/>'), {(1, "ignored"), (1, "name")}, 1),
    "bracket": (doc("", nomenclature=TAXON.format(g="Bus", more='authorityName="Smith (ex Jones)" authorityYear="1900"')), {(1, "bracket")}, 1),
    "year": (doc("", nomenclature=TAXON.format(g="Bus", more='status="gen. nov." authorityName="Smith"')), {(0, "year")}, 0),
    "document": (doc("", nomenclature=TAXON.format(g="Bus", more='status="gen. nov."')), {(0, "document authority")}, 0),
    "cited_rank": (doc(GROUP.format('<treatmentCitation><taxonomicName genus="Bus" rank="genus" authorityName="Smith" authorityYear="1900"/></treatmentCitation>')), {(1, "cited rank")}, 1),
    "cited_lost": (doc(GROUP.format('<treatmentCitation><taxonomicName kingdom="Animalia" genus="Bus"/></treatmentCitation>')), {(2, "citation")}, 2),
    "nameless": (doc(GROUP.format("<treatmentCitation>nobody</treatmentCitation>")), {(0, "nameless citation")}, 0),
    "language": (doc('<vernacularName language="qqq">Zork</vernacularName>'), {(0, "language")}, 0),
    "no_identifier": (doc('<materialsCitation collectorName="x"/>'), {(1, "material")}, 1),
    "author_without_part": (doc('<mods:mods><mods:name><mods:role><mods:roleTerm>author</mods:roleTerm></mods:role></mods:name></mods:mods><materialsCitation collectorName="x"/>'), {(3, "exception"), (1, "material")}, 3),
    "empty_figure": (doc('<materialsCitation collectorName="x"/><figureCitation httpUri="" figureDoi=""/>'), {(3, "exception"), (1, "material")}, 3),
    "odd_rank": (doc("", nomenclature='<taxonomicName kingdom="Animalia" genus="Bus" clade="Cladus" rank="clade" authorityName="Smith" authorityYear="1900"/>'), set(), 0),
    "label_below": (doc("", nomenclature='<taxonomicName kingdom="Animalia" genus="Bus" rank="genus" authorityName="Smith" authorityYear="1900"/><paragraph><taxonomicName kingdom="Animalia" genus="Cus" rank="genus"/><emphasis/><taxonomicNameLabel>gen. nov.</taxonomicNameLabel></paragraph>'), set(), 0),
}


def test_every_remark_has_its_level(spark):
    src = spark.createDataFrame([(k, v[0]) for k, v in REMARKS.items()], "doc_path string, content string")
    n = cut(tree.nodes(src, texts=TEXT_TAGS))
    got = {}
    for r in diagnostics(n, src).collect():
        got.setdefault(r.doc_path, set()).add((r.level, r.key))
    assert {k: got.get(k, set()) for k in REMARKS} == {k: v[1] for k, v in REMARKS.items()}
    assert dict(map(tuple, document_status(n, src).collect())) == {k: v[2] for k, v in REMARKS.items()}
    e = cut(events(n, T.DEFAULT_HOST))
    s = cut(statements(n, taxa=e))
    said = lambda path, predicate: {r.object for r in s.collect() if r.doc_path == path and r.predicate == predicate}
    assert not s.where("doc_path in ('author_without_part', 'empty_figure')").count()
    assert said("document", "dwc:authority") == {'"Smith & Jones, 2001"'} and said("document", "dwc:authorityName") == {'"Smith & Jones"'} and said("document", "dwc:authorityYear") == {'"2001"'} and said("year", "dwc:authority") == set()
    assert said("bracket", "# Warning:") == {'Removing "(ex Jones)" from authority'} and said("ignored", "# Warning:") == {'ignoring variety "var."'}
    assert said("cited_rank", "# Warning:") == {"Not adding 'trt:citesTaxonName <http://taxon-concept.example.org/id/INVALID/Bus_Smith_1900>' due to issues with rank", "Could not determine parent name"} - {"Could not determine parent name"}
    assert len(said("cited_lost", "# Error:")) == 1 and said("label_below", "trt:definesTaxonConcept")
    text = dict(map(tuple, documents_turtle(s, src, comments=comments(n, src, e)).collect()))
    assert text["author_without_part"].split("\n")[9:] == ["# Error: an author has no name part"]
    assert text["empty_figure"].split("\n")[9:] == ["# Warning: Failed to output a material citation, could not create identifier", "# Error: a figure has neither link nor DOI"]
    assert text["no_parent"].split("\n")[9] == "# Warning: treatment taxon is missing ancestor kingdom"


def test_json_records_are_read_as_their_xml(spark):
    one = '{"document": {"@attributes": {"docId": "D", "docTitle": "A & b"}, "treatment": [{"nomenclature": {"taxonomicName": {"kingdom": "Animalia", "genus": "Bus", "rank": "genus"}}, "materials_examined": {"paragraph": {"materialsCitation": [{"@attributes": {"id": "1"}}, {"id": "2", "specimenCode": 7}]}}, "reference_group": {"treatmentCitation": {"taxonomicName": {"genus": "Old", "#text": "Old one"}}}}]}}'
    other = '<document docId="D" docTitle="A &amp; b"><treatment><subSubSection type="nomenclature"><taxonomicName kingdom="Animalia" genus="Bus" rank="genus"/></subSubSection><subSubSection type="materials_examined"><paragraph><materialsCitation id="1"/><materialsCitation id="2" specimenCode="7"/></paragraph></subSubSection><subSubSection type="reference_group"><treatmentCitation><taxonomicName genus="Old">Old one</taxonomicName></treatmentCitation></subSubSection></treatment></document>'
    df = spark.createDataFrame([("j", one), ("x", other), ("b", '{"document": {'), ("n", None), ("l", "[1]"), ("t", '{"a": {}, "b": {}}')], "doc_path string, content string")
    got = {"j": [], "x": []}
    for r in tree.nodes(df, form="any").orderBy("doc_path", "node_id").collect():
        got[r.doc_path].append(tuple(r)[1:])
    assert got["j"] == got["x"] and len(got["j"]) == 11


def test_ancestors_of_deep_and_circular_lists(spark):
    edges = [(k, k + 1) for k in range(12)] + [(100, 101), (101, 102), (102, 100), (3, 4), (None, 1), (5, None)]
    got = {(r.node, r.ancestor): r.distance for r in ancestors(spark.createDataFrame(edges, "child int, parent int")).collect()}
    want = {(a, b): b - a for a in range(12) for b in range(a + 1, 13)} | {(a, b): ((b - a) % 3) or 3 for a in (100, 101, 102) for b in (100, 101, 102)}
    assert got == want and ancestors(spark.createDataFrame([], "child int, parent int")).count() == 0
