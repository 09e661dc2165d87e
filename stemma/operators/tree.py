"""Documents as node tables, and path predicates on them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODES = "doc_path string, node_id int, parent_id int, depth int, tag string, sib_ord int, ancestors array<struct<node_id:int,tag:string,type:string>>, attrs map<string,string>, attr_names array<string>, text string, subtree_end int"
_ARROW = pa.schema([("doc_path", pa.string()), ("node_id", pa.int32()), ("parent_id", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("sib_ord", pa.int32()), ("ancestors", pa.list_(pa.struct([("node_id", pa.int32()), ("tag", pa.string()), ("type", pa.string())]))), ("attrs", pa.map_(pa.string(), pa.string())), ("attr_names", pa.list_(pa.string())), ("text", pa.string()), ("subtree_end", pa.int32())])
_BLANKS = re.compile(r"\s+")
_MODS = re.compile(r"(</?)mods:")
#: HTML elements that never have an end tag (fixed values).
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Members of a JSON record that stand for a section of that type, and those for attributes and text.
SECTIONS, SECTION, ATTRIBUTES, TEXT = ("nomenclature", "reference_group", "materials_examined", "multiple"), "subSubSection", "@attributes", "#text"


class _Builder:
    """Collects elements in document order, with the text of those whose tag is in ``texts``
    (None: of all)."""

    def __init__(self, texts: frozenset | None = None):
        self.rows, self.open, self.children, self.texts = [], [], {}, texts

    def start(self, tag: str, attrs: dict) -> None:
        parent = self.open[-1] if self.open else None
        k = len(self.rows)
        at = self.children.get(parent and parent["node_id"], 0)
        self.children[parent and parent["node_id"]] = at + 1
        row = {"node_id": k, "parent_id": parent["node_id"] if parent else None, "depth": len(self.open), "tag": tag, "sib_ord": at, "ancestors": [{"node_id": x["node_id"], "tag": x["tag"], "type": x["attrs"].get("type")} for x in self.open], "attrs": attrs, "attr_names": list(attrs), "text": [], "subtree_end": k + 1}
        self.rows.append(row)
        self.open.append(row)

    def end(self) -> None:
        self.open.pop()["subtree_end"] = len(self.rows)

    def data(self, text: str) -> None:
        text = _BLANKS.sub(" ", text)
        for row in self.open:
            if self.texts is None or row["tag"] in self.texts:
                row["text"].append(text)


class _Html(HTMLParser):
    def __init__(self, texts: frozenset | None = None):
        super().__init__(convert_charrefs=True)
        self.b = _Builder(texts)

    def handle_starttag(self, tag, attrs):
        self.b.start(tag, {k: v or "" for k, v in reversed(attrs)})
        if tag in VOID:
            self.b.end()

    def handle_startendtag(self, tag, attrs):
        self.b.start(tag, {k: v or "" for k, v in reversed(attrs)})
        self.b.end()

    def handle_endtag(self, tag):
        if any(x["tag"] == tag for x in self.b.open):  # an end without a start is left out
            while self.b.open[-1]["tag"] != tag:
                self.b.end()
            self.b.end()

    def handle_data(self, data):
        if self.b.open:
            self.b.data(data)


def parse_xml(text: str, texts: frozenset | None = None) -> list[dict]:
    """The nodes of an XML text, 'mods:' read as part of plain names; [] if it is broken."""
    b, parser = _Builder(texts), expat.ParserCreate(encoding="utf-8")
    parser.buffer_text = True
    parser.StartElementHandler = lambda tag, attrs: b.start(tag, attrs)
    parser.EndElementHandler = lambda tag: b.end()
    parser.CharacterDataHandler = b.data
    try:
        parser.Parse(_MODS.sub(r"\1MODS", text.lstrip("﻿")).encode("utf-8", "surrogatepass"), True)
    except (expat.ExpatError, ValueError):
        return []
    return b.rows


class _Members(list):
    """A JSON object as its members in the order written."""


_JSON = json.JSONDecoder(object_pairs_hook=_Members)


def _as_text(value) -> str:
    return value if isinstance(value, str) else json.dumps(value)


def parse_json(text: str, texts: frozenset | None = None) -> list[dict]:
    """The nodes of a JSON record: objects and lists of objects are elements of their member's
    name, sections elements of that type, plain members and '@attributes' attributes; [] if it is broken
    or its top level has other than one object."""
    try:
        top = _JSON.decode(text.lstrip("﻿"))
    except (ValueError, RecursionError):
        return []
    b = _Builder(texts)
    roots = [(name, x) for name, v in top for x in (v if isinstance(v, list) and not isinstance(v, _Members) else [v]) if isinstance(x, _Members)] if isinstance(top, _Members) else []
    stack = [roots[0]] if len(roots) == 1 else []
    while stack:  # depth first, in the order written
        name, value = stack.pop()
        if name is None:
            b.end()
            continue
        tag, attrs, below = (SECTION, {"type": name}, []) if name in SECTIONS else (name, {}, [])
        own = None
        for k, v in value if isinstance(value, _Members) else ():
            if k == ATTRIBUTES and isinstance(v, _Members):
                attrs |= {a: _as_text(x) for a, x in v if not isinstance(x, list) and x is not None}
            elif k == TEXT and v is not None:
                own = _as_text(v)
            elif isinstance(v, list):
                below += [(k, x) for x in (v if not isinstance(v, _Members) else [v]) if x is not None]
            elif v is not None:
                attrs[k] = _as_text(v)
        b.start(tag, attrs)
        own = own if isinstance(value, _Members) else _as_text(value)
        if own:
            b.data(own)
        stack.append((None, None))
        stack.extend(reversed(below))
    return b.rows


def parse_html(text: str, texts: frozenset | None = None) -> list[dict]:
    """The nodes of an HTML text, however broken."""
    parser = _Html(texts)
    parser.feed(text)
    parser.close()
    while parser.b.open:
        parser.b.end()
    return parser.b.rows


#: Rows of nodes that are handed over at once.
BATCH = 10_000


def nodes(documents: DataFrame, path: str = "doc_path", content: str = "content", form: str = "xml", texts: tuple | None = None) -> DataFrame:
    """One row per element (see NODES), numbered in document order; an element's subtree
    is the numbers from its own to subtree_end. ``form`` is 'xml', 'json', 'html' or, for
    'any', XML or JSON by the first sign. Null, blank and broken documents have no rows; texts have
    runs of white space collapsed and are kept of elements whose tag is in ``texts`` (None: of
    all, which holds each text once per level). No shuffle."""
    parse = {"xml": parse_xml, "html": parse_html, "json": parse_json}.get(form, lambda t, kept: (parse_json if t.lstrip("﻿ \t\r\n")[:1] == "{" else parse_xml)(t, kept))
    kept = None if texts is None else frozenset(texts)

    def batch(rows: list[dict]) -> pa.RecordBatch:
        columns = {c: [row[c] for row in rows] for c in _ARROW.names}
        columns["text"] = ["".join(t) for t in columns["text"]]
        columns["attrs"] = [list(a.items()) for a in columns["attrs"]]
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in _ARROW], schema=_ARROW)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            for p, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for row in parse(text, kept) if text and text.strip() else []:
                    row["doc_path"] = p
                    held.append(row)
                if len(held) >= BATCH:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    return documents.select(F.col(path).cast("string").alias("_p"), F.col(content).cast("string").alias("_c")).mapInArrow(work, NODES)


def below(*tags: str) -> Column:
    """Is the node below elements of these tags, outermost first? A tag may be 'tag[type]'."""
    at: Column = F.lit(0)
    ok: Column = F.lit(True)
    for t in tags:
        rest = F.slice("ancestors", at + 1, F.greatest(F.size("ancestors") - at, F.lit(0)))
        place = F.array_position(F.transform(rest, _is(t)), F.lit(True)).cast("int")
        ok = ok & (place > 0)
        at = at + place
    return ok


def _is(tag: str):
    name, _, kind = tag.partition("[")
    kind = kind.rstrip("]")
    return lambda a: F.coalesce((a["tag"] == name) & ((a["type"] == kind) if kind else F.lit(True)), F.lit(False))


def inside_any(*tags: str) -> Column:
    """Is any ancestor one of these tags?"""
    return F.exists("ancestors", lambda a: a["tag"].isin(*tags))


def child_of(*tags: str) -> Column:
    """Are the nearest ancestors these tags, the parent last?"""
    ok = F.lit(True)
    for k, t in enumerate(reversed(tags), 1):
        ok = ok & (F.get(F.reverse("ancestors"), F.lit(k - 1))["tag"] == t)
    return F.coalesce(ok, F.lit(False))


def first_below(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """(doc_path, node_id, first_id): of each outer node itself or the first inner node of
    its subtree (null: none), by an interval join within the document."""
    o = outer.select("doc_path", "node_id", "subtree_end")
    i = inner.select(F.col("doc_path").alias("_d"), F.col("node_id").alias("_i"))
    met = o.join(i, (o["doc_path"] == i["_d"]) & (i["_i"] >= o["node_id"]) & (i["_i"] < o["subtree_end"]), "left")
    return met.groupBy("doc_path", "node_id").agg(F.min("_i").alias("first_id"))
