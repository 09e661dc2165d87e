"""Deeply nested records to related flat tables, with Arrow kernels.

Each payload (XML or JSON) is read once into column buffers: one entry per element in
the order written, with the index of its parent and the few attributes that are asked
for. The entries of a payload form one list of an Arrow ListArray, so that list offsets
and parent indices, not rows, carry the structure: child tables are cut out by filter
kernels and keys are handed down by vectorised takes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from xml.parsers import expat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.sources.tables import cut

# --- fixed values: names of the record format --------------------------------------
ROOT, TREATMENT, TAXON, MATERIAL, SECTION = "document", "treatment", "taxonomicName", "materialsCitation", "subSubSection"
OWN_NAME_SECTION = "nomenclature"
OTHER, IS_ROOT, IS_TREATMENT, IS_TAXON, IS_MATERIAL, IS_OWN_SECTION = range(6)
CODES = {ROOT: IS_ROOT, TREATMENT: IS_TREATMENT, TAXON: IS_TAXON, MATERIAL: IS_MATERIAL, OWN_NAME_SECTION: IS_OWN_SECTION}
#: element -> the attribute that is kept of it
KEPT = {IS_ROOT: "docId", IS_TAXON: "rank", IS_MATERIAL: "specimenCode"}
JSON_ATTRIBUTES = "@attributes"
# -----------------------------------------------------------------------------------


class _Members(list):
    """A JSON object as its members in the order written (names may come twice)."""


def _refuse(word: str):
    raise ValueError(word)


_JSON = json.JSONDecoder(object_pairs_hook=_Members, parse_constant=_refuse)


def read_xml(text: str, kinds: list, parents: list, values: list, base: int) -> bool:
    """Append the elements of an XML payload to the buffers; False if it is broken or
    its root is another element (the caller cuts the buffers back)."""
    stack = [-1]
    parser = expat.ParserCreate(encoding="utf-8")
    parser.buffer_text = True

    def start(tag, attributes):
        kind = CODES.get(tag, OTHER)
        if kind == IS_OWN_SECTION or tag == SECTION:
            kind = IS_OWN_SECTION if tag == SECTION and attributes.get("type") == OWN_NAME_SECTION else OTHER
        kept = KEPT.get(kind)
        kinds.append(kind)
        parents.append(stack[-1])
        values.append(attributes.get(kept) if kept else None)
        stack.append(len(kinds) - 1)

    parser.StartElementHandler = start
    parser.EndElementHandler = lambda tag: stack.pop()
    try:
        parser.Parse(text.lstrip("﻿").encode("utf-8", "surrogatepass"), True)
    except (expat.ExpatError, ValueError):
        return False
    return len(kinds) > base and kinds[base] == IS_ROOT


def read_json(text: str, kinds: list, parents: list, values: list, base: int) -> bool:
    """The same of a JSON payload, whose top level must have the root as a member."""
    try:
        top = _JSON.decode(text.lstrip("﻿"))
    except (ValueError, RecursionError):
        return False
    roots = [v for k, v in top if k == ROOT] if isinstance(top, _Members) else []
    if len(roots) == 1 and isinstance(roots[0], list) and not isinstance(roots[0], _Members) and len(roots[0]) == 1:
        roots = roots[0]
    if len(roots) != 1 or not isinstance(roots[0], _Members):
        return False
    stack = [(IS_ROOT, roots[0], -1)]  # depth first, in the order written
    while stack:
        kind, members, parent = stack.pop()
        at = len(kinds)
        kinds.append(kind)
        parents.append(parent)
        kept, value, below = KEPT.get(kind), None, []
        for name, member in members if isinstance(members, _Members) else ():
            if name == JSON_ATTRIBUTES and isinstance(member, _Members):
                if kept:
                    value = next((v for k, v in member if k == kept), value)
            elif kept and name == kept and not isinstance(member, list):
                value = member
            else:
                code = CODES.get(name, OTHER)
                if isinstance(member, _Members):
                    below.append((code, member, at))
                elif isinstance(member, list):
                    below += [(code, m, at) for m in member if isinstance(m, _Members) or code in KEPT and m is not None]
                elif code in KEPT and member is not None:
                    below.append((code, member, at))
        values.append(None if value is None or isinstance(value, (list, bool)) else str(value))
        stack.extend(reversed(below))
    return True


def nested(payloads: list, forms: list) -> pa.ListArray:
    """One list of elements (kind, parent, value) per payload; parent is the index among
    all elements of the array. Null, blank, broken and rootless payloads give empty lists."""
    kinds: list[int] = []
    parents: list[int] = []
    values: list[str | None] = []
    offsets = [0]
    for text, form in zip(payloads, forms):
        base = len(kinds)
        if text and not text.isspace():
            read = read_json if form == "json" or form is None and text.lstrip()[:1] == "{" else read_xml
            if not read(text, kinds, parents, values, base):
                del kinds[base:], parents[base:], values[base:]
        offsets.append(len(kinds))
    entries = pa.StructArray.from_arrays([pa.array(kinds, pa.int8()), pa.array(parents, pa.int32()), pc.utf8_trim_whitespace(pa.array(values, pa.string()))], ["kind", "parent", "value"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)


def _positions(mask: np.ndarray, starts: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Number the marked elements of each list from 1."""
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[1:] - total[starts[row]]


def flat_tables(keys: pa.Array, payloads: list, forms: list) -> dict[str, pa.RecordBatch]:
    """The related flat tables of a batch of payloads.

    documents(key, docid); treatments(key, treatment_pos, parent_pos, taxon_pos, taxon_rank):
    parent_pos is the enclosing treatment's (0: none), taxon_pos the own name's (0: none);
    taxa(key, taxon_pos, treatment_pos, taxon_rank); materials(key, docid, mc_pos,
    treatment_pos, taxon_pos, taxon_rank, specimencode), whose taxon is the own name of the
    innermost enclosing treatment that has one (0 and '' if none has).
    """
    lists = nested(payloads, forms)
    flat = lists.flatten()
    row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()
    kind = flat.field("kind").to_numpy(zero_copy_only=False)
    parent = flat.field("parent").to_numpy(zero_copy_only=False)
    value = flat.field("value")
    n = len(kind)
    is_t, is_n, is_m = kind == IS_TREATMENT, kind == IS_TAXON, kind == IS_MATERIAL

    def nearest(good: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of each element of ``first``, itself or its nearest ancestor that is good; -1: none."""
        at = first.copy()
        while True:
            move = (at >= 0) & ~good[at]
            if not move.any():
                return at
            at[move] = parent[at[move]]

    treatment = nearest(is_t, parent) if n else parent
    # the own name of a treatment: the first name below a nomenclature of which it is the nearest treatment
    section = nearest((kind == IS_OWN_SECTION) | is_t, parent) if n else parent
    in_section = is_n & (section >= 0) & (kind[section] == IS_OWN_SECTION) if n else is_n
    named = np.flatnonzero(in_section & (treatment >= 0))
    own = np.full(n, -1)
    own[treatment[named[::-1]]] = named[::-1]  # the first one is written last
    holder = nearest(own >= 0, treatment) if n else treatment
    taxon_pos, treatment_pos, mc_pos = (_positions(m, starts, row) for m in (is_n, is_t, is_m)) if n else (kind, kind, kind)

    def take(source, at: np.ndarray, none):
        """source[at], and ``none`` where at is -1."""
        got = pc.take(pa.array(source) if isinstance(source, np.ndarray) else source, pa.array(at, mask=at < 0))
        return pc.fill_null(got, none)

    root = np.array([s if s < e else -1 for s, e in zip(starts, starts[1:])]) if n else starts[:-1] * 0 - 1
    docid = take(value, root, "") if n else pa.array([""] * len(keys))

    def pick(mask: np.ndarray, **columns) -> pa.RecordBatch:
        at = np.flatnonzero(mask)
        return pa.RecordBatch.from_pydict({"key": keys.take(pa.array(row[at])), **{k: f(at) for k, f in columns.items()}})

    own_of = (lambda at: np.where(holder[at] >= 0, own[holder[at]], -1)) if n else (lambda at: at)
    rank = lambda at: take(value, at, "")
    pos = lambda p, at: take(p.astype("int64"), at, 0)
    return {
        "documents": pick(np.isin(np.arange(n), root), docid=lambda at: docid.take(pa.array(row[at]))),
        "treatments": pick(is_t, treatment_pos=lambda at: pos(treatment_pos, at), parent_pos=lambda at: pos(treatment_pos, treatment[at]), taxon_pos=lambda at: pos(taxon_pos, own[at]), taxon_rank=lambda at: rank(own[at])),
        "taxa": pick(is_n, taxon_pos=lambda at: pos(taxon_pos, at), treatment_pos=lambda at: pos(treatment_pos, treatment[at]), taxon_rank=lambda at: rank(at)),
        "materials": pick(is_m, docid=lambda at: docid.take(pa.array(row[at])), mc_pos=lambda at: pos(mc_pos, at), treatment_pos=lambda at: pos(treatment_pos, treatment[at]), taxon_pos=lambda at: pos(taxon_pos, own_of(at)), taxon_rank=lambda at: rank(own_of(at)), specimencode=lambda at: take(value, at, "")),
    }


SCHEMAS = {
    "documents": "key long, docid string",
    "treatments": "key long, treatment_pos long, parent_pos long, taxon_pos long, taxon_rank string",
    "taxa": "key long, taxon_pos long, treatment_pos long, taxon_rank string",
    "materials": "key long, docid string, mc_pos long, treatment_pos long, taxon_pos long, taxon_rank string, specimencode string",
}


def flatten_records(df: DataFrame, which: str, key: str = "raw_id", form: str = "payload_form", payload: str = "payload") -> DataFrame:
    """One of the flat tables (see ``flat_tables``) of all payloads of df.

    Payloads that are null, blank, broken or have another root give no rows; records that
    come twice give rows under each key; values are decoded and trimmed. No shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = flat_tables(b.column(0), b.column(2).to_pylist(), b.column(1).to_pylist())[which]
            if made.num_rows:
                yield made

    src = df.select(F.col(key).cast("long"), F.col(form).cast("string"), F.col(payload).cast("string")).where(F.length(F.trim(payload)) > 0)
    return src.mapInArrow(work, SCHEMAS[which])


#: All columns of the flat tables, and the table that a row is of.
UNION = "part string, key long, docid string, treatment_pos long, parent_pos long, taxon_pos long, taxon_rank string, mc_pos long, specimencode string"


def flatten_all(df: DataFrame, key: str = "raw_id", form: str = "payload_form", payload: str = "payload") -> dict[str, DataFrame]:
    """All flat tables by name, for one reading of the payloads: they leave it as one table with
    a column for the part, which is written to the shared folder; see ``flatten_records``."""
    fields = [f.split() for f in UNION.split(", ")]
    types = {"string": pa.string(), "long": pa.int64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, made in flat_tables(b.column(0), b.column(2).to_pylist(), b.column(1).to_pylist()).items():
                if n := made.num_rows:
                    has = {"part": pa.array([part] * n), **{c: made.column(c) for c in made.schema.names}}
                    yield pa.RecordBatch.from_arrays([has[c].cast(types[t]) if c in has else pa.nulls(n, types[t]) for c, t in fields], [c for c, _ in fields])

    src = df.select(F.col(key).cast("long"), F.col(form).cast("string"), F.col(payload).cast("string")).where(F.length(F.trim(payload)) > 0)
    rows = cut(src.mapInArrow(work, UNION))
    return {part: rows.where(F.col("part") == part).select(*(c.split()[0] for c in schema.split(", "))) for part, schema in SCHEMAS.items()}
