"""Queries of joins, aggregates, windows, sets, hierarchies, sinks and change sets, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators import tree
from stemma.operators.flatten import flatten_all, flatten_records
from stemma.operators.graph import LANGUAGES, MATERIAL_TERMS, NOT_COPIED, TEXT_TAGS, attribute_statements, citation_sets, cited_taxa, comments, diagnostics, document_rows, document_status, events, listed, material_statements, statements, treated_taxa
from stemma.operators.hierarchy import RANKS, SPECIES_GROUP, ancestors, concept_uri, levels, with_parents
from stemma.operators.status import apply_changes, latest, parse_status, status_lines, upsert
from stemma.operators.turtle import documents_turtle, subject_blocks
from stemma.plans import text_queries
from stemma.plans.text_queries import TAXON, json_sql, norm_sql, part_sql, present_sql, uri_sql
from stemma.sources.tables import broadcast_checked, cut, table
from stemma.streaming.changes import stream_changes

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


# --- joins --------------------------------------------------------------------------


def _values(rows: dict) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in rows.items())


SPOKEN = {"en": "eng", "de": "deu", "fr": "fra"}


@query(f"SELECT doc_id, lang, code, CASE WHEN code IS NULL THEN 'no tag for ' || coalesce(lang, 'undefined') END AS info FROM documents LEFT JOIN (VALUES {_values(SPOKEN)}) AS m(tag, code) ON lang = tag")
def language_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A dimension of codes that lacks some: hits get the code, misses a message."""
    codes = spark.createDataFrame([(t, c) for t, c in SPOKEN.items() if LANGUAGES[c] == t], "tag string, code string")
    met = table(spark, d, "documents").join(broadcast_checked(codes), F.col("lang") == F.col("tag"), "left")
    return met.select("doc_id", "lang", "code", F.when(F.col("code").isNull(), F.concat(F.lit("no tag for "), F.coalesce("lang", F.lit("undefined")))).alias("info"))


_LATEST = "SELECT * FROM treatments QUALIFY row_number() OVER (PARTITION BY docid ORDER BY updated_ts DESC, received_ts DESC, doc_status DESC, doc_path DESC) = 1"


@query(f"WITH t AS ({_LATEST}) SELECT row_id, docdate, docauthor FROM materials LEFT JOIN t USING (docid)")
def document_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Each material with the date and authors of its document's latest version."""
    t = latest(table(spark, d, "treatments"), ["docid"], ["updated_ts", "received_ts", "doc_status", "doc_path"])
    return table(spark, d, "materials").join(t.select("docid", "docdate", "docauthor"), "docid", "left").select("row_id", "docdate", "docauthor")


@query("SELECT a.name_row_id AS left_id, min(b.name_row_id) AS next_id, count(b.name_row_id) AS following FROM taxon_names a LEFT JOIN taxon_names b ON a.docid = b.docid AND b.name_row_id > a.name_row_id AND b.taxon_role = 'citation' WHERE a.taxon_role = 'treatment' GROUP BY 1")
def sibling_range_join(spark: SparkSession, d: str) -> DataFrame:
    """The citations behind each treated name among its siblings: what a range self-join would
    gather, read off a running aggregate from the last sibling up, so that no pairs are made."""
    behind = Window.partitionBy("docid").orderBy(F.desc("name_row_id")).rowsBetween(Window.unboundedPreceding, -1)
    cited = F.when(F.col("taxon_role") == "citation", F.col("name_row_id"))
    t = table(spark, d, "taxon_names").select("docid", "name_row_id", "taxon_role")
    met = t.withColumn("next_id", F.min(cited).over(behind)).withColumn("following", F.count(cited).over(behind))
    return met.where("taxon_role = 'treatment'").select(F.col("name_row_id").alias("left_id"), "next_id", "following")


@query("SELECT e.event_id AS outer_id, count(i.event_id) AS inside, min(i.event_id) AS first_id FROM events e LEFT JOIN events i ON e.user_id = i.user_id AND i.ts >= e.ts AND i.ts < e.ts + INTERVAL 6 HOUR AND i.event_type = 'click' WHERE e.event_type = 'signup' GROUP BY 1")
def containment_join(spark: SparkSession, d: str) -> DataFrame:
    """Intervals that contain points. Both sides are cut into time slots as long as the
    interval, an interval counts in the two slots it may reach, and the equi-join is on owner and slot:
    an owner of a third of all rows is as many groups as it has slots."""
    e = table(spark, d, "events")
    slot = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(6 * 3_600_000_000))
    o = e.where("event_type = 'signup'").select(F.col("event_id").alias("outer_id"), "user_id", F.col("ts").alias("start"), F.explode(F.array(slot, slot + 1)).alias("slot"))
    i = e.where("event_type = 'click'").select(F.col("event_id").alias("i_id"), F.col("user_id").alias("i_user"), F.col("ts").alias("i_ts"), slot.alias("i_slot"))
    met = o.join(i, (F.col("user_id") == F.col("i_user")) & (F.col("slot") == F.col("i_slot")) & (F.col("i_ts") >= F.col("start")) & (F.col("i_ts") < F.col("start") + F.expr("interval 6 hours")), "left")
    return met.groupBy("outer_id").agg(F.count("i_id").alias("inside"), F.min("i_id").alias("first_id"))


@query("SELECT DISTINCT doc_path FROM change_feed c WHERE doc_path LIKE '%.xml' AND EXISTS (SELECT 1 FROM treatments t WHERE t.doc_path = c.doc_path)")
def existing_files(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "change_feed").where(F.endswith("doc_path", F.lit(".xml"))).select("doc_path").distinct()
    return c.join(table(spark, d, "treatments").select("doc_path"), "doc_path", "left_semi")


@query("SELECT DISTINCT docid, doc_path FROM treatments t WHERE NOT EXISTS (SELECT 1 FROM materials m WHERE m.docid = t.docid)")
def documents_without_materials(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "treatments").select("docid", "doc_path").distinct().join(table(spark, d, "materials").select("docid"), "docid", "left_anti")


_ROLES = "WITH n AS (SELECT docid, name_row_id, concat_ws('_', genus, species) AS key, taxon_role FROM taxon_names)"


@query(_ROLES + ", f AS (SELECT docid, key, min(name_row_id) AS first FROM n WHERE taxon_role = 'treatment' GROUP BY ALL) SELECT n.name_row_id FROM n JOIN f USING (docid, key) WHERE n.taxon_role = 'citation' AND n.name_row_id > f.first")
def augment_if_exists(spark: SparkSession, d: str) -> DataFrame:
    """Cited names that a treated name of the same document has created before."""
    n = table(spark, d, "taxon_names").withColumn("key", F.concat_ws("_", "genus", "species"))
    first = n.where("taxon_role = 'treatment'").groupBy("docid", "key").agg(F.min("name_row_id").alias("first"))
    return n.where("taxon_role = 'citation'").join(first, ["docid", "key"]).where("name_row_id > first").select("name_row_id")


@query("WITH o AS (SELECT doc_path, max_by(change_op, (seq, change_op)) AS op, max(seq) AS seq FROM change_feed WHERE seq % 2 = 0 GROUP BY 1), n AS (SELECT doc_path, max_by(change_op, (seq, change_op)) AS op, max(seq) AS seq FROM change_feed WHERE seq % 2 = 1 GROUP BY 1) SELECT * FROM n UNION ALL SELECT * FROM o WHERE doc_path NOT IN (SELECT doc_path FROM n)")
def status_upsert(spark: SparkSession, d: str) -> DataFrame:
    """New rows over old rows by key, whatever their values."""
    c = table(spark, d, "change_feed").where("seq is not null")
    last = lambda x: latest(x.select("doc_path", "seq", F.col("change_op").alias("op")), ["doc_path"], ["seq", "op"])
    return upsert(last(c.where("seq % 2 = 0")), last(c.where("seq % 2 = 1")), "doc_path")


# --- aggregates ---------------------------------------------------------------------


@query("SELECT docid, array_to_string(list_sort(list_distinct(list(specimencode))), ', ') AS codes, count(DISTINCT specimencode) AS n FROM materials WHERE docid IS NOT NULL AND specimencode IS NOT NULL GROUP BY docid")
def subject_merge(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "materials").where("docid is not null and specimencode is not null").select("docid", "specimencode").distinct()
    return m.groupBy("docid").agg(F.array_join(F.array_sort(F.collect_list("specimencode")), ", ").alias("codes"), F.count("specimencode").alias("n"))


@query("SELECT genus, min_by(authorityname, name_row_id) AS authority FROM taxon_names WHERE authorityname IS NOT NULL GROUP BY genus")
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "taxon_names").where("authorityname is not null").groupBy("genus").agg(F.min_by("authorityname", "name_row_id").alias("authority"))


@query("SELECT masterdocid, max(doc_status) AS worst FROM treatments GROUP BY masterdocid")
def max_severity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "treatments").groupBy("masterdocid").agg(F.max("doc_status").alias("worst"))


@query("SELECT docid, string_agg(species, '; ' ORDER BY name_row_id) AS names FROM taxon_names WHERE species IS NOT NULL GROUP BY docid")
def ordered_concat(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "taxon_names").where("species is not null")
    return t.groupBy("docid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name_row_id", "species"))), lambda x: x["species"]), "; ").alias("names"))


@query("SELECT docid, string_agg(genus, ', ' ORDER BY first) AS genera FROM (SELECT docid, genus, min(name_row_id) AS first FROM taxon_names WHERE genus IS NOT NULL GROUP BY ALL) GROUP BY docid")
def distinct_ordered(spark: SparkSession, d: str) -> DataFrame:
    firsts = table(spark, d, "taxon_names").where("genus is not null").groupBy("docid", "genus").agg(F.min("name_row_id").alias("first"))
    return firsts.groupBy("docid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "genus"))), lambda x: x["genus"]), ", ").alias("genera"))


@query("SELECT docsource IS NULL AS no_source, count(*) FILTER (doc_status = 0) AS successful, count(*) FILTER (doc_status = 1) AS has_warnings, count(*) FILTER (doc_status = 2) AS has_errors, count(*) FILTER (doc_status = 3) AS failed FROM treatments GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "treatments").select(F.col("docsource").isNull().alias("no_source"), "doc_status")
    p = t.groupBy("no_source").pivot("doc_status", [0, 1, 2, 3]).count().na.fill(0)
    return p.select("no_source", *(F.col(str(k)).alias(n) for k, n in enumerate(("successful", "has_warnings", "has_errors", "failed"))))


@query("SELECT change_op, count(DISTINCT doc_path) AS files, count(*) AS changes FROM change_feed GROUP BY 1")
def file_counts(spark: SparkSession, d: str) -> DataFrame:
    by_file = table(spark, d, "change_feed").groupBy("change_op", "doc_path").count()  # two steps: no hot set of one key
    return by_file.groupBy("change_op").agg(F.count("doc_path").alias("files"), F.sum("count").alias("changes"))


# --- windows ------------------------------------------------------------------------


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AS is_first FROM events")
def first_occurrence(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    first = e.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    return e.join(first, ["user_id", "event_type"]).select("event_id", (F.col("event_id") == F.col("f.event_id")).alias("is_first"))


@query("SELECT rank_id, rank_name, lag(rank_name) OVER (ORDER BY rank_id) AS above FROM rank_ref")
def rank_before(spark: SparkSession, d: str) -> DataFrame:
    """The predecessor of each rank (a fixed table of 22 rows)."""
    return table(spark, d, "rank_ref").select("rank_id", "rank_name", F.lag("rank_name").over(Window.orderBy("rank_id")).alias("above"))


_RANK_COLUMNS = ("kingdom", "phylum", "class", "order", "family", "genus", "species", "subSpecies")
_LIST = "list_filter([" + ", ".join(f"{{'rank': '{k}', 'name': {TAXON[k]}}}" for k in _RANK_COLUMNS) + "], lambda x: coalesce(x.name, '') <> '')"


@query(f"SELECT name_row_id, list_extract({_LIST}, -1).rank AS lowest FROM taxon_names")
def last_valid_rank(spark: SparkSession, d: str) -> DataFrame:
    valid = F.filter(F.array(*(F.struct(F.lit(k).alias("rank"), F.col(TAXON[k]).alias("name")) for k in _RANK_COLUMNS)), lambda x: T.present(x["name"]))
    return table(spark, d, "taxon_names").select("name_row_id", F.try_element_at(valid, F.lit(-1))["rank"].alias("lowest"))


@query("SELECT doc_path, doc_status FROM treatments QUALIFY row_number() OVER (PARTITION BY doc_path ORDER BY updated_ts DESC, received_ts DESC, doc_status DESC) = 1")
def latest_status(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "treatments").select("doc_path", "doc_status", "updated_ts", "received_ts")
    return latest(t, ["doc_path"], ["updated_ts", "received_ts", "doc_status"]).select("doc_path", "doc_status")


# --- sets ---------------------------------------------------------------------------


@query("SELECT doc_path, seq FROM change_feed WHERE change_op = 'added' UNION ALL SELECT doc_path, seq FROM change_feed WHERE change_op = 'modified'")
def union_changes(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "change_feed")
    return c.where("change_op = 'added'").select("doc_path", "seq").unionByName(c.where("change_op = 'modified'").select("doc_path", "seq"))


@query("SELECT DISTINCT docid, genus FROM taxon_names WHERE taxon_role = 'citation' AND genus IS NOT NULL AND taxon_status IS DISTINCT FROM 'nomen dubium' EXCEPT SELECT docid, genus FROM taxon_names WHERE taxon_status = 'nomen dubium'")
def cites_minus_deprecates(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "taxon_names")
    cites = t.where("taxon_role = 'citation' and genus is not null and not (taxon_status <=> 'nomen dubium')").select("docid", "genus")
    return cites.subtract(t.where("taxon_status = 'nomen dubium'").select("docid", "genus"))


@query("(SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-04-01' EXCEPT ALL SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-04-01')")
def golden_difference(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one result that another lacks, repeated rows counted."""
    o = table(spark, d, "orders")
    cols = ["o_custkey", "o_orderpriority"]
    return o.where("o_orderdate < timestamp '1998-04-01'").select(cols).exceptAll(o.where("o_orderdate >= timestamp '1998-04-01'").select(cols))


@query("""WITH e AS (SELECT event_id AS ord, user_id AS doc, json_extract_string(props, '$.k') AS name, event_type AS kind FROM events),
 f AS (SELECT *, min(ord) OVER (PARTITION BY doc, name) AS first FROM e WHERE kind IN ('view', 'click', 'error')),
 g AS (SELECT doc, name FROM e WHERE kind = 'error'),
 c AS (SELECT DISTINCT doc, name, 'cites' AS said FROM f WHERE kind = 'click' AND (CAST(name AS INTEGER) % 2 = 0 OR ord = first) AND (doc, name) NOT IN (SELECT doc, name FROM g))
SELECT DISTINCT doc, name, 'citesName' AS said FROM f WHERE kind = 'view' AND ord = first UNION ALL SELECT DISTINCT doc, name, 'deprecates' AS said FROM g UNION ALL SELECT * FROM c""")
def seen_set(spark: SparkSession, d: str) -> DataFrame:
    """The rule of what has been cited before, as a window and set algebra: views stand for
    names without authority, clicks for citations (even keys with a year), errors for deprecations."""
    e = table(spark, d, "events").select(F.col("event_id").alias("ord"), F.col("user_id").alias("doc"), F.get_json_object("props", "$.k").alias("name"), F.col("event_type").alias("kind"))
    adds = e.where(F.col("kind").isin("view", "click", "error"))
    first = adds.groupBy("doc", "name").agg(F.min("ord").alias("first"))
    f = adds.join(first, ["doc", "name"])
    gone = e.where("kind = 'error'").select("doc", "name").distinct()
    cites = f.where("kind = 'click' and (cast(name as int) % 2 = 0 or ord = first)").select("doc", "name").distinct().join(gone, ["doc", "name"], "left_anti")
    names = f.where("kind = 'view' and ord = first").select("doc", "name").distinct()
    tag = lambda x, said: x.select("doc", "name", F.lit(said).alias("said"))
    return tag(names, "citesName").unionByName(tag(gone, "deprecates")).unionByName(tag(cites, "cites"))


# --- hierarchies --------------------------------------------------------------------


@query(f"SELECT name_row_id, len(l) - i AS level, l[i].rank AS rank, l[i].name AS name, CASE WHEN i > 1 THEN l[i - 1].rank END AS parent FROM (SELECT name_row_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT name_row_id, {_LIST} AS l FROM taxon_names))")
def hierarchy_levels(spark: SparkSession, d: str) -> DataFrame:
    """Each name with all its parents, one row a level, without recursion."""
    valid = F.filter(F.array(*(F.struct(F.lit(k).alias("rank"), F.col(TAXON[k]).alias("name")) for k in _RANK_COLUMNS)), lambda x: T.present(x["name"]))
    x = table(spark, d, "taxon_names").select("name_row_id", F.reverse(valid).alias("v")).select("name_row_id", "v", F.posexplode("v").alias("level", "x"))
    return x.select("name_row_id", "level", F.col("x.rank").alias("rank"), F.col("x.name").alias("name"), F.get("v", F.col("level") + 1)["rank"].alias("parent"))


_TREE = """WITH RECURSIVE edges AS (SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
 up AS (SELECT child AS node, parent AS ancestor, 1 AS distance FROM edges UNION ALL SELECT up.node, e.parent, up.distance + 1 FROM up JOIN edges e ON e.child = up.ancestor) SELECT node, ancestor, distance FROM up"""


@query(_TREE)
def hierarchy_recursive(spark: SparkSession, d: str) -> DataFrame:
    """All ancestors in an adjacency list, level by level."""
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("child"), F.concat(F.lit("n"), "s_nationkey").alias("parent"))
    return ancestors(n.unionByName(s))


_NAMED = [k for k in RANKS if k in TAXON]
_VALUE = "CASE {} " + " ".join(f"WHEN '{k}' THEN {TAXON[k]}" for k in (*_NAMED, "rank", "isHybrid")) + " END"
_MARK, _NAME_MARK = "(?i)^[^A-Za-z0-9_]*(var|subsp|f)[^A-Za-z0-9_]*$", r"(?i)^[^A-Za-z0-9_]*(var|subsp|f|\.)[^A-Za-z0-9_]*$"
_BARE = r"replace(regexp_replace(replace({}, '-', chr(1)), '[\pZ\pS\pP]', '', 'g'), chr(1), '-')"
_PAIRS = "[" + ", ".join(f"{{'rank': '{k}', 'name': {TAXON[k]}}}" for k in _NAMED) + "]"


_ENDINGS = f"""WITH a AS (SELECT *, list_filter({_PAIRS}, lambda x: x.name IS NOT NULL) AS r FROM taxon_names),
 o AS (SELECT *, list_transform(r, lambda x: x.rank) AS ranks, CASE WHEN taxon_rank IS NULL OR list_contains(list_transform(r, lambda x: x.rank), taxon_rank) THEN r ELSE list_append(r, {{'rank': taxon_rank, 'name': {_VALUE.format("taxon_rank")}}}) END AS own FROM a),
 v AS (SELECT *, list_transform(list_filter(own, lambda x: x.name <> '' AND NOT regexp_matches(trim(x.name), '{_MARK}')), lambda x: x.rank) AS valid FROM o),
 l AS (SELECT *, list_concat([NULL::VARCHAR], list_reverse(valid[2:]), CASE WHEN len(valid) > 0 AND valid[1] <> 'kingdom' THEN valid[1:1] ELSE []::VARCHAR[] END) AS limits FROM v),
 u AS (SELECT *, unnest(limits) AS upto, unnest(range(len(limits))) AS level FROM l),
 b AS (SELECT *, CASE WHEN list_position(ranks, upto) > 1 THEN ranks[:list_position(ranks, upto) - 1] ELSE ranks END AS below FROM u),
 k AS (SELECT *, CASE WHEN list_position(ranks, upto) > 1 THEN below[-1] ELSE taxon_rank END AS at_rank FROM b),
 e AS (SELECT *, CASE WHEN at_rank = 'kingdom' THEN '' WHEN at_rank IN ({", ".join(f"'{x}'" for x in SPECIES_GROUP)}) THEN '/' || {part_sql("array_to_string(list_transform(list_filter([genus, CASE WHEN ishybrid = 'true' THEN 'x' END, CASE WHEN list_contains(below, 'species') THEN species END, CASE WHEN list_contains(below, 'subSpecies') THEN subspecies END], lambda x: coalesce(x, '') <> '' AND NOT regexp_matches(x, '" + _NAME_MARK + "')), lambda x: " + _BARE.format("x") + "), '_')")}
   WHEN {_BARE.format(norm_sql(_VALUE.format("at_rank")))} <> '' THEN '/' || {part_sql("replace(" + _BARE.format(norm_sql(_VALUE.format("at_rank"))) + ", '.', '')")} END AS ending FROM k)"""


@query(_ENDINGS + f""",
 n AS (SELECT name_row_id, level, valid, limits, CASE WHEN ending IS NOT NULL THEN {uri_sql("('http://taxon-name.example.org/id/' || CASE WHEN " + present_sql("kingdom") + " THEN " + part_sql("kingdom") + " ELSE 'INVALID' END || ending)", "_")} END AS name_uri, CASE WHEN len(valid) > level THEN valid[len(valid) - level] END AS level_rank FROM e),
 p AS (SELECT *, lead(name_uri) OVER (PARTITION BY name_row_id ORDER BY level) AS above FROM n)
SELECT name_row_id, CAST(level AS INTEGER) AS level, name_uri, level_rank, CASE WHEN above <> name_uri THEN above END AS parent_uri, level = len(limits) - 1 AND coalesce(level_rank, '') <> 'kingdom' AS dead_end FROM p""")
def name_levels(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of all names and their parents by the full naming rules."""
    t = table(spark, d, "taxon_names")
    known = {k: v for k, v in TAXON.items() if k in RANKS or k in ("rank", "isHybrid")}
    attrs = F.map_filter(F.create_map(*(x for k, v in known.items() for x in (F.lit(k), F.col(v)))), lambda k, v: v.isNotNull())
    made = with_parents(levels(t.select("name_row_id", attrs.alias("attrs"))), ["name_row_id"])
    return made.select("name_row_id", "level", "name_uri", "level_rank", "parent_uri", "dead_end")


_COPIED = {k: v for k, v in TAXON.items() if k not in NOT_COPIED}


@query("SELECT * FROM (" + " UNION ALL ".join(f"""SELECT '<' || name_row_id || '>' AS subject, CASE WHEN regexp_matches({v}, '{_MARK}') THEN '# Warning:' ELSE 'dwc:{k}' END AS predicate,
 CASE WHEN regexp_matches({v}, '{_MARK}') THEN 'ignoring {k} ' || {json_sql(v)} ELSE {json_sql(norm_sql(v))} END AS object FROM taxon_names WHERE {v} IS NOT NULL""" for k, v in _COPIED.items()) + ")")
def taxon_statements(spark: SparkSession, d: str) -> DataFrame:
    """One statement per attribute of each taxon, by the operator of the graph."""
    attrs = F.map_filter(F.create_map(*(x for k, v in TAXON.items() for x in (F.lit(k), F.col(v)))), lambda k, v: v.isNotNull())
    rows = table(spark, d, "taxon_names").select(F.col("docid").alias("doc_path"), F.format_string("<%d>", "name_row_id").alias("subject"), F.lit(0).alias("ord"), attrs.alias("attrs"))
    return attribute_statements(rows, "attrs").select("subject", "predicate", "object")


# --- operators of the graph over tables that stand for nodes ----------------------------

_ATTRIBUTES = {"id": "mc_id", "httpUri": "httpuri", "specimenCode": "specimencode", "collectionCode": "collectioncode", "typeStatus": "typestatus", "latitude": "latitude", "longitude": "longitude", "elevation": "elevation", "collectingCountry": "collectingcountry", "collectingRegion": "collectingregion", "collectingMunicipality": "collectingmunicipality", "collectingCounty": "collectingcounty", "location": "locality", "locationDeviation": "locality_deviation", "collectorName": "collectorname", "collectingDate": "collectingdate", "collectingMethod": "collectingmethod", "ID-GBIF-Occurrence": "id_gbif_occurrence", "ID-GBIF-Specimen": "id_gbif_specimen"}


def _material_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The materials as nodes of their documents: a root each, and a citation per row."""
    m = table(spark, d, "materials").where("docid is not null")
    attrs = F.map_filter(F.create_map(*(x for k, v in _ATTRIBUTES.items() for x in (F.lit(k), F.col(v)))), lambda k, v: v.isNotNull())
    roots = m.select("docid").distinct().select(F.col("docid").alias("doc_path"), F.lit(-1).cast("long").alias("node_id"), F.lit("document").alias("tag"), F.create_map(F.lit("docId"), F.col("docid")).alias("attrs"))
    return roots.unionByName(m.select(F.col("docid").alias("doc_path"), F.col("row_id").alias("node_id"), F.lit("materialsCitation").alias("tag"), attrs.alias("attrs")))


_ADDRESS = f"""WITH m AS (SELECT *, {part_sql('docid')} AS d FROM materials WHERE docid IS NOT NULL), s AS (SELECT *, CASE WHEN {present_sql('mc_id')} THEN {uri_sql("'http://material.example.org/id/' || d || '.mc.' || mc_id")}
 WHEN {present_sql('id_gbif_occurrence')} THEN {uri_sql("'https://www.gbif.org/occurrence/' || id_gbif_occurrence")} WHEN {present_sql('httpuri')} THEN {uri_sql('httpuri')}
 ELSE {uri_sql("'http://treatment.example.org/id/' || d || '/' || " + part_sql('specimencode'), '_')} END AS subject FROM m WHERE {present_sql('mc_id')} OR {present_sql('httpuri')} OR {present_sql('specimencode')})"""


@query(_ADDRESS + " SELECT DISTINCT * FROM (" + " UNION ALL ".join(f"SELECT docid AS doc_path, subject, '{term}' AS predicate, {json_sql(_ATTRIBUTES[k])} AS object FROM s WHERE {_ATTRIBUTES[k]} IS NOT NULL" for k, term in MATERIAL_TERMS.items())
       + f" UNION ALL SELECT docid, subject, 'trt:httpUri', {uri_sql('httpuri')} FROM s WHERE {present_sql('httpuri')} UNION ALL SELECT docid, subject, 'trt:httpUri', " + uri_sql("'https://treatment.example.org/id/' || d || '#' || mc_id") + f" FROM s WHERE {present_sql('mc_id')} UNION ALL SELECT docid, subject, 'a', 'dwc:MaterialCitation' FROM s)")
def material_properties(spark: SparkSession, d: str) -> DataFrame:
    """What is stated of each cited material, by the operator of the graph."""
    nodes = _material_nodes(spark, d)
    own, _ = material_statements(nodes, document_rows(nodes), F.lit("<t>"), T.DEFAULT_HOST, None)
    return own.select("doc_path", "subject", "predicate", "object").distinct()


@query(_ADDRESS + " SELECT docid AS doc_path, string_agg(subject, ', ' ORDER BY row_id, subject) AS object FROM s GROUP BY docid")
def basis_of_record(spark: SparkSession, d: str) -> DataFrame:
    """The addresses of each document's materials as one list in order, by the operator of the graph."""
    nodes = _material_nodes(spark, d)
    _, basis = material_statements(nodes, document_rows(nodes), F.lit("<t>"), T.DEFAULT_HOST, None)
    return basis.select("doc_path", "object")


@query("SELECT CAST(doc AS VARCHAR) AS doc_path, string_agg(name, ', ' ORDER BY first) AS object FROM (SELECT user_id AS doc, '<' || event_type || '>' AS name, min(event_id) AS first FROM events GROUP BY ALL) GROUP BY doc")
def distinct_listed(spark: SparkSession, d: str) -> DataFrame:
    """Distinct addresses in the order of their first mention as one list, by the operator of the graph."""
    e = table(spark, d, "events")
    return listed(e.select(F.col("user_id").cast("string").alias("doc_path"), F.col("event_id").alias("ord"), F.format_string("<%s>", "event_type").alias("subject")), True)


@query("SELECT o.event_id AS node_id, min(i.event_id) AS first_id FROM events o LEFT JOIN events i ON i.user_id = o.user_id AND i.event_id >= o.event_id AND i.event_id < o.event_id + 900 AND i.event_type = 'click' WHERE o.event_type IN ('signup', 'click') GROUP BY 1")
def first_below(spark: SparkSession, d: str) -> DataFrame:
    """The first click from each sign-up or click on within 900 events, by the operator that finds
    the first name below a node."""
    e = table(spark, d, "events").select(F.col("user_id").alias("doc_path"), F.col("event_id").alias("node_id"), (F.col("event_id") + 900).alias("subtree_end"), "event_type")
    return tree.first_below(e.where("event_type in ('signup', 'click')"), e.where("event_type = 'click'")).select("node_id", "first_id")


@query(SQL["seen_set"])
def cited_before(spark: SparkSession, d: str) -> DataFrame:
    """The rule of what has been cited before, by the operator of the graph: views are names without
    authority, clicks citations (even keys have a year), errors deprecations."""
    e = table(spark, d, "events").where(F.col("event_type").isin("view", "click", "error"))
    name = F.get_json_object("props", "$.k")
    none = F.lit(None).cast("string")
    kind = F.when(F.col("event_type") == "view", "I").when(F.col("event_type") == "click", "C").otherwise("D")
    rows = e.select(F.col("user_id").alias("doc_path"), F.col("event_id").alias("ord"), kind.alias("class"), name.alias("tnuri"), F.when(F.col("event_type") != "view", name).alias("uri"), F.when(name.cast("int") % 2 == 0, "1900").otherwise("").alias("year"), none.alias("taxon_status"), F.lit(False).alias("defining"))
    said = F.when(F.col("predicate") == "trt:citesTaxonName", "citesName").when(F.col("predicate") == "trt:deprecates", "deprecates").otherwise("cites")
    return citation_sets(rows).select(F.col("doc_path").alias("doc"), F.col("object").alias("name"), said.alias("said")).distinct()


def _taxon_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The names of each document as its nodes: treated ones below a nomenclature, cited ones each in a
    citation of a reference group. A row of number n has its citation at 2n and its name at 2n + 1."""
    t = table(spark, d, "taxon_names").where("docid is not null")
    attrs = F.map_filter(F.create_map(*(x for k, v in TAXON.items() for x in (F.lit(k), F.col(v)))), lambda k, v: v.isNotNull())
    above = lambda *tags: F.array(*(F.struct(F.lit(-k - 1).cast("long").alias("node_id"), F.lit(tag).alias("tag"), F.lit(kind).cast("string").alias("type")) for k, (tag, kind) in enumerate(tags)))
    inside = (("document", None), ("treatment", None))
    node = lambda rows, number, end, tag, ancestors, a: rows.select(F.col("docid").alias("doc_path"), number.cast("long").alias("node_id"), F.lit(-9).cast("long").alias("parent_id"), number.cast("long").alias("sib_ord"), F.lit(tag).alias("tag"), ancestors.alias("ancestors"), a.alias("attrs"), F.lit("").alias("text"), end.cast("long").alias("subtree_end"))
    n = F.col("name_row_id")
    cited, treated = t.where("taxon_role = 'citation'"), t.where("taxon_role = 'treatment'")
    group = (*inside, ("subSubSection", "reference_group"))
    parts = [
        node(t.select("docid").distinct(), F.lit(-1), F.lit(1 << 40), "document", above(), F.create_map(F.lit("docId"), F.col("docid"))),
        node(treated, 2 * n + 1, 2 * n + 2, "taxonomicName", above(*inside, ("subSubSection", "nomenclature")), attrs),
        node(cited, 2 * n, 2 * n + 2, "treatmentCitation", above(*group), F.map_filter(attrs, lambda k, v: F.lit(False))),
        node(cited, 2 * n + 1, 2 * n + 2, "taxonomicName", above(*group, ("treatmentCitation", None)), attrs),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_FIRST = "SELECT * FROM taxon_names WHERE taxon_role = 'treatment' AND docid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY docid ORDER BY name_row_id) = 1"


@query(f"SELECT docid AS doc_path, 2 * name_row_id + 1 AS node_id, coalesce(taxon_status, 'ABSENT') AS status FROM ({_FIRST})")
def treated_names(spark: SparkSession, d: str) -> DataFrame:
    """The treated name of each document and its status, by the operator of the graph."""
    return treated_taxa(_taxon_nodes(spark, d)).select("doc_path", "node_id", F.col("taxon_status").alias("status"))


@query(f"""WITH u AS (SELECT name_row_id, name_uri FROM ({SQL['name_levels']}) WHERE level = 0), g AS ({text_queries.SQL['citation_guard']}), a AS ({text_queries.SQL['full_authority']}), r AS ({text_queries.SQL['taxon_relation']}), e AS ({text_queries.SQL['epithet_check']})
SELECT docid AS doc_path, 2 * name_row_id AS ord, CASE WHEN name_uri IS NULL THEN 'F' WHEN refused THEN 'R' WHEN authority = 'INVALID' THEN 'I' WHEN relation = 'CITES' THEN 'C' WHEN relation = 'DEPRECATES' THEN 'D' ELSE 'S' END AS class, name_uri
 FROM taxon_names JOIN u USING (name_row_id) JOIN g USING (name_row_id) JOIN a USING (name_row_id) JOIN r USING (name_row_id) WHERE taxon_role = 'citation' AND docid IS NOT NULL
UNION ALL SELECT docid, -1, CASE WHEN errors <> '' THEN 'X' WHEN name_uri IS NULL THEN 'F' ELSE 'T' END, name_uri FROM ({_FIRST}) JOIN u USING (name_row_id) JOIN e USING (name_row_id)""")
def taxa_of_documents(spark: SparkSession, d: str) -> DataFrame:
    """Each treated and cited taxon of all documents with what is to be done with it, by the operator
    of the graph: T treated, X of a bad name, F without address, R refused, I a name only, C cited,
    D deprecated, S left alone."""
    return events(_taxon_nodes(spark, d), T.DEFAULT_HOST).select("doc_path", "ord", "class", F.col("tnuri").alias("name_uri"))


@query(f"""WITH l AS ({SQL['name_levels']}), a AS ({text_queries.SQL['full_authority']}), s AS (SELECT name_row_id, authority, list_extract(string_split(split_part(split_part(split_part(authority, ')', 1), ' &', 1), ',', 1), ' '), -1) AS n, regexp_extract(authority, '[0-9]+') AS year FROM a)
SELECT name_row_id, CASE WHEN name_uri IS NOT NULL THEN {uri_sql("('http://taxon-concept.example.org/id/' || CASE WHEN " + present_sql("kingdom") + " THEN kingdom ELSE 'INVALID' END || ending || '_' || " + part_sql(r"CASE WHEN regexp_extract(n, '\(?\p{L}+') <> '' THEN regexp_extract(n, '\(?\p{L}+') ELSE n END") + " || '_' || year)")} END AS address
 FROM (SELECT name_row_id, name_uri FROM l WHERE level = 0) JOIN s USING (name_row_id) JOIN taxon_names USING (name_row_id) JOIN ({_ENDINGS} SELECT name_row_id, ending FROM e WHERE level = 0) USING (name_row_id)""")
def concept_addresses(spark: SparkSession, d: str) -> DataFrame:
    """The addresses of all taxa's concepts, by their authorities as cited ones."""
    t = table(spark, d, "taxon_names")
    attrs = F.map_filter(F.create_map(*(x for k, v in TAXON.items() for x in (F.lit(k), F.col(v)))), lambda k, v: v.isNotNull())
    none = F.lit(None).cast("string")
    a = t.select("name_row_id", attrs.alias("attrs"), T.full_authority({k: F.col(TAXON[k]) for k in ("authorityName", "authorityYear", "kingdom")}, none, none, False).alias("authority"))
    short = F.concat(F.lit("_"), T.authority_for_uri("authority"), F.lit("_"), T.partial_uri(T.first_year("authority")))
    return a.select("name_row_id", concept_uri(short).alias("address"))


# --- sinks --------------------------------------------------------------------------


_STATEMENTS = """SELECT '<n' || n_nationkey || '>' AS subject, 'a' AS predicate, 'ex:Nation' AS object FROM nation UNION ALL SELECT '<n' || n_nationkey || '>', 'ex:name', CAST(to_json(n_name) AS VARCHAR) FROM nation
 UNION ALL SELECT '<n' || n_nationkey || '>', 'ex:in', '<r' || n_regionkey || '>' FROM nation UNION ALL SELECT '<n' || s_nationkey || '>', 'ex:supplier', CAST(to_json(s_name) AS VARCHAR) FROM supplier
 UNION ALL SELECT '<n' || n_nationkey || '>', '# Info:', 'region ' || n_regionkey FROM nation"""


def _nation_statements(spark: SparkSession, d: str) -> DataFrame:
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    me = lambda c: F.concat(F.lit("<n"), F.col(c).cast("string"), F.lit(">")).alias("subject")
    row = lambda p, o: (F.lit(p).alias("predicate"), o.alias("object"))
    parts = [
        n.select(me("n_nationkey"), *row("a", F.lit("ex:Nation"))), n.select(me("n_nationkey"), *row("ex:name", T.string_literal("n_name"))), n.select(me("n_nationkey"), *row("ex:in", F.concat(F.lit("<r"), F.col("n_regionkey").cast("string"), F.lit(">")))),
        s.select(me("s_nationkey"), *row("ex:supplier", T.string_literal("s_name"))), n.select(me("n_nationkey"), *row("# Info:", F.concat(F.lit("region "), F.col("n_regionkey").cast("string")))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(_STATEMENTS.replace("UNION ALL", "UNION"))
def triples_view(spark: SparkSession, d: str) -> DataFrame:
    return _nation_statements(spark, d).distinct()


@query(f"""WITH s AS ({_STATEMENTS}), o AS (SELECT subject, predicate, string_agg(DISTINCT object, ', ' ORDER BY object) AS o FROM s WHERE predicate NOT LIKE '#%' GROUP BY ALL),
 p AS (SELECT subject, string_agg('    ' || predicate || ' ' || o, ' ;' || chr(10) ORDER BY CASE WHEN predicate = 'a' THEN '2a' ELSE '1' || predicate END) AS facts FROM o GROUP BY 1),
 c AS (SELECT subject, string_agg('    ' || predicate || ' ' || object, chr(10) ORDER BY object) || chr(10) AS notes FROM (SELECT DISTINCT * FROM s WHERE predicate LIKE '#%') GROUP BY 1)
SELECT subject, chr(10) || subject || chr(10) || coalesce(notes, '') || facts || ' .' AS block FROM p LEFT JOIN c USING (subject)""")
def turtle_blocks(spark: SparkSession, d: str) -> DataFrame:
    return subject_blocks(_nation_statements(spark, d), []).select("subject", "block")


@query("WITH t AS (SELECT doc_path, max(doc_status) AS s FROM treatments GROUP BY 1) SELECT '/' || ltrim(doc_path, '/') || ': ' || s AS line FROM t UNION ALL SELECT ':' || CASE s WHEN 0 THEN 'successful' WHEN 1 THEN 'has warnings' WHEN 2 THEN 'has errors' ELSE 'failed' END || ': ' || count(*) FROM t GROUP BY s")
def status_text(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "treatments").groupBy("doc_path").agg(F.max("doc_status").alias("status"))
    return status_lines(s).select("line")


@query("SELECT doc_path, max(doc_status) AS status FROM treatments GROUP BY 1")
def status_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The status table written as text and read again."""
    s = table(spark, d, "treatments").groupBy("doc_path").agg(F.max("doc_status").alias("status"))
    return parse_status(status_lines(s))


# --- change sets --------------------------------------------------------------------


_LAST = "SELECT doc_path, max_by(change_op, (seq, change_op)) AS change_op, max(seq) AS seq FROM change_feed GROUP BY doc_path"


@query(f"SELECT * FROM ({_LAST}) WHERE change_op <> 'removed'")
def change_feed_apply(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(table(spark, d, "change_feed")).where("change_op <> 'removed'")


@query(_LAST)
def incremental_equals_full(spark: SparkSession, d: str) -> DataFrame:
    """Two batches applied one after the other give what one gives."""
    c = table(spark, d, "change_feed")
    first = apply_changes(c.where("received_ts < timestamp '2023-06-01'"))
    second = apply_changes(c.where("received_ts >= timestamp '2023-06-01'"))
    return apply_changes(first.unionByName(second))


@query("SELECT DISTINCT doc_path, change_op FROM change_feed WHERE seq BETWEEN 100 AND 400")
def change_range(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "change_feed").where("seq between 100 and 400").select("doc_path", "change_op").distinct()


@query(_LAST)
def streamed_changes(spark: SparkSession, d: str) -> DataFrame:
    """The feed as a stream of files, upserted batch by batch."""
    return stream_changes(spark, f"{d}/change_feed.parquet")


# --- the graph ----------------------------------------------------------------------


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """All records, XML and JSON, as documents under a path each."""
    r = table(spark, d, "raw_records")
    return r.select(F.concat(F.lit("data/"), F.col("raw_id").cast("string"), F.lit("."), F.col("payload_form")).alias("doc_path"), F.col("payload").alias("content"))


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return cut(tree.nodes(_pages(spark, d), form="any", texts=TEXT_TAGS))


@query()
def xml_nodes(spark: SparkSession, d: str) -> DataFrame:
    return tree.nodes(_pages(spark, d), form="any").select("doc_path", "node_id", "parent_id", "depth", "tag", "sib_ord", "subtree_end", "text")


@query()
def outermost_citations(spark: SparkSession, d: str) -> DataFrame:
    return cited_taxa(_nodes(spark, d)).select("doc_path", "ord", "node_id")


@query()
def graph_statements(spark: SparkSession, d: str) -> DataFrame:
    return statements(_nodes(spark, d))


@query()
def graph_turtle(spark: SparkSession, d: str) -> DataFrame:
    pages, nodes = _pages(spark, d), _nodes(spark, d)
    taxa = cut(events(nodes, T.DEFAULT_HOST))
    return documents_turtle(cut(statements(nodes, taxa=taxa)), pages, comments=comments(nodes, pages, taxa))


@query()
def graph_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics(_nodes(spark, d), _pages(spark, d))


@query()
def graph_status(spark: SparkSession, d: str) -> DataFrame:
    return document_status(_nodes(spark, d), _pages(spark, d))


@query()
def record_treatments(spark: SparkSession, d: str) -> DataFrame:
    return flatten_records(table(spark, d, "raw_records"), "treatments")


@query()
def record_taxa(spark: SparkSession, d: str) -> DataFrame:
    return flatten_records(table(spark, d, "raw_records"), "taxa")



@query()
def record_tables(spark: SparkSession, d: str) -> DataFrame:
    """The related tables of one reading: of each document its treatments, names and materials,
    and those of them whose parent or name is no row of its table (none)."""
    t = flatten_all(table(spark, d, "raw_records"))
    count = lambda part: t[part].groupBy("key").agg(F.count(F.lit(1)).alias(part))
    names = t["taxa"].select("key", "taxon_pos")
    lost = t["materials"].where("taxon_pos > 0").join(names, ["key", "taxon_pos"], "left_anti").groupBy("key").agg(F.count(F.lit(1)).alias("lost"))
    out = t["documents"]
    for part in (count("treatments"), count("taxa"), count("materials"), lost):
        out = out.join(part, "key", "left")
    return out.select(F.col("key").alias("raw_id"), "docid", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("treatments", "taxa", "materials", "lost")))
