"""Documents to a graph of statements, as one declarative plan over the node table.

The order-dependent rules (what has been cited before) are written as windows and set
algebra, so every stage partitions by document and nothing is processed one after another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators import tree
from stemma.operators.hierarchy import attr, concept_uri, levels, name_statements, name_uri, present_ranks, punctuated, with_parents
from stemma.sources.tables import cut

# --- fixed values: attributes that are not copied, and the names of those that are ---
NOT_COPIED = ("id", "box", "pageId", "pageNumber", "lastPageId", "lastPageNumber", "higherTaxonomySource", "status")
NOT_COPIED_PATTERN = r"^_|\.|evidence|Evicence|lsidName"
MATERIAL_TERMS = {"specimenCode": "dwc:catalogNumber", "collectionCode": "dwc:collectionCode", "typeStatus": "dwc:typeStatus", "latitude": "dwc:verbatimLatitude", "longitude": "dwc:verbatimLongitude", "elevation": "dwc:verbatimElevation", "collectingCountry": "dwc:countryCode", "collectingRegion": "dwc:stateProvince", "collectingMunicipality": "dwc:municipality", "collectingCounty": "dwc:county", "location": "dwc:locality", "locationDeviation": "dwc:verbatimLocality", "collectorName": "dwc:recordedBy", "collectingDate": "dwc:eventDate", "collectingMethod": "dwc:samplingProtocol", "ID-GBIF-Occurrence": "trt:gbifOccurrenceId", "ID-GBIF-Specimen": "trt:gbifSpecimenId"}
DOUBTFUL = ("nomen dubium", "(nomen dubium)")
NOT_DEFINING = (*DOUBTFUL, "ABSENT", "incertae sedis")
#: Elements whose text is read.
TEXT_TAGS = ("taxonomicNameLabel", "vernacularName", "MODSroleTerm", "MODSnamePart", "MODStitle", "MODSdate", "MODSdateIssued", "MODSclassification", "MODSdetail", "MODSstart", "MODSend")
#: ISO 639-3 codes and their two-letter tags.
LANGUAGES = {"eng": "en", "deu": "de", "fra": "fr", "spa": "es", "por": "pt", "ita": "it", "nld": "nl", "rus": "ru", "zho": "zh", "jpn": "ja", "pol": "pl", "ces": "cs", "swe": "sv", "dan": "da", "nor": "no", "fin": "fi", "hun": "hu", "tur": "tr", "ara": "ar", "lat": "la", "ell": "el", "ukr": "uk", "kor": "ko", "vie": "vi", "ind": "id", "swa": "sw", "cat": "ca", "eus": "eu", "glg": "gl", "ron": "ro"}
# -----------------------------------------------------------------------------------


def valid_epithet(c: Column) -> Column:
    c = T.normalize_space(c)
    return (c != "") & (~c.rlike("[^a-zA-Z.\\-'’]") | c.rlike(r"(undefined|sp\.?|species)\s*-?[0-9]*\z"))


def epithet_errors(get, own: Column) -> Column:
    """What is wrong with a treated taxon's rank and epithets: an array of messages. ``own``
    is the attribute that its rank names, whatever the rank."""
    rank = get("rank")
    wrong = lambda n, c: F.concat(F.lit(f"{n} "), T.string_literal(c), F.lit(" contains invalid characters"))
    needs = (("species", ("subSpecies", "variety")), ("genus", ("subGenus", "species", "subSpecies", "variety")), ("family", ("subFamily", "tribe", "subTribe")), ("order", ("subOrder",)), ("class", ("subClass",)), ("phylum", ("subPhylum",)))
    found = [F.when(~F.coalesce(valid_epithet(own), F.lit(False)), wrong("sigEpithet", T.normalize_space(own)))]
    found += [F.when(rank.isin(*ranks) & ~F.coalesce(valid_epithet(get(n)), F.lit(False)), wrong(n, get(n))) for n, ranks in needs]
    return F.when(T.present(rank), F.array_compact(F.array(*found))).otherwise(F.array(F.lit("the rank attribute is missing")))


def refused(get, group: Column) -> Column:
    """May a cited taxon not be added, for want of a rank, a kingdom or a genus?"""
    return (group == "INVALID") | ~T.present(get("kingdom")) | ((group == "species") & ~T.present(get("genus")))


def status_of(*said: Column) -> Column:
    """The status of a treated taxon: the first of its sources, else ABSENT."""
    return F.coalesce(*said, F.lit("ABSENT"))


def is_defining(status: Column) -> Column:
    """Does a treatment with this status define its taxon?"""
    return (F.coalesce(status, F.lit("")) != "") & ~F.coalesce(status.isin(*NOT_DEFINING), F.lit(True))


def document_rows(nodes: DataFrame) -> DataFrame:
    """(doc_path, doc_id, attrs): the first document element of each path."""
    roots = nodes.where("tag = 'document'").groupBy("doc_path").agg(F.min_by("attrs", "node_id").alias("d"))
    doc_id = F.coalesce(F.nullif(T.partial_uri(F.try_element_at("d", F.lit("docId"))), F.lit("")), F.lit("MISSING_ID"))
    return roots.select("doc_path", doc_id.alias("doc_id"), "d")


def treated_taxa(nodes: DataFrame) -> DataFrame:
    """The first name below a nomenclature of each document, with its status (the
    attribute, else a label behind it, else a label of its rank, else ABSENT)."""
    own_names = nodes.where("tag = 'taxonomicName'")
    own = own_names.where(tree.below("document", "treatment", "subSubSection[nomenclature]"))
    first = own.groupBy("doc_path").agg(F.min_by(F.struct("node_id", "parent_id", "sib_ord", "attrs"), "node_id").alias("t")).select("doc_path", "t.*")
    # labels anywhere below the name's parent; "behind": with a name before it among its own siblings
    names = own_names.groupBy("doc_path", "parent_id").agg(F.min("sib_ord").alias("_f")).select(F.col("doc_path").alias("_e"), F.col("parent_id").alias("_q"), "_f")
    labels = nodes.where("tag = 'taxonomicNameLabel'").select(F.col("doc_path").alias("_d"), F.col("parent_id").alias("_p"), F.col("sib_ord").alias("_s"), F.col("node_id").alias("_n"), F.transform("ancestors", lambda a: a["node_id"]).alias("_a"), F.try_element_at("attrs", F.lit("rank")).alias("_r"), F.col("text").alias("_t"))
    labels = labels.join(names, (F.col("_d") == F.col("_e")) & (F.col("_p") == F.col("_q")), "left").withColumn("_behind", F.coalesce(F.col("_s") > F.col("_f"), F.lit(False)))
    met = first.join(labels, (first["doc_path"] == labels["_d"]) & F.array_contains(labels["_a"], first["parent_id"]), "left")
    said = met.groupBy("doc_path").agg(F.min_by("_t", F.when(F.col("_behind"), F.col("_n"))).alias("behind"), F.min_by("_t", F.when(F.col("_r") == attr("rank"), F.col("_n"))).alias("ranked"))
    return first.join(said, "doc_path").withColumn("taxon_status", status_of(attr("status"), F.col("behind"), F.col("ranked"))).drop("behind", "ranked")


def outermost() -> Column:
    """Is a node an outermost citation of a reference group?"""
    group = F.exists("ancestors", lambda a: (a["tag"] == "subSubSection") & F.coalesce(a["type"] == "reference_group", F.lit(False)))
    tag = F.col("tag")
    return group & ((tag == "treatmentCitationGroup") | ((tag == "treatmentCitation") & ~tree.inside_any("treatmentCitationGroup")) | ((tag == "taxonomicName") & ~tree.inside_any("treatmentCitation", "treatmentCitationGroup")))


def cited_taxa(nodes: DataFrame) -> DataFrame:
    """The name of each outermost citation of a reference group, in document order."""
    names = nodes.where("tag = 'taxonomicName'")
    first = tree.first_below(nodes.where(outermost()), names).where("first_id is not null").select("doc_path", F.col("node_id").alias("ord"), F.col("first_id").alias("node_id"))
    return first.join(names.select("doc_path", "node_id", "attrs"), ["doc_path", "node_id"])


def events(nodes: DataFrame, host: str) -> DataFrame:
    """One row per treated (ord -1) and cited taxon with class, addresses and year."""
    docs = document_rows(nodes)
    treated, cited = treated_taxa(nodes), cited_taxa(nodes)
    t = treated.select("doc_path", F.lit(-1).alias("ord"), "attrs", "taxon_status").join(docs, "doc_path").withColumn("errors", epithet_errors(attr, F.try_element_at("attrs", attr("rank"))))
    t = t.withColumn("bad", F.size("errors") > 0)
    own = t.select("doc_path", F.col("attrs").alias("t_attrs"))
    c = cited.select("doc_path", "ord", "attrs", F.lit(None).cast("string").alias("taxon_status")).join(docs, "doc_path").withColumn("errors", F.array().cast("array<string>")).withColumn("bad", F.lit(False))
    e = t.unionByName(c).join(own, "doc_path", "left")
    defining = (F.col("ord") == -1) & is_defining(F.col("taxon_status"))
    a = {k: attr(k) for k in ("authorityName", "authorityYear", "baseAuthorityName", "baseAuthorityYear", "authority", "kingdom")}
    author, date = F.try_element_at("d", F.lit("docAuthor")), F.try_element_at("d", F.lit("docDate"))
    e = e.withColumn("defining", defining).withColumn("authority", T.full_authority(a, author, date, F.col("defining")))
    e = e.withColumn("notes", T.authority_notes(a, F.coalesce(F.col("defining"), F.lit(False))))
    e = e.withColumn("year", T.first_year("authority")).withColumn("rank_group", T.rank_group(attr))
    e = e.withColumn("relation", T.taxon_relation(attr, lambda k: attr(k, "t_attrs"), F.col("ord") >= 0, F.col("t_attrs").isNotNull()))
    e = e.withColumn("tnuri", name_uri(attr("rank"), present_ranks(), host=host)).withColumn("punctuated", punctuated(attr("rank"), present_ranks()))
    short = F.concat(F.lit("_"), T.authority_for_uri("authority"), F.lit("_"), T.partial_uri("year"))
    e = e.withColumn("uri", F.when(F.col("authority") != "INVALID", concept_uri(short, host=host)))
    guard = refused(attr, F.col("rank_group"))
    kind = F.when(F.col("bad"), "X").when(F.col("tnuri").isNull(), "F").when(F.col("ord") == -1, "T").when(guard, "R").when(F.col("authority") == "INVALID", "I").when(F.col("relation") == "CITES", "C").when(F.col("relation") == "DEPRECATES", "D").otherwise("S")
    return e.withColumn("class", kind)


def citation_sets(e: DataFrame) -> DataFrame:
    """(doc_path, predicate, object, ord): what a treatment says of concepts and names.

    A name without a year is cited at its first mention only; what is deprecated anywhere is
    not cited; the treated concept is neither cited nor deprecated by a citation.
    """
    own = e.where("class = 'T'").select("doc_path", F.col("uri").alias("t_uri"))
    seen = e.join(own, "doc_path", "left").where("class in ('T', 'I', 'C', 'D')")
    adds = ~((F.col("class") == "D") & F.col("uri").eqNullSafe(F.col("t_uri")))
    first = F.min(F.when(adds, F.col("ord"))).over(Window.partitionBy("doc_path", "tnuri"))
    seen = seen.withColumn("first", first)
    status = F.col("taxon_status")
    said = F.when(F.col("uri").isNull(), F.lit("trt:treatsTaxonName")).when(status.isin(*DOUBTFUL), F.lit("trt:deprecates")).when(F.col("defining"), F.lit("trt:definesTaxonConcept")).otherwise(F.lit("trt:augmentsTaxonConcept"))
    treated = seen.where("class = 'T'").select("doc_path", said.alias("predicate"), F.coalesce("uri", "tnuri").alias("object"), "ord")
    names = seen.where("class = 'I' and ord = first").select("doc_path", F.lit("trt:citesTaxonName").alias("predicate"), F.col("tnuri").alias("object"), "ord")
    deprecated = seen.where("class = 'D' and not (uri <=> t_uri)").select("doc_path", F.lit("trt:deprecates").alias("predicate"), F.col("uri").alias("object"), "ord")
    gone = deprecated.unionByName(treated.where("predicate = 'trt:deprecates'")).select("doc_path", "object")
    cites = seen.where("class = 'C' and not (uri <=> t_uri) and (year <> '' or ord = first)").select("doc_path", F.lit("cito:cites").alias("predicate"), F.col("uri").alias("object"), "ord")
    return treated.unionByName(names).unionByName(deprecated).unionByName(cites.join(gone, ["doc_path", "object"], "left_anti").select("doc_path", "predicate", "object", "ord"))


def _long(df: DataFrame, kind: str, subject: Column, props: list, order: Column) -> DataFrame:
    items = F.array_compact(F.array(*(F.when(o.isNotNull(), F.struct((F.lit(p) if isinstance(p, str) else p).alias("predicate"), o.alias("object"))) for p, o in props)))
    return df.select("doc_path", F.lit(kind).alias("kind"), subject.alias("subject"), order.cast("long").alias("ord"), F.explode(items).alias("x")).select("doc_path", "kind", "subject", "x.predicate", "x.object", "ord")


#: The messages of failed documents.
LOST = "the treated name has no address"
NO_NAME_PART = "an author has no name part"
NO_FIGURE = "a figure has neither link nor DOI"


def failures(nodes: DataFrame, e: DataFrame) -> DataFrame:
    """(doc_path, message): documents that fail while they are read, with the first reason."""
    lost = e.where("class = 'F' and ord < 0").select("doc_path", F.lit(0).alias("at"), F.lit(LOST).alias("message"))
    authors = _persons(nodes).where("role rlike '(?i)author' and part is null").select("doc_path", F.lit(1).alias("at"), F.lit(NO_NAME_PART).alias("message"))
    figures = nodes.where((F.col("tag") == "figureCitation") & (F.map_contains_key("attrs", "httpUri") | F.map_contains_key("attrs", "figureDoi")) & ~T.present(attr("httpUri")) & ~T.present(attr("figureDoi"))).select("doc_path", F.lit(2).alias("at"), F.lit(NO_FIGURE).alias("message"))
    return lost.unionByName(authors).unionByName(figures).groupBy("doc_path").agg(F.min_by("message", "at").alias("message"))


def comments(nodes: DataFrame, paths: DataFrame, e: DataFrame) -> DataFrame:
    """(doc_path, ord, line): the remarks of a document that belong to no subject, in order; of
    a failed one its error last."""
    failed = failures(nodes, e)
    rows = diagnostic_rows(nodes, paths, e).where("place = 'document'").select("doc_path", F.when(F.col("level") == 3, F.lit(1 << 40)).otherwise(F.col("ord")).alias("ord"), F.concat(F.when(F.col("level") == 1, F.lit("# Warning: ")).otherwise(F.lit("# Error: ")), T.fold_error("message")).alias("line"), "key")
    # a document that fails before its materials are read says nothing of them
    early = failed.where(F.col("message") != NO_FIGURE).select("doc_path")
    rows = rows.where("key <> 'material'").unionByName(rows.where("key = 'material'").join(early, "doc_path", "left_anti"))
    return rows.select("doc_path", "ord", "line")


def statements(nodes: DataFrame, host: str = T.DEFAULT_HOST, material_base: str | None = None, taxa: DataFrame | None = None) -> DataFrame:
    """(doc_path, kind, subject, predicate, object, ord): all statements of all documents.

    taxa: the rows of ``events``, if they are at hand. Documents that fail (``failures``) have
    none; cited names whose address can't be made are an error remark of the treatment.
    """
    docs = cut(document_rows(nodes))
    e = taxa if taxa is not None else cut(events(nodes, host))
    get = lambda k: F.try_element_at("d", F.lit(k))
    treatment = T.uri(F.concat(F.lit(f"http://treatment.{host}/id/"), F.col("doc_id")))
    authors = _authors(nodes)
    d = docs.join(authors, "doc_path", "left").withColumn("creator", T.string_literal("authors")).withColumn("publication", T.publication_uri(get("ID-DOI"), get("docSource"), get("masterDocId"), host))
    about = lambda rows, predicate, o: rows.select("doc_path", "doc_id", F.lit("treatment").alias("kind"), treatment.alias("subject"), F.lit(predicate).alias("predicate"), o.alias("object"), F.lit(0).cast("long").alias("ord")).drop("doc_id")
    short = F.when(F.col("authority") == "INVALID", F.col("tnuri")).otherwise(F.col("uri"))
    out = [
        _long(d, "treatment", treatment, [("dc:title", F.when(get("docTitle").isNotNull(), T.string_literal(get("docTitle")))), ("dc:creator", F.col("creator")), ("trt:publishedIn", F.col("publication")), ("a", F.lit("trt:Treatment"))], F.lit(0)),
        about(e.where("bad").withColumn("error", F.explode("errors")), "# Warning: Could not add treatment taxon because", F.col("error")),
        about(e.where("class = 'R'"), "# Warning:", F.concat(F.lit("Not adding 'trt:citesTaxonName "), short, F.lit("' due to issues with rank"))),
        about(e.where("class = 'F' and ord >= 0"), "# Error:", F.lit("Could not add TaxonConceptCitation\nno address can be made of the name")),
        citation_sets(e).join(docs, "doc_path").select("doc_path", F.lit("treatment").alias("kind"), treatment.alias("subject"), "predicate", "object", F.lit(0).cast("long").alias("ord")),
        _publication(nodes, d),
    ]
    # concepts
    made = e.where("class in ('T', 'C', 'D') and uri is not null")
    order = F.col("ord") + 1
    whole = (F.col("rank_group") != "INVALID") & (F.col("relation") != "NONE")
    first = F.min_by("authority", "ord").over(Window.partitionBy("doc_path", "uri").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    made = made.withColumn("named_by", first)
    out.append(_long(made, "concept", F.col("uri"), [("trt:hasTaxonName", F.col("tnuri")), ("dwc:scientificNameAuthorship", F.when(whole, T.string_literal("named_by"))), ("# Error:", F.when(F.col("rank_group") == "INVALID", F.lit("Invalid Rank"))), ("# Error:", F.when(F.col("relation") == "NONE", F.lit("Invalid taxon relation"))), ("a", F.lit("dwcFP:TaxonConcept"))], order))
    noted = made.where(whole)
    removed = lambda which, what: ("# Warning:", F.when(F.col(f"notes.{which}").isNotNull(), F.concat(F.lit('Removing "'), F.col(f"notes.{which}"), F.lit(f'" from {what}'))))
    author, date = get("docAuthor"), get("docDate")
    of_document = lambda o: F.when(F.col("notes.document"), o)
    out.append(_long(noted, "concept", F.col("uri"), [removed("base", "baseAuthority"), removed("own", "authority"), ("# Warning:", F.when(F.col("notes.year"), F.lit("Using document metadata for authority year"))), ("dwc:authority", of_document(T.string_literal("authority"))), ("dwc:authorityName", of_document(T.string_literal(T.shorten_authors(author)))), ("dwc:authorityYear", of_document(T.string_literal(date))), ("# Info:", of_document(F.lit("authority attributes generated from docAuthor")))], order))
    out.append(attribute_statements(made.where(whole).select("doc_path", F.col("uri").alias("subject"), order.cast("long").alias("ord"), "attrs"), "attrs").withColumn("kind", F.lit("concept")))
    # names: created with their parents by T and D, only added to by C and first I
    base = e.where("class in ('T', 'D', 'C', 'I')").select("doc_path", "ord", "class", "attrs")
    leveled = name_statements(with_parents(levels(base, host=host), ["doc_path", "ord"])).where("name_uri is not null")
    creates = F.col("class").isin("T", "D")
    pushed = F.min(F.when(creates, F.col("ord"))).over(Window.partitionBy("doc_path", "name_uri"))
    kept = leveled.withColumn("pushed", pushed).where(creates | ((F.col("level") == 0) & (F.col("pushed") < F.col("ord"))))
    props = F.when(creates, F.col("props")).otherwise(F.filter("props", lambda x: ~x["predicate"].isin("trt:hasParentName") & ~F.coalesce(x["object"] == "Could not determine parent name", F.lit(False))))
    out.append(kept.select("doc_path", F.lit("name").alias("kind"), F.col("name_uri").alias("subject"), F.explode(props).alias("x"), ((F.col("ord") + 1) * 100 + F.col("level")).cast("long").alias("ord")).select("doc_path", "kind", "subject", "x.predicate", "x.object", "ord"))
    out.append(_vernacular(nodes, e))
    out += _figures(nodes, docs, treatment, d)
    out += material_statements(nodes, docs, treatment, host, material_base)
    made = reduce(lambda a, b: a.unionByName(b), (x.select("doc_path", "kind", "subject", "predicate", "object", F.col("ord").cast("long").alias("ord")) for x in out)).where("subject is not null")
    return made.join(failures(nodes, e).select("doc_path"), "doc_path", "left_anti")


def attribute_statements(rows: DataFrame, attrs: str) -> DataFrame:
    """(doc_path, subject, predicate, object, ord): one statement per attribute of a taxon."""
    items = rows.select("doc_path", "subject", "ord", F.explode(F.map_entries(attrs)).alias("x")).where(~F.col("x.key").isin(*NOT_COPIED) & ~F.col("x.key").rlike(NOT_COPIED_PATTERN))
    value = F.col("x.value")
    mark = value.rlike(T.RANK_MARK)
    predicate = F.when(F.col("x.key") == "ID-CoL", F.lit("rdfs:seeAlso")).when(mark, F.lit("# Warning:")).otherwise(F.concat(F.lit("dwc:"), F.col("x.key")))
    said = F.when(F.col("x.key") == "ID-CoL", T.uri(F.concat(F.lit("https://www.catalogueoflife.org/data/taxon/"), T.normalize_space(value)))).when(mark, F.concat(F.lit("ignoring "), F.col("x.key"), F.lit(" "), T.string_literal(value))).otherwise(T.string_literal(T.normalize_space(value)))
    return items.select("doc_path", "subject", predicate.alias("predicate"), said.alias("object"), "ord")


def _persons(nodes: DataFrame) -> DataFrame:
    """(doc_path, node_id, role, part): each person of the bibliographic records with the first
    role and the first name part below."""
    persons = nodes.where("tag = 'MODSname'").select("doc_path", F.col("node_id").alias("_id"), "subtree_end")
    below = nodes.where("tag in ('MODSroleTerm', 'MODSnamePart')").select(F.col("doc_path").alias("_d"), F.col("node_id").alias("_r"), "tag", "text")
    met = persons.join(below, (F.col("doc_path") == F.col("_d")) & (F.col("_r") > F.col("_id")) & (F.col("_r") < F.col("subtree_end")), "left")
    of = lambda tag: F.min_by("text", F.when(F.col("tag") == tag, F.col("_r")))
    return met.groupBy("doc_path", F.col("_id").alias("node_id")).agg(of("MODSroleTerm").alias("role"), of("MODSnamePart").alias("part"))


def _authors(nodes: DataFrame) -> DataFrame:
    """(doc_path, authors): the names of all persons whose role is author, in order."""
    known = _persons(nodes).where("role rlike '(?i)author' and part is not null")
    return known.groupBy("doc_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_id", F.trim("part").alias("p")))), lambda x: x["p"]), "; ").alias("authors"))


def _publication(nodes: DataFrame, d: DataFrame) -> DataFrame:
    """Statements on the publication from its bibliographic record."""
    text = lambda norm: T.string_literal(T.normalize_space("text") if norm else F.col("text"))
    head = nodes.where(((F.col("tag") == "MODStitle") & tree.child_of("MODSmods", "MODStitleInfo")))
    titles = head.groupBy("doc_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_id", text(False).alias("o")))), lambda x: x["o"]), ", ").alias("object")).select("doc_path", F.lit("dc:title").alias("predicate"), "object")
    dates = nodes.where(((F.col("tag") == "MODSdate") & tree.child_of("MODSpart")) | ((F.col("tag") == "MODSdateIssued") & tree.child_of("MODSoriginInfo"))).select("doc_path", F.lit("dc:date").alias("predicate"), text(False).alias("object"))
    kinds = nodes.where("tag = 'MODSclassification' and text in ('journal article', 'book chapter', 'book')").select("doc_path", "text").distinct()
    host = F.exists("ancestors", lambda a: (a["tag"] == "MODSrelatedItem") & F.coalesce(a["type"] == "host", F.lit(False)))
    within = nodes.where(host)
    journal = F.when((F.col("tag") == "MODStitle") & tree.child_of("MODStitleInfo"), F.struct(F.lit("bibo:journal").alias("predicate"), text(False).alias("object"))).when((F.col("tag") == "MODSdetail") & tree.child_of("MODSpart"), F.struct(F.concat(F.lit("bibo:"), F.coalesce(attr("type"), F.lit("null"))).alias("predicate"), text(True).alias("object")))
    pages = F.when(F.col("tag").isin("MODSstart", "MODSend") & tree.child_of("MODSpart", "MODSextent"), F.struct(F.when(F.col("tag") == "MODSstart", "bibo:startPage").otherwise("bibo:endPage").alias("predicate"), text(True).alias("object")))
    details = within.withColumn("j", journal).withColumn("p", pages).where("j is not null or p is not null").join(kinds.where("text <> 'book'").withColumnRenamed("text", "what"), "doc_path")
    details = details.select("doc_path", F.when(F.col("p").isNotNull(), F.col("p")).when(F.col("what") == "journal article", F.col("j")).alias("x")).where("x is not null").select("doc_path", "x.predicate", "x.object")
    hosts = nodes.where((F.col("tag") == "MODSrelatedItem") & (attr("type") == "host")).select("doc_path").distinct()
    types = kinds.where("text <> 'book'").join(hosts, "doc_path").unionByName(kinds.where("text = 'book'")).select("doc_path", F.lit("a").alias("predicate"), F.when(F.col("text") == "journal article", "fabio:JournalArticle").when(F.col("text") == "book chapter", "fabio:BookSection").otherwise("fabio:Book").alias("object"))
    creator = d.select("doc_path", F.lit("dc:creator").alias("predicate"), F.col("creator").alias("object"))
    all_of = reduce(lambda a, b: a.unionByName(b), (titles, dates, details, types, creator))
    return all_of.join(d.select("doc_path", F.col("publication").alias("subject")), "doc_path").withColumn("kind", F.lit("publication")).withColumn("ord", F.lit(0))


def _vernacular(nodes: DataFrame, e: DataFrame) -> DataFrame:
    """Names in living languages of the treated taxon, with a tag where the code is known."""
    v = nodes.where(F.col("tag") == "vernacularName").select("doc_path", attr("language").alias("code"), T.string_literal(T.normalize_space("text")).alias("word"))
    known = F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv))
    v = v.withColumn("tag", F.try_element_at(known, F.coalesce("code", F.lit("")))).join(e.where("class = 'T'").select("doc_path", F.col("tnuri").alias("subject")), "doc_path")
    pairs = F.array_compact(F.array(F.struct(F.lit("dwc:vernacularName").alias("predicate"), F.when(F.col("tag").isNotNull(), F.concat("word", F.lit("@"), "tag")).otherwise(F.col("word")).alias("object")), F.when(F.col("tag").isNull(), F.struct(F.lit("# Info:").alias("predicate"), F.concat(F.lit("Couldn't generate language tag for "), "word", F.lit("@"), F.coalesce("code", F.lit("undefined"))).alias("object")))))
    return v.select("doc_path", F.lit("name").alias("kind"), "subject", F.explode(pairs).alias("x"), F.lit(0).alias("ord")).select("doc_path", "kind", "subject", "x.predicate", "x.object", "ord")


def listed(rows: DataFrame, distinct: bool) -> DataFrame:
    """(doc_path, object): the addresses of each document in order as one list."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("ord", "subject"))), lambda x: x["subject"])
    return rows.where("subject is not null").groupBy("doc_path").agg(F.array_join(F.array_distinct(items) if distinct else items, ", ").alias("object"))


def _figures(nodes: DataFrame, docs: DataFrame, treatment: Column, d: DataFrame) -> list[DataFrame]:
    f = nodes.where((F.col("tag") == "figureCitation") & (F.map_contains_key("attrs", "httpUri") | F.map_contains_key("attrs", "figureDoi"))).withColumn("subject", T.figure_uri(attr("httpUri"), attr("figureDoi"))).withColumn("ord", F.col("node_id"))
    own = _long(f, "figure", F.col("subject"), [("dc:description", F.when(attr("captionText").isNotNull(), T.string_literal(attr("captionText")))), ("fabio:hasRepresentation", T.figure_representation(attr("httpUri"))), ("a", F.lit("fabio:Figure"))], F.col("ord"))
    every = listed(f, True)
    cites = every.join(docs, "doc_path").select("doc_path", F.lit("treatment").alias("kind"), treatment.alias("subject"), F.lit("cito:cites").alias("predicate"), "object", F.lit(0).alias("ord"))
    part = every.join(d, "doc_path").select("doc_path", F.lit("publication").alias("kind"), F.col("publication").alias("subject"), F.lit("fabio:hasPart").alias("predicate"), "object", F.lit(0).alias("ord"))
    return [own, cites, part]


def material_statements(nodes: DataFrame, docs: DataFrame, treatment: Column, host: str, base: str | None) -> list[DataFrame]:
    """The statements of each cited material, and of each document's materials as one list."""
    m = nodes.where("tag = 'materialsCitation'").join(docs.select("doc_path", "doc_id"), "doc_path").withColumn("ord", F.col("node_id"))
    m = m.withColumn("subject", T.material_uri(attr("id"), attr("ID-GBIF-Occurrence"), attr("httpUri"), attr("specimenCode"), F.col("doc_id"), host, base))
    props = [(term, F.when(attr(a).isNotNull(), T.string_literal(attr(a)))) for a, term in MATERIAL_TERMS.items()]
    props.append(("trt:httpUri", F.when(T.present(attr("id")), T.uri(F.concat(F.lit(f"https://treatment.{host}/id/"), F.col("doc_id"), F.lit("#"), attr("id"))))))
    own = _long(m.where("subject is not null"), "material", F.col("subject"), [*props, ("trt:httpUri", F.when(T.present(attr("httpUri")), T.uri(attr("httpUri")))), ("a", F.lit("dwc:MaterialCitation"))], F.col("ord"))
    basis = listed(m, False).join(docs, "doc_path").select("doc_path", F.lit("treatment").alias("kind"), treatment.alias("subject"), F.lit("dwc:basisOfRecord").alias("predicate"), "object", F.lit(0).alias("ord"))
    return [own, basis]


def diagnostic_rows(nodes: DataFrame, paths: DataFrame, e: DataFrame, host: str = T.DEFAULT_HOST) -> DataFrame:
    """(doc_path, ord, level, key, place, message): all that is remarked of documents; level 3 is
    failed, 2 error, 1 warning, 0 information; place is 'document' for what no subject carries,
    'log' for what no output carries."""
    docs = document_rows(nodes)
    row = lambda df, order, level, key, place, message: df.select("doc_path", (F.lit(order) if isinstance(order, int) else order).cast("long").alias("ord"), (F.lit(level) if isinstance(level, int) else level).alias("level"), F.lit(key).alias("key"), F.lit(place).alias("place"), (F.lit(message) if isinstance(message, str) else message).alias("message"))
    none = paths.select("doc_path").distinct().join(docs, "doc_path", "left_anti")
    t = docs.join(treated_taxa(nodes).select("doc_path", "attrs"), "doc_path", "left")
    cited = nodes.where(outermost())
    base = e.where("class in ('T', 'D', 'C', 'I')").withColumn("recursive", F.col("class").isin("T", "D"))
    leveled = name_statements(with_parents(levels(base.select("doc_path", "ord", "class", "recursive", "attrs"), host=host), ["doc_path", "ord"]))
    once = base.where("class = 'I'").groupBy("doc_path", "tnuri").agg(F.min("ord").alias("_o")).select(F.col("doc_path").alias("_d"), "_o")
    # only the first mention of a name without authority makes the name
    leveled = leveled.join(once, (F.col("doc_path") == F.col("_d")) & (F.col("ord") == F.col("_o")), "left").where("recursive or (level = 0 and (class = 'C' or _o is not null))")
    remarks = leveled.select("doc_path", "ord", F.explode(F.filter("props", lambda x: (x["predicate"] == "# Warning:") & (F.col("recursive") | (x["object"] != "Could not determine parent name")))).alias("x"))
    order = F.col("ord") + 1
    kept = e.where("class in ('T', 'C', 'D') and uri is not null and rank_group <> 'INVALID' and relation <> 'NONE'")
    v = nodes.where(F.col("tag") == "vernacularName").select("doc_path", "node_id", T.string_literal(T.normalize_space("text")).alias("word"), attr("language").alias("code")).join(e.where("class = 'T'").select("doc_path"), "doc_path", "left_semi")
    known = F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv))
    made = e.where("class in ('T', 'C', 'D') and uri is not null")
    ignored = attribute_statements(kept.select("doc_path", F.col("uri").alias("subject"), order.cast("long").alias("ord"), "attrs"), "attrs").where("predicate = '# Warning:'")
    noted = e.where("class in ('T', 'R', 'I', 'C', 'D', 'S')")
    removed = lambda which, what: row(noted.where(F.col(f"notes.{which}").isNotNull()), order, 1, "bracket", "concept", F.concat(F.lit('Removing "'), F.col(f"notes.{which}"), F.lit(f'" from {what}')))
    punctuation = leveled.where("punctuated").select("doc_path", "ord").unionByName(e.where("punctuated and class <> 'X'").select("doc_path", "ord")).distinct()
    rows = [
        row(none, 0, 3, "root", "document", "missing <document>"),
        row(failures(nodes, e), F.lit(1 << 30), 3, "exception", "document", F.col("message")),
        row(t.where("attrs is null"), 0, 2, "taxon", "document", "the treatment is lacking the taxon"),
        row(t.where(F.col("attrs").isNotNull() & ~T.present(attr("kingdom"))), 0, 1, "kingdom", "document", "treatment taxon is missing ancestor kingdom"),
        row(e.where("bad").withColumn("error", F.explode("errors")), 0, 1, "epithet", "treatment", F.col("error")),
        row(e.where("class = 'T' and authority = 'INVALID'"), 0, 1, "authority", "log", F.concat(F.lit("Invalid Authority for "), F.col("tnuri"))),
        row(made.where("rank_group = 'INVALID'"), order, 2, "rank", "concept", "Invalid Rank"),
        row(made.where("relation = 'NONE'"), order, 2, "relation", "concept", "Invalid taxon relation"),
        row(ignored, F.col("ord"), 1, "ignored", "concept", F.col("object")),
        row(remarks, order, 1, "name", "name", F.col("x.object")),
        removed("base", "baseAuthority"), removed("own", "authority"),
        row(kept.where("notes.year"), order, 0, "year", "concept", "Using document metadata for authority year"),
        row(kept.where("notes.document"), order, 0, "document authority", "concept", "authority attributes generated from docAuthor"),
        row(e.where("class = 'R'"), order, 1, "cited rank", "treatment", "issues with rank"),
        row(e.where("class = 'F' and ord >= 0"), order, 2, "citation", "treatment", "no address can be made of the name"),
        row(tree.first_below(cited, nodes.where("tag = 'taxonomicName'")).where("first_id is null"), F.col("node_id"), 0, "nameless citation", "log", "found without taxonomicName"),
        row(punctuation, order, 1, "punctuation", "log", "punctuation removed from a name"),
        row(v.where(F.try_element_at(known, F.coalesce("code", F.lit(""))).isNull()), F.col("node_id"), 0, "language", "name", F.concat(F.lit("Couldn't generate language tag for "), F.col("word"), F.lit("@"), F.coalesce("code", F.lit("undefined")))),
        row(nodes.where((F.col("tag") == "materialsCitation") & ~T.present(attr("id")) & ~T.present(attr("httpUri")) & ~T.present(attr("specimenCode"))), F.col("node_id"), 1, "material", "document", "Failed to output a material citation, could not create identifier"),
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def diagnostics(nodes: DataFrame, paths: DataFrame, host: str = T.DEFAULT_HOST) -> DataFrame:
    """(doc_path, level, key, message): 3 failed, 2 error, 1 warning, 0 information; documents
    without any are absent."""
    return diagnostic_rows(nodes, paths, cut(events(nodes, host)), host).select("doc_path", "level", "key", "message")


def document_status(nodes: DataFrame, paths: DataFrame, host: str = T.DEFAULT_HOST) -> DataFrame:
    """(doc_path, status): the greatest level of each path, 0 without diagnostics."""
    worst = diagnostics(nodes, paths, host).groupBy("doc_path").agg(F.max("level").alias("level"))
    return paths.select("doc_path").distinct().join(worst, "doc_path", "left").select("doc_path", F.coalesce("level", F.lit(0)).alias("status"))
