"""Queries of the string functions, projections and predicates, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators.graph import epithet_errors, is_defining, refused, status_of
from stemma.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


WS_SQL = r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"


def norm_sql(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{WS_SQL}', ' ', 'g'))"


def part_sql(c: str) -> str:
    return norm_sql(f"regexp_replace(coalesce({c}, ''), '[;/?:@&=+$,#]+', ' ', 'g')")


def encode_sql(c: str) -> str:
    out = f"replace(url_encode({c}), '+', '%20')"
    for code, sign in T.RESERVED:
        out = f"replace({out}, '{code}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return out


def uri_sql(c: str, blank: str = "") -> str:
    body = f"regexp_replace(regexp_replace(regexp_replace({c}, '^{WS_SQL}', ''), '{WS_SQL}$', ''), '{WS_SQL}', '{blank}', 'g')"
    return f"CASE WHEN coalesce({c}, '') <> '' THEN '<' || {encode_sql(body)} || '>' ELSE '[]' END"


def json_sql(c: str) -> str:
    return f"CAST(to_json(coalesce({c}, '')) AS VARCHAR)"


# taxa of taxon_names under the attribute names of the documents
TAXON = {"rank": "taxon_rank", "kingdom": "kingdom", "phylum": "phylum", "class": "class_name", "order": "order_name", "family": "family", "genus": "genus", "species": "species", "subSpecies": "subspecies", "authorityName": "authorityname", "authorityYear": "authorityyear", "isHybrid": "ishybrid", "status": "taxon_status"}


def taxon(prefix: str = ""):
    """get(attribute) on the columns of taxon_names, null for attributes that it lacks."""
    return lambda k: F.col(prefix + TAXON[k]) if k in TAXON else F.lit(None).cast("string")


@query(f"SELECT doc_id, {norm_sql('text')} AS text_norm FROM documents")
def normalize_space(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.normalize_space("text").alias("text_norm"))


@query(f"SELECT row_id, {part_sql('specimencode')} AS part FROM materials")
def partial_uri(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "materials").select("row_id", T.partial_uri("specimencode").alias("part"))


@query(f"SELECT docid, doc_path, updated_ts, received_ts, {uri_sql('doctitle', '_')} AS address FROM treatments")
def encode_uri(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "treatments").select("docid", "doc_path", "updated_ts", "received_ts", T.uri("doctitle", "_").alias("address"))


@query(f"SELECT row_id, {json_sql('locality_deviation')} AS literal, {json_sql('collectorname')} AS collector FROM materials")
def string_literal(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "materials").select("row_id", T.string_literal("locality_deviation").alias("literal"), T.string_literal("collectorname").alias("collector"))


@query("SELECT row_id, split_part(specimencode, ':', 1) AS head, list_extract(string_split(specimencode, ':'), -1) AS tail, list_extract(string_split(httpuri, '/'), -1) AS last FROM materials WHERE specimencode IS NOT NULL")
def substring_before_after(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "materials").where("specimencode is not null").select("row_id", T.substring_before("specimencode", ":").alias("head"), T.substring_after("specimencode", ":").alias("tail"), T.substring_after("httpuri", "/").alias("last"))


@query(r"""SELECT row_id, replace(regexp_replace(replace(locality, '-', chr(1)), '[\pZ\pS\pP]', '', 'g'), chr(1), '-') AS bare,
 coalesce(replace(regexp_replace(replace(locality, '-', chr(1)), '[\pZ\pS\pP]', '', 'g'), chr(1), '-') <> locality, false) AS changed FROM materials""")
def remove_punctuation(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "materials").select("row_id", T.remove_punctuation("locality").alias("bare"), F.coalesce(T.remove_punctuation("locality") != F.col("locality"), F.lit(False)).alias("changed"))


AUTHORITY_SQL = r"""
WITH s AS (SELECT {key}, trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g')) AS a FROM {src}),
 y AS (SELECT {key}, replace(replace(regexp_replace(a, ' *,* *(\(?[0-9]{{4}})[^)]*(\)?).*$', ', \1\2'), '"', ''), '''', '') AS a FROM s),
 i AS (SELECT {key}, regexp_replace(a, '(?:\b\p{{Lu}}\. *)+([A-Za-z0-9_]+)', '\1', 'g') AS a FROM y),
 n AS (SELECT {key}, regexp_replace(regexp_replace(a, '(?i) +and +', ' & ', 'g'), ' +[Ee][Tt] +([^a])', ' & \1', 'g') AS a FROM i),
 b AS (SELECT {key}, regexp_replace(regexp_replace(regexp_replace(regexp_replace(a, '\)\)$', ')'), '^\(\(', '('), '^ *[,:;]+ *', ''), ' *[,:;]+ *$', '') AS a FROM n),
 j AS (SELECT {key}, trim(a) AS a, list_transform(string_split(trim(a), '&'), lambda x: trim(x)) AS l FROM b),
 k AS (SELECT {key}, CASE WHEN len(l) > 2 THEN array_to_string(l[1:len(l)-1], ', ') || ' & ' || l[len(l)] ELSE a END AS a FROM j)
SELECT {key}, CASE WHEN contains(a, '(') AND (NOT contains(a, ')') OR instr(reverse(a), '(') < instr(reverse(a), ')')) THEN a || ')' ELSE a END AS authority FROM k"""


@query(AUTHORITY_SQL.format(key="name_row_id", c="CASE WHEN authorityname IS NULL THEN NULL ELSE concat_ws(', ', authorityname, authorityyear) END", src="taxon_names"))
def normalize_authority(spark: SparkSession, d: str) -> DataFrame:
    full = F.when(F.col("authorityname").isNotNull(), F.concat_ws(", ", "authorityname", "authorityyear"))
    return table(spark, d, "taxon_names").select("name_row_id", T.normalize_authority(full).alias("authority"))


@query(AUTHORITY_SQL.format(key="row_id", c="concat_ws(', ', replace(collectorname, ' & ', ' et '), collectingdate)", src="materials"))
def normalize_collectors(spark: SparkSession, d: str) -> DataFrame:
    full = F.concat_ws(", ", F.replace("collectorname", F.lit(" & "), F.lit(" et ")), "collectingdate")
    return table(spark, d, "materials").select("row_id", T.normalize_authority(full).alias("authority"))


@query(r"""WITH a AS (SELECT docid, doc_path, updated_ts, received_ts, list_extract(string_split(split_part(split_part(split_part(docauthor, ')', 1), ' &', 1), ',', 1), ' '), -1) AS a FROM treatments)
SELECT docid, doc_path, updated_ts, received_ts, """ + part_sql(r"CASE WHEN regexp_extract(a, '\(?\p{L}+') <> '' THEN regexp_extract(a, '\(?\p{L}+') ELSE a END") + " AS name FROM a")
def authority_for_uri(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "treatments").select("docid", "doc_path", "updated_ts", "received_ts", T.authority_for_uri("docauthor").alias("name"))


@query("SELECT name_row_id, regexp_extract(coalesce(authorityyear, ''), '[0-9]+') AS year FROM taxon_names")
def year_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "taxon_names").select("name_row_id", T.first_year("authorityyear").alias("year"))


def title_sql(c: str) -> str:
    marked = f"regexp_replace({c}, '[A-Za-z0-9_][A-Z]+\\b[^.]|[A-Za-z0-9_][A-Z]+$', chr(1) || '\\0' || chr(2), 'g')"
    return f"array_to_string(list_transform(string_split({marked}, chr(1)), lambda p: CASE WHEN contains(p, chr(2)) THEN left(p, 1) || lower(split_part(substr(p, 2), chr(2), 1)) || split_part(p, chr(2), 2) ELSE p END), '')"


@query(f"""WITH n AS (SELECT row_id, {norm_sql('collectorname')} AS a FROM materials),
 r AS (SELECT row_id, replace(replace(regexp_replace(a, '([^,@&]+), +[^,@&]+', '\\1@', 'g'), '@&', ' &'), '@', '') AS a FROM n)
SELECT row_id, CASE WHEN length(a) >= 2 THEN {title_sql('a')} ELSE a END AS names FROM r""")
def shorten_authors(spark: SparkSession, d: str) -> DataFrame:
    """Surnames of all lists of collectors."""
    return table(spark, d, "materials").select("row_id", T.shorten_authors("collectorname").alias("names"))


@query(f"SELECT name_id, CASE WHEN length(collectorname) >= 2 AND NOT regexp_matches(collectorname, '[a-z]') THEN {title_sql('collectorname')} ELSE collectorname END AS titled FROM collector_names")
def title_case(spark: SparkSession, d: str) -> DataFrame:
    """Whole names, shouted or not."""
    return table(spark, d, "collector_names").select("name_id", T.title_case_shouted(F.col("collectorname")).alias("titled"))


@query(f"""SELECT docid, doc_path, updated_ts, received_ts, CASE WHEN coalesce(id_doi, '') = '' THEN {uri_sql("'http://publication.example.org/id/' || " + part_sql('masterdocid'))}
 WHEN contains(id_doi, 'doi.org') THEN {uri_sql("replace(replace(id_doi, 'https://', 'http://'), 'http://dx.doi.org/', 'http://doi.org/')")}
 ELSE {uri_sql("'http://doi.org/' || id_doi")} END AS publication FROM treatments""")
def publication_uri(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "treatments")
    return t.select("docid", "doc_path", "updated_ts", "received_ts", T.publication_uri(F.col("id_doi"), F.col("docsource"), F.col("masterdocid")).alias("publication"))


def present_sql(c: str) -> str:
    return f"coalesce({c}, '') <> ''"


@query(f"""SELECT row_id, CASE WHEN {present_sql('mc_id')} THEN {uri_sql("'http://material.example.org/id/' || docid || '.mc.' || mc_id")}
 WHEN {present_sql('id_gbif_occurrence')} THEN {uri_sql("'https://www.gbif.org/occurrence/' || id_gbif_occurrence")}
 WHEN {present_sql('httpuri')} THEN {uri_sql('httpuri')}
 ELSE {uri_sql("'http://treatment.example.org/id/' || docid || '/' || " + part_sql('specimencode'), '_')} END AS address
 FROM materials WHERE docid IS NOT NULL AND ({present_sql('mc_id')} OR {present_sql('httpuri')} OR {present_sql('specimencode')})""")
def material_uri(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "materials").where("docid is not null")
    return m.select("row_id", T.material_uri(*map(F.col, ("mc_id", "id_gbif_occurrence", "httpuri", "specimencode", "docid"))).alias("address")).where("address is not null")


@query(f"""SELECT row_id, CASE WHEN {present_sql('httpuri')} THEN {uri_sql('httpuri')} WHEN {present_sql('id_gbif_specimen')} THEN {uri_sql("'http://dx.doi.org/' || id_gbif_specimen")} END AS figure FROM materials
 WHERE {present_sql('httpuri')} OR {present_sql('id_gbif_specimen')}""")
def figure_uri(spark: SparkSession, d: str) -> DataFrame:
    """Links and identifiers of materials taken as a figure's: a link comes first unless there is a DOI."""
    m = table(spark, d, "materials")
    return m.select("row_id", T.figure_uri(F.col("httpuri"), F.when(~T.present("httpuri"), F.col("id_gbif_specimen"))).alias("figure")).where("figure is not null")


# links and identifiers of every form that figures have, made of each row's number
_LINK = "CASE row_id % 6 WHEN 0 THEN 'https://doi.org/10.5281/zenodo.' || row_id WHEN 1 THEN 'https://zenodo.org/ record/' || row_id || '/files/figure 1.png' WHEN 2 THEN httpuri WHEN 3 THEN '' WHEN 4 THEN 'http://a.example/' || row_id END"
_DOI = "CASE row_id % 4 WHEN 0 THEN 'https://doi.org/10.1/' || row_id WHEN 1 THEN '10.1/' || row_id WHEN 2 THEN '' END"


@query(f"""SELECT row_id, CASE WHEN contains(coalesce(link, ''), '10.5281/zenodo.') THEN {uri_sql('link')}
 WHEN contains(coalesce(link, ''), 'zenodo.') THEN {uri_sql("'http://dx.doi.org/10.5281/zenodo.' || list_extract(string_split(split_part(replace(link, ' ', ''), '/files/', 1), '/record/'), -1)")}
 WHEN contains(coalesce(doi, ''), 'doi.org/10.') THEN {uri_sql('doi')} WHEN coalesce(doi, '') <> '' THEN {uri_sql("'http://dx.doi.org/' || doi")} WHEN coalesce(link, '') <> '' THEN {uri_sql('link')} END AS figure,
 CASE WHEN contains(coalesce(link, ''), '10.5281/zenodo.') THEN {uri_sql("'https://zenodo.org/record/' || list_extract(string_split(link, '10.5281/zenodo.'), -1) || '/files/figure.png'")} WHEN coalesce(link, '') <> '' THEN {uri_sql("replace(link, ' ', '')")} END AS picture
 FROM (SELECT row_id, {_LINK} AS link, {_DOI} AS doi FROM materials)""")
def figure_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Addresses and pictures of figures, over all forms of links and identifiers."""
    m = table(spark, d, "materials").select("row_id", F.expr(_LINK).alias("link"), F.expr(_DOI).alias("doi"))
    return m.select("row_id", T.figure_uri(F.col("link"), F.col("doi")).alias("figure"), T.figure_representation(F.col("link")).alias("picture"))


@query("SELECT row_id FROM materials WHERE coalesce(mc_id, '') = '' AND coalesce(httpuri, '') = '' AND coalesce(specimencode, '') = ''")
def material_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "materials").where(~T.present("mc_id") & ~T.present("httpuri") & ~T.present("specimencode")).select("row_id")


@query("SELECT doc_path, seq, change_op, left(doc_path, length(doc_path) - 4) || '.ttl' AS target, regexp_replace(doc_path, '/[^/]*$', '') AS folder, CASE WHEN starts_with(doc_path, '/') THEN doc_path ELSE '/' || doc_path END AS rooted FROM change_feed")
def path_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "change_feed").select("doc_path", "seq", "change_op", T.target_path("doc_path").alias("target"), T.directory("doc_path").alias("folder"), T.rooted("doc_path").alias("rooted"))


@query("SELECT doc_id, replace(text, chr(10), chr(10) || '# ') AS folded FROM documents WHERE text IS NOT NULL")
def error_folding(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", T.fold_error("text").alias("folded"))


@query("SELECT raw_id, regexp_replace(payload, '(</?)taxonomic', '\\1MODS', 'g') AS rewritten FROM raw_records WHERE payload_form = 'xml'")
def tag_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """The rewriting of prefixed tags, on a prefix that these payloads have."""
    return table(spark, d, "raw_records").where("payload_form = 'xml'").select("raw_id", F.regexp_replace("payload", "(</?)taxonomic", "$1MODS").alias("rewritten"))


GROUP_SQL = "CASE WHEN coalesce({p}species,'')<>'' THEN 'species' WHEN coalesce({p}genus,'')<>'' THEN 'genus' WHEN coalesce({p}family,'')<>'' THEN 'family' WHEN coalesce({p}order_name,'')<>'' THEN 'order' WHEN coalesce({p}class_name,'')<>'' THEN 'class' WHEN coalesce({p}phylum,'')<>'' THEN 'phylum' WHEN coalesce({p}kingdom,'')<>'' THEN 'kingdom' ELSE 'INVALID' END"


@query(f"SELECT name_row_id, {GROUP_SQL.format(p='')} AS rank_group FROM taxon_names")
def rank_group(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "taxon_names").select("name_row_id", T.rank_group(taxon()).alias("rank_group"))


def _treated(t: DataFrame) -> DataFrame:
    """The treated taxon of each document: the least row."""
    own = t.where("taxon_role = 'treatment'")
    cols = [c for c in t.columns if c != "docid"]
    return own.groupBy("docid").agg(F.min_by(F.struct(*cols), "name_row_id").alias("t")).select("docid", *(F.col(f"t.{c}").alias(f"t_{c}") for c in cols))


@query(f"""WITH t AS (SELECT * FROM taxon_names WHERE taxon_role = 'treatment' QUALIFY row_number() OVER (PARTITION BY docid ORDER BY name_row_id) = 1),
 p AS (SELECT c.name_row_id, t.name_row_id AS t_id, {GROUP_SQL.format(p='c.')} AS cg, {GROUP_SQL.format(p='t.')} AS tg, c.taxon_rank AS cr, t.taxon_rank AS tr,
  coalesce(c.genus, '') AS cgen, coalesce(t.genus, '') AS tgen, c.genus IS NOT DISTINCT FROM t.genus AS same_genus, c.species IS NOT DISTINCT FROM t.species AS same_species,
  (c.authorityyear IS NOT NULL AND c.authorityyear IS NOT DISTINCT FROM t.authorityyear AND c.authorityname IS NOT DISTINCT FROM t.authorityname) AND c.taxon_rank IS NOT DISTINCT FROM t.taxon_rank
   AND c.genus IS NOT DISTINCT FROM t.genus AND c.species IS NOT DISTINCT FROM t.species AND c.subspecies IS NOT DISTINCT FROM t.subspecies AS alike
  FROM taxon_names c LEFT JOIN t USING (docid) WHERE c.taxon_role = 'citation')
SELECT name_row_id, CASE WHEN t_id IS NULL THEN 'CITES' WHEN cg = 'INVALID' OR tg = 'INVALID' THEN 'NONE' WHEN cg <> tg THEN 'CITES' WHEN cgen = '' OR tgen = '' THEN 'CITES'
 WHEN coalesce(cr = 'genus', false) AND NOT coalesce(tr = 'genus', false) AND same_genus THEN 'CITES' WHEN coalesce(cr = 'species', false) AND NOT coalesce(tr = 'species', false) AND same_genus AND same_species THEN 'CITES'
 WHEN alike THEN 'SAME' ELSE 'DEPRECATES' END AS relation FROM p""")
def taxon_relation(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "taxon_names")
    met = t.where("taxon_role = 'citation'").join(_treated(t), "docid", "left")
    return met.select("name_row_id", T.taxon_relation(taxon(), taxon("t_"), F.lit(True), F.col("t_name_row_id").isNotNull()).alias("relation"))


LONG = ("kingdom", "phylum", "class", "order", "family", "genus", "species", "subSpecies", "authorityName", "authorityYear", "isHybrid")


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT name_row_id, '{k}' AS attribute, {TAXON[k]} AS value FROM taxon_names" for k in LONG) + ") WHERE value IS NOT NULL")
def attribute_unpivot(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "taxon_names")
    return t.select("name_row_id", *(F.col(TAXON[k]).alias(k) for k in LONG)).unpivot("name_row_id", list(LONG), "attribute", "value").where("value is not null")


MATERIAL = {"specimencode": "catalogNumber", "collectioncode": "collectionCode", "typestatus": "typeStatus", "latitude": "verbatimLatitude", "longitude": "verbatimLongitude", "elevation": "verbatimElevation", "collectingcountry": "countryCode", "collectingregion": "stateProvince", "collectingmunicipality": "municipality", "collectingcounty": "county", "locality": "locality", "locality_deviation": "verbatimLocality", "collectorname": "recordedBy", "collectingdate": "eventDate", "collectingmethod": "samplingProtocol", "id_gbif_occurrence": "gbifOccurrenceId", "id_gbif_specimen": "gbifSpecimenId"}


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT row_id, '{v}' AS term, {k} AS value FROM materials" for k, v in MATERIAL.items()) + ") WHERE value IS NOT NULL")
def attribute_rename(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "materials").select("row_id", *(F.col(k).alias(v) for k, v in MATERIAL.items()))
    return m.unpivot("row_id", list(MATERIAL.values()), "term", "value").where("value is not null")


DYNAMIC = ("kingdom", "phylum", "class", "order", "family", "genus", "species", "subSpecies")


@query("SELECT name_row_id, CASE taxon_rank " + " ".join(f"WHEN '{k}' THEN {TAXON[k]}" for k in DYNAMIC) + " END AS epithet, coalesce(regexp_matches(CASE taxon_rank " + " ".join(f"WHEN '{k}' THEN {TAXON[k]}" for k in DYNAMIC) + " END, '(?i)^[^A-Za-z0-9_]*(var|subsp|f)[^A-Za-z0-9_]*$'), false) AS mark FROM taxon_names")
def dynamic_attribute(spark: SparkSession, d: str) -> DataFrame:
    attrs = F.create_map(*(x for k in DYNAMIC for x in (F.lit(k), F.col(TAXON[k]))))
    e = F.try_element_at(attrs, F.coalesce("taxon_rank", F.lit("")))
    return table(spark, d, "taxon_names").select("name_row_id", e.alias("epithet"), F.coalesce(e.rlike(T.RANK_MARK), F.lit(False)).alias("mark"))


@query("SELECT name_row_id, coalesce(taxon_status, nullif(ishybrid, 'false'), 'ABSENT') AS status, coalesce(taxon_status, nullif(ishybrid, 'false'), 'ABSENT') NOT IN ('', 'nomen dubium', '(nomen dubium)', 'ABSENT', 'incertae sedis') AS defining FROM taxon_names")
def coalesce_status(spark: SparkSession, d: str) -> DataFrame:
    status = status_of(F.col("taxon_status"), F.nullif("ishybrid", F.lit("false")))
    return table(spark, d, "taxon_names").select("name_row_id", status.alias("status"), is_defining(status).alias("defining"))


def _valid_sql(c: str) -> str:
    n = norm_sql(c)
    return f"({n} <> '' AND (NOT regexp_matches({n}, '[^a-zA-Z.\\-''’]') OR regexp_matches({n}, '(undefined|sp\\.?|species)\\s*-?[0-9]*$')))"


_OWN = "CASE taxon_rank " + " ".join(f"WHEN '{k}' THEN {TAXON[k]}" for k in DYNAMIC) + " END"
_WRONG = lambda n, c: f"'{n} ' || {json_sql(c)} || ' contains invalid characters'"


@query(f"""SELECT name_row_id, CASE WHEN coalesce(taxon_rank, '') = '' THEN 'the rank attribute is missing' ELSE array_to_string(list_filter([
 CASE WHEN NOT {_valid_sql(_OWN)} THEN {_WRONG('sigEpithet', norm_sql(_OWN))} END,
 CASE WHEN taxon_rank IN ('subSpecies', 'variety') AND NOT {_valid_sql('species')} THEN {_WRONG('species', 'species')} END,
 CASE WHEN taxon_rank IN ('subGenus', 'species', 'subSpecies', 'variety') AND NOT {_valid_sql('genus')} THEN {_WRONG('genus', 'genus')} END,
 CASE WHEN taxon_rank IN ('subFamily', 'tribe', 'subTribe') AND NOT {_valid_sql('family')} THEN {_WRONG('family', 'family')} END,
 CASE WHEN taxon_rank = 'subOrder' AND NOT {_valid_sql('order_name')} THEN {_WRONG('order', 'order_name')} END,
 CASE WHEN taxon_rank = 'subClass' AND NOT {_valid_sql('class_name')} THEN {_WRONG('class', 'class_name')} END,
 CASE WHEN taxon_rank = 'subPhylum' AND NOT {_valid_sql('phylum')} THEN {_WRONG('phylum', 'phylum')} END], lambda x: x IS NOT NULL), '; ') END AS errors FROM taxon_names""")
def epithet_check(spark: SparkSession, d: str) -> DataFrame:
    own = F.try_element_at(F.create_map(*(x for k in DYNAMIC for x in (F.lit(k), F.col(TAXON[k])))), F.coalesce("taxon_rank", F.lit("")))
    return table(spark, d, "taxon_names").select("name_row_id", F.array_join(epithet_errors(taxon(), own), "; ").alias("errors"))


@query(f"SELECT name_row_id, {GROUP_SQL.format(p='')} = 'INVALID' OR coalesce(kingdom, '') = '' OR (coalesce(species, '') <> '' AND coalesce(genus, '') = '') AS refused FROM taxon_names")
def citation_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "taxon_names").select("name_row_id", refused(taxon(), T.rank_group(taxon())).alias("refused"))


_STRIPPED = r"regexp_replace(authorityname, '\bin\b[^0-9]*', '')"
_INSIDE = r"coalesce(nullif(regexp_extract(a, '\(.*\)'), ''), nullif(regexp_extract(a, '\(.*$'), ''), nullif(regexp_extract(a, '^.*\)'), ''), '')"
_NAMED = f"""WITH s AS (SELECT name_row_id, authorityname, authorityyear, CASE WHEN {_STRIPPED} = 'L.' THEN 'Linnaeus' ELSE {_STRIPPED} END AS a FROM taxon_names WHERE {present_sql('authorityname')}),
 t AS (SELECT name_row_id, authorityyear, CASE WHEN length(a) >= 2 AND NOT regexp_matches(a, '[a-z]') THEN {title_sql('a')} ELSE a END AS a FROM s), i AS (SELECT *, {_INSIDE} AS inside FROM t),
 r AS (SELECT name_row_id, authorityyear, CASE WHEN regexp_matches(a, '[()]') AND regexp_matches(inside, '[a-zA-Z]') AND inside <> a THEN trim(left(a, instr(a, inside) - 1) || substr(a, instr(a, inside) + length(inside))) ELSE a END AS a FROM i)
 SELECT name_row_id, CASE WHEN authorityyear IS NULL THEN a ELSE a || ', ' || authorityyear END AS full FROM r"""


# authors with words and parts in brackets of every form, made of the fields of each taxon
_WORDED = "concat(coalesce(authorityname, ''), CASE name_row_id % 5 WHEN 0 THEN ' in Smith & al. 1900' WHEN 1 THEN ' (ex Jones)' WHEN 2 THEN ' (not closed' WHEN 3 THEN ' opened) here' ELSE '' END)"


@query(f"""WITH w AS (SELECT name_row_id, {_WORDED} AS w FROM taxon_names), s AS (SELECT name_row_id, w, regexp_replace(w, '\\bin\\b[^0-9]*', '') AS a FROM w), i AS (SELECT name_row_id, w AS a, a AS stripped, {_INSIDE.replace('(a,', '(w,')} AS inside FROM s)
SELECT name_row_id, CASE WHEN stripped = 'L.' THEN 'Linnaeus' ELSE stripped END AS stripped, CASE WHEN regexp_matches(a, '[()]') AND regexp_matches(inside, '[a-zA-Z]') AND inside <> a THEN trim(left(a, instr(a, inside) - 1) || substr(a, instr(a, inside) + length(inside))) ELSE a END AS bare FROM i""")
def authority_parts(spark: SparkSession, d: str) -> DataFrame:
    """Authors without their 'in ...' and without their brackets."""
    w = table(spark, d, "taxon_names").select("name_row_id", F.expr(_WORDED).alias("w"))
    return w.select("name_row_id", T.strip_in(F.col("w")).alias("stripped"), T.remove_bracketed(F.col("w")).alias("bare"))


@query("SELECT n.name_row_id, CASE WHEN coalesce(f.authority, '') = '' THEN 'INVALID' ELSE " + norm_sql("f.authority") + " END AS authority FROM taxon_names n LEFT JOIN (" + AUTHORITY_SQL.format(key="name_row_id", c='"full"', src=f"({_NAMED})").strip() + ") f USING (name_row_id)")
def full_authority(spark: SparkSession, d: str) -> DataFrame:
    """Authorities of all taxa, as cited ones."""
    attrs = {k: F.col(TAXON[k]) for k in ("authorityName", "authorityYear", "kingdom")}
    none = F.lit(None).cast("string")
    return table(spark, d, "taxon_names").select("name_row_id", T.full_authority(attrs, none, none, False).alias("authority"))


@query()
def based_authority(spark: SparkSession, d: str) -> DataFrame:
    """Authorities of all taxa as treated ones, with the family's name as base authority of some and
    the document's author and date; tested against a model."""
    t = table(spark, d, "taxon_names")
    docs = table(spark, d, "treatments").groupBy("docid").agg(F.max("docauthor").alias("author"), F.max("docdate").alias("date"))
    attrs = {k: F.col(TAXON[k]) for k in ("authorityName", "authorityYear", "kingdom")} | {"baseAuthorityName": F.when(F.col("family").isNotNull(), F.col("genus")), "baseAuthorityYear": F.when(F.col("order_name").isNotNull(), F.col("authorityyear"))}
    return t.join(docs, "docid", "left").select("name_row_id", T.full_authority(attrs, F.col("author"), F.col("date"), True).alias("authority"))
