"""Ranked names: the names of a taxon and of all its parents, without recursion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions.text import DEFAULT_HOST, NAME_MARK, RANK_MARK, let, normalize_space, partial_uri, present, remove_punctuation, string_literal, uri
from stemma.sources.tables import cut

# --- fixed values: the ranks in order, and those whose names have several parts -----
RANKS = ("kingdom", "phylum", "subPhylum", "class", "subClass", "order", "subOrder", "superFamily", "family", "subFamily", "tribe", "subTribe", "genus", "subGenus", "section", "subSection", "series", "species", "undef-species", "subSpecies", "variety", "form")
SPECIES_GROUP = ("subGenus", "section", "subSection", "series", "species", "undef-species", "subSpecies", "variety", "form")
# -----------------------------------------------------------------------------------


def attr(name: str, attrs: str = "attrs") -> Column:
    return F.try_element_at(F.col(attrs), F.lit(name))


def present_ranks(attrs: str = "attrs") -> Column:
    """The ranks that a taxon has as attributes, blank ones included, in order."""
    return F.filter(F.array(*map(F.lit, RANKS)), lambda r: F.map_contains_key(F.col(attrs), r))


def base_uri(kind: str, kingdom: Column, host: str) -> Column:
    return F.concat(F.lit(f"http://{kind}.{host}/id/"), kingdom)


def _parts(rank: Column, ranks: Column, attrs: str) -> Column:
    """The words of a name's address at a rank, when only ``ranks`` count."""
    get = lambda n: attr(n, attrs)
    has = lambda n: F.array_contains(ranks, n)
    part = lambda n: F.when(has(n), get(n))
    none = F.lit(None).cast("string")
    names = F.array(get("genus"), F.when(get("isHybrid") == "true", F.lit("x")), F.when(has("species"), get("species")), *(F.when(~has("species"), get(n)).otherwise(none) for n in ("subGenus", "section", "subSection", "series")), *(part(n) for n in ("undef-species", "subSpecies", "variety", "form")))
    return F.filter(names, lambda n: present(n) & ~n.rlike(NAME_MARK))


def name_end(rank: Column, ranks: Column, attrs: str = "attrs") -> Column:
    """The end of a name's address at a rank, when only ``ranks`` count: null where none can be made."""
    several = F.concat(F.lit("/"), partial_uri(F.array_join(F.transform(_parts(rank, ranks, attrs), remove_punctuation), "_")))
    single = remove_punctuation(normalize_space(F.try_element_at(F.col(attrs), rank)))
    one = F.when(present(single), F.concat(F.lit("/"), partial_uri(F.replace(single, F.lit("."), F.lit("")))))
    return F.when(rank == "kingdom", F.lit("")).when(rank.isin(*SPECIES_GROUP), several).otherwise(one)


def punctuated(rank: Column, ranks: Column, attrs: str = "attrs") -> Column:
    """Does a name's address at a rank leave out signs of its words?"""
    changed = lambda x: remove_punctuation(x) != x
    single = normalize_space(F.try_element_at(F.col(attrs), rank))
    return F.coalesce(F.when(rank == "kingdom", F.lit(False)).when(rank.isin(*SPECIES_GROUP), F.exists(_parts(rank, ranks, attrs), changed)).otherwise(changed(single)), F.lit(False))


def name_uri(rank: Column, ranks: Column, attrs: str = "attrs", host: str = DEFAULT_HOST) -> Column:
    """The address of a taxon's name; null where none can be made."""
    kingdom = F.when(present(attr("kingdom", attrs)), partial_uri(attr("kingdom", attrs))).otherwise(F.lit("INVALID"))
    return let(name_end(rank, ranks, attrs), lambda end: F.when(end.isNotNull(), uri(F.concat(base_uri("taxon-name", kingdom, host), end), "_")))


def concept_uri(authority: Column, attrs: str = "attrs", host: str = DEFAULT_HOST) -> Column:
    """The address of a taxon's concept after an authority in its short form."""
    kingdom = F.when(present(attr("kingdom", attrs)), attr("kingdom", attrs)).otherwise(F.lit("INVALID"))
    return let(name_end(attr("rank", attrs), present_ranks(attrs), attrs), lambda end: F.when(end.isNotNull(), uri(F.concat(base_uri("taxon-concept", kingdom, host), end, authority))))


def levels(taxa: DataFrame, attrs: str = "attrs", host: str = DEFAULT_HOST) -> DataFrame:
    """One row per taxon and level: level 0 is the taxon's own name, each further one its parent's.

    Adds level, name_uri, level_rank (the rank written), parent_uri (null: none) and
    dead_end (the parent can't be told). Levels come from one posexplode of the valid
    ranks; a level whose address can't be made has a null name_uri.
    """
    all_ranks = present_ranks(attrs)
    own = attr("rank", attrs)
    with_own = F.when(own.isNotNull() & ~F.array_contains(all_ranks, own), F.concat(all_ranks, F.array(own))).otherwise(all_ranks)
    valid = lambda rs: F.filter(rs, lambda r: present(F.try_element_at(F.col(attrs), r)) & ~F.trim(F.try_element_at(F.col(attrs), r)).rlike(RANK_MARK))
    t = taxa.withColumn("_r", all_ranks).withColumn("_v", valid(with_own))
    n = F.size("_v")
    # limits: none for the own name, then the valid ranks from the lowest to the second, and the first if it isn't the kingdom
    upward = F.reverse(F.slice("_v", 2, F.greatest(n - 1, F.lit(0))))
    dead = F.when((n > 0) & (F.get("_v", F.lit(0)) != "kingdom"), F.slice("_v", 1, 1)).otherwise(F.array().cast("array<string>"))
    t = t.withColumn("_lims", F.concat(F.array(F.lit(None).cast("string")), upward, dead)).select("*", F.posexplode("_lims").alias("level", "_lim"))
    at = F.array_position("_r", F.col("_lim")).cast("int")
    below = F.when(at > 1, F.slice("_r", F.lit(1), F.greatest(at - 1, F.lit(0)))).otherwise(F.col("_r"))
    t = t.withColumn("_below", F.when(F.col("_lim").isNull(), F.col("_r")).otherwise(below))
    rank = F.when(F.col("_lim").isNotNull() & (at > 1), F.element_at("_below", -1)).otherwise(own)
    t = t.withColumn("name_uri", name_uri(rank, F.col("_below"), attrs, host)).withColumn("punctuated", punctuated(rank, F.col("_below"), attrs))
    t = t.withColumn("level_rank", F.get("_v", n - 1 - F.col("level")))
    ends = F.size("_lims") - 1
    t = t.withColumn("dead_end", (F.col("level") == ends) & ~F.coalesce(F.col("level_rank") == "kingdom", F.lit(False)))
    return t


def with_parents(leveled: DataFrame, key: list[str]) -> DataFrame:
    """Adds parent_uri: the next level's name, unless it is the name itself."""
    from pyspark.sql import Window

    ahead = F.lead("name_uri").over(Window.partitionBy(*key).orderBy("level"))
    return leveled.withColumn("_next", ahead).withColumn("parent_uri", F.when(F.col("_next") != F.col("name_uri"), F.col("_next"))).drop("_next")


def name_statements(leveled: DataFrame) -> DataFrame:
    """Adds props: the (predicate, object) pairs that a level states of its name."""
    lit = lambda r: string_literal(normalize_space(F.try_element_at(F.col("attrs"), r)))
    pair = lambda p, o: F.struct(p.alias("predicate"), o.alias("object"))
    own = F.transform("_v", lambda r: pair(F.concat(F.lit("dwc:"), r), lit(r)))
    short = F.transform(F.filter("_v", lambda r: F.contains(F.try_element_at(F.col("attrs"), r), F.lit("."))), lambda r: pair(F.lit("# Warning:"), F.concat(F.lit("abbreviated "), r, F.lit(" "), string_literal(F.trim(F.try_element_at(F.col("attrs"), r))))))
    ignored = F.transform(F.filter(F.map_keys("attrs"), lambda k: (F.array_contains("_r", k) | (k == attr("rank"))) & F.trim(F.try_element_at(F.col("attrs"), k)).rlike(RANK_MARK)), lambda r: pair(F.lit("# Warning:"), F.concat(F.lit("ignoring "), r, F.lit(" "), string_literal(F.trim(F.try_element_at(F.col("attrs"), r))))))
    above = F.array(*(F.when(F.array_contains(F.slice("_v", F.lit(1), F.greatest(F.size("_v") - F.col("level"), F.lit(0))), r), pair(F.lit(f"dwc:{r}"), lit(F.lit(r)))) for r in ("genus", "kingdom")), F.when(F.col("level_rank").isNotNull(), pair(F.concat(F.lit("dwc:"), F.col("level_rank")), lit(F.col("level_rank")))))
    always = F.array(F.when(F.col("level_rank").isNotNull(), pair(F.lit("dwc:rank"), string_literal(F.col("level_rank")))), F.when(F.col("parent_uri").isNotNull(), pair(F.lit("trt:hasParentName"), F.col("parent_uri"))), F.when(F.col("dead_end"), pair(F.lit("# Warning:"), F.lit("Could not determine parent name"))), pair(F.lit("a"), F.lit("dwcFP:TaxonName")))
    return leveled.withColumn("props", F.array_compact(F.concat(F.when(F.col("level") == 0, F.concat(own, short, ignored)).otherwise(above), always)))


def ancestors(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(node, ancestor, distance): all ancestors of each node of an adjacency list, the nearest
    way counting.

    One join per level, each level written to the shared folder, until a level adds nothing; no
    bound on levels or rows. Null ends are left out, repeated edges count once; on a circle each
    node is its own ancestor at last.
    """
    one = cut(edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull()).select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).distinct())
    step = one.select(F.col("node").alias("_a"), F.col("ancestor").alias("_up"))
    last = known = one.withColumn("distance", F.lit(1))
    while last.limit(1).count():
        up = last.join(step, last["ancestor"] == step["_a"]).select("node", F.col("_up").alias("ancestor"), (F.col("distance") + 1).alias("distance")).distinct()
        last = cut(up.join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti"))
        known = known.unionByName(last)
    return known
