from stemma.llm.canonical import canonicalise, common_words, core
from stemma.llm.edits import deletes, skeleton, weighted_distance

REFS = [
    ("c", 1, "Meduwostan", [], ["TV", "TVO"]), ("c", 2, "Sestegiuna", ["Loustaiavia"], ["ST", "STA"]), ("c", 3, "North Lubamiuna", None, ["LB", "LBN"]), ("c", 4, "South Lubamiuna", [], ["LA", None]),
    ("c", 5, "Republic of Zimusteel", [], []), ("c", 6, "Saint Lumugeavia", [], []), ("c", 7, "Goutotaland Islands", [], []), ("c", 8, "United Provinces of Nofubruin", [], []), ("r", 1, "class", ["classis", "Klasse"], []), ("r", 2, "subSpecies", ["ssp.", "subsp."], []), ("r", 3, "form", ["forma", "f."], []),
]
CASES = {
    ("c", "Meduwostan"): 1, ("c", "MEDUWOSTAN?"): 1, ("c", "meduwotsan"): 1, ("c", "M E D U W O S T A N"): 1, ("c", "MeduwÃ¶stan"): 1, ("c", "Meduwostan [TVO]"): 1, ("c", "tvo"): 1, ("c", "T.V."): 1, ("c", "The Meduwostan"): 1, ("c", "Rep. of Meduwostan"): 1,
    ("c", "LOUSTAAVIA"): 2, ("c", "Lubamiuna"): -1, ("c", "S. Lubamiuna"): 4, ("c", "southern Lubamiuna"): 4, ("c", "Lubamiuna (North)"): 3, ("c", "north lubbamiuna"): 3, ("c", "Kingdom of Zimusteel"): 5, ("c", "St. Lumugeavia"): 6, ("c", "Lumugeavja"): 6, ("c", "Goutotaland"): 7, ("c", "United Provinces of Nofruuin"): 8,
    ("c", "Meduwostan / Sestegiuna"): -1, ("c", "Meduwostan / MEDUWOSTAN"): 1, ("c", "High Seas"): -1, ("c", "?"): -1, ("c", "TVP"): -1, ("r", "Klase"): 1, ("r", "clade"): -1, ("r", "sub-species"): 2, ("r", "SSP"): 2, ("r", "F."): 3, ("r", "0"): -1,
}


def test_values_map_to_entries(spark):
    refs = spark.createDataFrame(REFS, "field_name string, ref_id long, name string, others array<string>, codes array<string>")
    rows = [(f, k, v, "x") for k, (f, v) in enumerate(CASES)] + [("c", 900, None, "x"), ("c", 901, " ", "x"), ("c", 902, "tvo", "x")]
    got = {r.row_key: r.ref_id for r in canonicalise(spark.createDataFrame(rows, "field_name string, row_key long, value string, key string"), refs).collect()}
    assert {c: got[k] for k, c in enumerate(CASES)} == CASES
    assert 900 not in got and 901 not in got and got[902] == 1


def test_empty_tables(spark):
    refs = spark.createDataFrame([], "field_name string, ref_id long, name string, others array<string>, codes array<string>")
    rows = spark.createDataFrame([("c", 1, "x")], "field_name string, row_key long, value string")
    assert [r.ref_id for r in canonicalise(rows, refs).collect()] == [-1]
    assert canonicalise(rows.limit(0), refs).count() == 0


def test_distances_and_deletes():
    assert deletes("abc", 1) == {"abc", "ab", "ac", "bc"}
    assert weighted_distance("abcd", "abdc") < 1 and weighted_distance("abc", "abc") == 0 and weighted_distance("0a", "oa") == 0.5
    assert skeleton("Huza0ra") == "huzaora" and core("United Provinces of Stenoia") == "Stenoia" and core("Mokolastan Republic") == "Mokolastan"


def test_whole_values_come_before_their_parts(spark):
    refs = spark.createDataFrame([("c", 1, "Bosnia and Herzegovina", [], ["BA"]), ("c", 2, "Saint Livufoia", [], []), ("c", 3, "Saint Mupistaimark", [], []), ("c", 4, "Meduwostan", [], [])], "field_name string, ref_id long, name string, others array<string>, codes array<string>")
    cases = {"Bosnia and Herzegovina": 1, "Bosnia and Hercegovina": 1, "Saint": -1, "S. Livufoia": 2, "Saint Livufoia / Meduwostan": -1, "Kingdom of Saint Livufoia": 2}
    rows = spark.createDataFrame([("c", k, v) for k, v in enumerate(cases)], "field_name string, row_key long, value string")
    got = {list(cases)[r.row_key]: r.ref_id for r in canonicalise(rows, refs).collect()}
    assert common_words(refs) == {"c": {"saint"}} and got == cases
