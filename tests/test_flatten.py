import json

from stemma.operators.flatten import flatten_records

XML = """<document docId=" D1 "><treatment><subSubSection type="nomenclature"><taxonomicName rank="genus"/><taxonomicName rank="x"/></subSubSection>
<subSubSection type="materials_examined"><materialsCitation specimenCode="A &amp; B"/><!-- <materialsCitation specimenCode="OLD"/> --><materialsCitation specimenCode="  "/></subSubSection>
<subSubSection type="multiple"><treatment><subSubSection type="materials_examined"><materialsCitation specimenCode="C"/></subSubSection></treatment>
<treatment><subSubSection type="nomenclature"><paragraph><taxonomicName/></paragraph></subSubSection><materialsCitation specimenCode="E"/></treatment></subSubSection></treatment>
<materialsCitation specimenCode="F"/></document>"""
JSON = {"document": {"treatment": {"materials_examined": {"paragraph": [{"materialsCitation": {"specimenCode": 7}}, {"materialsCitation": [{"@attributes": {"specimenCode": " G "}}, None]}]}, "nomenclature": {"taxonomicName": {"@attributes": {"rank": " species "}}}}, "@attributes": {"docId": "D2"}}}


def found(spark, rows, which="materials"):
    df = spark.createDataFrame(rows, "raw_id long, payload_form string, payload string, received_ts string")
    return sorted(map(tuple, flatten_records(df, which).collect()))


def test_xml_keeps_parents_and_positions(spark):
    got = found(spark, [(1, "xml", XML, None)])
    assert got == [(1, "D1", 1, 1, 1, "genus", "A & B"), (1, "D1", 2, 1, 1, "genus", ""), (1, "D1", 3, 2, 1, "genus", "C"), (1, "D1", 4, 3, 3, "", "E"), (1, "D1", 5, 0, 0, "", "F")]
    assert found(spark, [(1, "xml", XML, None)], "treatments") == [(1, 1, 0, 1, "genus"), (1, 2, 1, 0, ""), (1, 3, 1, 3, "")]
    assert [r[1] for r in found(spark, [(1, "xml", XML, None)], "taxa")] == [1, 2, 3]


def test_json_in_written_order(spark):
    assert found(spark, [(2, "json", json.dumps(JSON), None)]) == [(2, "D2", 1, 1, 1, "species", "7"), (2, "D2", 2, 1, 1, "species", "G")]


def test_what_is_no_document_has_no_rows(spark):
    bad = [None, "", "  ", "<document", "<a><document docId='1'><materialsCitation specimenCode='x'/></document></a>", "{}", '{"document": 1}', '{"document": {"docId": "a"}', "[1]", '"document"', '{"document": NaN}']
    assert found(spark, [(k, "json" if t and t[:1] in '{["' else "xml", t, None) for k, t in enumerate(bad)]) == []
    assert found(spark, []) == []


def test_broken_payloads_leave_their_neighbours_alone(spark):
    rows = [(1, "xml", XML[:-5], None), (2, "json", json.dumps(JSON), None), (3, "xml", XML, None), (3, "xml", XML, None)]
    assert [r[0] for r in found(spark, rows)] == [2, 2] + [3] * 10


def test_one_reading_gives_all_tables(spark):
    from stemma.operators.flatten import SCHEMAS, flatten_all
    from stemma.sources.tables import table

    df = table(spark, "/root/testdata/sf0.001", "raw_records")
    rows = lambda x: sorted(map(repr, x.collect()))
    every = flatten_all(df)
    for part in SCHEMAS:
        assert rows(every[part]) == rows(flatten_records(df, part)) and every[part].columns == flatten_records(df, part).columns
    assert every["materials"].count() > 0 and flatten_all(df.where("false"))["taxa"].count() == 0
