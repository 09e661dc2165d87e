"""Change sets from a folder of XML files to a folder of Turtle files."""

import pytest

from stemma.__main__ import main
from stemma.plans.jobs import Job, changed_paths, message, run
from stemma.sinks.files import read_status
from stemma.sources.files import read_documents
from stemma.sources.tables import broadcast_checked

PAGE = '<document docId="{id}" docTitle="{t}"><treatment><subSubSection type="nomenclature"><taxonomicName kingdom="Animalia" genus="Bus" rank="genus" authorityName="Smith" authorityYear="1900"/></subSubSection></treatment></document>'


@pytest.fixture
def folders(tmp_path):
    source, target = tmp_path / "source", tmp_path / "target"
    for path, text in {"data/a/one.xml": PAGE.format(id="A1", t="first"), "data/b/two.xml": PAGE.format(id="B2", t="second"), "data/b/bad.xml": "<document>", "data/b/note.txt": "no", "data/empty.xml": ""}.items():
        (source / path).parent.mkdir(parents=True, exist_ok=True)
        (source / path).write_text(text)
    return source, target


def test_added_modified_and_removed_files(spark, folders):
    source, target = folders
    made = run(spark, Job("j1", {"added": ["data/a/one.xml", "data/b/two.xml", "data/b/bad.xml", "data/b/note.txt", "data/none.xml"], "modified": ["/data/empty.xml"], "removed": ["data/never.xml"]}), str(source), str(target))
    assert made == {"files": 7, "written": 4, "removed": 0, "message": f"stemma j1 ({source})"}
    assert 'dc:title "first"' in (target / "data/a/one.ttl").read_text() and (target / "data/b/bad.ttl").read_text().endswith("missing <document>")
    assert sorted(p.name for p in target.rglob("*.ttl")) == ["bad.ttl", "empty.ttl", "one.ttl", "two.ttl"] and not list((target / "_staging").rglob("*-*"))
    status = lambda: {r.doc_path: r.status for r in read_status(spark, str(target)).collect()}
    assert status() == {"data/a/one.xml": 0, "data/b/two.xml": 0, "data/b/bad.xml": 3, "data/empty.xml": 3}
    (source / "data/a/one.xml").write_text(PAGE.format(id="A1", t="third"))
    (source / "data/b/two.xml").unlink()
    feed = spark.createDataFrame([("data/a/one.xml", "added", 1), ("data/b/two.xml", "added", 2), ("data/a/one.xml", "modified", 5), ("data/b/two.xml", "removed", 7), ("data/b/bad.xml", "modified", 99)], "doc_path string, change_op string, seq long")
    job = Job("j2", start=3, till=50)
    assert run(spark, job, str(source), str(target), feed) == {"files": 2, "written": 1, "removed": 1, "message": f"stemma {source}@7"} and (job.start, job.till) == (5, 7)
    assert 'dc:title "third"' in (target / "data/a/one.ttl").read_text() and not (target / "data/b/two.ttl").exists()
    assert status()["data/a/one.xml"] == 0 and status()["data/b/two.xml"] == 0 and len(status()) == 4
    lines = "".join(p.read_text() for p in sorted((target / "_status/v1").glob("part-*"))).splitlines()
    assert lines[:4] == ["/data/a/one.xml: 0", "/data/b/bad.xml: 3", "/data/b/two.xml: 0", "/data/empty.xml: 3"] and set(lines[4:]) == {":successful: 2", ":failed: 2"}
    again = run(spark, Job("j3", start=3, till=50), str(source), str(target), feed)
    assert (again["written"], again["removed"]) == (1, 0)


def test_a_job_needs_its_files(spark):
    with pytest.raises(ValueError):
        changed_paths(spark, Job("x"))
    rows = changed_paths(spark, Job("x", {"modified": ["a.xml"], "removed": ["b.xml"]})).collect()
    assert [tuple(r) for r in rows] == [("a.xml", False)]
    assert message(Job("x", till=4), "s") == "stemma s@4" and changed_paths(spark, Job("x", {"modified": []})).count() == 0


def test_command_line(spark, folders):
    source, target = folders
    assert main([str(source), "-o", str(target), "--host", "names.test"]) == 1
    assert "<http://taxon-concept.names.test/id/Animalia/Bus_Smith_1900>" in (target / "data/a/one.ttl").read_text()
    assert main([str(source / "data/a/one.xml"), "-o", str(target / "single")]) == 0 and (target / "single/one.ttl").exists()
    assert read_documents(spark, str(source), spark.createDataFrame([("/data/a/one.xml",), (None,)], "doc_path string")).count() == 1


def test_broadcasts_are_measured(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower() or "ResolvedHint" in df._jdf.queryExecution().logical().toString()
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) as t", "array(id) as a")
    assert hinted(broadcast_checked(df)) and not hinted(broadcast_checked(df, limit=99)) and not hinted(broadcast_checked(df, most_bytes=50_000))
    assert hinted(broadcast_checked(df.where("false")))
