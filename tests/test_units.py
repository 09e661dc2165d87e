import pytest
from pyspark.sql import functions as F

from stemma.functions.units import read_measure, segmentations
from stemma.operators.units import measures, rounded_measures

CASES = [
    ("49d22m0s S", "latitude", None, None, -(49 + 22 / 60)), ("36.5100 gon N", "latitude", "degree", ",", 32.859), ("0Â°50'59\"S", "latitude", None, None, -(50 / 60 + 59 / 3600)),
    ("23°31'10''east", "longitude", None, None, 23 + 31 / 60 + 10 / 3600), ("-47479934", "latitude", "microdegree", None, -47.479934), ("169,3436", "longitude", "gon", ",", 169.3436 * 0.9),
    ("493122N", "latitude", "microdegree", None, 49 + 31 / 60 + 22 / 3600), ("0101604E", "longitude", None, None, 10 + 16 / 60 + 4 / 3600), ("46.621 N", "latitude", "gon", None, 46.621), ("44 1 47 s", "latitude", None, None, -(44 + 1 / 60 + 47 / 3600)),
    ("N58-26-27", "latitude", None, None, 58 + 26 / 60 + 27 / 3600), ("S 1°14’45,6”", "latitude", None, None, -1.246), ("27.2721 gr. S", "latitude", None, None, -27.2721 * 0.9), ("-34:56:54", "longitude", None, None, -(34 + 56 / 60 + 54 / 3600)),
    ("26°89'N", "latitude", None, None, None), ("95.5", "latitude", None, None, None), ("181 E", "longitude", None, None, None), ("see label", "latitude", None, None, None), (" ", "latitude", None, None, None), (None, "latitude", None, None, None),
    ("41 m (134 ft)", "elevation", "foot", ".", 41), ("1.263km", "elevation", None, ".", 1263), ("2,489 km", "elevation", None, ",", 2489), ("449 Fuß", "elevation", None, ".", 449 * 0.3048), ("49 yd", "elevation", None, ".", 49 * 0.9144), ("230'", "elevation", None, ".", 230 * 0.3048),
    ("409 - 429 m", "elevation", "foot", ".", 419), ("38 to 338 m", "elevation", None, None, 188), ("3156ft-3656ft", "elevation", None, None, 3406 * 0.3048), ("ca. 454 m", "elevation", None, None, 454), ("1741 m ü. M.", "elevation", None, None, 1741), ("1,398", "elevation", "foot", ".", 1398 * 0.3048),
    ("1.398", "elevation", "metre", ",", 1398), ("1518,7", "elevation", "metre", ",", 1518.7), ("-9999", "elevation", None, None, None), ("9500 m", "elevation", None, None, None), ("-12 m", "elevation", None, None, -12),
]


@pytest.mark.parametrize("text,field,unit,mark,want", CASES)
def test_read_measure(text, field, unit, mark, want):
    got = read_measure(text, field, unit, mark)
    assert got is None if want is None else got == pytest.approx(want)


def test_field_priors_decide_ambiguous_units():
    assert segmentations("m", "elevation")[0][1][0].dimension == "length"
    assert segmentations("m", "latitude")[0][1][0].dimension == "minute"
    assert segmentations("km", "elevation")[0][1][0].factor == 1000


def test_operator_agrees_with_reader_and_handles_nulls(spark):
    rows = [(k, t if f == "latitude" else None, t if f == "longitude" else None, t if f == "elevation" else None, f"p{k}", None) for k, (t, f, *_) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "row_id long, latitude string, longitude string, elevation string, provider_code string, text string")
    units = [(f"p{k}", u if f != "elevation" else None, u if f == "elevation" else None, m) for k, (_, f, u, m, _) in enumerate(CASES)]
    providers = spark.createDataFrame(units + units[:2], "provider_code string, coord_unit string, elevation_unit string, decimal_mark string")
    got = {(r.row_id, r.quantity): r.value for r in measures(df, providers, "row_id").collect()}
    want = {(k, f): v for k, (_, f, _, _, v) in enumerate(CASES) if v is not None}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])
    assert rounded_measures(measures(df, providers, "row_id")).where("quantity = 'elevation' and row_id = 20").first().unit_value == 41


def test_empty_tables_and_repeated_rows(spark):
    schema = "row_id long, latitude string, longitude string, elevation string, provider_code string"
    none = spark.createDataFrame([], "provider_code string, coord_unit string, elevation_unit string, decimal_mark string")
    assert measures(spark.createDataFrame([], schema), none, "row_id").count() == 0
    twice = spark.createDataFrame([(1, "1.5", None, None, None)] * 2, schema)
    assert [r.value for r in measures(twice, none, "row_id").collect()] == [1.5, 1.5]
    assert measures(twice.withColumn("text", F.lit("x")).withColumn("_m", F.lit(",")), none, "row_id").count() == 2
