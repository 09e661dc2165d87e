import math
import random

import pytest

from stemma.operators.components import components
from stemma.operators.pairs import pairs_within
from stemma.operators.spatial import cover, near_pairs, points_in_regions, rings

R = 6_371_000.0


def metres(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((p - q) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(a[0] - b[0]) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(h))


@pytest.mark.parametrize("hot", [2_000, 5])
def test_near_pairs_against_brute_force(spark, hot):
    rng = random.Random(3)
    pts = [(rng.uniform(-180, 180), rng.uniform(-89, 89)) for _ in range(40)]
    for lon, lat in list(pts):
        for _ in range(5):
            pts.append((lon + rng.uniform(-0.02, 0.02) / max(0.02, math.cos(math.radians(lat))), lat + rng.uniform(-0.008, 0.008)))
    pts += [(180.0, 10.0), (-180.0, 10.001), (179.999, 10.0), (0.0, 90.0), (100.0, 89.9999), (-100.0, 89.9999), (0.0, -90.0), (5.0, -89.9999)] + [(20.0, 20.0)] * 30
    pts = [((x + 180) % 360 - 180, y) for x, y in pts]
    want = {(i, j) for i in range(len(pts)) for j in range(i + 1, len(pts)) if metres(pts[i], pts[j]) <= 500}
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)] + [(999, None, 1.0)], "point_id long, lon double, lat double")
    got = [tuple(r) for r in near_pairs(df, 500.0, hot).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want


def test_regions_with_holes_against_brute_force(spark):
    areas = [(1, "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (3 3, 6 3, 6 6, 3 6, 3 3))"), (2, "MULTIPOLYGON (((5 5, 30 7, 12 25, 5 5)), ((-3 -3, -1 -3, -2 -1, -3 -3)))"), (3, None), (4, "broken"), (5, "POLYGON ((0.1 0.1, 0.2 0.1, 0.15 0.2, 0.1 0.1))")]
    rng = random.Random(5)
    pts = [(rng.uniform(-5, 32), rng.uniform(-5, 27)) for _ in range(3000)] + [(rng.uniform(0, 0.3), rng.uniform(0, 0.3)) for _ in range(300)]

    def inside(x, y, wkt):
        hit = False
        for ring in rings(wkt):
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    hit = not hit
        return hit

    want = {(i, a) for i, (x, y) in enumerate(pts) for a, w in areas if inside(x, y, w)}
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)] + [(9999, None, None)], "point_id long, lon double, lat double")
    got = [tuple(r) for r in points_in_regions(df, spark.createDataFrame(areas, "area_id long, outline string")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert any(c[3] for c in cover(areas[1][1])) and any(not c[3] for c in cover(areas[1][1]))


def test_detailed_coasts_have_small_cells(spark):
    rng = random.Random(6)
    ring = [(7.3 + (1.0 + 0.2 * math.sin(40 * a) + rng.uniform(0, 0.02)) * math.cos(a), 2.1 + (0.8 + 0.1 * math.cos(25 * a)) * math.sin(a)) for a in (2 * math.pi * k / 4000 for k in range(4000))]
    box = [(6.0, 1.0), (8.0, 1.0), (8.0, 3.0), (6.0, 3.0)]  # along the borders of cells
    text = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")"
    areas = [(1, f"POLYGON ({text(ring)})"), (2, f"POLYGON ({text(box)}, {text([(7 + (x - 7) / 9, 2 + (y - 2) / 9) for x, y in box])})")]
    cells = [c for _, w in areas for c in cover(w)]
    border = [len(c[5]) for c in cells if not c[3]]
    assert max(border) <= 24 and max(c[0] for c in cells) > 2 and sum(border) < 6 * 4000
    pts = [(rng.uniform(5.9, 8.9), rng.uniform(0.9, 3.3)) for _ in range(4000)]
    hit = lambda x, y, w: sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for r in rings(w) for (x1, y1), (x2, y2) in zip(r, r[1:])) % 2
    want = {(i, a) for i, (x, y) in enumerate(pts) for a, w in areas if hit(x, y, w)}
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "point_id long, lon double, lat double")
    got = [tuple(r) for r in points_in_regions(df, spark.createDataFrame(areas, "area_id long, outline string")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "point_id long, lon double, lat double")
    assert near_pairs(none, 500.0).count() == 0
    assert points_in_regions(none, spark.createDataFrame([], "area_id long, outline string")).count() == 0


def test_components_and_pairs(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (5, 5), (None, 1)] + [(k, k + 1) for k in range(20, 50)]
    nodes = spark.createDataFrame([(k,) for k in [*range(1, 10), *range(20, 51), None]], "node long")
    got = dict(map(tuple, components(nodes, spark.createDataFrame(links, "a long, b long")).collect()))
    assert got[4] == 1 and got[9] == 8 and got[5] == 5 and got[50] == 20 and got[7] == 7
    groups = [(i, "hot" if i < 30 else f"g{i % 3}") for i in range(40)] + [(99, None)]
    rows = pairs_within(spark.createDataFrame(groups, "k long, g string"), "g", "k", hot_rows=7).collect()
    want = {(a, b) for a, g in groups for b, h in groups if a < b and g == h and g}
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want
