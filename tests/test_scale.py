"""What the plans promise: shuffles, joins, pruning, skew."""

import numpy as np
from pyspark.sql import functions as F

from __spark_entry__ import queries
from marshlight.operators import keys as K
from marshlight.operators import spatial as P
from marshlight.plans import outliers

SF = "/root/testdata/sf0.001"
ALL = queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_outliers_shuffle_twice_whatever_the_number_of_indicators(spark):
    cols = [f"I{i}" for i in range(8)]
    schema = ("PERIOD int, YEAR int, MONTH int, ADM1_ID string, ADM2_ID string, OU_ID string, ADM1_NAME string, "
              "ADM2_NAME string, OU_NAME string" + "".join(f", {c} double" for c in cols))
    df = spark.createDataFrame([], schema)
    for out in (outliers.run(df, cols, "IQR").imputed, outliers.run_staged(df, cols).imputed):
        assert plan(out).count("Exchange hashpartitioning") == 2


def test_staged_complete_is_dealt_by_facility_once_more_after_the_cleaning(spark):
    schema = ("PERIOD int, YEAR int, MONTH int, ADM1_ID string, ADM2_ID string, OU_ID string, ADM1_NAME string, "
              "ADM2_NAME string, OU_NAME string, CONF double")
    out = outliers.run_staged(spark.createDataFrame([], schema), ["CONF"], complete=True).imputed
    assert plan(out).count("Exchange hashpartitioning") == 3


def test_columns_reach_the_scan(spark):
    text = plan(ALL["D51_national_months"](spark, SF))
    line = next(x for x in text.splitlines() if "lineitem" in x and "ReadSchema" in x)
    assert "l_tax" not in line and "l_comment" not in line


def test_first_per_key_combines_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    text = plan(K.first_per_key(df, ["k"], ["v"]))
    assert "partial_min_by" in text
    assert K.first_per_key(df, ["k"], ["v"]).first().v == 0


def test_hot_facility_with_many_copies(spark):
    """A third of all rows are copies of one facility's months."""
    base = spark.range(60).select((F.col("id") % 20).alias("f"), (F.lit(200001) + F.col("id") % 12).cast("int").alias("PERIOD"))
    hot = spark.range(20000).select(F.lit(0).cast("bigint").alias("f"), (F.lit(200001) + F.col("id") % 12).cast("int").alias("PERIOD"))
    df = base.unionByName(hot).select(
        "PERIOD", (F.col("PERIOD") / 100).cast("int").alias("YEAR"), (F.col("PERIOD") % 100).alias("MONTH"),
        F.lit("R").alias("ADM1_ID"), F.lit("D").alias("ADM2_ID"), F.concat(F.lit("F"), "f").alias("OU_ID"),
        F.lit("r").alias("ADM1_NAME"), F.lit("d").alias("ADM2_NAME"), F.lit("u").alias("OU_NAME"),
        (F.col("f") + F.col("PERIOD") % 7).cast("double").alias("CONF"))
    out = outliers.run(df, ["CONF"], "IQR").imputed
    assert out.count() == df.select("OU_ID", "PERIOD").distinct().count()


def test_points_match_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-1, 6, (400, 2)).round(2))]
    rings = {"A": [(0, 0), (4, 0), (4, 4), (0, 4)], "B": [(4, 0), (5, 2), (4, 4)]}
    hole = [(1, 1), (2, 1), (2, 2), (1, 2)]
    edges = []
    for name, ring in [*rings.items(), ("A", hole)]:
        edges += [(name, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(ring, ring[1:] + ring[:1])]
    p = spark.createDataFrame(pts, "id int, LONGITUDE double, LATITUDE double")
    e = spark.createDataFrame(edges, "ADM2_ID string, x1 double, y1 double, x2 double, y2 double")
    got = {(r.id, r.ADM2_ID) for r in P.all_shapes(p, e, ["ADM2_ID"], 0.7).collect()}

    def within(x, y, name):
        odd = False
        for n, x1, y1, x2, y2 in edges:
            if n != name:
                continue
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    assert got == {(i, n) for i, x, y in pts for n in rings if within(x, y, n)}


def test_distance_matches_brute_force_near_the_pole(spark):
    import math

    import numpy as np

    rng = np.random.default_rng(2)
    cells = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(rng.uniform(10, 12, 300), rng.uniform(79, 81, 300)))]
    sites = [(float(x), float(y)) for x, y in zip(rng.uniform(10, 12, 20), rng.uniform(79, 81, 20))]
    c = spark.createDataFrame(cells, "id int, lon double, lat double")
    f = spark.createDataFrame(sites + sites[:3], "LONGITUDE double, LATITUDE double")

    def km(x1, y1, x2, y2):
        a = math.sin(math.radians(y2 - y1) / 2) ** 2 + math.cos(math.radians(y1)) * math.cos(math.radians(y2)) * math.sin(
            math.radians(x2 - x1) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(a))

    want = {i for i, x, y in cells if any(km(x, y, a, b) <= 5 for a, b in sites)}
    assert {r.id for r in P.within_distance(c, f, 5.0).collect()} == want and want


def test_distance_join_at_the_date_line_and_a_pole(spark):
    cells = [(0, -179.99, 10.0), (1, 179.97, 10.01), (2, -179.9, 10.0), (3, 170.0, 89.99), (4, -10.0, 89.98), (5, 0.0, 89.9), (6, 0.0, 10.0)]
    sites = [(179.99, 10.0), (20.0, 89.985)]
    c = spark.createDataFrame(cells, "id int, lon double, lat double")
    f = spark.createDataFrame(sites, "LONGITUDE double, LATITUDE double")
    assert {r.id for r in P.within_distance(c, f, 5.0).collect()} == {0, 1, 3, 4}


def _ring(n, cx, cy, radius, wave):
    angle = np.arange(n) / n * 2 * np.pi
    r = radius * (1 + wave * np.sin(angle * 37))
    x, y = cx + r * np.cos(angle), cy + r * np.sin(angle)
    return list(zip(x, y, np.roll(x, -1), np.roll(y, -1)))


def test_squares_of_a_polygon_of_many_vertices_stay_small_and_answer_alike(spark):
    rings = {"A": _ring(100_000, 5.0, 5.0, 4.0, 0.2), "B": _ring(40, 7.0, 6.0, 2.0, 0.0), "C": [(1, 1, 1, 3), (1, 3, 3, 3), (3, 3, 3, 1), (3, 1, 1, 1)]}
    rows = [(k, i, *map(float, e)) for k, ring in rings.items() for i, e in enumerate(ring)]
    edges = spark.createDataFrame(rows, "id string, seq int, x1 double, y1 double, x2 double, y2 double")
    sizes = P.shape_index(edges, ["id"], 0.5).select(F.explode("shapes").alias("s")).select(F.size("s.edges").alias("n"), "s.odd")
    assert sizes.agg(F.max("n")).first()[0] < 5_000  # all 100 000 were in every square of a band before
    assert sizes.where("n = 0 and odd").count() > 50  # squares wholly inside carry no edge

    rng = np.random.default_rng(8)
    corners = [(float(x), float(y)) for x in np.arange(0, 5, 0.5) for y in np.arange(0, 5, 0.5)]  # on lines of squares and on edges
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate([*rng.uniform(0, 10, (400, 2)), *corners])]
    found = P.locate(spark.createDataFrame(points, "i int, LONGITUDE double, LATITUDE double"), edges, ["id"], 0.5)
    got = {r["i"]: [s["id"] for s in r["found"]] for r in found.collect()}
    for i, x, y in points:
        want = []
        for k, ring in rings.items():
            e = np.array(ring, dtype=float)
            spans = (e[:, 1] > y) != (e[:, 3] > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0]
            on = ((e[:, 2] - e[:, 0]) * (y - e[:, 1]) == (e[:, 3] - e[:, 1]) * (x - e[:, 0])) & (
                np.minimum(e[:, 0], e[:, 2]) <= x) & (x <= np.maximum(e[:, 0], e[:, 2])) & (np.minimum(e[:, 1], e[:, 3]) <= y) & (y <= np.maximum(e[:, 1], e[:, 3]))
            if (spans & (x < at)).sum() % 2 and not on.any():
                want.append(k)
        assert got[i] == want, (x, y)
