import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import dates, geo, parse, text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items()) or "x string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(("given", "want"), [("", 0.0), (" 7.5 ", 7.5), (None, None), ("x", None), ("NaN", None)])
def test_js_number(spark, given, want):
    assert one(spark, parse.js_number(F.col("c")), c=given) == want


@pytest.mark.parametrize(("given", "want"), [("-9999.0", None), ("NULL", None), ("nan", None), ("3", 3.0), ("", None)])
def test_sentinels(spark, given, want):
    assert one(spark, parse.sentinel_number(F.col("c")), c=given) == want


def test_census_money_and_levels(spark):
    assert one(spark, parse.census_value(F.col("c")), c="1,234.565") == pytest.approx(1234.56, abs=0.011)
    assert one(spark, parse.census_value(F.col("c")), c="x") is None
    assert one(spark, parse.money_int(F.col("c")), c="$1,234.9") == 1234
    assert one(spark, parse.first_level(F.col("c")), c="Level 10") == 1
    assert one(spark, parse.first_level(F.col("c")), c="none") is None
    assert one(spark, parse.comma_number(F.col("c")), c="1,200 ha") == 1200.0


def test_rounding(spark):
    assert one(spark, parse.round_up(F.col("c")), c=-2.5) == -2.0
    assert one(spark, parse.round_even(F.col("c")), c=2.5) == 2.0


def test_text(spark):
    assert one(spark, text.slug(F.col("c")), c=" A & B--c! ") == "a-b-c"
    assert one(spark, text.slug_decomposed(F.col("c")), c="Café X") == "cafe-x"
    assert one(spark, text.business_name(F.col("c")), c="The Pine Co. Ltd") == "pine"
    assert one(spark, text.address(F.col("c")), c="12 North  Main Street, #4") == "12 n main st 4"
    assert one(spark, text.intersection_parts(F.col("c")), c="Oak Street & 1000 TO 2000 X & Ash Road & TURNING LANE") == ["ASH RD", "OAK ST"]
    assert one(spark, text.html_text(F.col("c")), c="<p>a&nbsp;<b>b</b></p><script>x<y</script>&amp;&rdquo;") == 'a b &"'
    assert one(spark, text.numeric_entities(F.col("c")), c="a&#65;b&#x;&#233;") == "aAb&#x;é"
    assert one(spark, text.absolute_url(F.col("c"), "http://a.org/x/"), c="/b") == "https://a.org/b"
    assert one(spark, text.url_stem(F.col("c")), c="https://a.org/b/c d.html?x=1") == "c_d"
    assert one(spark, text.archive_name(F.col("c")), c="/x/no2lur_a_2023-01-01_10-20-30_monthly.zip").asDict() == {"dataset": "no2lur_a", "cadence": "monthly"}
    assert one(spark, text.violation_kind(F.col("c")), c="Number of non-critical violations") == "non_critical"
    assert one(spark, text.prefix_family(F.col("c")), c="no2lur_a") == "air-quality"
    assert one(spark, text.prefix_family(F.col("c")), c="wtwbm_x") == "weather-biometeorology"
    assert one(spark, text.prefix_family(F.col("c")), c="ale_can") == "built-environment"
    assert one(spark, text.dataset_label(F.col("c")), c="grlan_lsat") == "Land greenness lsat"
    assert one(spark, text.keyword_class(F.col("c"), text.PARCEL_CLASSES), c="2 STY house") == "residential"
    assert one(spark, text.business_class(F.lit("x"), F.lit("y"), F.col("c")), c="Commercial Service")["category"] == "retail_service_candidate"
    assert one(spark, text.html_text(F.col("c")), c="a&#233;&#8211;&mdash;&lt;&#x;&#65601;") == "aé--&lt;&#x;A"
    assert one(spark, text.section(F.col("c"), "Observation", ("Corrective Action",)), c="Observation: dirty\nCorrective Action: clean") == "dirty"
    assert one(spark, text.byte_size(F.col("c")), c=1536.0) == "1.5 KB"


def test_dates(spark):
    assert one(spark, dates.clock_seconds(F.col("c")), c="25:01:02") == 90062
    assert one(spark, dates.clock_seconds(F.col("c")), c="x:1") is None
    assert one(spark, dates.parse_date(F.col("c")), c="3/4/2020") == "2020-03-04"
    assert one(spark, dates.parse_date(F.col("c")), c="spring") == "spring"
    assert one(spark, dates.iso_date(F.col("c")), c="86400000") == "1970-01-02"
    both = dates.bulletin_time(F.col("t"), F.col("n"))
    assert one(spark, both["local"], t="ISSUED: June 3, 2021 12:30", n="") == "2021-06-03 12:30"
    assert one(spark, both["local"], t="ISSUED 1:05 PM Monday, June 3, 2021", n="") == "2021-06-03 13:05"
    assert one(spark, both["utc"], t="none", n="x-2021-06-03.pdf") == "2021-06-03T07:00:00Z"
    assert one(spark, both["year"], t="none", n="none") is None


def test_geometry(spark):
    square = F.expr("array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 4D, 'y', 0D), named_struct('x', 4D, 'y', 4D), named_struct('x', 0D, 'y', 4D), named_struct('x', 0D, 'y', 0D)), array(named_struct('x', 1D, 'y', 1D), named_struct('x', 2D, 'y', 1D), named_struct('x', 2D, 'y', 2D), named_struct('x', 1D, 'y', 2D), named_struct('x', 1D, 'y', 1D)))")
    row = spark.range(1).select(geo.in_polygon(F.lit(3.0), F.lit(3.0), square).alias("a"), geo.in_polygon(F.lit(1.5), F.lit(1.5), square).alias("b"), geo.multipolygon_area(F.array(square)).alias("c"), geo.ring_centroid(F.element_at(square, 1)).alias("d"), geo.bbox(F.array(square)).alias("e")).first()
    assert (row["a"], row["b"], row["c"]) == (True, False, 15.0)
    assert tuple(row["d"]) == (2.0, 2.0) and tuple(row["e"]) == (0.0, 0.0, 4.0, 4.0)
    assert one(spark, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) == pytest.approx(math.pi * geo.EARTH_M / 180)


def test_utm_round_trip(spark):
    east, north = geo.utm10(F.lit(-122.75), F.lit(53.9))
    assert one(spark, east) == pytest.approx(516_432, abs=200)
    back = geo.utm10_inverse(east, north)
    assert one(spark, back[0]) == pytest.approx(-122.75, abs=1e-7) and one(spark, back[1]) == pytest.approx(53.9, abs=1e-7)


def test_shapes():
    from geoloom.functions import shapes

    line = np.array([(0, 0), (1, 0.01), (2, 0), (3, 2), (4, 0)], float)
    assert shapes.simplified_line(line, 0.1).tolist() == [[0, 0], [2, 0], [3, 2], [4, 0]]
    square = np.array([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], float)
    assert len(shapes.simplified_ring(square, 100.0)) >= 4
    parts = shapes.regrouped([square / 4 + 1.5, square, square / 2 + 1, square + 9])
    assert sorted(len(p) for p in parts) == [1, 1, 2] and max(parts, key=len)[0].max() == 4


def test_clip_keeps_holes_and_drops_what_is_outside(spark):
    ring = lambda *p: F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in p))
    outer, hole = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (3, 1), (3, 3), (1, 3), (1, 1))
    area = lambda *box: spark.range(1).select(geo.multipolygon_area(geo.clipped(F.array(F.array(outer, hole)), *box))).first()[0]
    assert area(-1, -1, 9, 9) == 12 and area(0, 0, 2, 2) == 3 and area(0, 0, 0.5, 4) == 2
    assert spark.range(1).select(geo.clipped(F.array(F.array(outer, hole)), 7, 7, 9, 9)).first()[0] is None
