"""Spatial queries: boundaries are built from suppliers, places from customers and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.operators.spatial import (
    BOX, cells_of_features, in_candidate_box, keep_boundary_classes, park_grids, park_grids_segregated,
    points_in_features, prepared, smallest_feature,
)
from regweave.plans.catalog import Tables, query
from regweave.session import stored

# Outer box (x0, y0, w, h) with a hole in its middle, and a second part, a small box east
# of it.  All numbers are short binary fractions, so both engines compute the same floats.
# Eight boundaries share a name.
FEATURE_SQL = """
feat AS (SELECT s_suppkey AS f, s_suppkey // 8 AS nk, 1.0::DOUBLE AS s,
  ((s_suppkey * 37) % 300 - 170)::DOUBLE + 0.25 + (s_suppkey // 300 % 512)::DOUBLE / 1024 AS x0, ((s_suppkey * 53) % 150 - 85)::DOUBLE + 0.5 AS y0 FROM supplier),
size_ AS (SELECT *, s * pow(2, f % 4 + 2) AS w, s * pow(2, f % 3 + 1) AS h FROM feat),
box AS (SELECT *, x0 + w AS x1, y0 + h AS y1, x0 + w / 4 AS hx0, x0 + 3 * w / 4 AS hx1, y0 + h / 4 AS hy0, y0 + 3 * h / 4 AS hy1,
  x0 + w + s AS ex0, x0 + w + 2 * s AS ex1, y0 AS ey0, y0 + s AS ey1, x0 AS bx0, x0 + w + 2 * s AS bx1, y0 AS by0,
  greatest(y0 + h, y0 + s) AS by1 FROM size_)"""
INSIDE_SQL = """((px BETWEEN x0 AND x1 AND py BETWEEN y0 AND y1 AND NOT (px > hx0 AND px < hx1 AND py > hy0 AND py < hy1))
   OR (px BETWEEN ex0 AND ex1 AND py BETWEEN ey0 AND ey1))"""
CELLS_SQL = """
cols AS (SELECT unnest(generate_series(0, 179)) AS c), rows_ AS (SELECT unnest(generate_series(0, 179)) AS r),
lattice AS (SELECT c, r, c * 2.0::DOUBLE - 180 AS cw, c * 2.0::DOUBLE - 178 AS ce, r - 90.0::DOUBLE AS cs, r - 89.0::DOUBLE AS cn FROM cols, rows_),
cover AS (SELECT f, nk, c, r, cw, ce, cs, cn, bx0, bx1, by0, by1 FROM box JOIN lattice ON
   (ce >= x0 AND cw <= x1 AND cn >= y0 AND cs <= y1 AND NOT (cw > hx0 AND ce < hx1 AND cs > hy0 AND cn < hy1))
   OR (ce >= ex0 AND cw <= ex1 AND cn >= ey0 AND cs <= ey1))"""
# A scan from the snapped-down minimum while below the maximum.
BOX_SQL = "c >= floor(({0}bx0 + 180) / 2) AND cw < {0}bx1 AND r >= floor({0}by0 + 90) AND cs < {0}by1"
LABEL_SQL = """chr((65 + c * 2 // 20)::INT) || chr((65 + r // 10)::INT) || ((c * 2) % 20 // 2) || (r % 10)"""


def _ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])


def features(t: Tables) -> DataFrame:
    """Supplier boundaries with a hole and a second part."""
    k = F.col("s_suppkey")
    x0 = ((k * 37) % 300 - 170).cast("double") + 0.25 + (F.floor(k / 300) % 512).cast("double") / 1024
    y0 = ((k * 53) % 150 - 85).cast("double") + 0.5
    s = F.lit(1.0)
    w, h = s * F.pow(F.lit(2.0), k % 4 + 2), s * F.pow(F.lit(2.0), k % 3 + 1)
    part = lambda n, ring: F.struct(F.lit(n).alias("part"), ring.alias("ring"))
    rings = F.array(
        part(0, _ring(x0, y0, x0 + w, y0 + h)), part(0, _ring(x0 + w / 4, y0 + h / 4, x0 + w * 3 / 4, y0 + h * 3 / 4)),
        part(1, _ring(x0 + w + s, y0, x0 + w + s * 2, y0 + s)),
    )
    layer = t.supplier.select(
        F.format_string("%09d", k).alias("feature_id"), F.concat(F.lit("Range "), F.floor(k / 8), F.lit(" NF")).alias("unit_name"),
        F.when(k % 2 == 0, F.col("s_name")).alias("local_name"),
        F.create_map(F.lit("boundary"), F.when(k % 3 == 0, "protected_area").otherwise("administrative")).alias("tags"), rings.alias("rings"),
    )
    # A real layer is a stored table; the derived one is stored too.
    return stored(prepared(layer))


def places(t: Tables) -> DataFrame:
    """Customer places on a 1/8 degree raster; half of them named like a boundary."""
    k = F.col("c_custkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("Range "), "c_nationkey", F.lit(" National Forest"))).otherwise(F.lit("qqqq"))
    return t.customer.select(
        F.concat(F.when(k % 5 == 0, "CA-").otherwise("US-"), k).alias("reference"), name.alias("name"),
        F.when(k % 5 == 0, "CA").otherwise("US").alias("country"),
        F.when(k % 97 != 0, ((k * 29) % 1280).cast("double") / 8 - 80.0).alias("lat"),
        F.when(k % 97 != 0, ((k * 131) % 2720).cast("double") / 8 - 170.0).alias("lon"),     )


PLACE_SQL = """
place AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN 'CA-' ELSE 'US-' END || c_custkey AS reference, c_custkey % 2 = 0 AS named,
  c_custkey % 5 <> 0 AS us, CASE WHEN c_custkey % 97 <> 0 THEN ((c_custkey * 29) % 1280)::DOUBLE / 8 - 80 END AS py,
  CASE WHEN c_custkey % 97 <> 0 THEN ((c_custkey * 131) % 2720)::DOUBLE / 8 - 170 END AS px FROM customer)"""


@query("point_in_polygon", f"""WITH {FEATURE_SQL},
pts AS (SELECT o_orderkey AS k, ((o_orderkey * 29) % 1280)::DOUBLE / 8 - 80 AS py, ((o_custkey * 131 + o_orderkey) % 2720)::DOUBLE / 8 - 170 AS px FROM orders)
SELECT k, lpad(f::VARCHAR, 9, '0') AS feature_id FROM pts JOIN box ON {INSIDE_SQL}""")
def point_in_polygon(t: Tables) -> DataFrame:
    """Points inside or on the edge of boundaries with holes and parts."""
    pts = t.orders.select(
        F.col("o_orderkey").alias("k"), (((F.col("o_orderkey") * 29) % 1280).cast("double") / 8 - 80.0).alias("lat"),
        (((F.col("o_custkey") * 131 + F.col("o_orderkey")) % 2720).cast("double") / 8 - 170.0).alias("lon"),
    )
    return points_in_features(pts, "k", features(t)).select("k", "feature_id")


@query("cell_coverage", f"""WITH {FEATURE_SQL}, {CELLS_SQL}
SELECT lpad(f::VARCHAR, 9, '0') AS feature_id, c::BIGINT AS c, r::BIGINT AS r FROM cover WHERE {BOX_SQL.format('')}""")
def cell_coverage(t: Tables) -> DataFrame:
    """Lattice cells that truly meet each boundary, holes left out."""
    shapes = features(t)
    box = shapes.select("feature_id", *BOX)
    return cells_of_features(shapes).join(box, "feature_id").filter(in_candidate_box()).select(
        "feature_id", F.col("c").cast("bigint").alias("c"), F.col("r").cast("bigint").alias("r")
    )


@query("smallest_area", f"""WITH {FEATURE_SQL}, {PLACE_SQL},
a AS (SELECT *, w * h - (w / 2) * (h / 2) + s * s AS area FROM box)
SELECT reference, lpad(f::VARCHAR, 9, '0') AS feature_id, area FROM (
  SELECT reference, f, area, row_number() OVER (PARTITION BY reference ORDER BY area, f) AS rn FROM place JOIN a ON {INSIDE_SQL}) WHERE rn = 1""")
def smallest_area(t: Tables) -> DataFrame:
    """Tightest containing boundary per place."""
    shapes = features(t)
    containing = points_in_features(places(t), "reference", shapes, keep=("area",), smallest=True)
    return smallest_feature(containing, "reference", shapes)


@query("feature_areas", f"""WITH {FEATURE_SQL} SELECT lpad(f::VARCHAR, 9, '0') AS feature_id, w * h - (w / 2) * (h / 2) + s * s AS area FROM box""")
def feature_areas(t: Tables) -> DataFrame:
    """Shoelace area, holes subtracted."""
    return features(t).select("feature_id", "area")


_MATCH_SQL = f"""
inside AS (SELECT reference, named, place.us, f, box.nk, w, h, s, bx0, bx1, by0, by1 FROM place JOIN box ON {INSIDE_SQL}),
names AS (SELECT DISTINCT reference, nk FROM inside WHERE named),
-- A matched boundary's second name pulls in nothing else: supplier names are unique.
ubox AS (SELECT reference, min(bx0) AS bx0, max(bx1) AS bx1, min(by0) AS by0, max(by1) AS by1 FROM names JOIN box USING (nk) GROUP BY 1),
high AS (SELECT DISTINCT reference, c, r, 'high' AS confidence FROM names JOIN cover USING (nk) JOIN ubox USING (reference)
         WHERE {BOX_SQL.format('ubox.')}),
best AS (SELECT reference, f FROM (SELECT *, row_number() OVER (PARTITION BY reference ORDER BY w * h - (w / 2) * (h / 2) + s * s, f) AS rn
         FROM inside WHERE NOT named) WHERE rn = 1),
medium AS (SELECT reference, c, r, 'medium' AS confidence FROM best JOIN cover USING (f) WHERE {BOX_SQL.format('')}),
matched AS (SELECT * FROM high UNION ALL SELECT * FROM medium)"""


@query("same_name_union", f"""WITH {FEATURE_SQL}, {CELLS_SQL}, {PLACE_SQL}, {_MATCH_SQL}
SELECT reference, {LABEL_SQL} AS grid, 'padus' AS source, confidence FROM matched JOIN place USING (reference) WHERE us
UNION ALL
SELECT reference, chr((65 + floor((px + 180) / 20))::INT) || chr((65 + floor((py + 90) / 10))::INT) || floor(((px + 180) % 20) / 2)::INT
       || floor((py + 90) % 10)::INT, 'pota-point', 'low'
FROM place WHERE px IS NOT NULL AND (NOT us OR reference NOT IN (SELECT reference FROM matched))""")
def same_name_union(t: Tables) -> DataFrame:
    """Grid set of places: name matches with same-name union, tightest fit, own point."""
    return park_grids(places(t), features(t))


@query("segregated_grids", f"""WITH {FEATURE_SQL.replace('FROM supplier', 'FROM supplier WHERE s_suppkey % 3 = 0')}, {CELLS_SQL}, {PLACE_SQL}, {_MATCH_SQL}
SELECT reference, {LABEL_SQL} AS grid, 'osm' AS source, confidence FROM matched JOIN place USING (reference) WHERE NOT us""")
def segregated_grids(t: Tables) -> DataFrame:
    """Share-alike grid set: filtered boundary classes, non-US places, no point rows."""
    shapes = keep_boundary_classes(features(t)).withColumn("unit_name", F.replace("unit_name", F.lit("NF"), F.lit("National Forest")))
    return park_grids_segregated(places(t), shapes)


