"""Operators of the lake on small tables."""

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shotlake.functions import geometry as G
from shotlake.functions.granules import granule_key, hash_list, parse_name
from shotlake.functions.tiles import tile_bounds, tile_of
from shotlake.operators import build, catalog, maintain, spatial
from shotlake.operators.crossovers import GUARD_M, crossovers, pairs_within
from shotlake.schema import PRODUCTS, lake_schema, product_fields, product_schema, unrolled
from shotlake.sources import lake, listings
from shotlake.streaming.intake import merge_plans, take_in


def box(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]


def regions(spark, *shapes):
    floats = lambda s: [[(float(x), float(y)) for x, y in ring] for ring in s]
    return spark.createDataFrame([(str(i), floats(s)) for i, s in enumerate(shapes)], f"region_id string, rings {G.RINGS}")


def test_schema_has_all_columns():
    assert [len(unrolled(product_fields(p))) for p in PRODUCTS] == [129, 110, 21, 10]
    names = lake_schema().fieldNames()
    assert len(names) == len(set(names)) and names[-2:] == ["tile_id", "year"]
    assert lake_schema()["absolute_time"].metadata["unit"] == "UTC timestamp"


def test_tiles_are_half_open(spark):
    rows = [(-63.0, -4.0), (-62.5, -4.0), (-62.5, -4.5), (0.0, 0.0), (0.5, 0.5), (-0.5, -0.5), (float("nan"), 1.0), (None, 1.0), (-180.0, 90.0)]
    got = [r[0] for r in spark.createDataFrame(rows, "x double, y double").select(tile_of(F.col("x"), F.col("y"))).collect()]
    assert got == ["S04_W063", "S04_W063", "S04_W063", "N00_E000", "N01_E000", "N00_W001", None, None, "N90_W180"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.floats(-180, 179.99), st.floats(-89.99, 90)), min_size=1, max_size=30))
def test_each_point_lies_in_its_tile_alone(spark, points):
    df = spark.createDataFrame(points, "x double, y double").withColumn("t", tile_of(F.col("x"), F.col("y")))
    b = tile_bounds(F.col("t"), strict=True)
    inside = (F.col("x") >= b["minx"]) & (F.col("x") < b["maxx"]) & (F.col("y") > b["miny"]) & (F.col("y") <= b["maxy"])
    assert df.where(~inside | inside.isNull()).count() == 0


def test_tile_bounds_reject_other_names(spark):
    df = spark.createDataFrame([("X04_W063",)], "t string")
    assert df.select(tile_bounds(F.col("t"))["minx"]).first()[0] is None
    with pytest.raises(Exception, match="not a tile id"):
        df.select(tile_bounds(F.col("t"), strict=True)["minx"]).collect()


def test_contains_leaves_out_boundary_and_holes(spark):
    shape = box(0, 0, 4, 4) + [[(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]]
    points = {(0.5, 0.5): True, (2, 2): False, (0, 2): False, (4, 4): False, (1, 2): False, (5, 2): False, (3.5, 1): True}
    rows = [(float(x), float(y), w) for (x, y), w in points.items()]
    df = spark.createDataFrame(rows, "x double, y double, w boolean").crossJoin(regions(spark, shape))
    assert df.where(G.contains(G.edges(F.col("rings")), F.col("x"), F.col("y")) != F.col("w")).count() == 0


def test_contains_against_brute_force(spark):
    rng = random.Random(3)
    shape = [[(math.cos(a) * r, math.sin(a) * r) for a, r in ((2 * math.pi * i / 11, rng.uniform(0.4, 2)) for i in range(11))]]
    shape[0].append(shape[0][0])

    def inside(x, y):
        hit = False
        for (ax, ay), (bx, by) in zip(shape[0], shape[0][1:]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hit = not hit
        return hit

    rows = [(x, y, inside(x, y)) for x, y in ((rng.uniform(-2, 2), rng.uniform(-2, 2)) for _ in range(500))]
    points = spark.createDataFrame(rows, "lon_lowestmode double, lat_lowestmode double, w boolean")
    got = spatial.within_regions(points, regions(spark, shape))
    assert sorted(map(tuple, got.select("lon_lowestmode", "lat_lowestmode").collect())) == sorted((x, y) for x, y, w in rows if w)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_points_in_clipped_polygons_against_brute_force(spark, seed):
    rng = random.Random(seed)
    ring = lambda x, y, r, k: [(round(x + math.cos(2 * math.pi * i / k) * rng.uniform(0.5, 1) * r, 1), round(y + math.sin(2 * math.pi * i / k) * rng.uniform(0.5, 1) * r, 1)) for i in range(k)]
    # corners lie on a grid of tenths, so that many are on the edges and corners of tiles, like some of the points
    shapes = [[ring(0, 0, 5, 9), ring(0.3, 0.1, 1.5, 5)], [ring(3, 2, 2, 4)], box(-1, -1, 1, 1), box(-2, 0, 3, 1)]
    points = [(round(rng.uniform(-6, 6), rng.choice([0, 1, 1, 3])), round(rng.uniform(-6, 6), rng.choice([0, 1, 1, 3]))) for _ in range(1500)]

    def inside(shape, x, y):
        odd = False
        for r in shape:
            for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1]):
                if (bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                    return False
                if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                    odd = not odd
        return odd

    df = spark.createDataFrame([(float(x), float(y)) for x, y in points], "lon_lowestmode double, lat_lowestmode double")
    got = spatial.within_regions(df, regions(spark, *shapes)).collect()
    want = [(x, y, str(i)) for i, s in enumerate(shapes) for x, y in points if inside(s, x, y)]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 200
    once = spatial.within_any(df, regions(spark, *shapes))
    assert sorted(map(tuple, once.collect())) == sorted((x, y) for x, y in points if any(inside(s, x, y) for s in shapes))


def test_long_coastline_in_one_tile(spark):
    rng = np.random.default_rng(8)
    k = 20_000
    angle = np.linspace(0, 2 * np.pi, k, endpoint=False)
    reach = 0.35 + 0.05 * np.sin(40 * angle) + rng.uniform(-0.002, 0.002, k)
    ring = np.stack([10.5 + reach * np.cos(angle), 20.5 + reach * np.sin(angle)], 1)
    x, y = rng.uniform(9.9, 11.1, 6000), rng.uniform(19.9, 21.1, 6000)
    x[:300], y[:300] = ring[::66][:300].T  # corners lie on the boundary
    x[300:400], y[300:400] = 10 + rng.integers(0, 65, 100) / 64, 20 + rng.integers(0, 65, 100) / 64  # and cells' corners anywhere
    a, b = ring, np.roll(ring, -1, 0)
    inside = np.array([(((a[:, 1] > v) != (b[:, 1] > v)) & (u < (b[:, 0] - a[:, 0]) * (v - a[:, 1]) / np.where(a[:, 1] == b[:, 1], 1, b[:, 1] - a[:, 1]) + a[:, 0])).sum() % 2 == 1 for u, v in zip(x, y)])
    inside[:300] = False
    points = spark.createDataFrame([(i, float(u), float(v)) for i, (u, v) in enumerate(zip(x, y))], "n long, lon_lowestmode double, lat_lowestmode double").repartition(4)
    shapes = regions(spark, [[tuple(map(float, p)) for p in [*ring, ring[0]]]], box(9.95, 19.95, 10.6, 20.6))
    boxed = (x > 9.95) & (x < 10.6) & (y > 19.95) & (y < 20.6)
    got = spatial.within_regions(points, shapes).select("n", "region_id").collect()
    assert sorted(r.n for r in got if r.region_id == "0") == np.flatnonzero(inside).tolist()
    assert sorted(r.n for r in got if r.region_id == "1") == np.flatnonzero(boxed).tolist()
    assert sorted(r.n for r in spatial.within_any(points, shapes).collect()) == np.flatnonzero(inside | boxed).tolist()


def test_polygons_across_the_180th_meridian(spark):
    ring = [[(179.2, 0.2), (-179.3, 0.4), (-179.5, 1.6), (178.8, 1.4), (179.2, 0.2)]]
    cells = spatial.covering_cells(regions(spark, ring, box(-170, 0.5, 170, 0.6)), across=True)
    got = {(r.minx, r.miny) for r in cells.where("region_id = '0'").collect()}
    assert got == {(x, y) for x in (178, 179, -180) for y in (0, 1)}
    # the short way for both
    assert {r.minx for r in cells.where("region_id = '1'").collect()} == {*range(169, 180), *range(-180, -169)}
    granules = spark.createDataFrame([("g",)], "granule_key string").crossJoin(regions(spark, ring).select(F.array("rings").alias("polygons")))
    from shotlake.plans.tile_plan import plan_tiles

    plan = plan_tiles(regions(spark, box(-180, -5, 180, 5)), granules, "2024-01-01")
    assert sorted(r.tile_id for r in plan.collect()) == ["N01_E178", "N01_E179", "N01_W180", "N02_E178", "N02_E179", "N02_W180"]


def test_covering_tiles_count_touching_and_slanted_edges(spark):
    names = lambda *s: sorted(r[0] for r in spatial.covering_tiles(regions(spark, *s)).select("tile_id").collect())
    assert names(box(-63.2, -4.2, -62.8, -3.8)) == ["S03_W063", "S03_W064", "S04_W063", "S04_W064"]
    assert len(names(box(1, 1, 2, 2))) == 9
    assert len(names(box(1, 1, 2, 2), box(1, 1, 2, 2))) == 9
    slanted = [[(0.1, 0.1), (2.9, 2.5), (2.9, 2.6), (0.1, 0.2), (0.1, 0.1)]]
    assert "N01_E002" not in names(slanted) and "N02_E001" in names(slanted)
    assert names(box(179.5, -89.9, 180, -89.5)) == ["S89_E179"]


def test_inside_tiles_are_known(spark):
    cells = spatial.covering_cells(regions(spark, box(0.5, 0.5, 3.5, 3.5)))
    assert sorted((r.minx, r.miny) for r in cells.where("inside").collect()) == [(x, y) for x in (1, 2) for y in (1, 2)]
    assert spatial.covering_cells(regions(spark, box(0.5, 0.5, 3.5, 3.5)), step=5).count() == 1


def test_pruning_reaches_partitions(spark, tmp_path):
    rows = [(1, 0.5, 0.5, "N01_E000", 2019), (2, 5.5, 5.5, "N06_E005", 2020)]
    df = spark.createDataFrame(rows, "shot_number long, lon_lowestmode double, lat_lowestmode double, tile_id string, year int")
    lake.write_lake(df, str(tmp_path / "lake"))
    got = spatial.with_tile_pruning(lake.read_lake(spark, str(tmp_path / "lake"), schema=df.schema), regions(spark, box(0.2, 0.2, 0.8, 0.8)))
    assert [r.shot_number for r in got.collect()] == [1]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(tile_id" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert lake.read_lake(spark, str(tmp_path / "lake"), ["N06_E005"], [2020], df.schema).count() == 1
    assert lake.read_parts(spark, str(tmp_path / "lake"), [("N01_E000", 2019)]).count() == 1


def test_write_replaces_only_its_partitions(spark, tmp_path):
    schema = "shot_number long, tile_id string, year int"
    root, more, aside = (str(tmp_path / n) for n in ("lake", "updates", "archive"))
    lake.write_lake(spark.createDataFrame([(1, "N01_E000", 2019), (2, "N01_E000", 2020), (3, "N02_E000", 2019)], schema), root)
    lake.write_lake(spark.createDataFrame([(9, "N01_E000", 2020)], schema), more)
    lake.merge_updates(spark, more, root)
    assert sorted(r.shot_number for r in spark.read.parquet(root).collect()) == [1, 3, 9]
    stale = lake.set_aside(spark, root, spark.createDataFrame([("N02_E000",)], "tile_id string"), aside)
    assert [r.tile_id for r in stale.collect()] == ["N02_E000"] and [r.shot_number for r in spark.read.parquet(aside).collect()] == [3]
    assert sorted(r.shot_number for r in spark.read.parquet(root).collect()) == [1, 9]  # moved, not copied
    assert lake.set_aside(spark, root, stale, aside).count() == 0 and spark.read.parquet(aside).count() == 1


def test_new_files(spark):
    listed = spark.createDataFrame([("a/year=2019/x.parquet",), ("a/year=2019/y.parquet",), ("a/year=2019/z.txt",)], "path string")
    assert [r.path for r in lake.new_files(listed, listed.limit(1)).collect()] == ["a/year=2019/y.parquet"]


def test_local_frames_and_description(spark):
    df = spark.createDataFrame([(1, 1.5, 2.5)], "shot_number long, lon_lowestmode double, lat_lowestmode double")
    frame = lake.to_local(df, ["shot_number"], 10)
    assert frame.geometry[0] == "0101000000000000000000F83F0000000000000440"
    with pytest.raises(ValueError, match="nothing"):
        lake.to_local(df, ["nothing"], 1)
    assert [tuple(r) for r in lake.from_local(spark, frame).collect()] == [(1, 1.5, 2.5)]
    texts = frame.assign(geometry=["point( 1.5  -2.5e0 )"])
    assert [tuple(r) for r in lake.from_local(spark, texts).collect()] == [(1, 1.5, -2.5)]
    assert lake.from_local(spark, frame[["shot_number"]]).count() == 1
    found = lake.describe(spark.createDataFrame([], lake_schema())).where("column_name LIKE '%elev%'")
    assert {r.column_name for r in found.collect()} == {"elev_lowestmode", "solar_elevation", "digital_elevation_model", "digital_elevation_model_srtm", "elev_highestreturn_a1", "elev_highestreturn_a2"}


def test_geometry_text_and_binary(spark):
    rows = [(1.5, -2.25), (-180.0, 90.0), (None, 1.0), (float("nan"), 1.0), (1e-7, 123.456)]
    df = spark.createDataFrame(rows, "x double, y double").select("x", "y", lake.point_wkb("x", "y").alias("w"), lake.point_text(F.col("x"), F.col("y")).alias("t"))
    for r in df.select("x", "y", "w", lake.point_from_wkb("w").alias("b"), lake.point_from_text(F.col("t")).alias("p")).collect():
        if r.x is None or r.x != r.x:
            assert r.w is None and r.b.x is None
        else:
            assert (r.b.x, r.b.y) == (r.p.x, r.p.y) == (r.x, r.y)
    bad = spark.createDataFrame([("POINT (a 1)",), ("LINE (1 2)",), (None,)], "t string").select(lake.point_from_text(F.col("t")).alias("p"), lake.rings_from_text(F.col("t")).alias("r"), lake.point_from_wkb(F.encode("t", "utf-8")).alias("w"))
    assert all(r.p is None and r.r is None and r.w.x is None for r in bad.collect())
    shapes = regions(spark, box(0, 0, 4, 4) + box(1, 1, 2, 2))
    back = shapes.select("rings", lake.rings_from_text(lake.rings_text(F.col("rings"))).alias("again")).first()
    assert back.rings == back.again and len(back.again) == 2


def test_shape_first_rows_and_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, "b"), (3, 5.0, None)], "shot_number long, level double, name string")
    assert tuple(lake.shape(df).first()) == (3, 3) and [r.shot_number for r in lake.first_rows(df, 2, F.desc("shot_number")).collect()] == [3, 2]
    assert [tuple(r) for r in lake.profile(df, "%e%").collect()] == [("shot_number", "bigint", 3, 1.0, 3.0), ("level", "double", 2, 2.0, 5.0)]
    assert {r.level for r in lake.describe(spark.createDataFrame([], lake_schema()), "rh^_%".replace("^", "\\")).collect()} == {"level2A"}


def test_regions_from_geojson(spark, tmp_path):
    doc = {"features": [{"id": "a", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}, {"id": "b", "geometry": {"type": "MultiPolygon", "coordinates": [[[[2, 2], [3, 2], [3, 3], [2, 2]]], [[[4, 4], [5, 4], [5, 5], [4, 4]]]]}}]}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    rows = lake.read_regions(spark, str(tmp_path / "r.json")).orderBy("region_id", "part_id").collect()
    assert [(r.region_id, r.part_id, r.rings[0][1].x) for r in rows] == [("a", 0, 1.0), ("b", 0, 3.0), ("b", 1, 5.0)]
    doc["features"][0]["geometry"]["coordinates"][0][0] = [500000, 0]
    (tmp_path / "bad.json").write_text(json.dumps(doc))
    with pytest.raises(Exception, match="degrees"):
        lake.read_regions(spark, str(tmp_path / "bad.json")).collect()


NAME = "X02_A_2019268053258_O04446_04_T02132_02_003_01_V002"


def test_listing_pages(spark, tmp_path):
    def entry(**more):
        return {"online_access_flag": True, "data_center": "LPDAAC", "producer_granule_id": NAME, "title": f"t.{NAME}.h5", "granule_size": "2.5", "polygons": [["10 20 11 20 11 21 10 20"]], "links": [{"href": "https://x", "title": "Download x"}, {"href": "s3://b/x", "title": "y"}]} | more

    page = {"feed": {"entry": [entry(), entry(online_access_flag=False), entry(data_center="LP and ORNL", title="a.other.b.c"), entry(data_center="elsewhere"), entry(polygons=[]), entry(links=[])]}}
    (tmp_path / "p.json").write_text(json.dumps(page))
    pages = listings.read_pages(spark, str(tmp_path / "p.json"))
    rows = listings.parse_entries(pages).collect()
    assert [(r.granule_name, r.granule_url) for r in rows] == [(NAME, "s3://b/x"), ("other", "s3://b/x"), (NAME, None)]
    assert [(p.x, p.y) for p in rows[0].polygons[0][0]] == [(20.0, 10.0), (20.0, 11.0), (21.0, 11.0), (20.0, 10.0)] and rows[0].granule_size == 2.5
    assert listings.parse_entries(pages, cloud=False).first().granule_url == "https://x"


def test_granule_names(spark):
    df = spark.createDataFrame([(f"{NAME}.h5",), ("nothing",)], "n string")
    parsed = df.select(parse_name(F.col("n")).alias("p"), granule_key(F.col("n")).alias("k")).collect()
    assert parsed[0].k == "O04446_04" and parsed[0].p.ground_track == "T02132" and parsed[0].p.julian_day == "268"
    assert parsed[1].p is None and parsed[1].k is None
    with pytest.raises(Exception, match="not a granule name"):
        df.select(parse_name(F.col("n"), strict=True)).collect()
    import hashlib

    got = spark.range(1).select(hash_list(F.array(F.lit("ab"), F.lit("c")))).first()[0]
    assert got == hashlib.md5(b"2:ab,1:c").hexdigest()


def rolled(spark, rows, **options):
    schema = "granule_name string, granule_url string, granule_size double, product string, product_order int"
    df = spark.createDataFrame(rows, schema).withColumn("polygons", F.array().cast(f"array<{G.RINGS}>"))
    return {r.granule_key: r for r in catalog.roll_up(df, **options).collect()}


def test_roll_up_required_and_optional(spark):
    def name(p, o):
        return f"X{p}_A_2019268053258_O{o:05d}_04_T02132_02_003_01_V002"

    rows = [(name(i, o), f"s3://{p}/{o}", 1.5, p, i) for o in (1, 2, 33765) for i, p in enumerate(PRODUCTS) if not (o == 2 and p == "level4C")]
    assert set(rolled(spark, rows)) == {"O00001_04", "O33765_04"}
    some = rolled(spark, rows, required=list(PRODUCTS[:3]), denied=("O33765_04",))
    assert set(some) == {"O00001_04", "O00002_04"} and some["O00002_04"].level4C_url is None
    assert some["O00001_04"].granule_size == 6.0 and some["O00001_04"].granule_names == [name(i, 1) for i in range(4)]
    assert some["O00001_04"].granule_hash != some["O00002_04"].granule_hash
    assert not rolled(spark, rows, start_year=2020, end_year=2021) and len(rolled(spark, rows, start_year=2020)) == 2
    with pytest.raises(ValueError, match="level9"):
        rolled(spark, rows, required=["level9"])


def test_product_tokens():
    assert catalog.product_tokens(" Level2a, level4C,level2A") == ["level2A", "level4C"]
    for bad in ("", "level9"):
        with pytest.raises(ValueError):
            catalog.product_tokens(bad)


def product(spark, name, shots, **values):
    schema = product_schema(name)
    keep = ["granule_key", "beam_name", "shot_number", "lat_lowestmode", "lon_lowestmode", *values]
    rows = [(g, "BEAM1", s, lat, lon, *[v[i] for v in values.values()]) for i, (g, s, lat, lon) in enumerate(shots)]
    return spark.createDataFrame(rows, type(schema)([schema[k] for k in keep]))


def test_assembly(spark):
    shots = [("g1", 1, 0.5, 0.5), ("g1", 2, 0.5, 0.6), ("g1", 3, 5.5, 0.6), ("g2", 4, 0.5, 0.5), ("g3", 5, 0.5, 0.5)]
    a = product(spark, "level2A", shots, delta_time=[0.0, float("nan"), 0.0, 31_536_000.5, 0.0], rh=[[1.0] * 101] * 5)
    b = product(spark, "level4A", shots[:1] + shots[2:4], agbd=[1.0, 2.0, 3.0])
    plan = spark.createDataFrame([("N01_E000", "g1", "u", "u"), ("N01_E000", "g2", "u", None), ("N01_E000", "g3", "u", "u")], "tile_id string, granule_key string, level2A_url string, level4A_url string")
    rows = {r.shot_number: r for r in build.assemble({"level2A": a, "level4A": b}, plan).collect()}
    assert set(rows) == {1, 4}  # 2 has a NaN, 3 lies in another tile, 5 lacks a product that is due
    assert rows[1].agbd == 1.0 and rows[4].agbd is None and rows[4].rh_100 == 1.0 and rows[1].wsci is None
    assert rows[4].absolute_time == dt.datetime(2019, 1, 1, 0, 0, 0, 500000) and rows[4].year == 2019 and rows[1].beam_name == "BEAM1"


def test_quality_switch_is_tile_wide(spark):
    good = dict(quality_flag=1, sensitivity=0.95, sensitivity_a2=0.98, degrade_flag=0, surface_flag=1)
    rows = [(s, t, *(good | ({"sensitivity": 0.5} if bad else {})).values()) for s, t, bad in ((1, "A", False), (2, "A", True), (3, "B", True))]
    shots = spark.createDataFrame(rows, "shot_number long, tile_id string, quality_flag int, sensitivity double, sensitivity_a2 double, degrade_flag int, surface_flag int")
    plan = spark.createDataFrame([("A", "g", "u"), ("B", "g", "u"), ("B", "h", None)], "tile_id string, granule_key string, level2A_url string")
    got = build.quality_filter(shots, plan, ["level2A"])
    assert sorted(r.shot_number for r in got.collect()) == [1, 3]


PLAN = "tile_id string, granule_key string, granule_hash string, cmr_access_time timestamp"


def plan_rows(spark, *rows):
    return spark.createDataFrame([(t, g, h, dt.datetime(2024, m, 1)) for t, g, h, m in rows], PLAN)


def test_upkeep(spark):
    old, new = plan_rows(spark, ("A", "g", "1", 1), ("A", "h", "1", 3)), plan_rows(spark, ("A", "g", "2", 2), ("A", "h", "9", 2), ("B", "g", "1", 2))
    got = {(r.tile_id, r.granule_key): r.granule_hash for r in maintain.latest(old, new).collect()}
    assert got == {("A", "g"): "2", ("A", "h"): "1", ("B", "g"): "1"}
    assert maintain.duplicates(old.unionByName(new)).count() == 2
    assert [(r.tile_id, r.granule_key) for r in maintain.missing_granules(new, old).collect()] == [("B", "g")]
    assert maintain.drifted(new, old).count() == 2
    assert not maintain.is_covered(new, old) and maintain.is_covered(old, new)
    status = maintain.tile_status(new, old, spark.createDataFrame([("C",), ("A",)], "tile_id string"))
    assert maintain.summary(status).first().asDict() == {"required": 2, "existing": 1, "missing": 1, "unplanned": 1, "stored_unplanned": 1}


def metres(a, b):
    """Vincenty's inverse, iterated until it stands still."""
    f, big = 1 / 298.257223563, 6378137.0
    small = big * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(p[0]))) for p in (a, b))
    el = math.radians(b[1] - a[1])
    lam = el = (el + math.pi) % (2 * math.pi) - math.pi
    for _ in range(50):
        ss = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if ss == 0:
            return 0.0
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sg, sa = math.atan2(ss, cs), math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        ca = 1 - sa * sa
        cm = cs - 2 * math.sin(u1) * math.sin(u2) / ca if ca else 0.0
        k = f / 16 * ca * (4 + f * (4 - 3 * ca))
        lam = el + (1 - k) * f * sa * (sg + k * ss * (cm + k * cs * (2 * cm * cm - 1)))
    uu = ca * (big**2 - small**2) / small**2
    aa, bb = 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu))), uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))
    ds = bb * ss * (cm + bb / 4 * (cs * (2 * cm * cm - 1) - bb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
    return small * aa * (sg - ds)


@pytest.mark.parametrize(("lat", "lon", "d"), [(0.0, 10.0, 40.0), (-51.3, 179.9999, 40.0), (79.5, -180.0, 120.0), (45.0, 0.0, 500.0)])
def test_crossovers_against_brute_force(spark, lat, lon, d):
    rng = random.Random(int(lat * 7 + d))
    span = 6 * d / 111_000
    points = [(i, lat + rng.uniform(-span, span), (lon + rng.uniform(-span, span) / math.cos(math.radians(lat)) + 180) % 360 - 180) for i in range(140)]
    df = spark.createDataFrame([*points, (999, float("nan"), 0.0), (998, None, 0.0)], "shot_number long, lat_lowestmode double, lon_lowestmode double")
    got = {(r.t1_shot_number, r.t2_shot_number): r.distance_m for r in pairs_within(df, d).collect()}
    want = {(a[0], b[0]): metres(a[1:], b[1:]) for a in points for b in points if a[0] < b[0]}
    want = {k: v for k, v in want.items() if v <= d}
    assert set(got) == set(want) and len(want) > 20
    assert max(abs(got[k] - want[k]) for k in want) < 1e-4


@pytest.mark.parametrize(("pole", "d"), [(90.0, 40.0), (-90.0, 40.0), (90.0, 2500.0)])
def test_crossovers_around_the_poles(spark, pole, d):
    rng = random.Random(int(d))
    points = [(0, pole, 0.0), (1, pole, 123.0)] + [(i, pole - math.copysign(rng.uniform(0, 4 * d / 111_000), pole), rng.uniform(-180, 180)) for i in range(2, 120)]
    df = spark.createDataFrame(points, "shot_number long, lat_lowestmode double, lon_lowestmode double")
    got = {(r.t1_shot_number, r.t2_shot_number): r.distance_m for r in pairs_within(df, d).collect()}
    want = {(a[0], b[0]): metres(a[1:], b[1:]) for a in points for b in points if a[0] < b[0]}
    assert set(got) == {k for k, v in want.items() if v <= d} and len(got) > 100
    assert max(abs(got[k] - want[k]) for k in got) < 1e-3


def test_a_point_looks_into_few_cells(spark):
    from shotlake.operators.crossovers import CELL, near_cells
    from shotlake.functions.geometry import earth_centred

    df = spark.range(5000).selectExpr("degrees(asin(2 * rand(1) - 1)) AS lat", "360 * rand(2) - 180 AS lon")
    n = df.select(F.size(near_cells(earth_centred(F.col("lat"), F.col("lon")), CELL * 40, 40.0)).alias("n")).agg(F.max("n"), F.avg("n")).first()
    assert n[0] <= 8 and n[1] < 3.2


def test_crossovers_filter_columns_and_guard(spark):
    df = spark.createDataFrame([(2, 0.5, 0.5, 1), (1, 0.5, 0.5001, 1), (3, 0.5, 0.5, 0), (4, 1.0, 0.5, 1)], "shot_number long, lat_lowestmode double, lon_lowestmode double, ok int")
    got = crossovers(df, regions(spark, box(0, 0, 1, 1)), 40.0, "ok = 1", ["ok", "shot_number"])
    assert got.columns == ["t1_shot_number", "t2_shot_number", "t1_lat_lowestmode", "t1_lon_lowestmode", "t2_lat_lowestmode", "t2_lon_lowestmode", "distance_m", "t1_ok", "t2_ok"]
    assert [(r.t1_shot_number, r.t2_shot_number) for r in got.collect()] == [(1, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        crossovers(df, regions(spark, box(0, 0, 1, 1)), GUARD_M, guard=True)


def test_streams_see_each_file_once(spark, tmp_path):
    incoming, seen = str(tmp_path / "in"), []
    df = spark.createDataFrame([(1,)], "x long")
    df.coalesce(1).write.parquet(incoming)
    for _ in range(2):
        take_in(spark, incoming, df.schema, str(tmp_path / "c"), lambda b, i: seen.append(b.count())).awaitTermination(60)
    df.coalesce(1).write.mode("append").parquet(incoming)
    take_in(spark, incoming, df.schema, str(tmp_path / "c"), lambda b, i: seen.append(b.count())).awaitTermination(60)
    assert seen == [1, 1]


def test_plan_stream_keeps_the_latest(spark, tmp_path):
    incoming, root = str(tmp_path / "in"), str(tmp_path / "plan")
    for part in (plan_rows(spark, ("A", "g", "1", 1), ("B", "g", "1", 1)), plan_rows(spark, ("A", "g", "2", 2), ("A", "h", "1", 2))):
        part.coalesce(1).write.mode("append").parquet(incoming)
        merge_plans(spark, incoming, part.schema, str(tmp_path / "c"), root).awaitTermination(120)
    got = sorted((r.tile_id, r.granule_key, r.granule_hash) for r in spark.read.parquet(root).collect())
    assert got == [("A", "g", "2"), ("A", "h", "1"), ("B", "g", "1")]


def test_broken_off_merge_is_made_good(spark, tmp_path, monkeypatch):
    from shotlake.streaming import intake

    incoming, root = str(tmp_path / "in"), str(tmp_path / "plan")
    plan_rows(spark, ("A", "g", "1", 1), ("A", "k", "1", 1)).coalesce(1).write.parquet(incoming)
    merge_plans(spark, incoming, spark.read.parquet(incoming).schema, str(tmp_path / "c"), root).awaitTermination(120)
    plan_rows(spark, ("A", "g", "2", 2)).coalesce(1).write.mode("append").parquet(incoming)

    def broken(df, at):
        lake.remove(spark, f"{at}/tile_id=A")  # as if it had ended between deleting and writing
        raise RuntimeError("broken off")

    with monkeypatch.context() as m:
        m.setattr(intake, "write_plan", broken)
        with pytest.raises(Exception, match="broken off"):
            merge_plans(spark, incoming, spark.read.parquet(incoming).schema, str(tmp_path / "c"), root).awaitTermination(120)
    merge_plans(spark, incoming, spark.read.parquet(incoming).schema, str(tmp_path / "c"), root).awaitTermination(120)
    assert sorted((r.granule_key, r.granule_hash) for r in spark.read.parquet(root).collect()) == [("g", "2"), ("k", "1")]
