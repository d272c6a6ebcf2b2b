"""What only larger tables or longer keys bring out."""

import duckdb
import pytest
from pyspark.sql import functions as F

from shotlake.functions.granules import NAME_PARTS, granule_key, name_part, parse_name, start_time
from shotlake.operators import maintain
from shotlake.queries import ORACLE_SQL, QUERIES


def same(spark, folder, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    told = lambda frame: sorted(map(str, frame[sorted(frame.columns)].astype(object).where(frame.notna(), None).itertuples(index=False, name=None)))
    got, want = QUERIES[name](spark, str(folder)).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert len(want) and sorted(got.columns) == sorted(want.columns) and told(got) == told(want)


@pytest.fixture(scope="module")
def long_orbits(spark, tmp_path_factory):
    """Orders whose granules have orbits of five and six digits, which names of five digits don't tell apart."""
    folder, first = tmp_path_factory.mktemp("long"), 16 * (337600 - 33760)
    keys = spark.range(0, 160).union(spark.range(first, first + 640)).withColumnRenamed("id", "o_orderkey")
    keys.select("o_orderkey", F.lit(1000.5).alias("o_totalprice"), F.lit("1997-03-04").cast("timestamp").alias("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
    spark.range(0, 700).withColumnRenamed("id", "c_custkey").write.parquet(f"{folder}/customer.parquet")
    return folder


@pytest.mark.parametrize("name", ["granule_catalog", "tile_granule_plan", "granule_listing"])
def test_granules_of_one_key_stay_apart(spark, long_orbits, name):
    same(spark, long_orbits, name, ("orders", "customer"))


def test_name_parts_found_at_once(spark):
    """Against a search for each part."""
    good = "GEDI02_A_2019123053258_O33760_01_T02132_02_003_01_V002"
    df = spark.createDataFrame([(good,), ("x" + good + ".h5",), (good[:-1] + "a",), ("other",), ("",), (None,)], "name string")
    name = F.col("name")
    parts = [F.nullif(name_part(name, n), F.lit("")).alias(n) for n in NAME_PARTS]
    orbit = F.concat(F.nullif(name_part(name, "orbit"), F.lit("")), F.lit("_"), name_part(name, "sub_orbit_granule"))
    for found, want in zip(df.select(parse_name(name).alias("p"), granule_key(name).alias("k"), start_time(name).cast("string").alias("t")).collect(), df.select(*parts, orbit.alias("k")).collect()):
        assert [found["p"][n] if found["p"] else None for n in NAME_PARTS] == list(want)[:-1] and found["k"] == want["k"]
        assert found["t"] == ("2019-05-03 05:32:58" if want["k"] else None)


def test_covered_joins_each_tile_once(spark):
    """A tile's shots aren't one key's work: what is joined has been reduced to tiles."""
    shots = spark.range(0, 1000).select((F.col("id") % 2).cast("string").alias("tile_id"))
    assert maintain.is_covered(shots, shots.where("tile_id < '9'")) and not maintain.is_covered(shots, shots.where("tile_id = '1'"))


def test_short_ways_are_bent(spark):
    """Up to a kilometre: as along the ellipsoid, at every latitude and direction, and without its steps in the plan."""
    from shotlake.functions.geometry import with_distance
    from shotlake.operators.crossovers import SHORT_M, pairs_within

    n = F.col("id")
    points = spark.range(0, 600).select(n.alias("shot_number"), ((n % 30) * 6.2 - 89.9 + (F.floor(n / 30) * 7919 % 101) * 2e-5).alias("lat_lowestmode"), (170 + (n % 30) * 0.3 + (F.floor(n / 30) * 31 % 97) * 5e-5).alias("lon_lowestmode"))
    found = pairs_within(points, SHORT_M)
    assert "ATAN2" not in found._jdf.queryExecution().optimizedPlan().toString().upper()
    both = with_distance(found.withColumnRenamed("distance_m", "d"), *[f"t{i}_{c}_lowestmode" for i in (1, 2) for c in ("lat", "lon")])
    count, most = both.agg(F.count("*"), F.max(F.abs(F.col("d") - F.col("distance_m")))).first()
    assert count > 3000 and most < 2e-7
    beyond = pairs_within(points, SHORT_M + 1e-6)
    assert beyond.count() == count and "ATAN2" in beyond._jdf.queryExecution().optimizedPlan().toString().upper()


def test_only_points_in_a_regions_extent_meet_its_edges(spark):
    """Boxes are compared first, so that a tile that many regions meet doesn't ask the edges of all of them for each point."""
    from shotlake.operators import spatial

    n = F.col("id")
    ring = lambda x, y: F.array(*[F.struct((x + F.lit(a)).alias("x"), (y + F.lit(b)).alias("y")) for a, b in ((0.0, 0.0), (0.06, 0.01), (0.03, 0.07), (0.0, 0.0))])
    regions = spark.range(0, 100).select(n.alias("region_id"), F.array(ring(n % 10 * 0.1 - 0.05, F.floor(n / 10) * 0.1 - 0.05)).alias("rings"))
    points = spark.range(0, 4000).select(n.alias("p"), (n * 7919 % 3989 / 3989).alias("lon_lowestmode"), (n * 104729 % 3967 / 3967).alias("lat_lowestmode"))
    found = spatial.within_regions(points, regions)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join Inner" in line and "filter(_near" in line]
    assert len(joins) == 2 and all(line.find("_box#") < line.find("filter(_near") and "_box#" in line for line in joins)
    got = sorted((r.p, r.region_id) for r in found.select("p", "region_id").collect())
    want = []
    for p, x, y in points.collect():
        for r in range(100):
            u, v = x - (r % 10 * 0.1 - 0.05), y - (r // 10 * 0.1 - 0.05)
            if 0.06 * v - 0.01 * u > 0 and -0.03 * (v - 0.01) - 0.06 * (u - 0.06) > 0 and -0.03 * v + 0.07 * u > 0:
                want.append((p, r))
    assert len(want) > 500 and got == want


def test_shots_of_one_place_are_compared_once(spark, monkeypatch):
    """Places are joined, and only those that are near each other become pairs of their shots."""
    from shotlake.operators import crossovers

    monkeypatch.setattr(crossovers, "MEMBERS", 3)
    n = F.col("id")
    # 40 places some 10 m apart, of one to eight shots; a number that comes again elsewhere, and a place of either zero
    rows = [(int(r.n), float(r.lat), float(r.lon), float(r.n) / 7) for r in spark.range(0, 180).select(n.alias("n"), (n * n % 40 * 9e-5).alias("lat"), F.lit(1.5).alias("lon")).collect()]
    rows += [(7, 9e-5, 1.5, 1.0), (900, 0.0, 1.5, 900 / 7), (901, -0.0, 1.5, 901 / 7)]
    points = spark.createDataFrame(rows, "shot_number long, lat_lowestmode double, lon_lowestmode double, v double")
    found = crossovers.pairs_within(points, 40.0, ["v"], digits=1)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= text.find("Generate explode(q_shots") < text.find("Join Inner")
    metre = 110574.3  # of latitude at the equator, a degree
    want = sorted((a[0], b[0], a[1], b[1], a[3], b[3]) for a in rows for b in rows if a[0] < b[0] and abs(a[1] - b[1]) * metre <= 40)
    got = found.collect()
    assert len(want) > 1000 and sorted((r.t1_shot_number, r.t2_shot_number, r.t1_lat_lowestmode, r.t2_lat_lowestmode, r.t1_v, r.t2_v) for r in got) == want
    assert all(abs(r.distance_m - abs(r.t1_lat_lowestmode - r.t2_lat_lowestmode) * metre) < 0.06 for r in got)


@pytest.mark.parametrize("most", [16_384, 5])
def test_pairs_are_counted_without_being_made(spark, monkeypatch, most):
    """Against the pairs: crowded places, cubes in parts, both sides of a cube's edge, a number that comes twice."""
    from shotlake.operators import crossovers

    monkeypatch.setattr(crossovers, "MEMBERS", 4)
    monkeypatch.setattr(crossovers, "MOST_PLACES", most)
    n = F.col("id")
    points = spark.range(0, 900).select((n * 7 % 890).alias("shot_number"), (-4.0 + n * 7919 % 23 * 7e-5).alias("lat_lowestmode"), (-63.0 + n * 104729 % 29 * 8e-5).alias("lon_lowestmode"))
    points = points.unionByName(spark.createDataFrame([(5000, 40.0, 40.0), (5001, None, 1.0)], points.schema))
    made = []
    kept = crossovers.pairs_within
    want = kept(points).groupBy("t1_shot_number").agg(F.count("*").alias("n"), F.max("distance_m").alias("farthest"))
    want = {tuple(r) for r in want.select("t1_shot_number", "n", "farthest").collect()}
    monkeypatch.setattr(crossovers, "pairs_within", lambda *a: made.append(a) or kept(*a))
    got = [tuple(r) for r in crossovers.counts_within(points).select("t1_shot_number", "n", "farthest").collect()]
    assert not made and len(got) > 500 and len(set(got)) == len(got) and set(got) == want
