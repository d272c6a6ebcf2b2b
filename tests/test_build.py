"""Assembly in one shuffle, stored product tables, and the lake's build while files arrive."""

import re

import pytest
from pyspark.sql import functions as F

from shotlake.operators import build
from shotlake.schema import product_schema
from shotlake.sources.products import one_of_each, read_product, write_product
from shotlake.streaming import intake
from shotlake.streaming.intake import build_tiles

KEPT = {"level2A": ["delta_time"], "level2B": ["pai", "dz"], "level4A": ["agbd"]}
YEAR = 31_536_000.0


def table(spark, product, *rows):
    """rows: (granule, beam, shot, lat, lon, values...)."""
    schema = product_schema(product)
    fields = ["granule_key", "beam_name", "shot_number", "lat_lowestmode", "lon_lowestmode", *KEPT[product]]
    return spark.createDataFrame(list(rows), type(schema)([schema[f] for f in fields]))


def plan_of(spark, *rows):
    return spark.createDataFrame([(t, g, *[f"s3://{p}" if p in have else None for p in KEPT]) for t, g, have in rows], "tile_id string, granule_key string, " + ", ".join(f"{p}_url string" for p in KEPT))


ALL = ("level2A", "level2B", "level4A")


def tables(spark):
    shots = [(g, f"BEAM{s % 2}", s, 0.5, 0.5 + t) for g, t in (("g", 0), ("h", 1), ("i", 0)) for s in range(1, 5)]
    two = {"level2A": table(spark, "level2A", *[(*r, 0.0 if r[0] != "i" else YEAR) for r in shots]), "level2B": table(spark, "level2B", *[(*r, float(r[2]), 7.0 + r[2] % 2) for r in shots if r[2] != 2]), "level4A": table(spark, "level4A", *[(*r, 10.0 * r[2]) for r in shots])}
    return two, plan_of(spark, ("N01_E000", "g", ALL), ("N01_E001", "h", ALL[1:]), ("N01_E000", "i", ALL[:2]), ("N01_E005", "g", ALL))


def facts(df):
    return sorted((r.granule, r.tile_id, r.shot_number, r.beam_name, r.year, r.pai, r.dz, r.agbd) for r in df.collect())


def wanted():
    of = lambda g, t, year, agbd: [(g, t, s, f"BEAM{s % 2}", year, float(s), 8.0, 10.0 * s if agbd else None) for s in (1, 3, 4)]
    return sorted(of("g", "N01_E000", 2018, True) + of("h", "N01_E001", None, True) + of("i", "N01_E000", 2019, False), key=str)


def exchanged(df):
    """Of each exchange that isn't of the plan: what it deals by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r" Exchange (hashpartitioning\([^)]*shot_number|hashpartitioning\([^)]*part#|rangepartitioning|RoundRobin)", plan), plan


def test_assembly_moves_products_once(spark):
    products, plan = tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = build.assemble(products, plan)
        found, text = exchanged(got)
        # one for the products' rows, one for the plan that meets them
        assert len(found) == 2 and text.count("REPARTITION_BY_COL") == 1 and text.count("SortMergeJoin [tile_id") == 1
        assert sorted(facts(got), key=str) == wanted()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(facts(build.assemble(products, plan)), key=str) == wanted()


def test_repeated_shots_count_once_and_ancillary_is_the_last_beams(spark):
    a = table(spark, "level2A", ("g", "B0", 1, 0.5, 0.5, 1.0), ("g", "B0", 1, 0.5, 0.5, 1.0), ("g", "B0", 1, 0.5, 0.5, float("nan")))
    b = table(spark, "level2B", ("g", "B0", 1, 0.5, 0.5, 1.0, 3.0), ("g", "B9", 2, 7.5, 0.5, 1.0, 4.0), ("h", "B9", 3, 0.5, 0.5, 1.0, None))
    plan = plan_of(spark, ("N01_E000", "g", ALL[:2]), ("N01_E000", "h", ALL[1:2]))
    rows = build.assemble({"level2A": a, "level2B": b}, plan).collect()
    # h's last beam has no value: its rows aren't whole
    assert [(r.shot_number, r.dz, r.delta_time) for r in rows] == [(1, 4.0, 1.0)]


def test_stored_products_stay_where_they_are(spark, tmp_path):
    products, plan = tables(spark)
    products["level2B"] = products["level2B"].unionByName(products["level2B"])
    names = {p: f"stored_{p}" for p in products}
    for p, df in products.items():
        write_product(df, p, names[p], str(tmp_path / p), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        whole = {p: spark.table(t) for p, t in names.items()}
        got = build.assemble_stored(whole, plan)
        found, text = exchanged(got)
        assert found == [] and text.count("SortMergeJoin [tile_id") >= 3 and "Bucketed: true" in text
        assert sorted(facts(got), key=str) == wanted()
        one = build.assemble_stored({p: read_product(spark, t, ["N01_E001"]) for p, t in names.items()}, plan.where("tile_id = 'N01_E001'"), whole)
        assert sorted(facts(one), key=str) == [r for r in wanted() if r[1] == "N01_E001"]
        pushed = read_product(spark, names["level2A"], ["N01_E001"])._jdf.queryExecution().executedPlan().toString()
        assert all(x in pushed for x in ("GreaterThanOrEqual(lon_lowestmode,1.0)", "LessThan(lon_lowestmode,2.0)", "GreaterThan(lat_lowestmode,0.0)", "LessThanOrEqual(lat_lowestmode,1.0)"))
        assert build.assemble_stored(whole, plan.limit(0)).count() == 0 and read_product(spark, names["level2A"], []).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        for t in names.values():
            spark.sql(f"DROP TABLE {t}")


def arrive(spark, tmp_path, products, plan):
    for p, df in products.items():
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{p}")
    schemas = {p: type(product_schema(p))([product_schema(p)[f] for f in ["granule_key", "beam_name", "shot_number", "lat_lowestmode", "lon_lowestmode", *KEPT[p]]]) for p in KEPT}
    build_tiles(spark, f"{tmp_path}/in", schemas, f"{tmp_path}/seen", plan, f"{tmp_path}/lake").awaitTermination(300)


def stored(spark, tmp_path):
    return facts(spark.read.schema("shot_number long, beam_name string, granule string, pai float, dz float, agbd double, tile_id string, year int").parquet(f"{tmp_path}/lake"))


def test_batches_that_share_tiles_and_years_lose_nothing(spark, tmp_path):
    products, plan = tables(spark)
    for n in (0, 1):
        arrive(spark, tmp_path, {p: df.where(f"shot_number % 2 = {n}") for p, df in products.items()}, plan)
    assert sorted(stored(spark, tmp_path), key=str) == wanted()
    arrive(spark, tmp_path, products, plan)  # the same files again
    assert sorted(stored(spark, tmp_path), key=str) == wanted()


def test_late_products_complete_their_shots(spark, tmp_path):
    products, plan = tables(spark)
    arrive(spark, tmp_path, {"level2A": products["level2A"], "level4A": products["level4A"].where("granule_key <> 'h'")}, plan)
    arrive(spark, tmp_path, {"level2B": products["level2B"].where("shot_number <> 3")}, plan)
    assert [r[:3] for r in stored(spark, tmp_path)] == [(g, t, s) for g, t in (("g", "N01_E000"), ("i", "N01_E000")) for s in (1, 4)]
    # the last beam of each granule comes late, and with it the value of all its rows
    assert {r[6] for r in stored(spark, tmp_path)} == {8.0}
    arrive(spark, tmp_path, {"level2B": products["level2B"].where("shot_number = 3").withColumn("dz", F.lit(9.0).cast("float")).withColumn("beam_name", F.lit("BEAM7")), "level4A": products["level4A"].where("granule_key = 'h'")}, plan)
    assert [r[:3] for r in stored(spark, tmp_path)] == [r[:3] for r in sorted(wanted(), key=str)] and {r[6] for r in stored(spark, tmp_path)} == {9.0}


def test_a_granule_that_leaves_a_year_leaves_no_rows_there(spark, tmp_path):
    products, plan = tables(spark)
    plan = plan.where("granule_key = 'g'")
    arrive(spark, tmp_path, products, plan)
    arrive(spark, tmp_path, {"level2A": products["level2A"].withColumn("delta_time", F.lit(3 * YEAR))}, plan)
    assert {r[4] for r in stored(spark, tmp_path)} == {2020} and len(stored(spark, tmp_path)) == 3


def test_a_build_that_was_broken_off_is_made_good(spark, tmp_path, monkeypatch):
    products, plan = tables(spark)
    arrive(spark, tmp_path, {p: df.where("shot_number % 2 = 0") for p, df in products.items()}, plan)
    kept, calls = intake.write_lake, []

    def broken(df, at, *more):
        if at.endswith("/lake"):
            calls.append(at)
            intake.remove(spark, f"{at}/tile_id=N01_E000")  # as if it had ended between deleting and writing
            raise RuntimeError("broken off")
        kept(df, at, *more)

    with monkeypatch.context() as m:
        m.setattr(intake, "write_lake", broken)
        with pytest.raises(Exception, match="broken off"):
            arrive(spark, tmp_path, {p: df.where("shot_number % 2 = 1") for p, df in products.items()}, plan)
    arrive(spark, tmp_path, {}, plan)
    assert calls and sorted(stored(spark, tmp_path), key=str) == wanted()


def test_a_batch_is_dealt_once_and_unready_granules_are_not_read(spark, tmp_path, monkeypatch):
    products, plan = tables(spark)
    assembled, made, calls = [], intake.assemble, []
    write = lambda df, at, *more: (calls.append((at, df, more)), kept(df, at, *more))
    kept = intake.write_lake
    with monkeypatch.context() as m:
        m.setattr(intake, "assemble", lambda t, p, *more: assembled.append((t, p.count(), {r[0] for df in t.values() for r in df.select("granule_key").distinct().collect()})) or made(t, p, *more))
        m.setattr(intake, "write_lake", write)
        # h lacks a product that is due
        arrive(spark, tmp_path, {"level2A": products["level2A"], "level2B": products["level2B"], "level4A": products["level4A"].where("granule_key <> 'h'")}, plan)
    assert assembled[0][1:] == (3, {"g", "i"})
    assert sorted(stored(spark, tmp_path), key=str) == [r for r in wanted() if r[0] != "h"]
    # neither what is staged nor the lake is shuffled for being written
    assert [at.rpartition("/")[2] for at, _, _ in calls] == ["new", "lake"] and all(more == (None, False) for _, _, more in calls)
    arrive(spark, tmp_path, {"level4A": products["level4A"].where("granule_key = 'h'")}, plan)
    assert sorted(stored(spark, tmp_path), key=str) == wanted()


def test_a_crowded_tile_is_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(build, "SPLIT_SHOTS", 2)
    products, plan = tables(spark)
    splits = build.tile_splits(build.row_counts(products))
    assert {r.tile_id: r.splits for r in splits.collect()} == {"N01_E000": 4, "N01_E001": 2}
    got = build.assemble(products, plan, splits)
    assert sorted(facts(got), key=str) == wanted()
    monkeypatch.setattr(build, "MOST_SENT", 1)
    assert sorted(facts(build.assemble(products, plan, splits)), key=str) == wanted()


def test_products_that_are_dealt_by_key_stay_where_they_are(spark):
    from shotlake import queries

    sf = "/root/testdata/sf0.001"
    dealt, others = queries.products(spark, sf, dealt=True), queries.products(spark, sf)
    for p in dealt:
        got, want = one_of_each(dealt[p], p, None), one_of_each(others[p], p, 4)
        text = got._jdf.queryExecution().executedPlan().toString()
        # the orders' exchange, before they become shots
        assert text.count("Exchange hashpartitioning(tile_id") == text.count("Exchange ") == 1
        assert sorted(got.columns) == sorted(want.columns)
        told = lambda df: sorted(map(str, df.select(sorted(got.columns)).collect()))  # noqa: B023, E731
        assert got.count() > 1000 and told(got) == told(want)


def test_partitions_without_a_batchs_granules_keep_their_files(spark, tmp_path):
    """New granules of a tile and year are put beside those that are there; only what is replaced is written anew."""
    products, plan = tables(spark)
    of = lambda *g: {p: df.where(F.col("granule_key").isin(*g)) for p, df in products.items()}
    products["level2A"] = products["level2A"].withColumn("delta_time", F.lit(0.0))
    files = lambda: {str(f.relative_to(tmp_path / "lake")): f.stat().st_mtime_ns for f in (tmp_path / "lake").rglob("*.parquet")}
    arrive(spark, tmp_path, of("g"), plan)
    first = files()
    arrive(spark, tmp_path, of("i"), plan)
    second = files()
    assert first and first.items() < second.items() and {f.rpartition("/")[0] for f in second} == {"tile_id=N01_E000/year=2018"}
    assert {r[0] for r in stored(spark, tmp_path)} == {"g", "i"} and len(stored(spark, tmp_path)) == 6
    arrive(spark, tmp_path, of("i"), plan)  # again: now its partition holds it
    assert not second.keys() & files().keys() and len(stored(spark, tmp_path)) == 6


def test_files_that_were_moved_in_part_are_moved_to_the_end(spark, tmp_path, monkeypatch):
    products, plan = tables(spark)
    kept, calls = intake.add_files, []

    def broken(session, staged, root, apart=()):
        calls.append(staged)
        kept(session, staged, root, {"tile_id=N01_E001/year=__HIVE_DEFAULT_PARTITION__"})
        raise RuntimeError("broken off")

    with monkeypatch.context() as m:
        m.setattr(intake, "add_files", broken)
        with pytest.raises(Exception, match="broken off"):
            arrive(spark, tmp_path, products, plan)
    assert {r[0] for r in stored(spark, tmp_path)} == {"g", "i"}
    arrive(spark, tmp_path, {}, plan)
    assert calls and sorted(stored(spark, tmp_path), key=str) == wanted()


def test_a_profile_is_whole_without_null_or_nan_bins(spark):
    nan = float("nan")
    rows = [([1.0, 2.0],), ([],), ([1.0, nan],), ([1.0, None],), ([nan, None],), ([None],), (None,), ([float("inf")],)]
    df = spark.createDataFrame(rows, "rh array<float>")
    found = df.select(build.whole(df, ["rh"]).alias("w"))
    assert [r.w for r in found.collect()] == [True, True, False, False, False, False, False, True]
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
