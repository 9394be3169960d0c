"""Derived tables, gates, rasterisation with resume, and the ledger."""

import shutil

import pytest
from conftest import COLUMNS, ROWS, frame, mapped_cells
from pyspark.sql import functions as F

from loamgrid.model.variables import resolve, variable
from loamgrid.operators import compare, lookup, sampling
from loamgrid.operators.properties import horizon_properties
from loamgrid.plans import derived, gates, ledger
from loamgrid.plans import rasterize as rz
from loamgrid.sources import pixels as px

TILE = 16


@pytest.fixture(scope="module")
def built(spark, soil, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("built"))
    report = derived.build(spark, soil, base, "run1")
    read = lambda n: derived.read_published(spark, base, n)
    names = ["valu1", "soil_properties", "map_unit_properties", "texture_classes", "horizon_diagnostics", "terrain_audit"]
    return {"report": report, "tables": derived.published(spark, base), "base": base, **{n: read(n) for n in names}}


@pytest.fixture(scope="module")
def tiled(raster):
    return px.with_tiles(raster, TILE).persist()


def test_build_publishes_tables_that_pass(built):
    rows = built["report"].collect()
    assert len(rows) == 12 and all(r["passed"] for r in rows)
    assert built["valu1"].columns == ["mukey", *derived.VALU1_COLUMNS] and len(derived.VALU1_COLUMNS) == 57
    assert built["soil_properties"].count() == 4 * 11 and len(built["soil_properties"].columns) == 26
    unit = built["map_unit_properties"].where("mukey = 7101").first()
    assert unit["droughty"] == 1 and unit["texture_class"] == 3 and unit["slope"] == 7
    record = {r["table_name"]: r for r in built["tables"].collect()}
    assert record["valu1"]["rows"] == 4 and record["valu1"]["source"] == "run1" and len(record) == 6
    assert built["horizon_diagnostics"].where("mukey = 7101 and property = 'ksat' and depth_interval = '0_100'").first()[
        "contributing_component_percent"] == 45


def test_a_crash_before_the_pointer_leaves_the_old_release_whole(spark, soil, built, tmp_path, monkeypatch):
    base = str(tmp_path)
    shutil.copytree(built["base"], base, dirs_exist_ok=True)
    before = {n: derived.read_published(spark, base, n).exceptAll(built[n]).count() for n in ("valu1", "texture_classes")}
    steeper = {**soil, "component": soil["component"].withColumn("slope_r", F.col("slope_r") + 1)}
    real = derived.point_to

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(derived, "point_to", lost)
        derived.build(spark, steeper, base, "run2")
    assert derived.point_to is real and before == {"valu1": 0, "texture_classes": 0}
    slope = lambda: derived.read_published(spark, base, "map_unit_properties").where("mukey = 7101").first()["slope"]
    assert slope() == 7 and {r["source"] for r in derived.published(spark, base).collect()} == {"run1"}
    with pytest.raises(derived.BuildError, match="published"):
        derived.build(spark, steeper, base, "run1")
    derived.build(spark, steeper, base, "run2")
    assert slope() == 8 and derived.published(spark, base).count() == 6
    broken = {**soil, "chorizon": soil["chorizon"].withColumn("awc_r", F.lit(-1.0))}
    with pytest.raises(gates.GateError):
        derived.build(spark, broken, base, "run3")
    assert slope() == 8
    with pytest.raises(derived.BuildError, match="nothing"):
        derived.published(spark, str(tmp_path / "none"))


def test_two_ways_to_the_soil_table_agree(soil, built):
    other = derived.merge_summary(built["valu1"], horizon_properties(soil["component"], soil["chorizon"])[0])
    a = built["soil_properties"].select(sorted(other.columns))
    rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    assert rounded(a).exceptAll(rounded(other.select(sorted(other.columns)))).count() == 0


def test_unlisted_map_unit_keeps_properties_without_stocks(soil):
    fewer = {**soil, "mapunit": soil["mapunit"].where("mukey <> 7303")}
    rows = {r["depth_interval"]: r for r in derived.soil_properties(fewer).where("mukey = 7303").collect()}
    assert rows["0_5"]["aws"] is None and rows["0_5"]["organic_matter"] == 2.0 and "150_profile" not in rows
    assert rows["100_150"]["aws"] is None and rows["100_150"]["awc"] == 0.05
    assert derived.valu1(fewer).where("mukey = 7303").count() == 0


def test_gates_catch_bad_values(built):
    bad = built["soil_properties"].withColumn("aws", F.lit(-1.0)).withColumn("sand", F.col("sand") + 9)
    report = {r["check_name"]: r for r in gates.soil_checks(bad.unionByName(bad.limit(1))).collect()}
    assert not report["aws_nonnegative"]["passed"] and not report["particle_size_closure"]["passed"]
    assert report["soil_unique_key"]["violations"] == 1 and report["soc_nonnegative"]["passed"]
    with pytest.raises(gates.GateError):
        gates.require_gates(gates.soil_checks(bad))
    empty = {r["check_name"]: r for r in gates.soil_checks(built["soil_properties"].limit(0)).collect()}
    assert empty["particle_size_closure"]["passed"]


def test_rasterize_values_and_fills(built, raster):
    flags = lookup.rasterize(raster, built["map_unit_properties"], variable("droughty"))
    assert dict(flags.dtypes)["value"] == "smallint"
    got = {r["mukey"]: r["value"] for r in flags.select("mukey", "value").distinct().collect()}
    assert got == {7101: 1, 7202: 255, 7303: 0, 7404: 1, 8888: 255, 9999: 255}
    aws = lookup.rasterize(raster, built["soil_properties"], variable("aws"), "0_100")
    got = {r["mukey"]: r["value"] for r in aws.select("mukey", "value").distinct().collect()}
    assert got[7101] == pytest.approx(114.5) and got[7202] is None and got[8888] is None
    with pytest.raises(lookup.LookupTableError):
        lookup.rasterize(raster, built["soil_properties"], variable("aws"))


def test_lookup_plan_does_not_shuffle_pixels(built, raster):
    plan = lookup.rasterize(raster, built["map_unit_properties"], variable("slope"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # of the value rows, one per map unit
    build_side = plan[plan.index("BroadcastExchange"):]
    assert "Exchange hashpartitioning" in build_side


def test_unmatched_keys(built, raster):
    unmatched = lookup.unmatched_keys(raster, built["map_unit_properties"])
    assert sorted(r["mukey"] for r in unmatched.collect()) == [8888, 9999]
    assert lookup.unmatched_report(unmatched).first()["unmatched_mukey_count"] == 2
    with pytest.raises(lookup.LookupTableError):
        lookup.require_lookup(built["soil_properties"], ["mukey"], "soil")


def test_pairs_resume_and_stay_idempotent(spark, built, tiled, tmp_path, monkeypatch):
    store = rz.Store(spark, str(tmp_path), TILE)
    soil_table, units = built["soil_properties"], built["map_unit_properties"]
    v = variable("aws")
    real, calls = rz.write_cells, []

    def failing(cells, *rest):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        real(cells, *rest)

    monkeypatch.setattr(rz, "write_cells", failing)
    with pytest.raises(RuntimeError):
        rz.rasterize_pair(store, "test", v, tiled, soil_table, "2026-02-13", tiles_per_commit=1)
    assert ledger.pair_state(store.ledger()).first()["complete"] is False
    done = len(calls) - 1
    assert rz.rasterize_pair(store, "test", v, tiled, soil_table, "2026-02-13", tiles_per_commit=1)
    assert len(calls) == done + 1 + (5 - done)  # five bands of tiles, none written twice
    assert not rz.rasterize_pair(store, "test", v, tiled, soil_table, "2026-02-13")
    once = store.read(v).count()
    assert once == mapped_cells() * 11
    same = compare.value_equality(store.read(v), soil_table, v).first()
    assert (same["compared"], same["mismatches"], same["status"]) == (once, 0, "passed")
    changed = soil_table.withColumn("aws", F.when((F.col("mukey") == 7101) & (F.col("depth_interval") == "0_5"), F.col("aws") + 40).otherwise(F.col("aws")))
    cells = store.read(v).where("mukey = 7101 and depth_interval = '0_5'").count()
    assert compare.value_equality(store.read(v), changed, v).first()["mismatches"] == cells > 0
    with pytest.raises(Exception, match="lookup keys repeat"):
        compare.value_equality(store.read(v), soil_table.unionByName(soil_table), v).first()
    assert rz.rasterize_pair(store, "test", v, tiled, soil_table, "2026-02-13", overwrite=True)
    assert store.read(v).count() == once
    record = ledger.provenance(store.ledger()).first()
    assert record["run_no"] == 2 and record["unmatched_mukey_count"] == 2 and record["algorithm_id"] == "valu1_aws"
    with pytest.raises(rz.LayoutError):
        rz.rasterize_pair(rz.Store(spark, str(tmp_path), 8), "test", v, tiled, soil_table, "2026-02-13", overwrite=True)

    assert rz.rasterize_all(store, ["test"], ["mukey", "texture_class"], tiled, soil_table, units, "2026-02-13") == 2
    stored_key = store.read(variable("mukey"))
    regions = spark.createDataFrame([("test",), ("other",)], "region string")
    verdicts = {r["region"]: r["status"] for r in compare.key_equality(stored_key, tiled, regions).collect()}
    assert verdicts == {"test": "passed", "other": compare.UNDERSAMPLED}
    assert compare.value_equality(store.read(variable("texture_class")), units, variable("texture_class")).first()["status"] == "passed"
    broken = stored_key.withColumn("mukey", F.when(F.col("row_no") == 5, F.col("mukey") + 1).otherwise(F.col("mukey")))
    assert compare.key_equality(broken, tiled, regions.where("region = 'test'")).first()["mismatches"] == mapped_cells([5])
    every = [v.name for v in resolve(None)]
    matrix = {r["region"]: r for r in ledger.completion_matrix(regions, every, store.ledger()).collect()}
    assert matrix["test"]["done"] == 3 and matrix["test"]["state"] == "3/43" and matrix["other"]["state"] == "not started"
    with pytest.raises(ledger.IncompleteError):
        ledger.require_complete(regions, every, store.ledger())
    finished = spark.createDataFrame([("test",)], "region string"), ["mukey"]
    assert [rz.release(store, *finished, "2026-02-13") for _ in range(2)] == ["2026-02-13", "2026-02-13-r2"]
    with pytest.raises(ledger.IncompleteError):
        rz.release(store, regions, every, "2026-02-13")


def broken_off(monkeypatch, at, *args, **kw):
    """Run a pair and lose it at the given write."""
    real, calls = rz.write_cells, []

    def failing(cells, *rest):
        calls.append(1)
        if len(calls) == at:
            raise RuntimeError("lost")
        real(cells, *rest)

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(rz, "write_cells", failing)
        rz.rasterize_pair(*args, tiles_per_commit=1, **kw)


@pytest.mark.parametrize("first, second", [(32, 16), (16, 32)])
def test_resume_under_another_tile_size(spark, built, raster, tmp_path, monkeypatch, first, second):
    units, v = built["map_unit_properties"], variable("slope")
    a, b = rz.Store(spark, str(tmp_path), first), rz.Store(spark, str(tmp_path), second)
    broken_off(monkeypatch, 2, a, "test", v, px.with_tiles(raster, first), units, "d1")
    assert rz.rasterize_pair(b, "test", v, px.with_tiles(raster, second), units, "d1")
    assert b.read(v).count() == px.mapped(raster).count()
    assert sorted(r["mukey"] for r in b.unmatched().collect()) == [8888, 9999]


def test_changed_values_and_fewer_tiles_leave_nothing_behind(spark, built, tiled, tmp_path, monkeypatch):
    units, v = built["map_unit_properties"], variable("slope")
    store = rz.Store(spark, str(tmp_path), TILE)
    rz.rasterize_pair(store, "test", v, tiled, units, "d1")
    steeper = units.withColumn("slope", F.col("slope") + 1)
    broken_off(monkeypatch, 2, store, "test", v, tiled, units, "d1", overwrite=True)
    assert compare.value_equality(store.read(v), units, v).first()["status"] == "passed"
    assert rz.rasterize_pair(store, "test", v, tiled, steeper, "d2", overwrite=True)
    assert compare.value_equality(store.read(v), steeper, v).first()["status"] == "passed"
    assert ledger.provenance(store.ledger()).first()["release_date"] == "d2"
    top = tiled.where("tile_y = 0")
    assert rz.rasterize_pair(store, "test", v, top, steeper, "d3", overwrite=True)
    assert store.read(v).count() == px.mapped(top).count() > 0


def test_no_shuffle_after_the_intervals(built, tiled):
    cells = rz.values_at(tiled.repartition("region", "tile_y", "tile_x"), built["soil_properties"], variable("aws"))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate")] and "Exchange" in plan


def test_pairs_are_named_without_a_join(spark):
    regions = spark.createDataFrame([("test",)], "region string")
    plan = ledger.wanted_pairs(regions, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert ledger.wanted_pairs(regions, []).count() == 0


def test_comparing_nothing_fails(spark):
    counts = spark.createDataFrame([("a", 0, 0), ("b", 5, 0), ("c", 5, 1)], "check_name string, compared bigint, mismatches bigint")
    got = {r["check_name"]: (r["status"], r["passed"]) for r in compare.check_status(counts).collect()}
    assert got == {"a": ("insufficient sampling", False), "b": ("passed", True), "c": ("failed", False)}
    assert all(r["passed"] for r in compare.check_status(counts, source_available=False).collect())


def test_samples_depend_on_the_seed_only(raster):
    pick = lambda df, seed: {tuple(r) for r in sampling.pixel_sample(df, 50, seed).select("row_no", "col_no").collect()}
    a = pick(raster.repartition(1), 7)
    assert len(a) == 50 and a == pick(raster.repartition(8), 7) and a != pick(raster, 8)
    tiles = sampling.tile_sample(raster, 3, 7, TILE)
    assert tiles.select("tile_y", "tile_x").distinct().count() == 3


def test_point_and_profile(spark, built, raster):
    grid = spark.createDataFrame([("test", ROWS, COLUMNS, 1000.0, 2000.0, 30.0)], "region string, height int, width int, x_min double, y_max double, pixel_size double")
    points = spark.createDataFrame([(1, "test", 1000 + 30 * 50 + 1.0, 2000 - 30 * 41 - 1.0), (2, "test", 0.0, 0.0)], "id int, region string, x double, y double")
    hit = lookup.keys_at(points, raster, grid).collect()
    found = {r["id"]: (r["row_no"], r["col_no"], r["mukey"]) for r in hit}
    assert len(hit) == 2 and found == {1: (41, 50, 7101), 2: (None, None, None)}
    profile = lookup.depth_profiles(points, raster, grid, built["soil_properties"], ["aws", "ph"]).collect()
    assert len(profile) == 22 and all(r["aws"] is None for r in profile if r["id"] == 2)


def test_duplicate_lookup_key_is_refused(spark):
    twice = frame(spark, "mapunit", [dict(mukey=1), dict(mukey=1), dict()])
    assert lookup.repeated_lookup_keys(twice, ["mukey"]).count() == 1
    values = twice.select("mukey", F.lit(1.0).alias("slope"))
    with pytest.raises(Exception, match="lookup keys repeat"):
        lookup.lookup_table(values, variable("slope")).collect()
    assert lookup.lookup_table(values.distinct(), variable("slope")).count() == 1


def jobs_while(spark, work):
    """Run ``work`` under a job group of its own; returns its result and how many jobs it started."""
    group = f"group-{id(work)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_tag_keeps_what_it_pinned(spark, built, raster, tmp_path):
    table = px.write_pixels(raster, str(tmp_path / "pixels"), TILE)
    store, units, soil = rz.Store(spark, str(tmp_path / "store"), TILE), built["map_unit_properties"], built["soil_properties"]
    names, regions = ["mukey", "slope", "aws"], spark.createDataFrame([("test",)], "region string")
    assert rz.rasterize_all(store, ["test"], names, table, soil, units, "d1") == 3
    first = rz.release(store, regions, names, "d1")
    steeper = units.withColumn("slope", F.col("slope") + 1)
    assert rz.rasterize_pair(store, "test", variable("slope"), table, steeper, "d2", overwrite=True)
    second = rz.release(store, regions, names, "d2")
    slope = variable("slope")
    for tag, expected in ((first, units), (second, steeper), (None, steeper)):
        assert compare.value_equality(store.read(slope, tag=tag), expected, slope).first()["status"] == "passed"
    assert compare.value_equality(store.read(slope, tag=first), steeper, slope).first()["mismatches"] > 0
    runs = {(r["tag"], r["variable"]): (r["run_no"], r["cells"]) for r in store.releases().collect()}
    cells = mapped_cells()
    assert runs == {("d1", n): (1, cells) for n in names} | {("d2", "mukey"): (1, cells), ("d2", "aws"): (1, cells), ("d2", "slope"): (2, cells)}
    # an unfinished overwrite changes neither the tags nor the current state
    with pytest.raises(rz.ReleaseTagError):
        store.read(slope, tag="never")
    assert store.read(variable("aws"), tag=first, depth="0_100").count() == cells


def test_all_products_in_one_pass_without_exchange(spark, built, raster, tmp_path, monkeypatch):
    path = str(tmp_path / "pixels")
    table = px.write_pixels(raster, path, TILE)
    store = rz.Store(spark, str(tmp_path / "store"), TILE)
    plans, real = [], rz.write_cells

    def seen(cells, *rest):
        plans.append(cells._jdf.queryExecution().executedPlan().toString())
        real(cells, *rest)

    monkeypatch.setattr(rz, "write_cells", seen)
    every = resolve(None)
    assert rz.rasterize_all(store, ["test"], None, table, built["soil_properties"], built["map_unit_properties"], "d") == len(every) == 43
    assert len(plans) == 1 and plans[0].count("BroadcastHashJoin") == 1
    assert plans[0].count(f"{path}]") == 1
    assert "Exchange" not in plans[0].replace("BroadcastExchange", "")
    assert rz.rasterize_all(store, ["test"], None, table, built["soil_properties"], built["map_unit_properties"], "d") == 0
    for v in every:
        values = built["soil_properties"] if v.by_depth else built["map_unit_properties"]
        cells = store.read(v)
        assert cells.count() == mapped_cells() * (11 if v.by_depth else 1)
        if not v.is_key:
            assert compare.value_equality(cells, values, v).first()["status"] == "passed", v.name
    # only the column asked for, and of it only the interval, is read, from the tiles of the box
    field = px.window(store.read(variable("aws"), depth="0_100"), "test", 2, 10, 3, 20, size=TILE)
    plan = field._jdf.queryExecution().executedPlan().toString()
    assert "aws:struct<0_100:float>" in plan and "soc" not in plan
    pruned = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "tile_y" in pruned and "run_no" in pruned and "region" in pruned


def test_products_beyond_the_broadcast_bound_take_more_passes(spark, built, raster, tmp_path):
    table = px.write_pixels(raster, str(tmp_path / "pixels"), TILE)
    some = [variable(n) for n in ("aws", "slope", "texture_class", "soc", "mukey")]
    groups = rz.passes([v for v in some if not v.is_key], 1000, 200_000)
    assert [v.name for g in groups for v in g] == ["aws", "slope", "texture_class", "soc"] and 1 < len(groups) < 4
    small, large = (rz.Store(spark, str(tmp_path / n), TILE) for n in ("small", "large"))
    for store, bound in ((small, 10), (large, 1 << 27)):
        rz.rasterize_products(store, "test", some, table, built["soil_properties"], built["map_unit_properties"], "d", broadcast_bytes=bound)
    for v in some:
        a, b = small.read(v), large.read(v)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_extension_leaves_stored_files_alone(spark, built, raster, tmp_path):
    table = px.write_pixels(raster, str(tmp_path / "pixels"), TILE)
    store, soil, units = rz.Store(spark, str(tmp_path / "store"), TILE), built["soil_properties"], built["map_unit_properties"]
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store" / "cells").rglob("*.parquet")}
    assert rz.extend(store, ["test"], ["mukey", "slope"], table, soil, units, "d") == 2
    before = files()
    assert rz.extend(store, ["test"], ["mukey", "slope", "aws"], table, soil, units, "d") == 1
    after = files()
    assert before.items() < after.items()
    assert rz.extend(store, ["test"], ["mukey", "slope", "aws"], table, soil, units, "d") == 0 and files() == after
    assert store.read(variable("slope")).count() == store.read(variable("mukey")).count() == mapped_cells()
    assert compare.value_equality(store.read(variable("aws")), soil, variable("aws")).first()["status"] == "passed"
    with pytest.raises(rz.LayoutError):
        rz.extend(rz.Store(spark, store.base, 8), ["test"], ["elevation"], table, soil, units, "d")


def test_structure_of_what_is_stored(spark, built, raster, tmp_path):
    table = px.write_pixels(raster, str(tmp_path / "pixels"), TILE)
    store, soil, units = rz.Store(spark, str(tmp_path / "store"), TILE), built["soil_properties"], built["map_unit_properties"]
    grid = spark.createDataFrame([("test", COLUMNS, ROWS)], "region string, width int, height int")
    some = [variable(n) for n in ("mukey", "slope", "aws")]
    rz.rasterize_products(store, "test", some[:2], table, soil, units, "d")
    rz.rasterize_products(store, "test", some[2:], table, soil, units, "d")
    report = {r["variable"]: r for r in gates.store_structure(store, some, grid).collect()}
    assert {n: (r["passed"], r["cells"], r["run_no"]) for n, r in report.items()} == {
        "mukey": (True, mapped_cells(), 1), "slope": (True, mapped_cells(), 1), "aws": (True, mapped_cells(), 2)}
    cells = rz.attach(table.cells, rz.encoded_values(some, soil, units), some)
    judge = lambda df, grid=grid, size=TILE: {r["variable"]: r for r in gates.stored_structure(df, some, grid, size).collect()}
    assert all(r["passed"] for r in judge(cells).values())
    wrong = judge(cells.withColumn("slope", F.col("slope").cast("double")))
    assert not wrong["slope"]["type_ok"] and wrong["aws"]["passed"] and not wrong["slope"]["passed"]
    fewer = judge(cells.withColumn("aws", F.col("aws").dropFields("0_100")))
    assert fewer["aws"]["type_ok"] and not fewer["aws"]["intervals_ok"] and fewer["slope"]["passed"]
    assert not judge(cells.drop("aws"))["aws"]["passed"]
    assert not any(r["tiles_ok"] for r in judge(cells, size=8).values())
    narrow = spark.createDataFrame([("test", COLUMNS - 1, ROWS), ("empty", 9, 9)], "region string, width int, height int")
    assert not any(r["inside_grid"] for r in judge(cells, narrow).values())
    with pytest.raises(rz.LayoutError):
        gates.store_structure(store, [variable("soc")], grid)


def test_background_tiles_are_recorded(spark, built, tmp_path):
    region = rz.REGIONS[0]
    cells = spark.createDataFrame([(region.name, 0, 0, 7101), (region.name, 0, 1, 0)], "region string, row_no int, col_no int, mukey bigint")
    store = rz.Store(spark, str(tmp_path), 4096)
    rz.rasterize_pair(store, region.name, variable("slope"), px.with_tiles(cells), built["map_unit_properties"], "d")
    record = ledger.provenance(store.ledger()).first()
    grid = -(-region.height // 4096) * -(-region.width // 4096)
    assert (record["tiles_written"], record["tiles_skipped"]) == (1, grid - 1)


def test_opening_pixels_and_joining_values_start_no_job(spark, built, raster, tmp_path):
    px.write_pixels(raster, str(tmp_path / "pixels"), TILE)
    units = built["map_unit_properties"]
    _, jobs = jobs_while(spark, lambda: lookup.rasterize(raster, units, variable("slope")))
    assert jobs == 0
    _, jobs = jobs_while(spark, lambda: (rz.values_at(raster, built["soil_properties"], variable("aws")), lookup.expand(raster, units, ["slope"])))
    assert jobs == 0
    _, jobs = jobs_while(spark, lambda: compare.value_comparison(
        lookup.rasterize(raster, units, variable("slope")), units, variable("slope")))
    assert jobs == 0


def test_repeated_keys_are_refused_with_and_without_depth(built, raster):
    slope, aws = variable("slope"), variable("aws")
    units, soil = built["map_unit_properties"], built["soil_properties"]
    for v, values in ((slope, units), (aws, soil)):
        cells = rz.values_at(raster, values, v)
        assert compare.value_equality(cells, values, v).first()["status"] == "passed"
        with pytest.raises(Exception, match="lookup keys repeat"):
            compare.value_equality(cells, values.unionByName(values.where("mukey = 7101")), v).first()
    plan = compare.value_comparison(rz.values_at(raster, soil, aws), soil, aws)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(mukey" in plan and "hashpartitioning(mukey#" in plan and ", depth_interval#" not in plan.split("hashpartitioning", 1)[1][:60]
