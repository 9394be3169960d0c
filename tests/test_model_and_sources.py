"""Registry rules, table contracts, expressions, release identity and the pixel table."""

import dataclasses
import os

import pytest
from conftest import frame, key_at, mapped_cells
from pyspark.sql import functions as F

from loamgrid import functions as fx
from loamgrid.model import intervals, regions, variables
from loamgrid.sources import pixels as px
from loamgrid.sources import release, tables


def test_registry_counts_and_order():
    assert len(variables.included()) == 43 and len(variables.VARIABLES) == 44
    assert variables.resolve()[0].name == "mukey"
    assert [v.name for v in variables.resolve(["slope", "mukey", "aws"])] == ["mukey", "aws", "slope"]
    assert len(regions.REGIONS) == 12 and len(intervals.INTERVALS) == 11


@pytest.mark.parametrize("bad", [["nope"], ["texture_class_by_depth"]])
def test_registry_refuses_requests(bad):
    with pytest.raises(variables.RegistryError):
        variables.resolve(bad)


def test_registry_refuses_definitions():
    with pytest.raises(variables.RegistryError):
        variables.Variable("x", variables.SOIL, "1", "made_up", ())
    with pytest.raises(variables.RegistryError):
        variables.Variable("x", variables.SOIL, "1", variables.UNREVIEWED, ())
    with pytest.raises(variables.RegistryError):
        variables.Variable("x", "nowhere", "1", "valu1_aws", ())
    with pytest.raises(variables.RegistryError):
        variables.check_unique([variables.variable("aws"), variables.variable("aws")])


def test_dimension_frames(spark):
    rows = {r["depth_interval"]: r for r in intervals.interval_frame(spark).collect()}
    assert rows["150_profile"]["bottom_cm"] is None and rows["150_profile"]["source_suffix"] == "150_999"
    assert regions.region_frame(spark).count() == 12 and variables.variable_frame(spark).count() == 43


def values(spark, *exprs, **one):
    return spark.range(1).select(*exprs).first()


def test_clamp_keeps_null_and_rounding_is_half_even(spark):
    null = F.lit(None).cast("double")
    r = values(spark, fx.clamp(null, 0, 5), fx.clamp(F.lit(9.0), 0, 5), fx.half_even(F.lit(2.5)), fx.half_even(F.lit(3.5)))
    assert tuple(r) == (None, 5.0, 2.0, 4.0)


def test_dates_tokens_and_words(spark):
    r = values(spark, fx.date_in_name(F.lit("x_02_13_2026.gpkg")), fx.date_in_name(F.lit("x_13_02_2026")), fx.date_in_name(F.lit("none")),
               fx.tidy_token(F.lit(" STV-L ")), fx.tidy_token(F.lit("--")), fx.word_in(F.lit("Open WATERS"), "water"),
               fx.word_in(F.lit("Waterford"), "water"))
    assert tuple(r) == ("2026-02-13", None, None, "stv_l", "unknown", True, False)


def test_tolerance_equality(spark):
    nan, null = F.lit(float("nan")), F.lit(None).cast("double")
    r = values(spark, fx.close_enough(nan, null), fx.close_enough(F.lit(1.0), null), fx.close_enough(F.lit(1e6), F.lit(1e6 + 0.5)),
               fx.close_enough(F.lit(1.0), F.lit(1.1)))
    assert tuple(r) == (True, False, True, False)


def test_encoding_and_its_range(spark):
    df = spark.createDataFrame([(None,), (1.0,), (0.4,), (float("nan"),)], "v double")
    assert [r[0] for r in df.select(fx.encode_integer("v", 0, 255, 255, "v")).collect()] == [255, 1, 0, 255]
    with pytest.raises(Exception, match="outside 0..255"):
        spark.createDataFrame([(300.0,)], "v double").select(fx.encode_integer("v", 0, 255, 255, "v")).collect()


def test_scan_casts_prunes_filters_and_drops_nan(spark):
    raw = spark.createDataFrame([("1", "NCCPI - x", "r", "0", "0.5", "junk"), ("2", "nccpi y", "r", "0", "NaN", ""), ("3", "ENG", "r", "0", "1", "")],
                                "cokey string, mrulename string, rulename string, ruledepth string, interphr string, other string")
    out = tables.scan(raw, tables.TABLES["cointerp"])
    assert out.columns == list(tables.TABLES["cointerp"].columns)
    assert {r["cokey"]: r["interphr"] for r in out.collect()} == {"1": 0.5, "2": None}
    broken = raw.withColumn("interphr", F.lit("n/a"))
    assert tables.scan(broken, tables.TABLES["cointerp"], strict=False).first()["interphr"] is None
    with pytest.raises(Exception):
        tables.scan(broken, tables.TABLES["cointerp"]).collect()


def test_contracts_and_keys(spark, soil):
    report = {r["table_name"]: r for r in tables.required_columns(soil).collect()}
    assert report["component"]["passed"] and not report["muaggatt"]["passed"]
    doubled = frame(spark, "mapunit", [dict(mukey=1), dict(mukey=1)])
    with pytest.raises(tables.ContractError):
        tables.require_unique(doubled, ["mukey"], "mapunit")
    assert tables.require_unique(soil["chorizon"], ["chkey"], "chorizon") is soil["chorizon"]


def test_scan_reaches_the_file(spark, soil, tmp_path):
    path = str(tmp_path / "component")
    soil["component"].write.parquet(path)
    plan = spark.read.parquet(path).select("mukey", "comppct_r").where("comppct_r > 50")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(comppct_r,50.0)" in text and "elev_r" not in text


def test_release_identity(spark):
    names = [(1, "a_02_13_2026.gpkg"), (1, "a_02_13_2026.7z"), (1, "a_01_30_2026"), (2, "b_02_13_2026.gpkg"), (2, "b_02_14_2026.7z"), (3, "c.gpkg")]
    dated = release.file_dates(spark.createDataFrame(names, "rel int, file_name string"))
    got = {r["rel"]: (r["release_date"], r["passed"]) for r in release.release_identity(dated, ["rel"]).collect()}
    assert got == {1: ("2026-02-13", True), 2: (None, False), 3: (None, False)}
    with pytest.warns(UserWarning, match="directory"):
        assert release.require_release(dated.where("rel = 1"), "2026-02-13") == "2026-02-13"
    with pytest.raises(release.ReleaseError):
        release.require_release(dated.where("rel = 1"), "2025-01-01")
    with pytest.raises(release.ReleaseError):
        release.require_release(dated.where("rel = 2"), "2026-02-13")


def test_release_rules(spark):
    names = [
        (1, "a_02_13_2026.gpkg"), (1, "a.7z"), (1, "a_02_13_2026"), (2, "a.gpkg"), (2, "a_02_13_2026.7z"), (2, "a_01_01_2026"),
        (3, "a_02_13_2026.gpkg"), (3, "b_02_13_2026.gpkg"), (4, "a_02_13_2026.7z"), (5, "a_02_13_2026.gpkg"), (5, "b.7z"), (5, "c.7z"),
        (6, "a_02_13_2026.gpkg"), (6, "a_02_14_2026.7z"), (7, "a.gpkg"), (7, "a_02_13_2026"), (8, None)]
    dated = release.file_dates(spark.createDataFrame(names, "rel int, file_name string"))
    got = {r["rel"]: (r["release_date"], r["date_source"], r["problem"], r["directory_differs"]) for r in release.release_findings(dated, ["rel"]).collect()}
    assert got == {
        1: ("2026-02-13", "geopackage", None, False), 2: ("2026-02-13", "archive", None, True), 3: (None, None, "not one table file", False),
        4: (None, None, "not one table file", False), 5: (None, None, "several archives", False), 6: (None, None, "conflicting dates", False),
        7: (None, None, "no date", False), 8: (None, None, "not one table file", False)}
    for rel, words in ((3, "table file"), (5, "archives"), (7, "no date"), (9, "no release")):
        with pytest.raises(release.ReleaseError, match=words):
            release.require_release(dated.where(f"rel = {rel}"), "2026-02-13")


def test_manifest(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(b"12345")
    (tmp_path / "b.gpkg").write_bytes(b"x" * 50)
    got = {r["artifact_type"]: r for r in release.artifact_manifest(spark, str(tmp_path)).collect()}
    assert got["raster"]["size_bytes"] == 5 and got["geopackage"]["size_bytes"] == 50


def test_stale_units(spark):
    now = spark.createDataFrame([("a", 1), ("b", 2)], "t string, f int")
    then = spark.createDataFrame([("a", 1), ("b", 1)], "t string, f int")
    assert [r["t"] for r in release.stale_units(now, then, ["t", "f"]).collect()] == ["b"]
    assert release.stale_units(now, then, ["t", "f"], force=True).count() == 2


def test_every_cell_of_a_grid_is_in_one_tile(spark):
    grid = (regions.Region("g", "G", 4326, 1.0, 103, 57, 0.0, 0.0),)
    tiles = px.tile_grid(spark, grid, 10)
    assert tiles.count() == 11 * 6
    assert tiles.agg(F.sum((F.col("row_to") - F.col("row_from")) * (F.col("col_to") - F.col("col_from")))).first()[0] == 103 * 57


def test_written_pixels_prune_by_tile(spark, raster, tmp_path):
    path = str(tmp_path / "pixels")
    px.write_pixels(raster, path, 16)
    stored = px.read_pixels(spark, path, "test")
    assert stored.count() == mapped_cells()
    field = px.window(stored, "test", 5, 20, 5, 20, size=16)
    assert field.count() == sum(key_at(r, c) > 0 for r in range(5, 20) for c in range(5, 20))
    text = field._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "tile_y" in text.split("PartitionFilters")[1]


def test_an_algorithm_without_function_is_refused():
    from loamgrid.model.variables import RegistryError, included, variable
    from loamgrid.plans import registry

    fewer = {k: a for k, a in registry.FUNCTIONS.items() if k[0] != "valu1_pwsl"}
    with pytest.raises(RegistryError, match="has no function"):
        registry.check(included(), fewer)
    with pytest.raises(RegistryError, match="declared but not registered"):
        registry.check([v for v in included() if v.name != "ksat"], registry.FUNCTIONS)
    with pytest.raises(RegistryError, match="not declared"):
        registry.check([*included(), dataclasses.replace(variable("ksat"), name="ksat2")], registry.FUNCTIONS)
    with pytest.raises(RegistryError, match="bound twice"):
        registry.algorithm("valu1_pwsl", ["x"])(lambda c: None)
    with pytest.raises(RegistryError, match="unknown algorithm"):
        registry.algorithm("nobody", ["x"])(lambda c: None)


def test_a_new_entry_alone_makes_a_new_product(soil, monkeypatch):
    from loamgrid.model import variables as model
    from loamgrid.plans import registry

    monkeypatch.setitem(model.ALGORITHMS, "component_count", "components listed for a map unit")
    monkeypatch.setitem(registry.ALGORITHMS, "component_count", "components listed for a map unit")
    new = dataclasses.replace(model.variable("slope"), name="components", algorithm="component_count", source_fields=("cokey",))
    functions = dict(registry.FUNCTIONS)
    registry.algorithm("component_count", ["components"], into=functions)(
        lambda c: c.tables["component"].groupBy("mukey").agg(F.count("*").alias("components")))
    plain = registry.assemble(registry.Context(soil), False)
    out = registry.assemble(registry.Context(soil), False, [*model.included(), new], functions)
    assert out.columns == [*plain.columns, "components"]
    want = {r["mukey"]: r["count"] for r in soil["component"].groupBy("mukey").count().collect()}
    assert {r["mukey"]: r["components"] for r in out.where("components is not null").collect()} == want


def test_one_touched_file_is_stale(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(30).repartition(3).write.parquet(path)
    recorded = release.file_fingerprints(spark, path)
    stored = str(tmp_path / "ledger")
    recorded.write.parquet(stored)
    seen = spark.read.parquet(stored)
    assert seen.count() == 3 and release.stale_files(spark, path, seen).isEmpty()
    file = sorted((tmp_path / "t").glob("*.parquet"))[1]
    os.utime(file, (1_700_000_000, 1_700_000_000))
    assert [r["file_name"] for r in release.stale_files(spark, path, seen).collect()] == [file.name]
    assert release.stale_files(spark, path, seen, force=True).count() == 3
    plan = release.file_fingerprints(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
