"""Operators on the hand-worked fixture and on the awkward cases."""

import pytest
from conftest import frame
from pyspark.sql import functions as F

from loamgrid.operators import components as comp
from loamgrid.operators import crops, measures, properties, rootzone, stocks, texture, wetland
from loamgrid.operators.overlap import interval_overlaps, with_label


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_overlaps_split_at_interval_bounds(soil):
    got = {(r["chkey"], r["depth_interval"]): r["overlap_cm"]
           for r in with_label(interval_overlaps(soil["chorizon"], ["chkey"]), "chkey").collect()}
    assert got["g1", "20_50"] == 5 and got["g2", "20_50"] == 25
    assert got["g1", "0_100"] == 25 and got["g2", "0_100"] == 65
    assert ("g2", "100_150") not in got and ("g3", "150_profile") not in got
    assert got["g3", "0_profile"] == 40 and got["g7", "150_profile"] == 30


def test_invalid_horizons_meet_nothing(spark):
    rows = [dict(cokey="a", chkey="x", hzdept_r=10.0, hzdepb_r=10.0), dict(cokey="a", chkey="y", hzdepb_r=10.0),
            dict(cokey="a", chkey="z", hzdept_r=-8.0, hzdepb_r=-2.0)]
    assert interval_overlaps(frame(spark, "chorizon", rows)).count() == 0


def test_linear_mean_and_coverage(soil):
    got = by(measures.measure_map_units(soil["chorizon"], soil["component"], measures.linear("v", "om_r")), "mukey", "depth_interval")
    top = got[7101, "0_20"]
    assert top["v"] == pytest.approx(2.5) and top["contributing_thickness"] == 20 and top["contributing_component_percent"] == 90
    metre = got[7101, "0_100"]
    assert metre["v"] == pytest.approx((152 / 90 + 1.0) / 2) and metre["contributing_thickness"] == pytest.approx(65)


def test_mean_renormalises_over_components_with_data(spark):
    parts = frame(spark, "component", [dict(mukey=1, cokey="a", comppct_r=50.0), dict(mukey=1, cokey="b", comppct_r=50.0),
                                       dict(mukey=1, cokey="n"), dict(mukey=1, cokey="z", comppct_r=0.0)])
    rows = frame(spark, "chorizon", [dict(cokey="a", chkey="1", hzdept_r=0.0, hzdepb_r=5.0, om_r=4.0)] + [
        dict(cokey=k, chkey=k, hzdept_r=0.0, hzdepb_r=5.0, om_r=9.0 if k != "b" else None) for k in "bnz"])
    r = by(measures.measure_map_units(rows, parts, measures.linear("v", "om_r")), "depth_interval")["0_5"]
    assert r["v"] == 4.0 and r["contributing_component_percent"] == 50.0


def test_composition_needs_all_parts(soil, spark):
    got = by(measures.measure_map_units(soil["chorizon"], soil["component"], properties.PARTICLE_SIZE), "mukey", "depth_interval")
    r = got[7101, "0_20"]
    assert (r["sand"], r["silt"], r["clay"]) == pytest.approx((40, 42.5, 17.5))
    for r in got.values():
        assert r["sand"] + r["silt"] + r["clay"] == pytest.approx(100)
    holed = soil["chorizon"].withColumn("silttotal_r", F.lit(None).cast("double"))
    assert measures.measure_map_units(holed, soil["component"], properties.PARTICLE_SIZE).count() == 0


def test_dominant_prefers_major_then_percent_then_key(spark):
    parts = frame(spark, "component", [
        dict(mukey=1, cokey="b", comppct_r=80.0, majcompflag="No"), dict(mukey=1, cokey="a", comppct_r=20.0, majcompflag="Yes"),
        dict(mukey=2, cokey="9", comppct_r=50.0, majcompflag="Yes"), dict(mukey=2, cokey="10", comppct_r=50.0, majcompflag="Yes"),
        dict(mukey=3, cokey="q", majcompflag="Yes")])
    got = {r["mukey"]: r["cokey"] for r in comp.dominant_component(parts).collect()}
    assert got == {1: "a", 2: "10"}  # keys compare as text


def test_conductivity_is_the_dominant_component_minimum(soil):
    got = by(measures.least_transmissive(soil["chorizon"], soil["component"]), "mukey", "depth_interval")
    assert got[7101, "0_100"]["value"] == 3.0 and got[7101, "0_100"]["contributing_component_percent"] == 45
    assert got[7101, "0_5"]["value"] == 9.0


def test_water_stock_family(soil):
    got = by(stocks.aws_family(soil["chorizon"], soil["component"]), "mukey")
    r = got[7101]
    assert r["aws0_100"] == pytest.approx(114.5) and r["tk0_100a"] == pytest.approx(95) and r["musumcpcta"] == 90
    assert r["aws0_5"] == pytest.approx(7.5) and r["aws100_150"] == pytest.approx(16) and r["aws150_999"] is None
    assert 7202 not in got


def test_layers_add_up_to_the_zone(soil):
    layers = ["aws0_5", "aws5_20", "aws20_50", "aws50_100", "aws100_150"]
    for r in stocks.aws_family(soil["chorizon"], soil["component"]).where("mukey in (7303, 7404)").collect():
        assert sum(r[c] or 0 for c in layers) == pytest.approx(r["aws0_150"])


def test_carbon_stock(soil):
    r = by(stocks.soc_family(soil["chorizon"], soil["component"], soil["chfrags"]), "mukey")[7101]
    expected = (5 * 1.1 * (4 / 1.724 / 100) * 0.85 + 5 * 1.4 * (1 / 1.724 / 100)) * 1e4 / 2
    assert r["soc0_5"] == pytest.approx(expected)


def test_fragments_are_summed_and_limited(spark):
    rows = [dict(chkey="a", fragvol_r=70.0), dict(chkey="a", fragvol_r=60.0), dict(chkey="b"), dict(chkey="c", fragvol_r=-3.0)]
    assert {r["chkey"]: r["fragvol"] for r in properties.fragment_volume(frame(spark, "chfrags", rows)).collect()} == {"a": 100, "c": 0}


def test_root_zone(soil):
    got = by(rootzone.root_zone(soil["component"], soil["corestrictions"], soil["chorizon"]), "mukey")
    assert (got[7303]["rootznemc"], got[7303]["rootznaws"], got[7303]["droughty"]) == (64, pytest.approx(160), 0)
    assert (got[7404]["rootznemc"], got[7404]["rootznaws"], got[7404]["droughty"]) == (150, pytest.approx(150), 1)
    # salt stops the roots of one half at 40 cm
    assert (got[7101]["rootznemc"], got[7101]["rootznaws"], got[7101]["droughty"]) == (95, pytest.approx((141 + 40) / 2), 1)
    assert 7202 not in got


def test_chemistry_limits_roots_and_missing_water_counts_as_zero(spark):
    parts = frame(spark, "component", [dict(mukey=k, cokey=str(k), comppct_r=100.0, compkind="Series", majcompflag="Yes") for k in (1, 2)])
    rows = frame(spark, "chorizon", [
        dict(cokey="1", chkey="a", hzdept_r=0.0, hzdepb_r=60.0, awc_r=0.1, ph1to1h2o_r=6.0),
        dict(cokey="1", chkey="b", hzdept_r=60.0, hzdepb_r=150.0, awc_r=0.1, ph1to1h2o_r=3.0)])
    got = by(rootzone.root_zone(parts, frame(spark, "corestrictions", []), rows), "mukey")
    assert (got[1]["rootznemc"], got[1]["rootznaws"]) == (60, pytest.approx(60))
    assert (got[2]["rootznemc"], got[2]["rootznaws"], got[2]["droughty"]) == (150, 0, 1)


def test_root_depth_rounds_half_to_even(spark):
    parts = frame(spark, "component", [dict(mukey=1, cokey=k, comppct_r=50.0, compkind="Series", majcompflag="Yes") for k in "ab"])
    stops = frame(spark, "corestrictions", [dict(cokey="a", reskind="Duripan", resdept_r=50.0), dict(cokey="b", reskind="Duripan", resdept_r=51.0)])
    r = rootzone.root_zone(parts, stops, frame(spark, "chorizon", [])).first()
    assert r["rootznemc"] == 50


def test_drought_threshold_is_met_whatever_the_rounding_of_the_sums(spark):
    """95 cm of 0.17 on 60 percent and 65 cm of 0.19 on 20 percent hold 152 mm, in doubles 152.00000000000003."""
    parts = frame(spark, "component", [
        dict(mukey=1, cokey=k, comppct_r=p, compkind="Series", majcompflag="Yes") for k, p in (("a", 60.0), ("b", 20.0))])
    rows = frame(spark, "chorizon", [
        dict(cokey="a", chkey="a", hzdept_r=0.0, hzdepb_r=95.0, awc_r=0.17), dict(cokey="b", chkey="b", hzdept_r=0.0, hzdepb_r=65.0, awc_r=0.19)])
    r = rootzone.root_zone(parts, frame(spark, "corestrictions", []), rows).first()
    assert (r["rootznaws"], r["droughty"]) == (pytest.approx(152), 1)


def test_crop_ratings(soil):
    got = by(crops.crop_ratings(soil["component"], soil["cointerp"]), "mukey")
    r = got[7101]
    assert r["nccpi3corn"] == pytest.approx(0.55) and r["nccpi3sg"] == pytest.approx(0.5)
    assert r["nccpi3cot"] is None and r["nccpi3soy"] is None and r["nccpi3all"] == pytest.approx(0.5)
    assert r["pctearthmc"] == 90 and 7202 not in got


def test_wetland_percent(soil):
    got = {r["mukey"]: r["pwsl1pomu"] for r in wetland.wetland_percent(soil["component"], soil["mapunit"]).collect()}
    assert got == {7101: 65, 7202: 999, 7303: 0, 7404: 55}


def test_percent_sum_is_not_limited(soil):
    got = {r["mukey"]: r["musumcpct"] for r in comp.component_percent_sum(soil["component"]).collect()}
    assert got == {7101: 110, 7202: 80, 7303: 70, 7404: 55}


def test_terrain_and_audit(soil):
    r = by(comp.terrain(soil["component"]), "mukey")[7101]
    assert r["slope"] == 7 and r["aspect"] == 350
    audit = by(comp.terrain_audit(soil["component"]), "mukey")[7101]
    assert audit["selected_cokey"] == "k10" and audit["selected_comppct_r"] == 45


def test_surface_texture_and_codes(soil):
    surface = texture.surface_texture(soil["component"], soil["chorizon"], soil["chtexturegrp"])
    got = {r["mukey"]: r["texture"] for r in surface.collect()}
    assert got == {7101: "SICL", 7202: None, 7303: "GRV-L", 7404: "MPM"}
    hidden = soil["chtexturegrp"].withColumn("rvindicator", F.when(F.col("chkey") != "g1", "Yes").otherwise("No"))
    assert {r["mukey"]: r["texture"] for r in texture.surface_texture(soil["component"], soil["chorizon"], hidden).collect()}[7101] is None
    codes = {r["name"]: r["code"] for r in texture.texture_dictionary(soil["chtexturegrp"]).collect()}
    assert codes == {"FSL": 0, "GRV-L": 1, "MPM": 2, "SICL": 3, "SIL": 4}


def test_row_order_and_partitioning_do_not_matter(soil):
    def run(n):
        sums = properties.property_sums(
            soil["component"].repartition(n), soil["chorizon"].repartition(n), [properties.PARTICLE_SIZE, *properties.LINEAR_MEASURES])
        return {(r["mukey"], r["depth_interval"]): (round(r["sand"] or 0, 9), r["ksat"], round(r["ph"] or 0, 9)) for r in sums.collect()}

    assert run(1) == run(5)


def test_percentiles_are_exact_whether_bracketed_or_not(spark):
    from loamgrid.operators.inventory import exact_percentiles

    big = spark.range(60_000).select(F.lit("big").alias("g"), F.when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") * 7919) % 60_013 / 7).alias("v"))
    few = spark.range(7).select(F.lit("few").alias("g"), (F.col("id") * F.col("id")).cast("double").alias("v"))
    rows = big.unionByName(few)
    got = by(exact_percentiles(rows, "g", "v", {"m": 0.5, "t": 0.3, "u": 0.95}), "g")
    want = by(rows.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in [("m", 0.5), ("t", 0.3), ("u", 0.95)]]), "g")
    for g in ("big", "few"):
        assert all(got[g][n] == pytest.approx(want[g][n]) for n in ("m", "t", "u"))


def test_percentiles_are_exact_for_any_values(spark):
    import numpy as np

    from loamgrid.operators.inventory import exact_percentiles

    rng = np.random.default_rng(3)
    sets = {
        "one": [5.0], "two": [1.0, 2.0], "equal": [7.0] * 500, "spread": rng.lognormal(0, 40, 3000).tolist(),
        "steps": [10.0 ** -k for k in range(300)], "near": (1 + np.arange(2000) * 2.0 ** -52).tolist(),
        "far": [0.0] * 10 + [1e300] + (1e-300 * rng.random(999)).tolist(), "signs": rng.standard_normal(1001).tolist(),
        "huge": [-1.7e308, 1.7e308, 0.0, 1.0, 2.0],
    }
    rows = [(k, float(x)) for k, v in sets.items() for x in v] + [("one", None), ("one", float("nan")), ("none", None)]
    wanted = {"median": 0.5, "p95": 0.95, "least": 0.0, "most": 1.0}
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_percentiles(df, "g", "v", wanted).collect()}
    assert set(got) == set(sets)
    for k, v in sets.items():
        v = sorted(v)
        for name, p in wanted.items():
            at = p * (len(v) - 1)
            low, high, part = v[int(at)], v[min(int(at) + (at % 1 > 0), len(v) - 1)], at % 1
            assert got[k][name] == (low + part * (high - low) if part and low != high else low), (k, name)
    assert exact_percentiles(df.limit(0), "g", "v", wanted).count() == 0


def test_names_are_numbered_without_one_task_for_all(spark):
    from loamgrid.operators.texture import numbered

    names = sorted({f"{c}{i}" for c in "abzÄ中~" for i in range(40)}, key=lambda n: n.encode())
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    out = numbered(df, "name")
    assert {r["name"]: r["number"] for r in out.collect()} == {n: i for i, n in enumerate(names)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line or "+- Window" in line]
    assert windows and all("[byte" in w for w in windows) and "CartesianProduct" not in plan
