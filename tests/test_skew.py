"""A hot key must change the plan, never the result."""

import pytest
from pyspark.sql import functions as F

from loamgrid.operators import lookup, measures, properties

BIG = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    """One component holds most horizons; one map unit holds most components."""
    rows = spark.range(BIG * 2).select(
        F.when(F.col("id") < BIG, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("cokey"),
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("chkey"),
        (F.col("id") % 150).cast("double").alias("hzdept_r"), (F.col("id") % 150 + 1 + F.col("id") % 40).cast("double").alias("hzdepb_r"),
        *[F.when(F.col("id") % 11 != i % 11, (F.col("id") % (13 + i)).cast("double")).alias(c)
          for i, c in enumerate([*properties.PARTS.values(), "ksat_r", *properties.LINEAR.values()])],
    )
    parts = spark.range(98).select(
        F.when(F.col("id") == 97, "hot").otherwise(F.col("id").cast("string")).alias("cokey"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 20 + 2).cast("bigint").alias("mukey"),
        (F.col("id") % 50 + 1).cast("double").alias("comppct_r"), F.lit("Yes").alias("majcompflag"),
    )
    return parts, rows


def _measures():
    return [properties.PARTICLE_SIZE, *properties.LINEAR_MEASURES]


def _values(df):
    return sorted(tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in
                  df.select("mukey", "depth_interval", "sand", "ksat", "organic_matter", "ph").na.fill(-1.0).collect())


def test_named_hot_components_give_the_same_values(skewed):
    parts, rows = skewed
    hot = lookup.hot_keys(rows, "cokey", share=0.2)
    assert hot == ["hot"]
    assert _values(properties.property_sums(parts, rows, _measures(), hot=hot)) == _values(
        properties.property_sums(parts, rows, _measures()))


def test_adaptive_execution_splits_a_hot_component(spark, skewed):
    parts, rows = skewed
    expected = _values(properties.property_sums(parts, rows, _measures()))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        many = rows.repartition(8)
        df = properties.property_sums(parts, many, _measures())
        got = _values(df)
        probe = df.select("mukey", "depth_interval", "sand", "ksat", "organic_matter", "ph")
        probe.collect()
        plan = probe._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == expected
    assert "skew=true" in plan


def test_skew_safe_join_is_the_whole_join(spark):
    facts = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("mukey"), "id")
    unknown = spark.range(900).select(F.lit(None).cast("bigint").alias("mukey"), (F.col("id") + 9000).alias("id"))
    facts = facts.unionByName(unknown)
    assert set(lookup.hot_keys(facts, "mukey", share=0.1)) == {None, 7}
    values = spark.range(400).select(F.col("id").alias("mukey"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        plain = facts.join(values, "mukey", how)
        hot = lookup.hot_keys(facts, "mukey", share=0.1)
        split = lookup.skew_safe_join(facts, values, "mukey", how=how, rows=400, hot=hot, broadcast_bytes=100)
        assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
        unmeasured = lookup.skew_safe_join(facts, values, "mukey", how=how)
        assert unmeasured.exceptAll(plain).count() == 0 and plain.exceptAll(unmeasured).count() == 0
        small = lookup.skew_safe_join(facts, values, "mukey", how=how, rows=400)
        assert small.exceptAll(plain).count() == 0 and plain.exceptAll(small).count() == 0


def test_hot_keys_from_stored_counts(spark):
    facts = spark.range(1000).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).cast("bigint").alias("mukey"))
    counts = facts.groupBy("mukey").count().withColumnRenamed("count", "pixels")
    assert lookup.hot_among(counts, "mukey", "pixels") == lookup.hot_keys(facts, "mukey") == [7]


def test_hot_keys_are_few_by_definition(spark):
    facts = spark.range(1000).select((F.col("id") % 4).alias("k"))
    assert sorted(lookup.hot_keys(facts, "k", share=0.2)) == [0, 1, 2, 3]
    assert lookup.hot_keys(facts, "k", share=0.3) == []


def test_partitions_grow_with_the_shuffled_bytes(spark):
    """The session asks for four partitions; 120 MB don't stay in four, and the session's own sizes can be had again."""
    from loamgrid.session import PARTITIONING, tune

    tune(spark)
    rows = spark.range(3_000_000).select(F.md5(F.col("id").cast("string")).alias("k")).groupBy("k").count()
    assert rows.rdd.getNumPartitions() > 4
    tune(spark, partitioning=False)
    assert not any(spark.conf.get(k, None) == v for k, v in PARTITIONING.items())
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in PARTITIONING.items())


def test_a_scan_task_holds_no_table_of_horizons(spark):
    """Fragments are added after the shuffle on the horizon, so a scan task's memory doesn't grow with what it reads."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 500 == 0, None).otherwise((F.col("id") % 2000).cast("string")).alias("chkey"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 90).cast("double")).alias("fragvol_r"))
    found = properties.fragment_volume(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    want = {}
    for r in rows.where("fragvol_r is not null").collect():
        want[r["chkey"]] = want.get(r["chkey"], 0.0) + r["fragvol_r"]
    assert {r["chkey"]: r["fragvol"] for r in found.collect()} == {k: min(100.0, v) for k, v in want.items()}
    assert plan.count("Exchange hashpartitioning") == 1
    assert "HashAggregate" not in plan[plan.index("Exchange hashpartitioning"):]


def test_marked_horizons_give_the_same_rows_and_move_less(spark, skewed):
    """Which rows there are shows in one column, so the checks don't move every property to count a few."""
    parts, rows = skewed
    rows = rows.unionByName(rows.where("hzdept_r < 3").selectExpr(
        *[c if c in ("cokey", "chkey", "hzdept_r", "hzdepb_r") else f"cast(null as double) as {c}" for c in rows.columns]
    ).withColumn("cokey", F.lit("bare")))
    parts = parts.unionByName(spark.createDataFrame([("bare", 900, 5.0, "Yes"), ("5", 901, -1.0, "No")], parts.schema))
    marked = properties.property_sums(parts, measures.with_held(rows, _measures()), _measures(), marked=True)
    assert _values(marked) == _values(properties.property_sums(parts, rows, _measures()))
    assert not [c for c in marked.columns if c == measures.HELD]
    moved = {k: df.select("mukey", "depth_interval", "sand")._jdf.queryExecution().optimizedPlan().toString()
             for k, df in {"marked": marked, "plain": properties.property_sums(parts, rows, _measures())}.items()}
    assert "wsatiated_r__" not in moved["marked"] and "satiated_water_content__percent" in moved["plain"]
    assert "satiated_water_content__percent" not in moved["marked"]
