"""Filling (region, product) pairs: a resumable, idempotent batch over tiles, all products of a region in one pass.

Stored cells are wide: a row per cell, a column per product, a struct of the
eleven intervals for a product with depth.  The pixels of a region are read once
and meet one value table that carries every wanted product, encoded; nothing is
expanded and nothing is shuffled, as stored pixels lie by tile already.  Reading a
product is reading its column, reading an interval a field of it.

A run of a region writes its own partitions (region, run, tile), so products
written later, or again, are further files and never change those there are; the
ledger says which run holds the current column of each product.  One process at a
time works on a region.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model.intervals import DEPTH, LABELS
from ..model.regions import REGIONS, region_frame
from ..model.variables import SPARK_TYPE, Variable, resolve
from ..operators.lookup import BROADCAST_BYTES, encoded, hot_among, row_bytes, single, skew_safe_join
from ..sources.pixels import TILE, PixelTable, describe, mapped
from . import ledger as led

RUN = ["region", "run_no"]
UNMATCHED_SCHEMA = "mukey bigint, pixels bigint, region string, variable string, run_no int"
RELEASE_SCHEMA = "tag string, region string, variable string, run_no int, cells bigint"


class LayoutError(ValueError):
    """Stored tiles that do not match the configured tile size."""


class ReleaseTagError(KeyError):
    """A tag that no release has."""


def column_type(v: Variable) -> T.DataType:
    """How a product is stored: one value, or one field per interval."""
    kind = SPARK_TYPE[v.dtype]
    return T.StructType([T.StructField(label, kind) for label in LABELS]) if v.by_depth else kind


@dataclass(frozen=True)
class Store:
    """Where stored pixels and their ledger live."""

    spark: SparkSession
    base: str
    tile_size: int = TILE

    @property
    def ledger_path(self) -> str:
        return f"{self.base}/ledger"

    @property
    def cells_path(self) -> str:
        return f"{self.base}/cells"

    @property
    def releases_path(self) -> str:
        return f"{self.base}/releases"

    def ledger(self) -> DataFrame:
        return led.read_ledger(self.spark, self.ledger_path)

    def releases(self) -> DataFrame:
        """Every tag with the run it pins for each region and product; empty before the first release."""
        try:
            return self.spark.read.schema(RELEASE_SCHEMA).parquet(self.releases_path)
        except AnalysisException as error:
            if not led.not_written_yet(error):
                raise
            return self.spark.createDataFrame([], RELEASE_SCHEMA)

    def runs(self, v: Variable, tag: str | None = None) -> list[tuple[str, int]]:
        """(region, run) of a product, one a region: the latest finished ones, or those a tag pins."""
        if tag is None:
            found = led.finished_runs(self.ledger())
        else:
            found = self.releases().where(F.col("tag") == tag)
            if found.isEmpty():
                raise ReleaseTagError(tag)
        return sorted((r["region"], r["run_no"]) for r in found.where(F.col("variable") == v.name).select(*RUN).distinct().collect())

    def read(self, v: Variable, *, tag: str | None = None, depth: str | None = None) -> DataFrame:
        """Cells of one product, now or as of a release; a row per interval if it has depth.

        Region, run and tile are partitions, so only the files of the runs asked
        for are read, and of them only the product's column.  What older or
        unfinished runs wrote is never read.
        """
        cell = "region string, run_no int, tile_y int, tile_x int, row_no int, col_no int, mukey bigint"
        own = [] if v.is_key else [T.StructField(v.name, column_type(v))]
        schema = T.StructType([*T.StructType.fromDDL(cell).fields, *own])
        here = F.lit(False)
        for region, run_no in self.runs(v, tag):
            here = here | ((F.col("region") == region) & (F.col("run_no") == run_no))
        cells = self.spark.read.schema(schema).parquet(self.cells_path).where(here).drop("run_no")
        if v.is_key:
            return cells.withColumn("value", F.col("mukey"))
        if not v.by_depth:
            return cells.withColumnRenamed(v.name, "value")
        if depth is not None:
            return cells.withColumn(DEPTH, F.lit(depth)).withColumn("value", F.col(v.name)[depth]).drop(v.name)
        return lengthen(cells, v)

    def unmatched(self) -> DataFrame:
        """Every key without a value, per region, product and run."""
        return self.spark.read.schema(UNMATCHED_SCHEMA).parquet(f"{self.base}/unmatched")


@dataclass(frozen=True)
class ValueTable:
    """Encoded values of several products per map unit, and how many rows were stored."""

    table: DataFrame
    rows: int
    mark: str


def lengthen(cells: DataFrame, v: Variable) -> DataFrame:
    """One row per interval from the struct of a product with depth."""
    each = F.array(*[F.struct(F.lit(label).alias(DEPTH), F.col(v.name)[label].alias("value")) for label in LABELS])
    return cells.select(*[c for c in cells.columns if c != v.name], F.inline(each))


def encoded_values(variables: Sequence[Variable], soil: DataFrame | None, units: DataFrame | None) -> DataFrame:
    """mukey, a column per product in its stored form, and which of the two tables knows the map unit.

    Encoding happens here, once per map unit.  A repeated key is refused inside the aggregate.
    """
    sides = []
    for table, by_depth, flag in ((units, False, "in_units"), (soil, True, "in_soil")):
        chosen = [v for v in variables if v.by_depth == by_depth and not v.is_key]
        if not chosen:
            continue
        kind = lambda v: SPARK_TYPE[v.dtype]
        if by_depth:
            values = [
                F.struct(*[single(encoded(v), F.col(DEPTH) == label, v.name, kind(v)).alias(label) for label in LABELS]).alias(v.name)
                for v in chosen]
        else:
            values = [single(encoded(v), F.lit(True), v.name, kind(v)).alias(v.name) for v in chosen]
        sides.append(table.where(F.col("mukey").isNotNull()).groupBy("mukey").agg(F.lit(True).alias(flag), *values))
    return sides[0] if len(sides) == 1 else sides[0].join(sides[1], "mukey", "full")


def filled(v: Variable) -> Column:
    """A looked-up column with the fill where nothing was found."""
    fill = F.lit(v.fill).cast(SPARK_TYPE[v.dtype])
    if v.by_depth:
        return F.struct(*[F.coalesce(F.col(v.name)[label], fill).alias(label) for label in LABELS]).alias(v.name)
    return F.coalesce(F.col(v.name), fill).alias(v.name)


def attach(
    cells: DataFrame, values: DataFrame | None, variables: Sequence[Variable], *, rows: int | None = None, hot: Sequence = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Cells with a column per product: one join for all of them.  The key product is the key every cell carries."""
    found = cells if values is None else skew_safe_join(cells, values, "mukey", rows=rows, hot=hot, broadcast_bytes=broadcast_bytes)
    return found.select(*cells.columns, *[filled(v) for v in variables if not v.is_key])


def values_at(pixels: DataFrame, values: DataFrame, v: Variable, *, rows: int | None = None, hot: Sequence = ()) -> DataFrame:
    """Cells with the stored value of one product, one row per interval for a product with depth."""
    cells = mapped(pixels)
    if v.is_key:
        return cells.withColumn("value", F.col("mukey").cast(SPARK_TYPE[v.dtype]))
    wide = attach(cells, encoded_values([v], values, values), [v], rows=rows, hot=hot)
    return lengthen(wide, v) if v.by_depth else wide.withColumnRenamed(v.name, "value")


def store_values(store: Store, variables: Sequence[Variable], soil: DataFrame | None, units: DataFrame | None) -> ValueTable | None:
    """Write the value table; its rows and fingerprint are observed while it is written."""
    if all(v.is_key for v in variables):
        return None
    path = f"{store.base}/values/{uuid.uuid4().hex}"
    table = encoded_values(variables, soil, units)
    seen = Observation()
    h = F.xxhash64(*table.columns).cast("decimal(20,0)")
    table.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(h).alias("h")).write.parquet(path)
    found = seen.get
    names = ",".join(sorted(v.name for v in variables))
    return ValueTable(store.spark.read.schema(table.schema).parquet(path), found["rows"], f"{names}:{found['rows']}:{found['h']}")


def write_cells(cells: DataFrame, store: Store, run_no: int) -> None:
    """Overwrite exactly the tiles of the run present in ``cells``; all others stay.

    Cells are sorted where they lie; stored pixels come tile by tile.
    """
    parts = [*RUN, "tile_y", "tile_x"]
    (
        cells.withColumn("run_no", F.lit(run_no)).sortWithinPartitions(*parts, "row_no", "col_no")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(store.cells_path)
    )


def check_layout(ledger: DataFrame, region: str, tile_size: int) -> None:
    """Refuse to mix tile sizes in the stored products of a region."""
    other = ledger.where((F.col("region") == region) & (F.col("event") == led.PAIR_DONE) & (F.col("tile_size") != tile_size))
    if not other.isEmpty():
        raise LayoutError(f"{region}: stored with another tile size than {tile_size}")


def passes(variables: Sequence[Variable], rows: int, broadcast_bytes: int) -> list[list[Variable]]:
    """Products in groups whose value table is small enough to broadcast, in their order.

    Only a table of very many map units needs more than one group; a single
    product beyond the bound is a group of its own and is joined by shuffle.
    """
    out: list[list[Variable]] = []
    for v in variables:
        trial = [*out[-1], v] if out else [v]
        schema = T.StructType([T.StructField("mukey", T.LongType()), *[T.StructField(x.name, column_type(x)) for x in trial]])
        if out and rows * row_bytes(schema) <= broadcast_bytes:
            out[-1] = trial
        else:
            out.append([v])
    return out


def rasterize_products(
    store: Store, region: str, variables: Sequence[Variable], pixels: DataFrame | PixelTable, soil: DataFrame | None,
    units: DataFrame | None, release_date: str, *, tiles_per_commit: int = 0, overwrite: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> int:
    """Write several products of one region in one pass over its pixels; returns how many were owed.

    Products that are complete are left alone.  Tiles published by an unfinished
    run are skipped if it began with the same products, tile size, release and
    values; otherwise a new run starts over, and nothing of the old one is read.
    With ``tiles_per_commit`` the work is committed in batches of whole tile rows,
    so an interrupted run loses at most one batch; rewriting a tile replaces its
    partition, which makes every step safe to repeat.
    """
    spark = store.spark
    table = pixels if isinstance(pixels, PixelTable) else describe(pixels)
    here = F.col("region") == region
    ledger = store.ledger().where(here)
    states = {r["variable"]: r for r in led.pair_state(ledger).collect()}  # one row per product of the registry
    wanted = [v for v in variables if overwrite or v.name not in states or not states[v.name]["complete"]]
    if not wanted:
        return 0
    check_layout(ledger, region, store.tile_size)
    values = store_values(store, wanted, soil, units)
    mark = "key" if values is None else values.mark
    open_runs = {states[v.name]["run_no"] if v.name in states and not states[v.name]["complete"] else None for v in wanted}
    resumed = len(open_runs) == 1 and None not in open_runs and all(
        led.same_work(ledger.where(F.col("variable") == v.name), states[v.name]["run_no"], store.tile_size, release_date, mark) for v in wanted)
    run_no = open_runs.pop() if resumed else max((s["run_no"] for s in states.values()), default=0) + 1

    def record(rows: DataFrame, event: str) -> None:
        names = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in (
            ("variable", v.name), ("algorithm_id", v.algorithm), ("algorithm_version", v.version))]) for v in wanted])
        fixed = {"region": region, "run_no": run_no, "event": event, "tile_size": store.tile_size, "release_date": release_date,
                 "values_fingerprint": mark}
        each = rows.drop("region").withColumns({n: F.lit(x) for n, x in fixed.items()}).select("*", F.inline(names))
        led.append(each, store.ledger_path)

    if not resumed:
        record(spark.range(1), led.RUN_BEGUN)

    tiles = table.tiles.where(here).select("region", "tile_y", "tile_x")
    owed = led.owed_tiles(tiles.withColumn("variable", F.lit(wanted[0].name)), ledger, store.tile_size) if resumed else tiles
    # a grid has a fixed number of tiles, fewer than a thousand for the largest
    left = [(r["tile_y"], r["tile_x"]) for r in owed.select("tile_y", "tile_x").collect()]
    bands = sorted({y for y, _ in left})
    hot: list = []
    if values is not None and values.rows * row_bytes(values.table.schema) > broadcast_bytes:
        hot = hot_among(table.keys.where(here), "mukey", "pixels")
    step = len(bands) if tiles_per_commit <= 0 else max(1, tiles_per_commit)
    for start in range(0, len(bands), max(1, step)):
        batch = bands[start:start + step]
        cells = mapped(table.cells).where(here & F.col("tile_y").isin(batch)).select("region", "tile_y", "tile_x", "row_no", "col_no", "mukey")
        if values is None:
            wide = attach(cells, None, wanted)
        else:
            wide = cells
            for group in passes([v for v in wanted if not v.is_key], values.rows, broadcast_bytes):
                some = values.table.select("mukey", *[v.name for v in group])
                wide = attach(wide, some, group, rows=values.rows, hot=hot, broadcast_bytes=broadcast_bytes)
        write_cells(wide, store, run_no)
        chosen = spark.createDataFrame([t for t in left if t[0] in set(batch)], "tile_y int, tile_x int")
        record(chosen, led.TILE_DONE)
    written = tiles.count()
    lost = _write_unmatched(store, table.keys.where(here), values, wanted, run_no)
    grid = {r.name: r for r in REGIONS}.get(region)
    across = lambda n: -(-n // store.tile_size)
    skipped = None if grid is None else across(grid.height) * across(grid.width) - written
    count = F.lit(0)
    for name, n in lost.items():
        count = F.when(F.col("variable") == name, n).otherwise(count)
    done = {"tiles_written": F.lit(written), "tiles_skipped": F.lit(skipped).cast("bigint")}
    names = spark.createDataFrame([(v.name,) for v in wanted], "name string")
    record_counts = names.withColumns(done).withColumn("variable", F.col("name")).withColumn("unmatched_mukey_count", count)
    _finish(record_counts, store, region, wanted, run_no, release_date, mark)
    return len(wanted)


def _finish(rows: DataFrame, store: Store, region: str, wanted: Sequence[Variable], run_no: int, release_date: str, mark: str) -> None:
    """One append that completes every product of the run at once."""
    about = F.create_map(*[F.lit(x) for v in wanted for x in (v.name, f"{v.algorithm} {v.version}")])
    known = F.split(about[F.col("variable")], " ")
    led.append(rows.withColumns({
        "region": F.lit(region), "run_no": F.lit(run_no), "event": F.lit(led.PAIR_DONE), "tile_size": F.lit(store.tile_size),
        "release_date": F.lit(release_date), "values_fingerprint": F.lit(mark), "algorithm_id": known[0], "algorithm_version": known[1],
    }), store.ledger_path)


def _write_unmatched(
    store: Store, keys: DataFrame, values: ValueTable | None, wanted: Sequence[Variable], run_no: int,
) -> dict[str, int]:
    """Keys of the region's pixels that a product's table doesn't know, and their number by product."""
    if values is None:
        return {}
    lost = None
    for flag, by_depth in (("in_units", False), ("in_soil", True)):
        names = [v.name for v in wanted if v.by_depth == by_depth and not v.is_key]
        if names:
            known = values.table.where(F.col(flag)).select("mukey")
            each = keys.join(known, "mukey", "left_anti").select(
                "mukey", "pixels", "region", F.explode(F.array(*[F.lit(n) for n in names])).alias("variable"))
            lost = each if lost is None else lost.unionByName(each)
    (
        lost.withColumn("run_no", F.lit(run_no)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("region", "variable", "run_no").parquet(f"{store.base}/unmatched")
    )
    here = store.unmatched().where(F.col("run_no") == run_no).join(F.broadcast(keys.select("region").limit(1)), "region", "left_semi")
    return {r["variable"]: r["count"] for r in here.groupBy("variable").count().collect()}


def rasterize_pair(
    store: Store, region: str, v: Variable, pixels: DataFrame | PixelTable, values: DataFrame | None, release_date: str, **kw,
) -> bool:
    """Write one product of a region; returns False when it was already complete."""
    return rasterize_products(store, region, [v], pixels, values, values, release_date, **kw) > 0


def rasterize_all(
    store: Store, regions: Iterable[str], names: Iterable[str] | None, pixels: DataFrame | PixelTable, soil: DataFrame,
    units: DataFrame, release_date: str, **kw,
) -> int:
    """Every requested pair, a region at a time; returns how many were written."""
    wanted = resolve(names)
    return sum(rasterize_products(store, region, wanted, pixels, soil, units, release_date, **kw) for region in regions)


def extend(
    store: Store, regions: Sequence[str], names: Iterable[str] | None, pixels: DataFrame | PixelTable, soil: DataFrame,
    units: DataFrame, release_date: str, **kw,
) -> int:
    """Create only the declared products a region lacks; what is stored stays as it is, file for file.

    The missing ones are the declared pairs without a finished run in the ledger.
    """
    wanted = resolve(names)
    frame = store.spark.createDataFrame([(r,) for r in regions], "region string")
    owed: dict[str, set[str]] = {}
    for r in led.remaining_pairs(frame, [v.name for v in wanted], store.ledger()).collect():  # regions x registry
        owed.setdefault(r["region"], set()).add(r["variable"])
    return sum(
        rasterize_products(store, region, [v for v in wanted if v.name in owed[region]], pixels, soil, units, release_date, **kw)
        for region in regions if region in owed)


def status(store: Store, regions: DataFrame | None = None) -> DataFrame:
    """The completion matrix of the store."""
    spark = store.spark
    return led.completion_matrix(
        region_frame(spark, REGIONS) if regions is None else regions, [v.name for v in resolve(None)], store.ledger()
    )


def release(store: Store, regions: DataFrame, variables: Sequence[str], release_date: str) -> str:
    """Pin the runs of a complete store under a tag, and return the tag.

    Every pinned run is read back before the tag is written; its rows go out in one
    commit, so a tag is there whole or not at all.  A tag is never reused: a later
    release of the same date gets a revision.
    """
    led.require_complete(regions, variables, store.ledger())
    pinned = led.snapshot(store.ledger(), regions, variables)
    stored = store.spark.read.schema("region string, run_no int, tile_y int, tile_x int, row_no int").parquet(store.cells_path)
    runs = pinned.select(*RUN).distinct()
    cells = stored.join(F.broadcast(runs), RUN, "left_semi").groupBy(*RUN).agg(F.count("*").alias("cells"))  # runs: a few a region
    readable = pinned.join(cells, RUN, "left")
    empty = [f"{r['region']}/{r['variable']}" for r in readable.where(F.col("cells").isNull()).select("region", "variable").collect()]
    if empty:
        raise led.IncompleteError(f"pairs without stored cells: {sorted(empty)}")
    used = {r["tag"] for r in store.releases().select("tag").distinct().collect()}
    tag, revision = release_date, 1
    while tag in used:
        revision += 1
        tag = f"{release_date}-r{revision}"
    (
        readable.select(F.lit(tag).alias("tag"), "region", "variable", "run_no", "cells").coalesce(1)
        .write.mode("append").parquet(store.releases_path)
    )
    return tag
