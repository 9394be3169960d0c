"""Queries over the pixel table: lookups, inventories, samples, comparisons and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamgrid.functions import encode_integer, x_centre, y_centre
from loamgrid.model.intervals import DEPTH
from loamgrid.model.variables import variable
from loamgrid.operators import components as comp
from loamgrid.operators import compare, inventory, lookup, measures, rootzone, sampling, stocks, texture
from loamgrid.plans import gates, ledger
from loamgrid.plans.rasterize import attach, values_at
from loamgrid.plans.rasterize import encoded_values as encoded_table
from loamgrid.sources import pixels as px

from . import steps as s
from .queries_tables import derived_tables
from .registry import query

TILE = 16

# --- pixel table ---------------------------------------------------------------------------------


@query("mapped_pixels", views=["pixels"], ctes=[s.MAPPED], sql="select * from mapped")
def mapped_pixels(t):
    return px.mapped(t["pixels"])


@query(
    "pixel_tiles", views=["pixels"], ctes=[s.MAPPED],
    sql="""select region, row_no // 16 as tile_y, col_no // 16 as tile_x, count(*) as mapped_pixels, min(row_no) as min_row,
        max(row_no) as max_row, min(col_no) as min_col, max(col_no) as max_col from mapped group by 1, 2, 3""",
)
def pixel_tiles(t):
    return px.tile_summary(t["pixels"], TILE)


@query(
    "pixel_window", views=["pixels"], ctes=[s.MAPPED],
    sql="""select region, row_no, col_no, mukey from mapped
      where region = 'click' and row_no between 2 and 41 and col_no between 30 and 69""",
)
def pixel_window(t):
    tiled = px.with_tiles(t["pixels"], TILE)
    out = px.window(px.mapped(tiled), "click", 2, 42, 30, 70, size=TILE)
    return out.select("region", "row_no", "col_no", "mukey")


@query(
    "region_key_inventory", views=["pixels"], ctes=[s.MAPPED],
    sql="""select region, count(distinct mukey) as unique_mukeys, count(*) as mapped_pixels, min(mukey) as min_mukey,
        max(mukey) as max_mukey from mapped group by region""",
)
def region_key_inventory(t):
    return inventory.region_key_inventory(t["pixels"])


@query("key_pixel_counts", views=["pixels"], ctes=[s.MAPPED],
       sql="select region, mukey, count(*) as pixels from mapped group by region, mukey")
def key_pixel_counts(t):
    return lookup.key_counts(t["pixels"])


AREAS = """select s_suppkey as area, case s_nationkey % 3 when 0 then 'detailed' when 1 then 'general' else 'raster' end as source
from supplier"""
AREA_PIXELS = "select event_type as region, user_id % 300 as area from events"


@query(
    "source_class_inventory", ctes=[f"areas as ({AREAS})", f"area_pixels as ({AREA_PIXELS})"],
    sql="""select p.region, a.source, count(distinct a.area) as survey_area_records, count(*) as pixels
      from area_pixels p join areas a on p.area = a.area group by 1, 2""",
)
def source_class_inventory(t):
    return inventory.source_class_inventory(t.sql(AREAS, "supplier"), t.sql(AREA_PIXELS, "events"))


def region_dims(t):
    """Grids for the adapter's regions: thirty-unit cells from a common corner."""
    return t["pixels"].groupBy("region").agg(
        (F.max("row_no") + 1).alias("height"), F.lit(100).alias("width"), F.lit(0.0).alias("x_min"),
        F.lit(0.0).alias("y_max"), F.lit(30.0).alias("pixel_size"),
    )


REGIONS = """regions as (
  select region, max(row_no) + 1 as height, 100 as width, 0.0 as x_min, 0.0 as y_max, 30.0 as pixel_size
  from pixels group by region)"""


@query("pixel_centres", views=["pixels"], ctes=[s.MAPPED], doubles=["x", "y"],
       sql="select region, row_no, col_no, 30 * (col_no + 0.5) as x, -30 * (row_no + 0.5) as y from mapped")
def pixel_centres(t):
    size, zero = F.lit(30.0), F.lit(0.0)
    return px.mapped(t["pixels"]).select(
        "region", "row_no", "col_no", x_centre("col_no", zero, size).alias("x"), y_centre("row_no", zero, size).alias("y")
    )


OTHER = """select event_type as region, cast(floor(event_id / 100.0) as int) as row_no, cast(case when event_type = 'view' then event_id % 50 else event_id % 100 end as int) as col_no,
  cast(user_id + 1 as bigint) as mukey from events"""


@query(
    "grid_conformance", views=["pixels"], ctes=[REGIONS, f"other as ({OTHER})"],
    sql="""select r.region, a.n as first_pixels, b.n as second_pixels,
        greatest(a.r1, b.r1) < r.height and greatest(a.c1, b.c1) < r.width as inside_grid,
        a.r0 = b.r0 and a.r1 = b.r1 and a.c0 = b.c0 and a.c1 = b.c1 as same_extent,
        greatest(a.r1, b.r1) < r.height and greatest(a.c1, b.c1) < r.width
          and a.r0 = b.r0 and a.r1 = b.r1 and a.c0 = b.c0 and a.c1 = b.c1 as passed
      from regions r
      join (select region, count(*) as n, min(row_no) as r0, max(row_no) as r1, min(col_no) as c0, max(col_no) as c1
        from pixels group by region) a using (region)
      join (select region, count(*) as n, min(row_no) as r0, max(row_no) as r1, min(col_no) as c0, max(col_no) as c1
        from other group by region) b using (region)""",
)
def grid_conformance(t):
    return px.grid_conformance(t["pixels"], t.sql(OTHER, "events"), region_dims(t))


# --- values at pixels ----------------------------------------------------------------------------

_CELL = "p.region, p.row_no, p.col_no, p.mukey"
_ROOT_VIEWS = ["component", "chorizon", "corestrictions", "pixels"]
_ROOT_STEPS = [*s.DEPTH_STEPS, s.EARTHY, s.LIMITS, s.ROOTWATER, s.MAPPED,
               "flag as (select mukey, case when rootznaws <= 152 then 1 else 0 end as droughty from rootzone)"]


@query("rasterize_2d", views=_ROOT_VIEWS, ctes=_ROOT_STEPS,
       sql=f"select {_CELL}, cast(coalesce(f.droughty, 255) as smallint) as value from mapped p left join flag f on p.mukey = f.mukey")
def rasterize_2d(t):
    table = rootzone.root_zone(t["component"], t["corestrictions"], t["chorizon"])
    return lookup.rasterize(t["pixels"], table, variable("droughty"))


@query("rasterize_2d_float", views=["component", "pixels"], ctes=[s.DOMINANT, s.MAPPED], doubles=["value"],
       sql=f"select {_CELL}, cast(d.slope_r as float) as value from mapped p left join dominant d on p.mukey = d.mukey")
def rasterize_2d_float(t):
    return lookup.rasterize(t["pixels"], comp.terrain(t["component"]), variable("slope"))


@query("rasterize_key", views=["pixels"], ctes=[s.MAPPED], sql=f"select {_CELL}, p.mukey as value from mapped p")
def rasterize_key(t):
    return lookup.rasterize(t["pixels"], t["pixels"], variable("mukey"))


_KSAT_VIEWS = ["component", "chorizon", "pixels"]
_KSAT_STEPS = [*s.DEPTH_STEPS, s.DOMINANT, s.KSAT, s.MAPPED]


def ksat_table(t):
    return measures.least_transmissive(t["chorizon"], t["component"]).withColumnRenamed("value", "ksat")


@query("rasterize_3d_slice", views=_KSAT_VIEWS, ctes=_KSAT_STEPS, doubles=["value"],
       sql=f"""select {_CELL}, cast(k.value as float) as value from mapped p
         left join (select * from ksat where depth_interval = '0_100') k on p.mukey = k.mukey""")
def rasterize_3d_slice(t):
    return lookup.rasterize(t["pixels"], ksat_table(t), variable("ksat"), "0_100")


@query("rasterize_all_depths", views=_KSAT_VIEWS, ctes=_KSAT_STEPS, doubles=["value"],
       sql=f"""select {_CELL}, i.depth_interval, cast(k.value as float) as value from mapped p cross join intervals i
         left join ksat k on p.mukey = k.mukey and i.depth_interval = k.depth_interval""")
def rasterize_all_depths(t):
    return values_at(t["pixels"], ksat_table(t), variable("ksat"))


@query("encoded_values", views=["component"], ctes=[s.MUSUM],
       sql="""select u.mukey, cast(coalesce(round_even(m.musumcpct, 0), 65535) as bigint) as code
         from (select distinct mukey from component) u left join (select mukey, musumcpct / 4 as musumcpct from musum) m on u.mukey = m.mukey""")
def encoded_values(t):
    sums = t["component"].groupBy("mukey").agg((F.sum("comppct_r") / 4).alias("quarter"))
    return sums.select("mukey", encode_integer("quarter", 0, 65_535, 65_535, "quarter").alias("code"))


_UNMATCHED = "unmatched as (select region, mukey, count(*) as pixels from mapped where mukey not in (select mukey from mapunit) group by 1, 2)"


@query("unmatched_keys", views=["pixels", "mapunit"], ctes=[s.MAPPED, _UNMATCHED], sql="select * from unmatched")
def unmatched_keys(t):
    return lookup.unmatched_keys(t["pixels"], t["mapunit"])


@query("unmatched_report", views=["pixels", "mapunit"], ctes=[s.MAPPED, _UNMATCHED],
       sql="select count(distinct mukey) as unmatched_mukey_count from unmatched")
def unmatched_report(t):
    return lookup.unmatched_report(lookup.unmatched_keys(t["pixels"], t["mapunit"]))


POINTS = """select c_custkey as point_id,
  case c_custkey % 5 when 0 then 'view' when 1 then 'signup' when 2 then 'click' when 3 then 'error' else 'purchase' end as region,
  cast(c_custkey * 37 % 3100 as double) + 0.25 as x, 0.25 - cast(c_custkey * 53 % 3300 as double) as y from customer"""
_LOCATED = f"""points as ({POINTS}),
located as (
  select p.*, case when inside then cast(floor(-p.y / 30) as int) end as row_no, case when inside then cast(floor(p.x / 30) as int) end as col_no
  from points p left join (select q.point_id, true as inside from points q join regions r using (region)
    where floor(-q.y / 30) >= 0 and floor(-q.y / 30) < r.height and floor(q.x / 30) >= 0 and floor(q.x / 30) < r.width) i
  on p.point_id = i.point_id)"""


@query("point_lookup", views=["pixels"], ctes=[s.MAPPED, REGIONS, _LOCATED], doubles=["x", "y"],
       sql="""select l.point_id, l.region, l.x, l.y, l.row_no, l.col_no, m.mukey from located l left join mapped m
         on l.region = m.region and l.row_no = m.row_no and l.col_no = m.col_no""")
def point_lookup(t):
    return lookup.keys_at(t.sql(POINTS, "customer"), t["pixels"], region_dims(t))


@query("point_profile", views=["component", "chorizon", "pixels"],
       ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.AWS, s.MAPPED, REGIONS, _LOCATED], doubles=["aws"],
       sql="""select l.point_id, m.mukey, i.depth_interval, a.value as aws from located l left join mapped m
         on l.region = m.region and l.row_no = m.row_no and l.col_no = m.col_no cross join intervals i
         left join aws_long a on m.mukey = a.mukey and i.depth_interval = a.depth_interval""")
def point_profile(t):
    soil = stocks.aws_by_interval(t["chorizon"], t["component"])
    out = lookup.depth_profiles(t.sql(POINTS, "customer"), t["pixels"], region_dims(t), soil, ["aws"])
    return out.select("point_id", "mukey", DEPTH, "aws")


@query("field_window", views=["component", "chorizon", "pixels"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.AWS, s.MAPPED], doubles=["aws"],
       sql="""select m.row_no, m.col_no, a.value as aws from mapped m
         left join (select * from aws_long where depth_interval = '0_100') a on m.mukey = a.mukey
         where m.region = 'click' and m.row_no between 2 and 41 and m.col_no between 30 and 69""")
def field_window(t):
    soil = stocks.aws_by_interval(t["chorizon"], t["component"]).where(F.col(DEPTH) == "0_100")
    field = px.window(t["pixels"], "click", 2, 42, 30, 70)
    return lookup.expand(field, soil, ["aws"]).select("row_no", "col_no", "aws")


@query("depth_slice", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.DOMINANT, s.KSAT], doubles=["ksat"],
       sql="select mukey, value as ksat from ksat where depth_interval = '20_50'")
def depth_slice(t):
    return ksat_table(t).where(F.col(DEPTH) == "20_50").select("mukey", "ksat")


@query("texture_at_pixels", views=["component", "chorizon", "chtexturegrp", "pixels"], ctes=[s.DOMINANT, s.SURFACE, s.TEXTURES, s.MAPPED],
       sql=f"""select {_CELL}, coalesce(d.code, 65535) as value, d.name as texture_name, d.description from mapped p
         left join surface_texture t on p.mukey = t.mukey left join dictionary d on t.texture = d.name""")
def texture_at_pixels(t):
    codes = texture.texture_dictionary(t["chtexturegrp"])
    surface = texture.surface_texture(t["component"], t["chorizon"], t["chtexturegrp"])
    coded = lookup.rasterize(t["pixels"], texture.encode_texture(surface, codes), variable("texture_class"))
    return texture.decode_texture(coded, codes, "value")


# --- samples and comparisons ---------------------------------------------------------------------


@query("pixel_sample", views=["pixels"], ctes=[s.MAPPED],
       sql="""select *, md5(region || '|' || cast(row_no as varchar) || '|' || cast(col_no as varchar) || '|42') as draw from mapped
         order by draw, region, row_no, col_no limit 200""")
def pixel_sample(t):
    return sampling.pixel_sample(t["pixels"], 200, 42)


@query("tile_sample", views=["pixels"], ctes=[s.MAPPED, """chosen as (
  select region, tile_y, tile_x from (select distinct region, row_no // 16 as tile_y, col_no // 16 as tile_x from mapped) x
  order by md5(region || '|' || cast(tile_y as varchar) || '|' || cast(tile_x as varchar) || '|7'), 1, 2, 3 limit 8)"""],
       sql="""select m.*, c.tile_y, c.tile_x from mapped m join chosen c
         on m.region = c.region and m.row_no // 16 = c.tile_y and m.col_no // 16 = c.tile_x""")
def tile_sample(t):
    return sampling.tile_sample(t["pixels"], 8, 7, TILE)


STORED = """select event_type as region,
  cast(case when event_id % 701 = 3 then -1 - floor(event_id / 100.0) else floor(event_id / 100.0) end as int) as row_no, cast(event_id % 100 as int) as col_no,
  cast(case when event_id % 10 = 0 then 0 when event_id % 503 = 1 then user_id + 2 when event_id % 97 = 0 then 900000 + user_id
    else user_id + 1 end as bigint) as mukey from events"""
ASKED_REGIONS = "select distinct event_type as region from events union all select 'unsurveyed' as region"
_BOTH = f"""stored as ({STORED}),
both_cells as (
  select coalesce(a.region, b.region) as region, coalesce(a.row_no, b.row_no) as row_no, coalesce(a.col_no, b.col_no) as col_no,
    a.mukey as stored_mukey, b.mukey as source_mukey
  from (select * from stored where mukey <> 0) a full join mapped b
    on a.region = b.region and a.row_no = b.row_no and a.col_no = b.col_no)"""


@query("key_equality", views=["pixels"], ctes=[s.MAPPED, _BOTH],
       sql=f"""select *, status = 'passed' as passed from (select region, compared, mismatches,
           case when compared = 0 then 'insufficient sampling' when mismatches = 0 then 'passed' else 'failed' end as status
         from (select r.region, count(b.region) as compared,
             count(case when b.region is not null and stored_mukey is distinct from source_mukey then 1 end) as mismatches
           from ({ASKED_REGIONS}) r left join both_cells b on r.region = b.region group by r.region) x) y""")
def key_equality(t):
    return compare.key_equality(t.sql(STORED, "events"), t["pixels"], t.sql(ASKED_REGIONS, "events"))


@query("key_differences", views=["pixels"], ctes=[s.MAPPED, _BOTH],
       sql="select * from both_cells where stored_mukey is distinct from source_mukey")
def key_differences(t):
    return compare.key_differences(t.sql(STORED, "events"), t["pixels"])


def corrupted_slope(t):
    """Slope at pixels, with a few cells changed or emptied on purpose."""
    cells = lookup.rasterize(t["pixels"], comp.terrain(t["component"]), variable("slope"))
    n = F.col("row_no") * 100 + F.col("col_no")
    spoiled = F.when(n % 811 == 7, F.col("value") + 1).when(n % 907 != 5, F.col("value"))
    return cells.withColumn("value", spoiled.cast("float"))


_SPOILED = """cells as (
  select p.region, p.row_no, p.col_no, p.mukey, d.slope_r as expected,
    case when (p.row_no * 100 + p.col_no) % 811 = 7 then d.slope_r + 1 when (p.row_no * 100 + p.col_no) % 907 <> 5 then d.slope_r
      end as value
  from mapped p left join dominant d on p.mukey = d.mukey)"""


@query("value_comparison", views=["component", "pixels"], ctes=[s.DOMINANT, s.MAPPED, _SPOILED], doubles=["value", "expected"],
       sql="select region, row_no, col_no, mukey, value, expected from cells where value is distinct from expected")
def value_comparison(t):
    out = compare.value_comparison(corrupted_slope(t), comp.terrain(t["component"]), variable("slope"))
    return out.where(~F.col("same")).drop("same")


@query("value_equality", views=["component", "pixels"], ctes=[s.DOMINANT, s.MAPPED, _SPOILED],
       sql="""select 'slope' as variable, count(*) as compared,
           cast(sum(case when value is distinct from expected then 1 else 0 end) as bigint) as mismatches,
           case when sum(case when value is distinct from expected then 1 else 0 end) = 0 then 'passed' else 'failed' end as status
         from cells""")
def value_equality(t):
    return compare.value_equality(corrupted_slope(t), comp.terrain(t["component"]), variable("slope"))


def corrupted_ksat(t):
    """Conductivity at pixels for all intervals, with a few cells changed or emptied on purpose."""
    cells = values_at(t["pixels"], ksat_table(t), variable("ksat"))
    n = F.col("row_no") * 100 + F.col("col_no")
    spoiled = F.when((n % 811 == 7) & (F.col(DEPTH) == "0_5"), F.col("value") + 1).when((n % 907 != 5) | (F.col(DEPTH) != "20_50"), F.col("value"))
    return cells.withColumn("value", spoiled.cast("float"))


_SPOILED_KSAT = """cells as (
  select p.region, p.row_no, p.col_no, p.mukey, i.depth_interval, k.value as expected, cast(
    case when (p.row_no * 100 + p.col_no) % 811 = 7 and i.depth_interval = '0_5' then cast(k.value as float) + cast(1 as float)
      when (p.row_no * 100 + p.col_no) % 907 <> 5 or i.depth_interval <> '20_50' then cast(k.value as float) end as float) as value
  from mapped p cross join intervals i left join ksat k on p.mukey = k.mukey and i.depth_interval = k.depth_interval),
judged as (select *, coalesce(abs(value - expected) <= greatest(1e-6 * greatest(abs(value), abs(expected)), 1e-5),
    value is null and expected is null) as same from cells)"""


@query("value_comparison_by_depth", views=_KSAT_VIEWS, ctes=[*_KSAT_STEPS, _SPOILED_KSAT], doubles=["value", "expected"],
       sql="select region, row_no, col_no, mukey, depth_interval, value, expected from judged where not same")
def value_comparison_by_depth(t):
    out = compare.value_comparison(corrupted_ksat(t), ksat_table(t), variable("ksat"))
    return out.where(~F.col("same")).drop("same")


@query("value_equality_by_depth", views=_KSAT_VIEWS, ctes=[*_KSAT_STEPS, _SPOILED_KSAT],
       sql="""select 'ksat' as variable, count(*) as compared, count(case when not same then 1 end) as mismatches,
           case when count(case when not same then 1 end) = 0 then 'passed' else 'failed' end as status from judged""")
def value_equality_by_depth(t):
    return compare.value_equality(corrupted_ksat(t), ksat_table(t), variable("ksat"))


@query("stored_structure", views=_KSAT_VIEWS, ctes=[*_KSAT_STEPS, REGIONS],
       sql="""select r.region, count(m.mukey) as cells, v.variable, v.variable <> 'elevation' as type_ok, true as intervals_ok,
           count(case when m.row_no // 16 <> least(m.row_no // 16, 60) then 1 end) = 0 as tiles_ok,
           coalesce(max(m.row_no) < max(r.height) and max(m.col_no) < max(r.width), false) as inside_grid,
           v.variable <> 'elevation' and count(case when m.row_no // 16 <> least(m.row_no // 16, 60) then 1 end) = 0 and
             coalesce(max(m.row_no) < max(r.height) and max(m.col_no) < max(r.width), false) as passed
         from regions r left join mapped m on r.region = m.region
           cross join (values ('mukey'), ('slope'), ('ksat'), ('elevation')) v(variable) group by r.region, v.variable""")
def stored_structure(t):
    """Two products as they are stored, one that is missing, and tiles below row 976 stored under the wrong number."""
    some = [variable(n) for n in ("slope", "ksat")]
    table = encoded_table(some, ksat_table(t), comp.terrain(t["component"]))
    tiled = px.with_tiles(px.mapped(t["pixels"]), TILE).withColumn("tile_y", F.least("tile_y", F.lit(60)))
    wide = attach(tiled, table, some)
    return gates.stored_structure(wide, [variable(n) for n in ("mukey", "slope", "ksat", "elevation")], region_dims(t), TILE)


CHECKS = """select event_type || '/' || cast(user_id % 7 as string) as check_name,
  count(case when user_id % 7 < 5 then 1 end) as compared,
  count(case when user_id % 7 < 3 and value > 80 then 1 end) as mismatches from events group by 1"""


@query("check_status", ctes=[f"counted as ({CHECKS})"],
       sql="""select *, status = 'passed' as passed from (select *, case when compared = 0 then 'insufficient sampling'
           when mismatches = 0 then 'passed' else 'failed' end as status from counted) x""")
def check_status(t):
    return compare.check_status(t.sql(CHECKS, "events"))


@query("grid_structure", views=["component", "pixels"], ctes=[s.DOMINANT, s.MAPPED, REGIONS], doubles=["first_x", "first_y"],
       sql="""select r.region, count(m.mukey) as cells, count(d.slope_r) as with_value, 15.0 as first_x, -15.0 as first_y,
           min(m.row_no) >= 0 and min(m.col_no) >= 0 and max(m.row_no) < max(r.height) and max(m.col_no) < max(r.width) as passed
         from regions r left join mapped m on r.region = m.region left join dominant d on m.mukey = d.mukey group by r.region""")
def grid_structure(t):
    cells = lookup.rasterize(t["pixels"], comp.terrain(t["component"]), variable("slope"))
    return gates.grid_structure(cells, region_dims(t))


# --- ledger --------------------------------------------------------------------------------------

EVENTS = """select event_type as region, 'v' || cast(user_id % 40 as string) as variable, cast(1 + user_id % 3 as int) as run_no,
  case when event_id % 9 = 0 then 'complete' else 'tile' end as event, cast(event_id % 7 as int) as tile_y,
  cast(event_id % 5 as int) as tile_x, cast(case when event_id % 31 = 0 then 8192 else 4096 end as int) as tile_size,
  '2026-02-13' as release_date, 'a' || cast(user_id % 4 as string) as algorithm_id, '1.0' as algorithm_version,
  event_id as tiles_written, user_id as unmatched_mukey_count,
  event_id % 13 as tiles_skipped from events"""
WANTED_REGIONS = "select distinct event_type as region from events"
WANTED_VARIABLES = [f"v{i}" for i in range(42)]
_LEDGER = f"""ledger as ({EVENTS}),
state as (
  select region, variable, max(run_no) as run_no,
    coalesce(max(case when event = 'complete' then run_no end) = max(run_no), false) as complete from ledger group by 1, 2),
wanted as (select region, variable from ({WANTED_REGIONS}) r cross join (select unnest({WANTED_VARIABLES}) as variable) v),
owed as (select w.* from wanted w left join state s on w.region = s.region and w.variable = s.variable
  where not coalesce(s.complete, false))"""


def ledger_frames(t):
    return t.sql(WANTED_REGIONS, "events"), WANTED_VARIABLES, t.sql(EVENTS, "events")


@query("pair_state", ctes=[_LEDGER], sql="select * from state")
def pair_state(t):
    return ledger.pair_state(t.sql(EVENTS, "events"))


@query("remaining_pairs", ctes=[_LEDGER], sql="select * from owed")
def remaining_pairs(t):
    return ledger.remaining_pairs(*ledger_frames(t))


@query("completion_matrix", ctes=[_LEDGER],
       sql="""select region, wanted, done, in_flight, case when done = wanted then 'complete'
           when done = 0 and in_flight = 0 then 'not started' else cast(done as varchar) || '/' || cast(wanted as varchar) end as state, missing
         from (select w.region, count(*) as wanted, count(case when s.complete then 1 end) as done,
             count(case when not s.complete then 1 end) as in_flight,
             coalesce(string_agg(case when not coalesce(s.complete, false) then w.variable end, ', ' order by w.variable), '') as missing
           from wanted w left join state s on w.region = s.region and w.variable = s.variable group by w.region) x""")
def completion_matrix(t):
    return ledger.completion_matrix(*ledger_frames(t))


@query("release_gate", ctes=[_LEDGER], sql="select count(*) as missing_pairs, count(*) = 0 as passed from owed")
def release_gate(t):
    return ledger.release_gate(*ledger_frames(t))


_PINNED = """pins as (
  select 'first' as tag, region, variable, max(run_no) as run_no from ledger where event = 'complete' and run_no <= 2 group by 2, 3
  union all select 'second', region, variable, max(run_no) from ledger where event = 'complete' group by 2, 3),
asked as (select p.* from pins p join wanted w on p.region = w.region and p.variable = w.variable)"""


@query("release_as_of", ctes=[_LEDGER, _PINNED],
       sql="""select a.tag, l.region, l.variable, l.run_no, l.tile_y, l.tile_x, count(*) as records, cast(sum(l.tiles_written) as bigint) as total
         from ledger l join asked a on l.region = a.region and l.variable = a.variable and l.run_no = a.run_no
         where l.event = 'tile' group by all""")
def release_as_of(t):
    """Tiles as two releases pinned them: one made before the third runs, one after."""
    regions, variables, events = ledger_frames(t)
    before = ledger.snapshot(events.where("run_no <= 2"), regions, variables).withColumn("tag", F.lit("first"))
    pins = before.unionByName(ledger.snapshot(events, regions, variables).withColumn("tag", F.lit("second")))
    cells = ledger.as_of(events.where("event = 'tile'"), pins)
    return cells.groupBy("tag", "region", "variable", "run_no", "tile_y", "tile_x").agg(
        F.count("*").alias("records"), F.sum("tiles_written").alias("total"))


@query("owed_tiles", ctes=[_LEDGER, f"""tiles as (select distinct region, variable, tile_y, tile_x from ledger)"""],
       sql="""select * from tiles t where not exists (
           select 1 from ledger l join state s on l.region = s.region and l.variable = s.variable and l.run_no = s.run_no
           where not s.complete and l.event = 'tile' and l.tile_size = 4096 and l.region = t.region and l.variable = t.variable
             and l.tile_y = t.tile_y and l.tile_x = t.tile_x)""")
def owed_tiles(t):
    events = t.sql(EVENTS, "events")
    tiles = events.select("region", "variable", "tile_y", "tile_x").distinct()
    return ledger.owed_tiles(tiles, events, 4096)


@query("provenance", ctes=[f"ledger as ({EVENTS})"],
       sql="""select * exclude (event, tile_y, tile_x, place) from (select *, row_number() over (partition by region, variable
           order by run_no desc, release_date desc, algorithm_id desc, algorithm_version desc, tile_size desc, tiles_written desc,
             unmatched_mukey_count desc, tiles_skipped desc) as place from ledger where event = 'complete') x where place = 1""")
def provenance(t):
    return ledger.provenance(t.sql(EVENTS, "events"))


@query("merged_products", views=s.SOIL_VIEWS, ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.FRAGMENTS, s.AWS, s.SOC, s.COMPOSITION],
       doubles=["sand", "aws"],
       sql="""select coalesce(c.mukey, a.mukey) as mukey, coalesce(c.depth_interval, a.depth_interval) as depth_interval,
           c.sand, a.value as aws from composition c full join aws_long a
         on c.mukey = a.mukey and c.depth_interval = a.depth_interval""")
def merged_products(t):
    """Products of two operators on one key; keys known to either side are kept."""
    from loamgrid.operators.properties import AWS, PARTICLE_SIZE, property_sums

    found = derived_tables(t)
    return property_sums(found["component"], found["chorizon"], [PARTICLE_SIZE, AWS], ksat=False).select(
        "mukey", DEPTH, "sand", "aws"
    )
