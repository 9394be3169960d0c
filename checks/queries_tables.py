"""Queries over the relational tables: scans, contracts, horizons, components, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamgrid.functions import default_text
from loamgrid.model.intervals import DEPTH, interval_frame
from loamgrid.operators import components as comp
from loamgrid.operators import crops, measures, properties, rootzone, stocks, texture, wetland
from loamgrid.operators import inventory
from loamgrid.operators.overlap import NUMBER, OVERLAP, interval_overlaps, profile_bottom, valid_horizons, with_label
from loamgrid.plans import derived, gates
from loamgrid.sources import release, tables

from . import steps as s
from .registry import query

# --- scans and contracts -------------------------------------------------------------------------

RAW_COMPONENT = """
select cast(o_custkey + 1 as string) as mukey, cast(o_orderkey as string) as cokey,
  case when o_orderkey % 23 = 0 then 'n/a' when o_orderkey % 29 = 0 then '' else cast(o_orderkey % 90 as string) end as comppct_r,
  o_orderpriority as compname, 'Series' as compkind, o_orderstatus as majcompflag, cast(null as string) as otherph,
  cast(null as string) as localphase, 'No' as hydricrating, cast(null as string) as drainagecl,
  cast(o_orderkey % 45 as string) as slope_r, cast(o_orderkey % 200 as string) as slopelenusle_r,
  cast(o_orderkey % 3000 as string) as elev_r, cast(o_orderkey % 360 as string) as aspectrep, 'unused' as extra
from orders
"""


@query(
    "typed_scan", ctes=[f"raw as ({RAW_COMPONENT})"], doubles=["comppct_r", "slope_r", "slopelenusle_r", "elev_r", "aspectrep"],
    sql="""select cast(mukey as bigint) as mukey, cokey, try_cast(comppct_r as double) as comppct_r, compname, compkind,
      majcompflag, otherph, localphase, hydricrating, drainagecl, cast(slope_r as double) as slope_r,
      cast(slopelenusle_r as double) as slopelenusle_r, cast(elev_r as double) as elev_r, cast(aspectrep as double) as aspectrep
      from raw""",
)
def typed_scan(t):
    return tables.scan(t.sql(RAW_COMPONENT, "orders"), tables.TABLES["component"], strict=False)


@query(
    "interpretation_subset", views=["cointerp"], doubles=["interphr"],
    sql="select * from cointerp where upper(mrulename) like 'NCCPI%'",
)
def interpretation_subset(t):
    return tables.scan(t["cointerp"], tables.TABLES["cointerp"])


@query(
    "required_columns", views=["mapunit", "component", "chorizon", "chfrags", "corestrictions", "cointerp", "chtexturegrp"],
    sql="""select 'mapunit' as table_name, count(*) as rows, '' as missing_columns, true as passed from mapunit
      union all select 'muaggatt', 0, 'mukey, slopegraddcp, slopegradwta, aws025wta, aws0100wta, aws0150wta', false
      union all select 'component', count(*), 'otherph', false from component
      union all select 'chorizon', count(*), '', true from chorizon
      union all select 'chfrags', count(*), '', true from chfrags
      union all select 'corestrictions', count(*), '', true from corestrictions
      union all select 'cointerp', count(*), '', true from cointerp
      union all select 'chtexturegrp', count(*), '', true from chtexturegrp""",
)
def required_columns(t):
    found = {n: t[n] for n in tables.TABLES if n != "muaggatt"}
    found["component"] = found["component"].drop("otherph")
    return tables.required_columns(found)


@query(
    "key_uniqueness", views=["mapunit", "component", "chorizon", "chtexturegrp"],
    sql="""select table_name, cast(sum(n) as bigint) as rows, count(*) as distinct_keys,
        cast(sum(case when n > 1 then 1 else 0 end) as bigint) as repeated_keys,
        sum(case when n > 1 then 1 else 0 end) = 0 as passed
      from (select 'mapunit' as table_name, count(*) as n from mapunit group by mukey
        union all select 'component', count(*) from component group by cokey
        union all select 'chorizon', count(*) from chorizon group by chkey
        union all select 'chtexturegrp', count(*) from chtexturegrp group by chkey) x group by table_name""",
)
def key_uniqueness(t):
    return tables.key_report(
        {n: (t[n], [k]) for n, k in [("mapunit", "mukey"), ("component", "cokey"), ("chorizon", "chkey"), ("chtexturegrp", "chkey")]}
    )


UNITS_NOW = "select event_type as unit, cast(cast(ts as date) as string) as day, count(*) as n, cast(sum(event_id) as bigint) as mark from events group by 1, 2"
UNITS_THEN = (
    "select event_type as unit, cast(cast(ts as date) as string) as day, count(*) as n, "
    "cast(sum(case when event_id % 400 = 7 then 0 else event_id end) as bigint) as mark from events group by 1, 2"
)


@query(
    "stale_units", ctes=[f"requested as ({UNITS_NOW})", f"recorded as ({UNITS_THEN})"],
    sql="""select r.* from requested r left join recorded o on r.unit = o.unit and r.day = o.day and r.n = o.n
      and r.mark = o.mark where o.unit is null""",
)
def stale_units(t):
    return release.stale_units(t.sql(UNITS_NOW, "events"), t.sql(UNITS_THEN, "events"), ["unit", "day", "n", "mark"])


FILES = """
select o_orderkey as file_id, cast(o_custkey as bigint) as release_id,
  'survey_' || lpad(cast(o_orderkey % 14 as string), 2, '0') || '_' || lpad(cast(o_orderkey % 33 as string), 2, '0') || '_' ||
  cast(2000 + o_orderkey % 27 as string) || case o_orderkey % 4 when 0 then '.gpkg' when 1 then '.7z' when 2 then '.TIF' else '' end
  as file_name
from orders
"""
DATED = f"""dated as (
  select *, case when file_name like '%.gpkg' then 'geopackage' when file_name like '%.7z' then 'archive'
      when file_name like '%.TIF' then 'raster' else 'other' end as artifact_type,
    case when mm between 1 and 12 and dd between 1 and 31 then yyyy || '-' || lpad(cast(mm as varchar), 2, '0') || '-' ||
      lpad(cast(dd as varchar), 2, '0') end as release_date
  from (select *, cast(substr(file_name, 8, 2) as int) as mm, cast(substr(file_name, 11, 2) as int) as dd,
    substr(file_name, 14, 4) as yyyy from ({FILES}) f) x)"""


@query("file_dates", ctes=[DATED], sql="select file_id, release_id, file_name, artifact_type, release_date from dated")
def file_dates(t):
    return release.file_dates(t.sql(FILES, "orders"))


@query(
    "release_identity", ctes=[DATED],
    sql="""select release_id, case when count(distinct d) = 1 then max(d) end as release_date, count(d) as dated_files,
        count(distinct d) = 1 as passed
      from (select release_id, case when artifact_type in ('geopackage', 'archive') then release_date end as d from dated) x
      group by release_id""",
)
def release_identity(t):
    return release.release_identity(release.file_dates(t.sql(FILES, "orders")), ["release_id"])


@query(
    "release_findings", ctes=[DATED],
    sql="""select release_id, table_files, archives, case when problem is null then day end as release_date,
        case when problem is null then case when table_date is not null then 'geopackage' else 'archive' end end as date_source, problem,
        problem is null and coalesce(len(list_filter(others, lambda x: x <> day)), 0) > 0 as directory_differs, problem is null as passed
      from (select *, coalesce(table_date, archive_date) as day, case when table_files <> 1 then 'not one table file' when archives > 1 then 'several archives'
          when table_date <> archive_date then 'conflicting dates' when coalesce(table_date, archive_date) is null then 'no date' end as problem
        from (select release_id, count(case when artifact_type = 'geopackage' then 1 end) as table_files,
            count(case when artifact_type = 'archive' then 1 end) as archives,
            min(case when artifact_type = 'geopackage' then release_date end) as table_date,
            min(case when artifact_type = 'archive' then release_date end) as archive_date,
            list(release_date) filter (where artifact_type = 'other' and release_date is not null) as others
          from dated group by release_id) x) y""",
)
def release_findings(t):
    return release.release_findings(release.file_dates(t.sql(FILES, "orders")), ["release_id"])


# --- horizons and intervals ----------------------------------------------------------------------


@query("valid_horizons", views=["chorizon"], ctes=[s.VALID], doubles=["hzdept_r", "hzdepb_r"],
       sql="select cokey, chkey, hzdept_r, hzdepb_r from valid")
def valid(t):
    return valid_horizons(t["chorizon"]).select("cokey", "chkey", "hzdept_r", "hzdepb_r")


@query("profile_bottom", views=["chorizon"], ctes=[s.VALID], doubles=["profile_bottom"],
       sql="select cokey, max(hzdepb_r) as profile_bottom from valid group by cokey")
def bottom(t):
    return profile_bottom(t["chorizon"])


@query("depth_overlap_join", views=["chorizon"], ctes=s.DEPTH_STEPS, doubles=["overlap_cm"],
       sql="select chkey, cokey, depth_interval, overlap_cm from pieces")
def depth_overlap_join(t):
    return with_label(interval_overlaps(t["chorizon"], ["chkey", "cokey"]), "chkey", "cokey")


@query(
    "interval_occupancy", views=["chorizon"], ctes=s.DEPTH_STEPS, doubles=["total_cm"],
    sql="""select i.depth_interval, i.top_cm, i.bottom_cm, i.bottom_cm is null as to_reported_profile_depth,
        count(*) as horizons, sum(overlap_cm) as total_cm
      from pieces o join intervals i on o.depth_interval = i.depth_interval group by 1, 2, 3""",
)
def interval_occupancy(t):
    per = with_label(
        interval_overlaps(t["chorizon"], []).groupBy(NUMBER).agg(F.count("*").alias("horizons"), F.sum(OVERLAP).alias("total_cm"))
    )
    dims = interval_frame(t.spark).select(DEPTH, "top_cm", "bottom_cm", "to_reported_profile_depth")
    return dims.join(per, DEPTH).select(DEPTH, "top_cm", "bottom_cm", "to_reported_profile_depth", "horizons", "total_cm")


@query(
    "eligible_overlaps", views=["chorizon"], ctes=s.DEPTH_STEPS,
    sql="""select depth_interval, count(*) as overlaps, count(om_r) as with_organic_matter,
        cast(sum(case when sandtotal_r is not null and silttotal_r is not null and claytotal_r is not null then 1 else 0 end) as bigint)
          as with_all_parts
      from pieces group by depth_interval""",
)
def eligible_overlaps(t):
    rows = interval_overlaps(t["chorizon"], ["om_r", *properties.PARTS.values()])
    return with_label(
        rows.groupBy(NUMBER).agg(
            F.count("*").alias("overlaps"), F.count("om_r").alias("with_organic_matter"),
            F.count_if(F.expr(properties.PARTICLE_SIZE.mask)).alias("with_all_parts"),
        )
    )


@query("chemically_limited_horizons", views=["chorizon"], doubles=["hzdept_r", "ph1to1h2o_r", "ec_r"],
       sql="select chkey, hzdept_r, ph1to1h2o_r, ec_r from chorizon where ph1to1h2o_r < 3.5 or ec_r > 12")
def chemically_limited(t):
    return t["chorizon"].where(rootzone.CHEMICAL_LIMIT).select("chkey", "hzdept_r", "ph1to1h2o_r", "ec_r")


@query("fragment_volume", views=["chfrags"], ctes=[s.FRAGMENTS], doubles=["fragvol"], sql="select chkey, fragvol from frags")
def fragment_volume(t):
    return properties.fragment_volume(t["chfrags"])


@query(
    "horizon_fragments", views=["chorizon", "chfrags"], ctes=[s.FRAGMENTS], doubles=["fragvol", "om_r"],
    sql="select h.chkey, h.cokey, h.om_r, coalesce(f.fragvol, 0) as fragvol from chorizon h left join frags f on h.chkey = f.chkey",
)
def horizon_fragments(t):
    return properties.with_fragments(t["chorizon"], t["chfrags"]).select("chkey", "cokey", "om_r", "fragvol")


# --- two-level means -----------------------------------------------------------------------------

_COVER = ["value", "contributing_thickness", "contributing_component_percent"]


@query(
    "component_linear_mean", views=["chorizon"], ctes=s.DEPTH_STEPS, doubles=["value", "valid_thickness"],
    sql="""select cokey, depth_interval, sum(om_r * overlap_cm) / sum(overlap_cm) as value, sum(overlap_cm) as valid_thickness
      from pieces where om_r is not null group by cokey, depth_interval""",
)
def component_linear_mean(t):
    m = measures.linear("v", "om_r")
    by = measures.component_measures(interval_overlaps(t["chorizon"], ["cokey", "om_r"]), [m])
    return with_label(by.where(F.col("v__cm").isNotNull()), "cokey").select(
        "cokey", DEPTH, (F.col("v__sum") / F.col("v__cm")).alias("value"), F.col("v__cm").alias("valid_thickness")
    )


@query("linear_mean", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.linear_step("lin", "om_r")],
       doubles=_COVER, sql="select * from lin")
def linear_mean(t):
    return measures.measure_map_units(t["chorizon"], t["component"], measures.linear("value", "om_r"))


@query("composition_mean", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.COMPOSITION],
       doubles=["sand", "silt", "clay", *_COVER[1:]], sql="select * from composition")
def composition_mean(t):
    return measures.measure_map_units(t["chorizon"], t["component"], properties.PARTICLE_SIZE)


@query("least_transmissive", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.DOMINANT, s.KSAT],
       doubles=_COVER, sql="select * from ksat")
def least_transmissive(t):
    return measures.least_transmissive(t["chorizon"], t["component"])


@query("added_property_mean", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.linear_step("lin", "ec_r", "salinity")],
       doubles=["salinity", *_COVER[1:]], sql="select * from lin")
def added_property_mean(t):
    """A property the registry does not have, added by one declaration."""
    salinity = measures.linear("salinity", "ec_r")
    return measures.measure_map_units(t["chorizon"], t["component"], salinity)


@query(
    "custom_stock", views=["component", "chorizon"],
    ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.stock_step("claystock", "dbthirdbar_r * claytotal_r / 100 * overlap_cm * 10000",
                                                  "dbthirdbar_r is not null and claytotal_r is not null")],
    doubles=["clay_stock", *_COVER[1:]],
    sql="""select l.mukey, l.depth_interval, l.value as clay_stock, l.thickness as contributing_thickness,
        p.pct as contributing_component_percent from claystock_long l
      join (select mukey, depth_interval, sum(comppct_r) as pct from (select distinct cokey, depth_interval from claystock_rows) c
        join weights using (cokey) group by 1, 2) p on l.mukey = p.mukey and l.depth_interval = p.depth_interval""",
)
def custom_stock(t):
    """A stock of the caller's own: any expression per centimetre and any mask."""
    clay = measures.stock("clay_stock", "dbthirdbar_r * claytotal_r / 100D * 10000D", ["dbthirdbar_r", "claytotal_r"])
    return measures.measure_map_units(t["chorizon"], t["component"], clay)


@query("admitted_percent", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.AWS], doubles=["admitted"],
       sql="select mukey, admitted from aws_admitted")
def admitted_percent(t):
    return measures.admitted_percent(t["chorizon"], t["component"], properties.AWS, "admitted")


@query("aws_by_interval", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.AWS],
       doubles=["aws", "thickness"], sql="select mukey, depth_interval, value as aws, thickness from aws_long")
def aws_by_interval(t):
    out = stocks.aws_by_interval(t["chorizon"], t["component"])
    return out.select("mukey", DEPTH, "aws", F.col(properties.AWS.thickness).alias("thickness"))


@query("soc_by_interval", views=["component", "chorizon", "chfrags"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.FRAGMENTS, s.SOC],
       doubles=["soc", "thickness"], sql="select mukey, depth_interval, value as soc, thickness from soc_long")
def soc_by_interval(t):
    out = stocks.soc_by_interval(t["chorizon"], t["component"], t["chfrags"])
    return out.select("mukey", DEPTH, "soc", F.col(properties.SOC.thickness).alias("thickness"))


@query("aws_family", views=["component", "chorizon"],
       ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.AWS, s.wide_step("aws", "aws", "a", "musumcpcta")],
       doubles=s.AWS_COLUMNS, sql="select * from aws_wide")
def aws_family(t):
    return stocks.aws_family(t["chorizon"], t["component"])


@query("soc_family", views=["component", "chorizon", "chfrags"],
       ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.FRAGMENTS, s.SOC, s.wide_step("soc", "soc", "s", "musumcpcts")],
       doubles=s.SOC_COLUMNS, sql="select * from soc_wide")
def soc_family(t):
    return stocks.soc_family(t["chorizon"], t["component"], t["chfrags"])


@query("stock_unpivot", views=["component", "chorizon", "chfrags"],
       ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.FRAGMENTS, s.AWS, s.SOC],
       doubles=["aws", "aws_contributing_thickness", "soc", "soc_contributing_thickness"],
       sql="""select k.mukey, i.depth_interval, a.value as aws, a.thickness as aws_contributing_thickness, c.value as soc,
           c.thickness as soc_contributing_thickness
         from (select mukey from aws_long union select mukey from soc_long) k cross join intervals i
         left join aws_long a on a.mukey = k.mukey and a.depth_interval = i.depth_interval
         left join soc_long c on c.mukey = k.mukey and c.depth_interval = i.depth_interval""")
def stock_unpivot(t):
    """Wide stock columns back to rows, every interval kept."""
    return stocks.lengthen(derived.widen_stocks(derived.stock_sums(derived_tables(t))))


# --- components ----------------------------------------------------------------------------------


@query("component_weights", views=["component"], ctes=[s.WEIGHTS], doubles=["comppct_r"], sql="select * from weights")
def component_weights(t):
    return comp.weights(t["component"])


@query("earthy_major_components", views=["component"], ctes=[s.EARTHY], doubles=["comppct_r"], sql="select * from earthy")
def earthy_major_components(t):
    return comp.earthy_major(t["component"]).select("mukey", "cokey", "comppct_r")


@query("percent_earthy_major", views=["component"], ctes=[s.EARTHY], doubles=["pctearthmc"],
       sql="select mukey, sum(comppct_r) as pctearthmc from earthy group by mukey")
def percent_earthy_major(t):
    return comp.earthy_major(t["component"]).groupBy("mukey").agg(F.sum("comppct_r").alias("pctearthmc"))


@query("dominant_component", views=["component"], ctes=[s.DOMINANT], doubles=["comppct_r"],
       sql="select mukey, cokey, comppct_r, majcompflag from dominant")
def dominant_component(t):
    return comp.dominant_component(t["component"])


@query("terrain", views=["component"], ctes=[s.DOMINANT], doubles=["slope", "slope_length", "elevation", "aspect"],
       sql="select mukey, slope_r as slope, slopelenusle_r as slope_length, elev_r as elevation, aspectrep as aspect from dominant")
def terrain(t):
    return comp.terrain(t["component"])


@query("terrain_audit", views=["component"], ctes=[s.DOMINANT], doubles=["selected_comppct_r"],
       sql="""select mukey, cokey as selected_cokey, comppct_r as selected_comppct_r, majcompflag as selected_majcompflag
         from dominant""")
def terrain_audit(t):
    return comp.terrain_audit(t["component"])


@query("dominant_horizons", views=["component", "chorizon"], ctes=[s.DOMINANT], doubles=["ksat_r"],
       sql="select d.mukey, h.chkey, h.ksat_r from chorizon h join dominant d on h.cokey = d.cokey")
def dominant_horizons(t):
    chosen = comp.dominant_component(t["component"]).select("mukey", "cokey")
    return t["chorizon"].select("cokey", "chkey", "ksat_r").join(chosen, "cokey").select("mukey", "chkey", "ksat_r")


@query("component_percent_sum", views=["component"], ctes=[s.MUSUM], doubles=["musumcpct"], sql="select * from musum")
def component_percent_sum(t):
    return comp.component_percent_sum(t["component"])


# --- root zone, ratings, wetland -----------------------------------------------------------------


@query("limiting_restrictions", views=["corestrictions"], doubles=["restriction_cm"],
       sql="""select cokey, min(resdept_r) as restriction_cm from corestrictions where resdept_r is not null
         and reskind not in ('Plinthite', 'Permafrost') group by cokey""")
def limiting_restrictions(t):
    return rootzone.first_restriction(t["corestrictions"])


_ROOT_VIEWS = ["component", "chorizon", "corestrictions"]
_ROOT_STEPS = [*s.DEPTH_STEPS, s.EARTHY, s.LIMITS]


@query("chemical_limit", views=_ROOT_VIEWS, ctes=_ROOT_STEPS, doubles=["chemical_cm"], sql="select * from chemical")
def chemical_limit(t):
    return rootzone.chemical_limit(t["chorizon"])


@query("root_depths", views=_ROOT_VIEWS, ctes=_ROOT_STEPS, doubles=["comppct_r", "root_depth"], sql="select * from depths")
def root_depths(t):
    return rootzone.root_depths(t["component"], t["corestrictions"], t["chorizon"])


@query("root_zone_components", views=_ROOT_VIEWS, ctes=[*_ROOT_STEPS, s.ROOTWATER],
       doubles=["comppct_r", "root_depth", "rz_aws"], sql="select * from rootwater")
def root_zone_components(t):
    depths = rootzone.root_depths(t["component"], t["corestrictions"], t["chorizon"])
    return rootzone.water_by_component(depths, t["chorizon"])


@query("root_zone", views=_ROOT_VIEWS, ctes=[*_ROOT_STEPS, s.ROOTWATER], doubles=["rootznemc", "rootznaws"],
       sql="select *, cast(case when rootznaws <= 152 then 1 else 0 end as bigint) as droughty from rootzone")
def root_zone(t):
    return rootzone.root_zone(t["component"], t["corestrictions"], t["chorizon"])


@query("component_crop_ratings", views=["component", "cointerp"], ctes=[s.RATED],
       doubles=["nccpi3corn", "nccpi3soy", "nccpi3cot", "nccpi3sg", "nccpi3all"],
       sql="""select * from ratings where cokey in (select cokey from rated)""")
def component_crop_ratings(t):
    return crops.component_ratings(crops.interpretation_subset(t["cointerp"]))


@query("crop_ratings", views=["component", "cointerp"], ctes=[s.EARTHY, s.RATED, s.NCCPI], doubles=s.NCCPI_COLUMNS,
       sql="select * from nccpi")
def crop_ratings(t):
    return crops.crop_ratings(t["component"], crops.interpretation_subset(t["cointerp"]))


@query("wetland_tags", views=["component"], doubles=["comppct_r"],
       sql="""select mukey, cokey, comppct_r, case when hydricrating = 'Yes' then 'wet' when hydricrating = 'No' then 'dry'
           when drainagecl in ('Poorly drained', 'Very poorly drained') or localphase ilike '%flooded%'
             or otherph ilike '%drained%' then 'wet' else 'name' end as wetness from component""")
def wetland_tags(t):
    return wetland.wetland_tags(t["component"])


@query("wetland_percent", views=["component", "mapunit"], ctes=[s.PWSL], sql="select * from pwsl")
def wetland_percent(t):
    return wetland.wetland_percent(t["component"], t["mapunit"])


@query("named_map_units", views=["mapunit"],
       sql="""select mukey, coalesce(muname, '') as muname, regexp_matches(lower(coalesce(muname, '')), '\\bwaters?\\b') as open_water,
           coalesce(muname, '') ilike '%ponded%' as wet_name from mapunit""")
def named_map_units(t):
    from loamgrid.functions import phrase_in, word_in

    return t["mapunit"].select(
        "mukey", default_text("muname").alias("muname"), word_in("muname", "water").alias("open_water"),
        phrase_in("muname", wetland.PHRASES).alias("wet_name"),
    )


# --- texture -------------------------------------------------------------------------------------


@query("surface_horizon", views=["component", "chorizon", "chtexturegrp"], ctes=[s.DOMINANT, s.SURFACE], sql="select * from surface")
def surface_horizon(t):
    return texture.surface_horizon(t["chorizon"])


@query("representative_texture", views=["component", "chorizon", "chtexturegrp"], ctes=[s.DOMINANT, s.SURFACE], sql="select * from rv")
def representative_texture(t):
    return texture.representative_texture(t["chtexturegrp"])


@query("surface_texture", views=["component", "chorizon", "chtexturegrp"], ctes=[s.DOMINANT, s.SURFACE],
       sql="select * from surface_texture")
def surface_texture(t):
    return texture.surface_texture(t["component"], t["chorizon"], t["chtexturegrp"])


@query("texture_dictionary", views=["chtexturegrp"], ctes=[s.TEXTURES],
       sql="select *, case name when 'STV-L' then 'stv_l' else lower(name) end as token from dictionary")
def texture_dictionary(t):
    return texture.texture_dictionary(t["chtexturegrp"])


_TEXTURE_STEPS = [s.DOMINANT, s.SURFACE, s.TEXTURES]
_TEXTURE_VIEWS = ["component", "chorizon", "chtexturegrp"]


@query("texture_codes", views=_TEXTURE_VIEWS, ctes=_TEXTURE_STEPS,
       sql="select s.mukey, d.code as texture_class from surface_texture s left join dictionary d on s.texture = d.name")
def texture_codes(t):
    surface = texture.surface_texture(t["component"], t["chorizon"], t["chtexturegrp"])
    return texture.encode_texture(surface, texture.texture_dictionary(t["chtexturegrp"]))


@query("texture_decode", views=_TEXTURE_VIEWS, ctes=_TEXTURE_STEPS,
       sql="""select s.mukey, d.code as texture_class, d.name as texture_name, d.description
         from surface_texture s left join dictionary d on s.texture = d.name""")
def texture_decode(t):
    dictionary = texture.texture_dictionary(t["chtexturegrp"])
    surface = texture.surface_texture(t["component"], t["chorizon"], t["chtexturegrp"])
    return texture.decode_texture(texture.encode_texture(surface, dictionary), dictionary).select(
        "mukey", "texture_class", "texture_name", "description"
    )


# --- derived tables ------------------------------------------------------------------------------


def derived_tables(t):
    names = ["component", "chorizon", "chfrags", "corestrictions", "cointerp", "mapunit", "chtexturegrp", "muaggatt"]
    found = {n: t[n] for n in names}
    found["cointerp"] = crops.interpretation_subset(found["cointerp"])
    return found


@query("horizon_properties", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, *s.PROPERTY_STEPS, s.PROPERTIES],
       doubles=[*s.PROPERTY_COLUMNS, "particle_size_contributing_thickness", "particle_size_contributing_component_percent"],
       sql="select * from properties")
def horizon_properties(t):
    return properties.horizon_properties(t["component"], t["chorizon"])[0]


@query("horizon_diagnostics", views=["component", "chorizon"], ctes=[*s.DEPTH_STEPS, s.WEIGHTS, *s.PROPERTY_STEPS],
       doubles=_COVER[1:],
       sql=" union all ".join(
           [f"select mukey, depth_interval, '{n}' as property, contributing_thickness, contributing_component_percent from {c}"
            for n, c in [("particle_size_shared_mask", "composition"), ("ksat", "ksat"), *[(n, f"p_{n}") for n, _ in s.LINEAR_COLUMNS]]]))
def horizon_diagnostics(t):
    return properties.horizon_properties(t["component"], t["chorizon"])[1]


@query("valu1", views=s.VALU1_VIEWS, ctes=[*s.VALU1_STEPS, s.VALU1], doubles=s.VALU1_DOUBLES, sql="select * from summary")
def valu1(t):
    return derived.valu1(derived_tables(t))


@query("soil_properties", views=s.SOIL_VIEWS, ctes=s.SOIL_STEPS, doubles=s.SOIL_DOUBLES, sql="select * from soil")
def soil_properties(t):
    return derived.soil_properties(derived_tables(t))


@query("map_unit_properties", views=s.UNITS_VIEWS, ctes=s.UNITS_STEPS,
       doubles=[c for c in s.MAP_UNIT_COLUMNS if c not in ("droughty", "pwsl1pomu")] + ["slope", "slope_length", "elevation", "aspect"],
       sql="select * from units")
def map_unit_properties(t):
    found = derived_tables(t)
    return derived.map_unit_properties(found, derived.valu1(found))


# --- gates and profiles --------------------------------------------------------------------------


def _domain(name: str, table: str, column: str, bad: str) -> str:
    return (
        f"select '{name}' as check_name, count({column}) as examined, "
        f"cast(coalesce(sum(case when {bad} then 1 else 0 end), 0) as bigint) as violations, "
        f"coalesce(sum(case when {bad} then 1 else 0 end), 0) = 0 as passed from {table}"
    )


def _unique(name: str, table: str, keys: str) -> str:
    return (
        f"select '{name}' as check_name, count(*) as examined, count(*) - (select count(*) from (select distinct {keys} from {table}) k) "
        f"as violations, count(*) = (select count(*) from (select distinct {keys} from {table}) k) as passed from {table}"
    )


_GATES = [
    _unique("valu1_unique_mukey", "summary", "mukey"), _unique("soil_unique_key", "soil", "mukey, depth_interval"),
    _unique("map_unit_unique_mukey", "units", "mukey"),
    *[_domain(f"{c}_nonnegative", "soil", c, f"{c} < 0")
      for c in ("aws", "soc", "aws_contributing_thickness", "soc_contributing_thickness")],
    _domain("nccpi_in_unit_range", "units", "nccpi3all", "nccpi3all < 0 or nccpi3all > 1"),
    _domain("droughty_domain", "units", "droughty", "droughty not in (0, 1)"),
    _domain("pwsl_domain", "units", "pwsl1pomu", "not (pwsl1pomu between 0 and 100 or pwsl1pomu = 999)"),
    _domain("rootzn_capped", "units", "rootznemc", "rootznemc > 150"),
    """select 'particle_size_closure', count(*), cast(coalesce(sum(off), 0) as bigint), coalesce(avg(off) < 0.02, true) from (
      select case when sand + silt + clay < 97 or sand + silt + clay > 103 then 1 else 0 end as off from soil
      where sand is not null and particle_size_contributing_component_percent >= 80) x""",
]


@query(
    "gates", views=s.UNITS_VIEWS,
    ctes=[*s.UNITS_STEPS, *[x for x in s.PROPERTY_STEPS if x not in s.UNITS_STEPS], s.PROPERTIES, s.SOIL],
    sql=" union all ".join(_GATES),
)
def gates_report(t):
    found = derived_tables(t)
    summary = derived.valu1(found)
    soil = derived.soil_properties(found, derived.interval_sums(found, labelled=False, marked=True))
    return gates.scientific_report(summary, soil, derived.map_unit_properties(found, summary))


def _range(table: str, column: str, low: float, high: float) -> str:
    return _domain(column, table, column, f"{column} < {low} or {column} > {high}").replace("check_name", "variable")


@query("range_audit", views=["component"], ctes=[s.DOMINANT,
       "terrain as (select slope_r as slope, slopelenusle_r as slope_length, elev_r as elevation, aspectrep as aspect from dominant)"],
       sql=" union all ".join(_range("terrain", c, lo, hi) for c, lo, hi in
                              [("slope", 0, 500), ("slope_length", 0, 4000), ("elevation", -100, 7000), ("aspect", 0, 360)]))
def range_audit(t):
    return gates.range_audit(comp.terrain(t["component"]))


@query("range_audit_by_depth", views=["component", "chorizon"],
       ctes=[*s.DEPTH_STEPS, s.WEIGHTS, *s.PROPERTY_STEPS, s.PROPERTIES],
       sql=" union all ".join(
           _range("properties", c, lo, hi) for c, lo, hi in
           [("sand", 0, 100), ("silt", 0, 100), ("clay", 0, 100), ("organic_matter", 0, 100), ("bulk_density_tenth_bar", 0, 2.6),
            ("bulk_density_one_third_bar", 0, 2.6), ("bulk_density_fifteen_bar", 0, 2.6), ("bulk_density_oven_dry", 0, 2.6),
            ("ksat", 0, 1000), ("awc", 0, 1), ("water_content_tenth_bar", 0, 100), ("water_content_one_third_bar", 0, 100),
            ("water_content_fifteen_bar", 0, 100), ("satiated_water_content", 0, 100), ("cec_7", 0, 500), ("effective_cec", 0, 500),
            ("sum_of_bases", 0, 500), ("ph", 1.8, 11), ("particle_size_contributing_thickness", 0, 1000),
            ("particle_size_contributing_component_percent", 0, 200)]))
def range_audit_by_depth(t):
    return gates.range_audit(properties.horizon_properties(t["component"], t["chorizon"])[0])


@query("repeated_lookup_keys", views=["component"],
       sql="select mukey, count(*) as copies from component group by mukey having count(*) > 1")
def repeated_lookup_keys(t):
    from loamgrid.operators.lookup import repeated_lookup_keys as repeated

    return repeated(t["component"], ["mukey"])


@query("column_coverage", views=["component"],
       sql=" union all ".join(
           f"select '{c}' as column_name, count(distinct case when {c} is not null then mukey end) as nonnull_keys, "
           f"count(distinct mukey) as total_keys, cast(count(distinct case when {c} is not null then mukey end) as double) / "
           "count(distinct mukey) as nonnull_fraction from component"
           for c in ("comppct_r", "compkind", "otherph", "localphase", "slope_r", "hydricrating", "drainagecl")),
       doubles=["nonnull_fraction"])
def column_coverage(t):
    return inventory.column_coverage(
        t["component"], "mukey", ["comppct_r", "compkind", "otherph", "localphase", "slope_r", "hydricrating", "drainagecl"]
    )


@query("comparators", views=["component", "chorizon", "muaggatt"],
       ctes=[*s.DEPTH_STEPS, s.WEIGHTS, s.AWS, s.DOMINANT,
             """pairs as (
  select 'aws0_100' as comparison, l.value as a, 10 * m.aws0100wta as b from aws_long l join muaggatt m using (mukey)
    where depth_interval = '0_100'
  union all select 'slope', d.slope_r, m.slopegraddcp from dominant d join muaggatt m using (mukey))"""],
       doubles=["correlation", "median_gap", "p95_gap", "equal_share"],
       sql="""select comparison, count(*) as n, corr(a, b) as correlation, quantile_cont(abs(a - b), 0.5) as median_gap,
           quantile_cont(abs(a - b), 0.95) as p95_gap, avg(case when a = b then 1.0 else 0.0 end) as equal_share
         from pairs where a is not null and b is not null group by comparison""")
def comparators(t):
    water = stocks.aws_by_interval(t["chorizon"], t["component"]).where(F.col(DEPTH) == "0_100").select("mukey", "aws")
    computed = comp.terrain(t["component"]).join(water, "mukey", "full")
    return inventory.comparator(
        computed, t["muaggatt"], "mukey", {"aws0_100": ("aws", "10D * aws0100wta"), "slope": ("slope", "slopegraddcp")}
    )
