"""Named SQL steps shared by the checking queries, in plain textbook form."""

from __future__ import annotations

VALID = """valid as (
  select * from chorizon where hzdept_r is not null and hzdepb_r is not null and hzdepb_r > hzdept_r)"""

INTERVALS = """intervals as (
  select * from (values ('0_5', 0, 5), ('5_20', 5, 20), ('20_50', 20, 50), ('50_100', 50, 100), ('100_150', 100, 150),
    ('150_profile', 150, null), ('0_20', 0, 20), ('0_30', 0, 30), ('0_100', 0, 100), ('0_150', 0, 150),
    ('0_profile', 0, null)) t(depth_interval, top_cm, bottom_cm))"""

# the profile bottom is looked up here on purpose: it checks the shortcut taken in Spark
OVERLAPS = """profile as (select cokey, max(hzdepb_r) as profile_bottom from valid group by cokey),
pieces as (
  select * from (
    select v.*, i.depth_interval,
      least(v.hzdepb_r, coalesce(cast(i.bottom_cm as double), p.profile_bottom)) - greatest(v.hzdept_r, cast(i.top_cm as double))
        as overlap_cm
    from valid v join profile p on v.cokey = p.cokey cross join intervals i) x
  where overlap_cm > 0)"""

WEIGHTS = "weights as (select mukey, cokey, comppct_r from component where comppct_r is not null and comppct_r > 0)"

EARTHY = """earthy as (
  select mukey, cokey, comppct_r from component
  where majcompflag = 'Yes' and compkind is not null and compkind <> 'Miscellaneous area' and comppct_r > 0)"""

DOMINANT = """ranked as (
  select *, row_number() over (partition by mukey order by
    case when coalesce(majcompflag, '') = 'Yes' then 0 else 1 end, comppct_r desc, cokey) as rn
  from component where comppct_r is not null),
dominant as (select * from ranked where rn = 1)"""

FRAGMENTS = """frags as (
  select chkey, greatest(0, least(100, sum(fragvol_r))) as fragvol from chfrags where fragvol_r is not null group by chkey)"""

DEPTH_STEPS = [VALID, INTERVALS, OVERLAPS]


def linear_step(name: str, column: str, label: str = "value") -> str:
    """Thickness-weighted component means, then percent-weighted map-unit means."""
    return f"""{name} as (
  select mukey, depth_interval, sum(v * comppct_r) / sum(comppct_r) as {label},
    sum(cm * comppct_r) / sum(comppct_r) as contributing_thickness, sum(comppct_r) as contributing_component_percent
  from (select cokey, depth_interval, sum({column} * overlap_cm) / sum(overlap_cm) as v, sum(overlap_cm) as cm
        from pieces where {column} is not null group by cokey, depth_interval) c
  join weights w using (cokey) group by mukey, depth_interval)"""


def stock_step(name: str, expression: str, eligible: str, source: str = "pieces") -> str:
    """Component totals, then percent-weighted map-unit means, with admitted percent."""
    return f"""{name}_rows as (select *, {expression} as contribution from {source} where {eligible}),
{name}_long as (
  select mukey, depth_interval, sum(s * comppct_r) / sum(comppct_r) as value, sum(cm * comppct_r) / sum(comppct_r) as thickness
  from (select cokey, depth_interval, sum(contribution) as s, sum(overlap_cm) as cm
        from {name}_rows group by cokey, depth_interval) c
  join weights w using (cokey) group by mukey, depth_interval),
{name}_admitted as (
  select mukey, sum(comppct_r) as admitted from (select distinct cokey from {name}_rows) c join weights w using (cokey)
  group by mukey)"""


COMPOSITION = """composition as (
  select mukey, depth_interval, sum(sand_c * comppct_r) / sum(comppct_r) as sand, sum(silt_c * comppct_r) / sum(comppct_r) as silt,
    sum(clay_c * comppct_r) / sum(comppct_r) as clay, sum(cm * comppct_r) / sum(comppct_r) as contributing_thickness,
    sum(comppct_r) as contributing_component_percent
  from (select cokey, depth_interval, sum(sandtotal_r * overlap_cm) / sum(overlap_cm) as sand_c,
          sum(silttotal_r * overlap_cm) / sum(overlap_cm) as silt_c, sum(claytotal_r * overlap_cm) / sum(overlap_cm) as clay_c,
          sum(overlap_cm) as cm
        from pieces where sandtotal_r is not null and silttotal_r is not null and claytotal_r is not null
        group by cokey, depth_interval) c
  join weights w using (cokey) group by mukey, depth_interval)"""

KSAT = """ksat as (
  select d.mukey, o.depth_interval, min(o.ksat_r) as value, sum(o.overlap_cm) as contributing_thickness,
    max(d.comppct_r) as contributing_component_percent
  from pieces o join dominant d on o.cokey = d.cokey where o.ksat_r is not null group by d.mukey, o.depth_interval)"""

AWS = stock_step("aws", "awc_r * overlap_cm * 10", "awc_r is not null")
SOC = """fragged as (select o.*, coalesce(f.fragvol, 0) as fragvol from pieces o left join frags f on o.chkey = f.chkey),
""" + stock_step(
    "soc", "overlap_cm * dbthirdbar_r * (om_r / 1.724 / 100) * (1 - fragvol / 100) * 10000",
    "om_r is not null and dbthirdbar_r is not null", "fragged",
)

LIMITS = """restriction as (
  select cokey, min(resdept_r) as restriction_cm from corestrictions
  where resdept_r is not null and reskind in ('Lithic bedrock', 'Paralithic bedrock', 'Densic bedrock', 'Densic material',
    'Fragipan', 'Duripan', 'Sulfuric') group by cokey),
chemical as (
  select cokey, min(hzdept_r) as chemical_cm from pieces
  where depth_interval = '0_profile' and (ph1to1h2o_r < 3.5 or ec_r > 12) group by cokey),
depths as (
  select e.mukey, e.cokey, e.comppct_r,
    greatest(0, least(150, coalesce(r.restriction_cm, 150), coalesce(c.chemical_cm, 150))) as root_depth
  from earthy e left join restriction r on e.cokey = r.cokey left join chemical c on e.cokey = c.cokey)"""

ROOTWATER = """rootwater as (
  select d.mukey, d.cokey, d.comppct_r, d.root_depth,
    coalesce(sum(greatest(0, least(o.hzdepb_r, d.root_depth) - o.hzdept_r) * o.awc_r * 10), 0) as rz_aws
  from depths d left join pieces o on d.cokey = o.cokey and o.depth_interval = '0_profile' and o.awc_r is not null
  group by d.mukey, d.cokey, d.comppct_r, d.root_depth),
rootzone as (
  select mukey, round_even(sum(root_depth * comppct_r) / sum(comppct_r), 0) as rootznemc,
    sum(rz_aws * comppct_r) / sum(comppct_r) as rootznaws
  from rootwater group by mukey)"""

_CROPS = [("corn", "Corn"), ("soy", "Soybeans"), ("cot", "Cotton"), ("sg", "Small Grains")]
RATED = "rated as (select * from cointerp where mrulename ilike 'NCCPI%' and interphr is not null and rulename not like '%Irrigated%'),\n" + ",\n".join(
    f"crop_{c} as (select cokey, max(interphr) as r from rated where rulename like '%{word}%' group by cokey)" for c, word in _CROPS
) + """,
crop_overall as (select cokey, max(interphr) as r from rated where rulename like 'NCCPI - National Commodity%' group by cokey),
ratings as (
  select k.cokey, a.r as nccpi3corn, b.r as nccpi3soy, c.r as nccpi3cot, d.r as nccpi3sg,
    coalesce(o.r, greatest(a.r, b.r, c.r, d.r)) as nccpi3all
  from (select distinct cokey from component) k left join crop_corn a using (cokey) left join crop_soy b using (cokey)
    left join crop_cot c using (cokey) left join crop_sg d using (cokey) left join crop_overall o using (cokey))"""

NCCPI = """nccpi as (
  select mukey, """ + ", ".join(
    f"case when sum(case when nccpi3{c} is not null then comppct_r end) > 0 then sum(nccpi3{c} * comppct_r) / "
    f"sum(case when nccpi3{c} is not null then comppct_r end) end as nccpi3{c}"
    for c in ("corn", "soy", "cot", "sg", "all")
) + """, sum(comppct_r) as pctearthmc
  from earthy e left join ratings r using (cokey) group by mukey)"""

PWSL = """tagged as (
  select c.mukey, c.comppct_r, c.compname, coalesce(m.muname, '') as muname,
    case lower(coalesce(c.hydricrating, '')) when 'yes' then true when 'no' then false
      else coalesce(c.drainagecl, '') in ('Poorly drained', 'Very poorly drained')
        or regexp_matches(lower(coalesce(c.localphase, '')), 'drained|undrained|channeled|protected|ponded|flooded')
        or regexp_matches(lower(coalesce(c.otherph, '')), 'drained|undrained|channeled|protected|ponded|flooded')
        or regexp_matches(lower(coalesce(m.muname, '')), 'drained|undrained|channeled|protected|ponded|flooded') end as wet
  from component c left join mapunit m on c.mukey = m.mukey),
pwsl as (
  select mukey, case when max(case when regexp_matches(lower(muname), '\\bwaters?\\b') then 1 else 0 end) = 1
      or coalesce(sum(case when compname = 'Water' then comppct_r end), 0) >= 80 then 999
    else cast(round_even(coalesce(sum(case when wet then comppct_r end), 0), 0) as bigint) end as pwsl1pomu
  from tagged group by mukey)"""

MUSUM = "musum as (select mukey, sum(comppct_r) as musumcpct from component where comppct_r is not null group by mukey)"

SURFACE = """surface as (
  select cokey, chkey from (select cokey, chkey, row_number() over (partition by cokey order by hzdept_r, chkey) as rn
    from chorizon where hzdept_r is not null and hzdepb_r is not null) x where rn = 1),
rv as (
  select chkey, texture, texdesc from (select *, row_number() over (partition by chkey order by chtgkey) as rn
    from chtexturegrp where rvindicator = 'Yes' and texture is not null) x where rn = 1),
surface_texture as (
  select d.mukey, t.texture, t.texdesc from dominant d left join surface s on d.cokey = s.cokey left join rv t on s.chkey = t.chkey)"""

TEXTURES = """first_names as (
  select texture, texdesc from (select *, row_number() over (partition by texture order by chkey, chtgkey) as rn
    from chtexturegrp where rvindicator = 'Yes' and texture is not null and texture <> '') x where rn = 1),
dictionary as (
  select cast(row_number() over (order by texture) - 1 as int) as code, texture as name,
    coalesce(nullif(texdesc, ''), texture) as description from first_names)"""

MAPPED = "mapped as (select * from pixels where mukey <> 0)"

INTERVAL_SUFFIX = {
    "0_5": "0_5", "5_20": "5_20", "20_50": "20_50", "50_100": "50_100", "100_150": "100_150", "150_profile": "150_999",
    "0_20": "0_20", "0_30": "0_30", "0_100": "0_100", "0_150": "0_150", "0_profile": "0_999",
}


def wide_step(name: str, prefix: str, letter: str, admitted: str) -> str:
    """A stock family as one row per map unit."""
    picks = [f"max(case when depth_interval = '{d}' then value end) as {prefix}{s}" for d, s in INTERVAL_SUFFIX.items()]
    picks += [f"max(case when depth_interval = '{d}' then thickness end) as tk{s}{letter}" for d, s in INTERVAL_SUFFIX.items()]
    return f"""{name}_wide as (
  select * from (select mukey, {', '.join(picks)} from {name}_long group by mukey) a
  full join (select mukey, admitted as {admitted} from {name}_admitted) b using (mukey))"""


def family_columns(prefix: str, letter: str, admitted: str) -> list[str]:
    return [f"{prefix}{s}" for s in INTERVAL_SUFFIX.values()] + [f"tk{s}{letter}" for s in INTERVAL_SUFFIX.values()] + [admitted]


AWS_COLUMNS = family_columns("aws", "a", "musumcpcta")
SOC_COLUMNS = family_columns("soc", "s", "musumcpcts")
NCCPI_COLUMNS = ["nccpi3corn", "nccpi3soy", "nccpi3cot", "nccpi3sg", "nccpi3all", "pctearthmc"]

LINEAR_COLUMNS = [
    ("organic_matter", "om_r"), ("bulk_density_tenth_bar", "dbtenthbar_r"), ("bulk_density_one_third_bar", "dbthirdbar_r"),
    ("bulk_density_fifteen_bar", "dbfifteenbar_r"), ("bulk_density_oven_dry", "dbovendry_r"), ("awc", "awc_r"),
    ("water_content_tenth_bar", "wtenthbar_r"), ("water_content_one_third_bar", "wthirdbar_r"),
    ("water_content_fifteen_bar", "wfifteenbar_r"), ("satiated_water_content", "wsatiated_r"), ("cec_7", "cec7_r"),
    ("effective_cec", "ecec_r"), ("sum_of_bases", "sumbases_r"), ("ph", "ph1to1h2o_r"),
]
PROPERTY_COLUMNS = ["sand", "silt", "clay", "ksat", *[n for n, _ in LINEAR_COLUMNS]]

# every property computed on its own and outer-joined, the long way round
PROPERTY_STEPS = [COMPOSITION, DOMINANT, KSAT, *[linear_step(f"p_{n}", c) for n, c in LINEAR_COLUMNS]]
_ALL = ["composition", "ksat", *[f"p_{n}" for n, _ in LINEAR_COLUMNS]]
PROPERTIES = f"""keys as ({' union '.join(f'select mukey, depth_interval from {n}' for n in _ALL)}),
properties as (
  select k.mukey, k.depth_interval, c.sand, c.silt, c.clay, s.value as ksat,
    {', '.join(f'p_{n}.value as {n}' for n, _ in LINEAR_COLUMNS)},
    c.contributing_thickness as particle_size_contributing_thickness,
    c.contributing_component_percent as particle_size_contributing_component_percent
  from keys k left join composition c using (mukey, depth_interval) left join ksat s using (mukey, depth_interval)
    {' '.join(f'left join p_{n} using (mukey, depth_interval)' for n, _ in LINEAR_COLUMNS)})"""

VALU1_VIEWS = ["component", "chorizon", "chfrags", "corestrictions", "cointerp", "mapunit"]
VALU1_STEPS = [
    *DEPTH_STEPS, WEIGHTS, EARTHY, FRAGMENTS, AWS, wide_step("aws", "aws", "a", "musumcpcta"), SOC,
    wide_step("soc", "soc", "s", "musumcpcts"), LIMITS, ROOTWATER, RATED, NCCPI, PWSL, MUSUM,
]
VALU1_COLUMNS = [
    *AWS_COLUMNS, *SOC_COLUMNS, *NCCPI_COLUMNS, "rootznemc", "rootznaws", "droughty", "pwsl1pomu", "musumcpct",
]
VALU1_DOUBLES = [c for c in VALU1_COLUMNS if c not in ("droughty", "pwsl1pomu")]
VALU1 = f"""summary as (
  select u.mukey, {', '.join(AWS_COLUMNS)}, {', '.join(SOC_COLUMNS)}, {', '.join(NCCPI_COLUMNS)}, rootznemc, rootznaws,
    cast(case when rootznaws <= 152 then 1 when rootznaws > 152 then 0 end as bigint) as droughty, pwsl1pomu, musumcpct
  from (select distinct mukey from mapunit) u left join aws_wide using (mukey) left join soc_wide using (mukey)
    left join rootzone using (mukey) left join nccpi using (mukey) left join pwsl using (mukey) left join musum using (mukey))"""

MAP_UNIT_COLUMNS = [
    "droughty", "nccpi3corn", "nccpi3soy", "nccpi3cot", "nccpi3sg", "nccpi3all", "pctearthmc", "rootznemc", "rootznaws",
    "pwsl1pomu", "musumcpct", "musumcpcta", "musumcpcts",
]
UNITS_VIEWS = [*VALU1_VIEWS, "chtexturegrp"]
UNITS = f"""terrain as (
  select mukey, slope_r as slope, slopelenusle_r as slope_length, elev_r as elevation, aspectrep as aspect from dominant),
coded as (select s.mukey, d.code as texture_class from surface_texture s left join dictionary d on s.texture = d.name),
units as (
  select * from (select mukey, {', '.join(MAP_UNIT_COLUMNS)} from summary) a full join terrain using (mukey)
    full join coded using (mukey))"""
UNITS_STEPS = [*VALU1_STEPS, VALU1, DOMINANT, SURFACE, TEXTURES, UNITS]

SOIL = f"""soil as (
  select mukey, depth_interval, aws, aws_contributing_thickness, soc, soc_contributing_thickness, {', '.join(PROPERTY_COLUMNS)},
    particle_size_contributing_thickness, particle_size_contributing_component_percent
  from (
    select u.mukey, i.depth_interval, a.value as aws, a.thickness as aws_contributing_thickness, s.value as soc,
      s.thickness as soc_contributing_thickness
    from (select distinct mukey from mapunit) u cross join intervals i
      left join aws_long a on a.mukey = u.mukey and a.depth_interval = i.depth_interval
      left join soc_long s on s.mukey = u.mukey and s.depth_interval = i.depth_interval) x
  full join properties using (mukey, depth_interval))"""
SOIL_VIEWS = ["component", "chorizon", "chfrags", "mapunit"]
SOIL_STEPS = [*DEPTH_STEPS, WEIGHTS, FRAGMENTS, AWS, SOC, *PROPERTY_STEPS, PROPERTIES, SOIL]
SOIL_DOUBLES = [
    "aws", "aws_contributing_thickness", "soc", "soc_contributing_thickness", *PROPERTY_COLUMNS,
    "particle_size_contributing_thickness", "particle_size_contributing_component_percent",
]
