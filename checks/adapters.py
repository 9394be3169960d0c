"""Soil tables as views over the shared star-schema tables.

customer -> orders -> lineitem has the shape map unit -> component -> horizon.
The same SQL text runs in Spark and in the checking engine.  Every view works
row by row: no window, sort or shuffle, so it stays cheap however large or
skewed the tables are.  The expressions inject the awkward cases on purpose:
missing values, repeated rows, zero-thickness and above-surface horizons,
percent sums over one hundred, rule names in lower case.  No row is left out:
where a partner must be absent, the row has a key that nobody else has or no value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MAPUNIT = """
select cast(case when c_custkey % 211 = 5 then -1 - c_custkey else c_custkey + 1 end as bigint) as mukey,
  case when c_mktsegment = 'HOUSEHOLD' and c_custkey % 10 = 0 then 'Water'
       when c_mktsegment = 'MACHINERY' and c_custkey % 12 = 0 then 'Open waters, lake'
       when c_mktsegment = 'BUILDING' and c_custkey % 8 = 0 then 'Waterford loam'
       when c_mktsegment = 'FURNITURE' and c_custkey % 5 = 0 then 'Delta muck, Ponded'
       when c_custkey % 17 = 0 then cast(null as string)
       else c_mktsegment || ' complex' end as muname,
  case when c_custkey % 3 = 0 then 'Complex' else 'Consociation' end as mukind
from customer
"""

MUAGGATT = """
select cast(c_custkey + 1 as bigint) as mukey,
  cast(c_custkey % 45 as double) as slopegraddcp,
  cast(c_custkey % 44 as double) as slopegradwta,
  cast(c_custkey % 9 as double) as aws025wta,
  case when c_custkey % 21 = 0 then cast(null as double) else cast(c_custkey % 30 as double) end as aws0100wta,
  cast(c_custkey % 37 as double) as aws0150wta
from customer
"""

COMPONENT = """
select cast(o_custkey + 1 as bigint) as mukey, cast(o_orderkey as string) as cokey,
  case o_orderpriority when '1-URGENT' then cast(60 as double) when '2-HIGH' then cast(40 as double)
    when '3-MEDIUM' then cast(25 as double) when '5-LOW' then cast(o_orderkey % 3 * 5 as double) end as comppct_r,
  case when o_orderkey % 12 = 0 then 'Water' else 'Series ' || cast(o_orderkey % 5 as string) end as compname,
  case when o_orderkey % 9 = 0 then 'Miscellaneous area' when o_orderkey % 13 = 0 then cast(null as string)
    else 'Series' end as compkind,
  case when o_orderstatus = 'P' then 'No' when o_orderkey % 19 = 0 then cast(null as string) else 'Yes' end as majcompflag,
  case when o_orderkey % 14 = 0 then 'Undrained phase' else cast(null as string) end as otherph,
  case when o_orderkey % 15 = 0 then 'frequently Flooded' else cast(null as string) end as localphase,
  case o_orderkey % 4 when 0 then 'Yes' when 1 then 'No' when 2 then 'Unranked' end as hydricrating,
  case o_orderkey % 5 when 0 then 'Poorly drained' when 1 then 'Very poorly drained' when 2 then 'Well drained'
    end as drainagecl,
  case when o_orderkey % 11 = 0 then cast(null as double) else cast(o_orderkey % 45 as double) end as slope_r,
  cast(o_orderkey % 200 as double) as slopelenusle_r,
  cast(o_orderkey % 3000 as double) as elev_r,
  cast(o_orderkey % 360 as double) as aspectrep
from orders
"""

CHORIZON = """
select cokey, chkey, hzdept_r,
  case when part % 29 = 0 then hzdept_r else base + l_quantity end as hzdepb_r,
  case when n = 5 then cast(null as double) else cast(20 + n * 5 as double) end as sandtotal_r,
  case when part % 31 = 0 then cast(null as double) else cast(70 - n * 5 - part % 7 as double) end as silttotal_r,
  cast(10 + part % 7 as double) as claytotal_r,
  case when n = 7 then cast(null as double) else l_discount * 50 end as om_r,
  case when n = 2 then cast(null as double) else cast(1 as double) + l_tax * 4 end as dbtenthbar_r,
  case when n = 6 then cast(null as double) else cast(1 as double) + l_tax * 5 end as dbthirdbar_r,
  cast(1 as double) + l_tax * 6 as dbfifteenbar_r,
  case when part % 10 = 0 then cast(null as double) else cast(1 as double) + l_tax * 7 end as dbovendry_r,
  case when n = 3 then cast(null as double) else l_extendedprice / 10000 end as ksat_r,
  case when n = 4 then cast(null as double) else l_discount * 2 end as awc_r,
  case when n = 1 then cast(null as double) else cast(40 + n as double) end as wtenthbar_r,
  cast(30 + n as double) as wthirdbar_r,
  case when part % 4 = 0 then cast(null as double) else cast(10 + n as double) end as wfifteenbar_r,
  cast(50 + n as double) as wsatiated_r,
  case when part % 6 = 0 then cast(null as double) else l_discount * 200 end as cec7_r,
  case when n < 3 then cast(null as double) else l_tax * 300 end as ecec_r,
  l_discount * 100 + l_tax * 100 as sumbases_r,
  case when n = 2 then cast(null as double) else cast(n as double) / 2 + cast(64 as double) / 20 end as ph1to1h2o_r,
  case when part % 9 = 0 then cast(null as double) else l_tax * 160 end as ec_r
from (
  select cast(l_orderkey as string) as cokey,
    cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || cast(l_partkey as string) || '-' ||
      cast(l_suppkey as string) || '-' || cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as string)
      as chkey,
    l_linenumber as n, l_partkey as part, l_quantity, l_discount, l_tax, l_extendedprice,
    cast((l_linenumber - 1) * 25 as double) as base,
    case when l_partkey % 23 = 0 then cast(null as double)
         when l_linenumber = 1 and l_suppkey % 7 = 0 then cast(-4 as double)
         else cast((l_linenumber - 1) * 25 as double) end as hzdept_r
  from lineitem) x
"""

CHFRAGS = """
select case when part % 3 = 0 then 'none/' || chkey else chkey end as chkey,
  case when part % 7 = 0 then cast(null as double) else cast(part % 40 as double) end as fragvol_r
from (select {chkey} as chkey, l_partkey as part, l_quantity from lineitem) x
union all
select case when part % 2 = 0 then chkey else 'none/' || chkey end as chkey, l_quantity * 2 as fragvol_r
from (select {chkey} as chkey, l_partkey as part, l_quantity from lineitem) x
"""

CORESTRICTIONS = """
select case when o_orderkey % 3 = 0 then cast(o_orderkey as string) else 'none/' || cast(o_orderkey as string) end as cokey,
  case o_orderkey % 9 when 0 then 'Lithic bedrock' when 1 then 'Paralithic bedrock' when 2 then 'Densic bedrock'
    when 3 then 'Densic material' when 4 then 'Fragipan' when 5 then 'Duripan' when 6 then 'Sulfuric'
    when 7 then 'Plinthite' else 'Permafrost' end as reskind,
  case when o_orderkey % 8 = 0 then cast(null as double) else cast(10 + o_orderkey % 190 as double) end as resdept_r
from orders
union all
select case when o_orderkey % 6 = 0 then cast(o_orderkey as string) else 'none/' || cast(o_orderkey as string) end,
  'Duripan', cast(60 + o_orderkey % 120 as double) from orders
"""

COINTERP = """
select cast(o_orderkey as string) as cokey, mrulename, rulename, cast(ruledepth as bigint) as ruledepth,
  case when (o_orderkey + n) % 6 = 0 or (o_orderkey + n) % 4 = 0 then cast(null as double)
    else cast((o_orderkey * n) % 100 as double) / 100 end as interphr
from orders {rules}
"""

CHTEXTUREGRP = """
select chkey, chkey || '/' || cast(k as string) as chtgkey,
  case when (part + k) % 10 = 0 then cast(null as string) when (part + k) % 17 = 0 then ''
    else case part % 5 when 0 then 'L' when 1 then 'CL' when 2 then 'SL' when 3 then 'STV-L' else 'MUCK' end end as texture,
  case when part % 13 = 0 then cast(null as string) else 'texture ' || cast(part % 5 as string) end as texdesc,
  case when (part + k) % 3 = 0 then 'No' else 'Yes' end as rvindicator
from (select {chkey} as chkey, l_partkey as part from lineitem) h {copies}
"""

_CHKEY = """cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || cast(l_partkey as string) || '-' ||
      cast(l_suppkey as string) || '-' || cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as string)"""

PIXELS = """
select event_type as region, cast(floor(event_id / 100.0) as int) as row_no, cast(event_id % 100 as int) as col_no,
  cast(case when event_id % 10 = 0 then 0 when event_id % 97 = 0 then 900000 + user_id else user_id + 1 end as bigint)
    as mukey
from events
"""

RULES = [
    (1, "NCCPI - Corn (II)", "NCCPI - NCCPI Corn Submodel (II)", 0),
    (2, "nccpi - Soybeans (II)", "NCCPI - NCCPI Soybeans Submodel (II)", 0),
    (3, "NCCPI - Cotton (II)", "NCCPI - NCCPI Cotton Submodel (II)", 0),
    (5, "NCCPI - Small Grains (II)", "NCCPI - NCCPI Small Grains Submodel (II)", 0),
    (7, "NCCPI - National", "NCCPI - National Commodity Crop Productivity Index (Ver 3.0)", 0),
    (11, "NCCPI - Irrigated", "NCCPI - Irrigated Corn Submodel", 0),
    (13, "ENG - Dwellings", "ENG - Dwellings With Basements", 0),
]


def repeat_rows(rows: list[tuple], columns: str, *, spark: bool) -> str:
    """One output row per literal row, the only text that differs between the engines.

    In Spark each row generates its own copies, without a join.
    """
    literals = ["(" + ", ".join(repr(v) for v in row) + ")" for row in rows]
    if spark:
        return f"lateral view inline(array({', '.join('struct' + x for x in literals)})) r as {columns}"
    return f"cross join (select * from (values {', '.join(literals)}) t({columns})) r"


def _views(spark: bool) -> dict[str, str]:
    rules = repeat_rows(RULES, "n, mrulename, rulename, ruledepth", spark=spark)
    copies = repeat_rows([(1,), (2,)], "k", spark=spark)
    return {
        "mapunit": MAPUNIT, "muaggatt": MUAGGATT, "component": COMPONENT, "chorizon": CHORIZON,
        "chfrags": CHFRAGS.format(chkey=_CHKEY), "corestrictions": CORESTRICTIONS,
        "cointerp": COINTERP.format(rules=rules), "chtexturegrp": CHTEXTUREGRP.format(chkey=_CHKEY, copies=copies),
        "pixels": PIXELS,
    }


SPARK_VIEWS, SQL_VIEWS = _views(True), _views(False)


class Tables:
    """Views over one data directory, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}
        self._base: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._base[name]

    def sql(self, text: str, *bases: str) -> DataFrame:
        """SQL over base tables passed as arguments, so nothing is registered in the session."""
        for b in bases:
            text = text.replace(f"from {b}", f"from {{{b}}}")
        return self.spark.sql(text, **{b: self.base(b) for b in bases})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            base = next(b for b in ("customer", "orders", "lineitem", "events") if f"from {b}" in SPARK_VIEWS[name])
            self._made[name] = self.sql(SPARK_VIEWS[name], base)
        return self._made[name]

    def get(self, name: str) -> DataFrame | None:
        return self[name] if name in SPARK_VIEWS else None


def sql_ctes(*names: str) -> str:
    """The same views as the head of a ``with`` clause."""
    return ",\n".join(f"{n} as ({SQL_VIEWS[n].strip()})" for n in names)
