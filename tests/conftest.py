import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loamgrid.session import local_session  # noqa: E402
from loamgrid.sources.tables import TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, **{"spark.driver.memory": "4g", "spark.driver.host": "127.0.0.1"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def frame(spark, table, rows):
    """Rows given as dicts; columns left out are null."""
    contract = TABLES[table]
    return spark.createDataFrame([tuple(r.get(c) for c in contract.columns) for r in rows], contract.schema)


# Four map units made up for the hard cases: equal shares (k10 and k9), shares that
# add up to more than 100, a missing share, a missing property below a given one,
# two fragment rows, a salty subsoil and an open water of exactly 80 percent.
COMPONENTS = [
    dict(mukey=7101, cokey="k9", comppct_r=45.0, compname="Tarn", compkind="Taxadjunct", majcompflag="Yes",
         drainagecl="Well drained", slope_r=3.0, elev_r=812.0, aspectrep=10.0),
    dict(mukey=7101, cokey="k10", comppct_r=45.0, compname="Orrin", compkind="Series", majcompflag="Yes", hydricrating="No",
         drainagecl="Poorly drained", slope_r=7.0, slopelenusle_r=61.0, elev_r=790.0, aspectrep=350.0),
    dict(mukey=7101, cokey="k11", comppct_r=20.0, compname="Wick", compkind="Series", majcompflag="No", drainagecl="Poorly drained"),
    dict(mukey=7202, cokey="w1", comppct_r=80.0, compname="Water", compkind="Miscellaneous area", majcompflag="Yes"),
    dict(mukey=7202, cokey="w0", compname="Orrin", compkind="Series", majcompflag="Yes"),
    dict(mukey=7303, cokey="e1", comppct_r=70.0, compname="Esk", compkind="Family", majcompflag="Yes", hydricrating="no",
         slope_r=18.0, slopelenusle_r=22.0, elev_r=1430.0, aspectrep=135.0),
    dict(mukey=7404, cokey="f2", comppct_r=25.0, compname="Fenn", compkind="Series", majcompflag="No", hydricrating="YES"),
    dict(mukey=7404, cokey="f1", comppct_r=30.0, compname="Sill", compkind="Series", majcompflag="Yes", hydricrating="Unranked",
         drainagecl="Moderately well drained", localphase="undrained", slope_r=0.5, elev_r=3.0),
]

HORIZON_COLUMNS = ("cokey", "chkey", "hzdept_r", "hzdepb_r", "sandtotal_r", "silttotal_r", "claytotal_r", "om_r", "dbthirdbar_r",
                   "ksat_r", "awc_r", "ph1to1h2o_r", "ec_r")
HORIZONS = [dict(zip(HORIZON_COLUMNS, values, strict=True)) for values in [
    ("k10", "g1", 0.0, 25.0, 20.0, 60.0, 20.0, 4.0, 1.1, 9.0, 0.20, 5.9, 0.2),
    ("k10", "g2", 25.0, 90.0, 10.0, 62.0, 28.0, 0.8, 1.5, 3.0, 0.14, 6.3, 0.2),
    ("k9", "g3", 0.0, 40.0, 60.0, 25.0, 15.0, 1.0, 1.4, 30.0, 0.10, 7.2, 1.0),
    ("k9", "g4", 40.0, 120.0, None, None, None, None, None, 50.0, 0.08, None, 14.0),
    ("e1", "g5", 0.0, 64.0, 33.0, 41.0, 26.0, 2.0, 1.25, 4.0, 0.25, 6.1, None),
    ("e1", "g6", 64.0, 110.0, None, None, None, None, None, None, 0.05, None, None),
    ("f1", "g7", 0.0, 180.0, 70.0, 18.0, 12.0, 5.0, 0.9, 12.0, 0.10, 4.4, 2.0),
    ("f2", "g8", 0.0, 12.0, None, None, None, 30.0, 0.3, 6.0, None, 4.0, None),
]]
RATINGS = [
    ("k10", "NCCPI - NCCPI Corn Submodel (II)", 0.7), ("k10", "NCCPI - NCCPI Small Grains Submodel (II)", 0.5),
    ("k10", "NCCPI - Irrigated Cotton Submodel", 0.95), ("k10", "NCCPI - NCCPI Corn Submodel (II)", 0.2),
    ("k9", "NCCPI - NCCPI Corn Submodel (II)", 0.4), ("k9", "NCCPI - National Commodity Crop Productivity Index (Ver 3.0)", 0.3),
    ("k11", "NCCPI - NCCPI Soybeans Submodel (II)", 0.9), ("e1", "NCCPI - NCCPI Soybeans Submodel (II)", None),
]
TEXTURES = [("g1", "u2", "SIL", "Yes"), ("g1", "u1", "SICL", "Yes"), ("g3", "u3", "FSL", "Yes"), ("g5", "u5", "GRV-L", "Yes"),
            ("g7", "u7", "MPM", "Yes"), ("g8", "u8", "PEAT", "No")]
NAMES = {7101: "Orrin-Tarn complex, frequently flooded", 7202: "Upper Reservoir", 7303: "Esk gravelly loam, steep", 7404: "Sill mucky peat"}


@pytest.fixture(scope="session")
def soil(spark):
    return {
        "component": frame(spark, "component", COMPONENTS),
        "chorizon": frame(spark, "chorizon", HORIZONS),
        "chfrags": frame(spark, "chfrags", [dict(chkey="g1", fragvol_r=6.0), dict(chkey="g1", fragvol_r=9.0), dict(chkey="g2")]),
        "corestrictions": frame(spark, "corestrictions", [
            dict(cokey="e1", reskind="Fragipan", resdept_r=64.0), dict(cokey="e1", reskind="Abrupt textural change", resdept_r=20.0),
            dict(cokey="k10", reskind="Duripan")]),
        "cointerp": frame(spark, "cointerp", [
            dict(cokey=c, mrulename=r, rulename=r, ruledepth=0, interphr=v) for c, r, v in RATINGS]),
        "mapunit": frame(spark, "mapunit", [dict(mukey=k, muname=n) for k, n in NAMES.items()]),
        "chtexturegrp": frame(spark, "chtexturegrp", [
            dict(chkey=h, chtgkey=k, texture=x, texdesc=x.lower(), rvindicator=rv) for h, k, x, rv in TEXTURES]),
    }


ROWS, COLUMNS = 72, 88
STRANGE = {(5, 7): 8888, (40, 41): 9999, (71, 87): 8888}


def key_at(r, c):
    """A checkerboard of blocks, background along every ninth diagonal, and two keys nobody knows."""
    return STRANGE.get((r, c), 0 if (r + c) % 9 == 0 else list(NAMES)[(r // 18 + c // 22) % 4])


def mapped_cells(rows=range(ROWS)):
    return sum(key_at(r, c) > 0 for r in rows for c in range(COLUMNS))


@pytest.fixture(scope="session")
def raster(spark):
    cells = [("test", r, c, key_at(r, c)) for r in range(ROWS) for c in range(COLUMNS)]
    return spark.createDataFrame(cells, "region string, row_no int, col_no int, mukey bigint").repartition(4)
