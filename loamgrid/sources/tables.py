"""Contracts of the relational source tables and the scans that honour them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nan_to_null

# Numeric columns that the "_r" rule does not cover.
LONG_COLUMNS = frozenset({"mukey", "ruledepth"})
DOUBLE_COLUMNS = frozenset(
    {"interphr", "aspectrep", "slopegraddcp", "slopegradwta", "aws025wta", "aws0100wta", "aws0150wta"}
)


def column_type(name: str) -> T.DataType:
    """Keys other than the map-unit key stay text, so they compare as text."""
    if name in LONG_COLUMNS:
        return T.LongType()
    if name in DOUBLE_COLUMNS or name.endswith("_r"):
        return T.DoubleType()
    return T.StringType()


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...] = ()
    rule_prefix: str | None = None  # keep only interpretations starting with this

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, column_type(c)) for c in self.columns])

    def row_filter(self) -> Column | None:
        """The source compares rule names without regard to case."""
        return None if self.rule_prefix is None else F.col("mrulename").ilike(self.rule_prefix + "%")


def _contract(name: str, columns: str, key: str = "", **kw) -> TableContract:
    return TableContract(name, tuple(columns.split()), tuple(key.split()), **kw)


# The columns each source table must supply, and its key.
TABLES: dict[str, TableContract] = {
    t.name: t
    for t in (
        _contract("mapunit", "mukey muname mukind", "mukey"),
        _contract("muaggatt", "mukey slopegraddcp slopegradwta aws025wta aws0100wta aws0150wta", "mukey"),
        _contract(
            "component",
            "mukey cokey comppct_r compname compkind majcompflag otherph localphase hydricrating drainagecl "
            "slope_r slopelenusle_r elev_r aspectrep",
            "cokey",
        ),
        _contract(
            "chorizon",
            "cokey chkey hzdept_r hzdepb_r sandtotal_r silttotal_r claytotal_r om_r dbtenthbar_r dbthirdbar_r "
            "dbfifteenbar_r dbovendry_r ksat_r awc_r wtenthbar_r wthirdbar_r wfifteenbar_r wsatiated_r cec7_r "
            "ecec_r sumbases_r ph1to1h2o_r ec_r",
            "chkey",
        ),
        _contract("chfrags", "chkey fragvol_r"),
        _contract("corestrictions", "cokey reskind resdept_r"),
        _contract("cointerp", "cokey mrulename rulename ruledepth interphr", rule_prefix="NCCPI"),
        _contract("chtexturegrp", "chkey chtgkey texture texdesc rvindicator"),
    )
}


class ContractError(ValueError):
    """A source table that does not honour its contract."""


def coerce(df: DataFrame, contract: TableContract, *, strict: bool = True) -> DataFrame:
    """The contract's columns in its types; other columns are dropped.

    ``strict`` lets a malformed number fail the job; otherwise it becomes null.
    """
    out = []
    for name in contract.columns:
        kind = column_type(name)
        source = F.col(name)
        value = source.cast(kind) if strict else source.try_cast(kind)
        if isinstance(kind, T.DoubleType):
            value = nan_to_null(value)
        out.append(value.alias(name))
    return df.select(*out)


def scan(df: DataFrame, contract: TableContract, *, strict: bool = True) -> DataFrame:
    """Typed, pruned and filtered view of one source table.

    The filter comes before the casts so that it reaches the file scan.
    """
    keep = contract.row_filter()
    return coerce(df if keep is None else df.where(keep), contract, strict=strict)


def read_tables(spark: SparkSession, base: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Parquet tables ``base/<name>.parquet`` under their declared schemas."""
    return {n: scan(spark.read.parquet(f"{base}/{n}.parquet"), TABLES[n]) for n in (names or TABLES)}


def read_jdbc(
    spark: SparkSession, url: str, contract: TableContract, *, partition_column: str | None = None,
    lower: int = 0, upper: int = 0, partitions: int = 1, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same scan over a relational source, split on a numeric column when one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", contract.name).options(**(options or {}))
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions)
        )
    return scan(reader.load(), contract)


def required_columns(tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract] = TABLES) -> DataFrame:
    """One row per contract: row count, missing columns, verdict.

    A table that is absent altogether reports every column as missing.
    """
    spark = next(iter(tables.values())).sparkSession
    out = None
    for name, contract in contracts.items():
        df = tables.get(name)
        missing = list(contract.columns) if df is None else [c for c in contract.columns if c not in df.columns]
        rows = spark.range(1).select(F.lit(0).cast("bigint").alias("rows")) if df is None else df.agg(F.count("*").alias("rows"))
        row = rows.select(
            F.lit(name).alias("table_name"), "rows",
            F.lit(", ".join(missing)).alias("missing_columns"), F.lit(not missing).alias("passed"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that occur more than once, with their size."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def key_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, distinct keys and repeated keys for each named (table, key)."""
    out = None
    for name, (df, keys) in tables.items():
        sizes = df.groupBy(*keys).agg(F.count("*").alias("copies"))
        row = sizes.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
            F.count("*").alias("distinct_keys"),
            F.count_if(F.col("copies") > 1).alias("repeated_keys"),
        ).select(F.lit(name).alias("table_name"), "rows", "distinct_keys", "repeated_keys")
        out = row if out is None else out.unionByName(row)
    return out.withColumn("passed", F.col("repeated_keys") == 0)


def require_unique(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """The table itself, after an aggregate has shown that its key is unique."""
    repeated = duplicate_keys(df, keys).count()
    if repeated:
        raise ContractError(f"{label}: {repeated} repeated values of {', '.join(keys)}")
    return df
