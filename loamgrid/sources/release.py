"""Identity and inventory of a release directory."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_in_name

# Kind of artifact by file suffix.
ARTIFACT_KIND = {
    "gpkg": "geopackage", "tif": "raster", "7z": "archive", "dbf": "vat", "xml": "metadata", "ovr": "overview",
    "tfw": "worldfile", "cpg": "codepage",
}


class ReleaseError(ValueError):
    """Files whose names disagree about the release they belong to."""


def artifact_kind(path: Column) -> Column:
    """Known kinds by suffix, otherwise the suffix itself, otherwise 'other'."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    kinds = F.create_map(*[F.lit(x) for pair in ARTIFACT_KIND.items() for x in pair])
    return F.coalesce(kinds[suffix], F.nullif(suffix, F.lit("")), F.lit("other"))


def artifact_manifest(
    spark: SparkSession, directory: str, *, release_date: str | None = None, archive: str | None = None,
) -> DataFrame:
    """One row per file: path, kind, size and time, all from the listing; no file is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    return listing.select(
        F.col("path").alias("relative_path"),
        artifact_kind(F.col("path")).alias("artifact_type"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
        F.lit(archive).cast("string").alias("source_archive"),
        F.lit(release_date).cast("string").alias("release_date"),
    )


def file_dates(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Each file name with its kind and the date it carries."""
    return files.withColumn("artifact_type", artifact_kind(F.col(name))).withColumn("release_date", date_in_name(name))


def release_identity(dated: DataFrame, by: list[str]) -> DataFrame:
    """The date agreed by the archive and the table file of each release.

    Directory names are advisory, so only those two kinds are consulted; a
    release whose two kinds disagree, or that has no date at all, fails.
    """
    voters = F.col("artifact_type").isin("geopackage", "archive")
    return dated.groupBy(*by).agg(
        F.min(F.when(voters, F.col("release_date"))).alias("first_date"),
        F.max(F.when(voters, F.col("release_date"))).alias("last_date"),
        F.count_if(F.col("release_date").isNotNull() & voters).alias("dated_files"),
    ).select(
        *by,
        F.when(F.col("first_date") == F.col("last_date"), F.col("first_date")).alias("release_date"),
        "dated_files",
        F.coalesce(F.col("first_date") == F.col("last_date"), F.lit(False)).alias("passed"),
    )


def release_findings(dated: DataFrame, by: list[str]) -> DataFrame:
    """What the files of each release say about it: one row a release, with the first rule it breaks.

    There has to be exactly one table file and at most one archive; their dates must
    agree where both have one, and one of them must.  The table file's date counts
    before the archive's.  A directory (a name without suffix) that carries another
    date is a warning only.
    """
    kind = F.col("artifact_type")
    day = lambda k: F.min(F.when(kind == k, F.col("release_date")))
    counts = dated.groupBy(*by).agg(
        F.count_if(kind == "geopackage").alias("table_files"), F.count_if(kind == "archive").alias("archives"),
        day("geopackage").alias("table_date"), day("archive").alias("archive_date"),
        F.collect_set(F.when(kind == "other", F.col("release_date"))).alias("others"))
    date = F.coalesce("table_date", "archive_date")
    problem = (
        F.when(F.col("table_files") != 1, "not one table file").when(F.col("archives") > 1, "several archives")
        .when(F.col("table_date") != F.col("archive_date"), "conflicting dates").when(date.isNull(), "no date"))
    found = counts.withColumn("problem", problem)
    sound = F.col("problem").isNull()
    return found.select(
        *by, "table_files", "archives", F.when(sound, date).alias("release_date"),
        F.when(sound, F.when(F.col("table_date").isNotNull(), "geopackage").otherwise("archive")).alias("date_source"), "problem",
        (sound & (F.size(F.array_remove("others", date)) > 0)).alias("directory_differs"), sound.alias("passed"))


def require_release(dated: DataFrame, expected: str) -> str:
    """The one date the files agree on, which must be the expected one; a directory that differs is warned about."""
    row = release_findings(dated.withColumn("_all", F.lit(1)), ["_all"]).first()
    if row is None or not row["passed"]:
        raise ReleaseError(f"no release: {'no files' if row is None else row['problem']}")
    if row["directory_differs"]:
        warnings.warn("a directory name carries another date than the release's files", stacklevel=2)
    if row["release_date"] != expected:
        raise ReleaseError(f"found release {row['release_date']}, expected {expected}")
    return row["release_date"]


def stale_units(requested: DataFrame, recorded: DataFrame, keys: list[str], *, force: bool = False) -> DataFrame:
    """Requested units whose fingerprint differs from the recorded one."""
    return requested if force else requested.join(recorded, keys, "left_anti")


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of every Parquet file of a table, as its scan sees them; no column is read."""
    about = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"))
    return about.distinct()


def stale_files(spark: SparkSession, path: str, recorded: DataFrame, *, force: bool = False) -> DataFrame:
    """Files of a table that are new or differ in size or time from what was recorded when they were last taken."""
    return stale_units(file_fingerprints(spark, path), recorded, ["file_name", "file_size", "modified"], force=force)
