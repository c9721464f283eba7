"""Raw feeds to typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K, schemas
from riskspark.functions import nested
from riskspark.sources.tables import DateLike, as_date


def catalogue(feed: DataFrame) -> DataFrame:
    """One typed row per nested record. Explode and projection stay in one stage, no shuffle.

    Call ``repartition`` on the result when the feed came as few large unsplittable files.
    """
    records = (
        feed.select(F.inline("vulnerabilities"))
        .select("cve.*")
        # flattened and split once for the three lists made from it
        .withColumn("platform_parts", nested.platform_parts())
    )
    names = F.col("platform_parts")
    return records.select(
        nested.key("id").alias("cve_id"),
        nested.iso_timestamp("published").alias("published"),
        nested.iso_timestamp("lastModified").alias("last_modified"),
        F.get("descriptions", F.lit(0))["value"].alias("description"),
        nested.weakness_ids().alias("cwes"),
        nested.base_score().alias("cvss_score"),
        nested.base_severity().alias("cvss_severity"),
        nested.score_version().alias("cvss_version"),
        nested.platform_values(names, "vendor").alias("cpe_vendors"),
        nested.platform_values(names, "product").alias("cpe_products"),
        nested.platform_values(names, "version").alias("cpe_versions"),
        nested.reference_count().alias("reference_count"),
        nested.has_tagged_reference("Exploit").alias("has_exploit_reference"),
        F.year(nested.iso_timestamp("published")).alias("published_year"),
    )


def within_window(
    df: DataFrame, first_year: int = K.FIRST_YEAR, column: str = "published_year"
) -> DataFrame:
    """Records of ``first_year`` or later; a record without a year is in no window."""
    return df.where(F.col(column) >= first_year)


def exploited(raw: DataFrame) -> DataFrame:
    known = F.lower(F.trim("knownRansomwareCampaignUse")) == "known"
    return raw.select(
        nested.key("cveID").alias("cve_id"),
        F.col("vendorProject").alias("vendor_project"),
        "product",
        F.col("vulnerabilityName").alias("vulnerability_name"),
        nested.iso_date("dateAdded").alias("kev_date_added"),
        F.col("shortDescription").alias("short_description"),
        F.col("requiredAction").alias("required_action"),
        F.col("knownRansomwareCampaignUse").alias("known_ransomware_campaign_use"),
        F.coalesce(known, F.lit(False)).alias("is_ransomware"),
    )


def probabilities(raw: DataFrame, score_date: DateLike) -> DataFrame:
    """Typed daily probabilities; a score that is no number stays null."""
    return raw.select(
        nested.key("cve").alias("cve_id"),
        F.col("epss").try_cast("double").alias("epss_score"),
        F.col("percentile").try_cast("double").alias("epss_percentile"),
        as_date(score_date).alias("score_date"),
    )


def conform(df: DataFrame, schema=schemas.CATALOGUE) -> DataFrame:
    """The schema's columns, in its order and types; missing ones as null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
