"""One enriched row per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.operators.dedupe import latest_per_key
from riskspark.sources.tables import DateLike, as_date


def exploited_side(exploited: DataFrame) -> DataFrame:
    one_each = latest_per_key(exploited, newest="kev_date_added")
    return one_each.select(
        "cve_id",
        "kev_date_added",
        F.col("vendor_project").alias("kev_vendor"),
        F.col("product").alias("kev_product"),
        F.col("vulnerability_name").alias("kev_vulnerability_name"),
        F.col("short_description").alias("kev_short_description"),
        F.col("required_action").alias("kev_required_action"),
        "known_ransomware_campaign_use",
        "is_ransomware",
        F.lit(1).alias("is_kev"),
    )


def probability_side(probabilities: DataFrame) -> DataFrame:
    one_each = latest_per_key(probabilities, newest="score_date")
    return one_each.select(
        "cve_id",
        "epss_score",
        "epss_percentile",
        F.col("score_date").alias("epss_score_date"),
    )


def first_of(values: str, fallback: str):
    return F.coalesce(F.get(values, F.lit(0)), F.col(fallback))


def build_master(
    catalogue: DataFrame, exploited: DataFrame, probabilities: DataFrame, snapshot_date: DateLike
) -> DataFrame:
    """Catalogue with both side tables attached and their gaps filled.

    Every side holds one row per key, so the joins never multiply rows. No join is hinted: the
    short exploited list is broadcast while it is under the planner's size threshold, and a
    probability snapshot about as long as the catalogue is joined by shuffle, where adaptive
    execution splits an overlong key of the catalogue side.
    """
    return (
        catalogue.join(exploited_side(exploited), "cve_id", "left")
        .join(probability_side(probabilities), "cve_id", "left")
        .withColumns(
            {
                "is_kev": F.coalesce("is_kev", F.lit(0)),
                "is_ransomware": F.coalesce("is_ransomware", F.lit(False)),
                "epss_score": F.coalesce("epss_score", F.lit(0.0)),
                "epss_percentile": F.coalesce("epss_percentile", F.lit(0.0)),
                "snapshot_date": as_date(snapshot_date),
                "primary_vendor": first_of("cpe_vendors", "kev_vendor"),
                "primary_product": first_of("cpe_products", "kev_product"),
            }
        )
    )
