"""Expressions over the nested feed record (P2a-P2h).

Array access uses ``get``, which gives null out of range also under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: metric lists in order of preference, with the version label of each
METRIC_VERSIONS = (
    ("cvssMetricV40", "v4.0"),
    ("cvssMetricV31", "v3.1"),
    ("cvssMetricV30", "v3.0"),
    ("cvssMetricV2", "v2"),
)
# fixed values: positions in a colon-separated platform name
CPE_FIELDS = {"vendor": 3, "product": 4, "version": 5}


def _first_metric(name: str) -> Column:
    return F.get(F.col(f"metrics.{name}"), F.lit(0))


def _base_score(name: str) -> Column:
    return _first_metric(name)["cvssData"]["baseScore"]


def base_score() -> Column:
    return F.coalesce(*[_base_score(name) for name, _ in METRIC_VERSIONS])


def base_severity() -> Column:
    """First severity present; it may come from another version than the score."""
    inside = [
        _first_metric(name)["cvssData"]["baseSeverity"] for name, _ in METRIC_VERSIONS[:-1]
    ]
    return F.coalesce(*inside, _first_metric(METRIC_VERSIONS[-1][0])["baseSeverity"])


def score_version() -> Column:
    return F.coalesce(
        *[F.when(_base_score(name).isNotNull(), label) for name, label in METRIC_VERSIONS]
    )


def _or_none(texts: Column) -> Column:
    """An inner list that is missing holds nothing; ``flatten`` would make the whole list missing."""
    return F.coalesce(texts, F.array().cast("array<string>"))


def weakness_ids() -> Column:
    values = F.flatten(
        F.transform("weaknesses", lambda w: _or_none(F.transform(w["description"], lambda d: d["value"])))
    )
    return F.filter(F.array_distinct(values), lambda v: v.startswith("CWE-"))


def platform_names() -> Column:
    """All platform names of a record, of every configuration, node and match."""

    def of_node(node: Column) -> Column:
        return _or_none(F.transform(node["cpeMatch"], lambda match: match["criteria"]))

    def of_configuration(configuration: Column) -> Column:
        return _or_none(F.flatten(F.transform(configuration["nodes"], of_node)))

    return F.flatten(F.transform("configurations", of_configuration))


def platform_parts() -> Column:
    """The fields of every platform name. An escaped colon in a name is not treated specially."""
    return F.transform(platform_names(), lambda name: F.split(name, ":"))


def platform_values(parts: Column, field: str) -> Column:
    """Distinct values of one field of split platform names."""
    position = F.lit(CPE_FIELDS[field])
    picked = F.transform(parts, lambda fields: F.get(fields, position))
    return F.array_distinct(picked)


def reference_count() -> Column:
    return F.coalesce(F.size("references"), F.lit(0))


def has_tagged_reference(tag: str) -> Column:
    return F.coalesce(
        F.exists("references", lambda r: F.array_contains(r["tags"], tag)), F.lit(False)
    )


def key(column: str) -> Column:
    """Identifiers compare trimmed and in upper case."""
    return F.upper(F.trim(column))


def iso_timestamp(column: str) -> Column:
    return F.col(column).try_cast("timestamp")


def iso_date(column: str) -> Column:
    return F.try_to_date(F.col(column), "yyyy-MM-dd")
