"""Declared schemas. No reader infers types."""

from pyspark.sql import types as T

_text = T.StringType()
_texts = T.ArrayType(_text)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def _metric_list() -> T.ArrayType:
    return T.ArrayType(_struct(cvssData=_struct(baseScore=T.DoubleType(), baseSeverity=_text)))


_LOCALISED = _struct(lang=_text, value=_text)

#: One feed document: a list of nested records. Only the fields that are used are declared,
#: so a feed that lacks a metric version reads as null instead of failing.
FEED = _struct(
    vulnerabilities=T.ArrayType(
        _struct(
            cve=_struct(
                id=_text,
                published=_text,
                lastModified=_text,
                descriptions=T.ArrayType(_LOCALISED),
                weaknesses=T.ArrayType(_struct(description=T.ArrayType(_LOCALISED))),
                metrics=_struct(
                    cvssMetricV40=_metric_list(),
                    cvssMetricV31=_metric_list(),
                    cvssMetricV30=_metric_list(),
                    # the oldest version keeps its severity beside the data struct, not in it
                    cvssMetricV2=T.ArrayType(
                        _struct(cvssData=_struct(baseScore=T.DoubleType()), baseSeverity=_text)
                    ),
                ),
                configurations=T.ArrayType(
                    _struct(
                        nodes=T.ArrayType(
                            _struct(cpeMatch=T.ArrayType(_struct(criteria=_text)))
                        )
                    )
                ),
                references=T.ArrayType(_struct(url=_text, tags=_texts)),
            )
        )
    )
)

EXPLOITED_RAW = _struct(
    cveID=_text,
    vendorProject=_text,
    product=_text,
    vulnerabilityName=_text,
    dateAdded=_text,
    shortDescription=_text,
    requiredAction=_text,
    knownRansomwareCampaignUse=_text,
)

PROBABILITY_RAW = _struct(cve=_text, epss=_text, percentile=_text)

CATALOGUE = _struct(
    cve_id=_text,
    published=T.TimestampType(),
    last_modified=T.TimestampType(),
    description=_text,
    cwes=_texts,
    cvss_score=T.DoubleType(),
    cvss_severity=_text,
    cvss_version=_text,
    cpe_vendors=_texts,
    cpe_products=_texts,
    cpe_versions=_texts,
    reference_count=T.IntegerType(),
    has_exploit_reference=T.BooleanType(),
    published_year=T.IntegerType(),
)

EXPLOITED = _struct(
    cve_id=_text,
    vendor_project=_text,
    product=_text,
    vulnerability_name=_text,
    kev_date_added=T.DateType(),
    short_description=_text,
    required_action=_text,
    known_ransomware_campaign_use=_text,
    is_ransomware=T.BooleanType(),
)

PROBABILITY = _struct(
    cve_id=_text,
    epss_score=T.DoubleType(),
    epss_percentile=T.DoubleType(),
    score_date=T.DateType(),
)

CLUSTER_RISK = _struct(
    cluster_id=T.IntegerType(),
    cluster_size=T.LongType(),
    avg_priority_final=T.DoubleType(),
    avg_cvss=T.DoubleType(),
    avg_epss=T.DoubleType(),
    max_epss=T.DoubleType(),
    kev_density=T.DoubleType(),
    n_kev=T.LongType(),
)

CLUSTER_METRICS = _struct(
    k=T.IntegerType(),
    silhouette=T.DoubleType(),
    cost=T.DoubleType(),
    davies_bouldin=T.DoubleType(),
)
