"""The star-schema test tables in the roles of the risk domain.

Every view is a projection or join over whole tables, so its size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark.operators.dedupe import latest_per_key

#: Snapshot date of views over ``lineitem``; its latest ship date is a few weeks earlier.
LINE_DATE = "2001-12-01"
#: Snapshot date of views over ``documents`` and ``events``; events end in late January 2024.
DOC_DATE = "2024-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows each become far more than they are, dealt over tasks by ``key``.

    A small table is one split, and its scan one task, however much is made of its rows.
    """
    return table(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def severity_class(score: Column) -> Column:
    return (
        F.when(score >= 9, "CRITICAL")
        .when(score >= 7, "HIGH")
        .when(score >= 4, "MEDIUM")
        .when(score > 0, "LOW")
    )


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as records, their part's brand and type as vendor and product."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    severity = F.col("l_quantity") / 5
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("cve_id"),
        F.col("l_shipdate").alias("published"),
        severity.alias("cvss_score"),
        F.lower(severity_class(severity)).alias("cvss_severity"),
        (F.col("l_tax") * 10).alias("epss_score"),
        (F.col("l_discount") * 10).alias("epss_percentile"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_kev"),
        # every eighth supplier has no cluster
        F.nullif((F.col("l_suppkey") % 8).cast("int"), F.lit(7)).alias("cluster_id"),
        F.col("p_brand").alias("primary_vendor"),
        F.nullif("p_type", F.lit("PROMO")).alias("primary_product"),
    )


def probability_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event value of each user and day as a daily probability."""
    events = table(spark, sf_dir, "events").select(
        F.concat_ws("/", "user_id", F.to_date("ts")).alias("user_day"),
        F.col("user_id").cast("string").alias("cve_id"),
        (F.col("value") / 500).alias("epss_score"),
        F.round(F.col("value") / 500, 2).alias("epss_percentile"),
        F.to_date("ts").alias("score_date"),
        "ts",
        "event_id",
    )
    return latest_per_key(events, "user_day", "ts", ["-event_id"]).select(
        "cve_id", "epss_score", "epss_percentile", "score_date"
    )


def doc_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as catalogue records; short ones lack a score, some lack platforms."""
    severity = F.least(F.lit(10.0), F.col("n_chars") / 1000)
    known = F.when(F.col("n_chars") >= 500, severity)
    none = F.lit(None).cast("array<string>")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("cve_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("doc_id") % 3000).cast("int")).alias(
            "published"
        ),
        F.col("text").alias("description"),
        F.when(F.col("doc_id") % 5 == 0, none)
        .when(F.col("doc_id") % 5 == 1, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("CWE-"), (F.col("doc_id") % 7).cast("string"))))
        .alias("cwes"),
        known.alias("cvss_score"),
        severity_class(known).alias("cvss_severity"),
        F.when(F.col("doc_id") % 4 == 0, none).otherwise(F.array("source")).alias("cpe_vendors"),
        F.when(F.col("doc_id") % 4 == 0, none).otherwise(F.array("lang")).alias("cpe_products"),
    )


def doc_exploited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as the exploited list, each listed twice with different dates."""
    labels = table(spark, sf_dir, "labels").where((F.col("toxic") == 1) | (F.col("quality") == 0))
    listings = labels.select("*", F.explode(F.array(F.lit(0), F.lit(400))).alias("later"))
    added = F.date_add(
        F.lit("2020-01-01").cast("date"), ((F.col("doc_id") % 900) + F.col("later")).cast("int")
    )
    return listings.select(
        F.col("doc_id").cast("string").alias("cve_id"),
        F.concat(F.lit("maker-"), (F.col("doc_id") % 9).cast("string")).alias("vendor_project"),
        F.concat(F.lit("thing-"), F.col("quality").cast("string")).alias("product"),
        F.concat(F.lit("name "), F.col("doc_id").cast("string")).alias("vulnerability_name"),
        added.alias("kev_date_added"),
        F.lit("short").alias("short_description"),
        F.lit("patch").alias("required_action"),
        F.when(F.col("toxic") == 1, "Known").otherwise("Unknown").alias(
            "known_ransomware_campaign_use"
        ),
        (F.col("toxic") == 1).alias("is_ransomware"),
    )


def doc_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as the first day's catalogue rows."""
    return doc_catalogue(spark, sf_dir).withColumns(
        {"last_modified": F.col("published").cast("timestamp"), "published_year": F.year("published")}
    )


def doc_feed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second day: every tenth document has another severity, every twentieth another year too."""
    number = F.col("cve_id").cast("long")
    moved = F.when(number % 20 == 3, F.date_add("published", 366)).otherwise(F.col("published"))
    changed = doc_feed(spark, sf_dir).where(number % 10 == 3).withColumn("published", moved)
    return changed.withColumns(
        {
            "cvss_score": F.lit(9.5),
            "cvss_severity": F.lit("CRITICAL"),
            "published_year": F.year("published"),
            "last_modified": F.lit("2024-01-15").cast("timestamp"),
        }
    )


def doc_exploited_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploited list with the columns and texts of its feed."""
    return doc_exploited(spark, sf_dir).select(
        F.col("cve_id").alias("cveID"),
        F.col("vendor_project").alias("vendorProject"),
        "product",
        F.col("vulnerability_name").alias("vulnerabilityName"),
        F.date_format("kev_date_added", "yyyy-MM-dd").alias("dateAdded"),
        F.col("short_description").alias("shortDescription"),
        F.col("required_action").alias("requiredAction"),
        F.col("known_ransomware_campaign_use").alias("knownRansomwareCampaignUse"),
    )


def probability_raw(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """One day of the probability feed, all texts."""
    known = probability_history(spark, sf_dir).where(F.col("score_date") == F.lit(day).cast("date"))
    return known.select(
        F.col("cve_id").alias("cve"),
        F.col("epss_score").cast("string").alias("epss"),
        F.col("epss_percentile").cast("string").alias("percentile"),
    )


def _order_record() -> Column:
    """The nested feed record of an order."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    status, urgency = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    score = (key % 101) / 10
    words = F.substring("o_orderpriority", 3, 20)

    def metric(label: str, delta: float, nested: bool = True) -> Column:
        base = (score + delta).alias("baseScore")
        severity = F.concat(F.lit(label), words).alias("baseSeverity")
        if nested:
            return F.array(F.struct(F.struct(base, severity).alias("cvssData")))
        return F.array(F.struct(F.struct(base).alias("cvssData"), severity))

    def text(prefix: str, value: Column) -> Column:
        return F.struct(
            F.lit("en").alias("lang"), F.concat(F.lit(prefix), value.cast("string")).alias("value")
        )

    def platform(vendor: Column, product: Column, version: Column) -> Column:
        name = F.concat_ws(":", F.lit("cpe:2.3:a"), vendor, product, version, F.lit("*"))
        return F.struct(name.alias("criteria"))

    weaknesses = F.array(
        F.struct(
            F.array(text("CWE-", customer % 10), text("NVD-CWE-", F.lit("Other"))).alias(
                "description"
            )
        ),
        F.struct(
            F.array(text("CWE-", customer % 10), text("CWE-", key % 7)).alias("description")
        ),
    )
    platforms = F.array(
        platform(customer % 25, key % 6, key % 9),
        platform(customer % 25, key % 6, key % 4),
        platform(customer % 11, (key % 6) + 1, key % 9),
    )
    configurations = F.array(
        F.struct(F.array(F.struct(platforms.alias("cpeMatch"))).alias("nodes"))
    )
    # a name too short to have the wanted fields
    stubs = F.array(
        F.struct(
            F.array(
                F.struct(F.array(F.struct(F.lit("cpe:2.3").alias("criteria"))).alias("cpeMatch"))
            ).alias("nodes")
        )
    )
    tags = F.when(key % 2 == 0, F.array(F.lit("Patch"), F.lit("Exploit"))).otherwise(
        F.array(F.lit("Patch"))
    )
    references = F.array(
        F.struct(F.lit("http://a").alias("url"), F.lit(None).cast("array<string>").alias("tags")),
        F.struct(F.lit("http://b").alias("url"), tags.alias("tags")),
    )
    return F.struct(
        F.concat(F.lit("  cve-"), key.cast("string"), F.lit(" ")).alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("published"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("lastModified"),
        F.array(text("order ", key)).alias("descriptions"),
        F.when(status != "P", weaknesses).alias("weaknesses"),
        F.struct(
            F.when(urgency == "1", metric("four ", 0.0)).alias("cvssMetricV40"),
            F.when(urgency.isin("1", "2"), metric("three-one ", 0.5)).alias("cvssMetricV31"),
            F.when(urgency.isin("2", "3"), metric("three ", 1.0)).alias("cvssMetricV30"),
            F.when(urgency != "5", metric("two ", 2.0, nested=False)).alias("cvssMetricV2"),
        ).alias("metrics"),
        F.when(status == "P", stubs).otherwise(configurations).alias("configurations"),
        F.when(status == "O", references)
        .when(status == "F", F.slice(references, 1, 1))
        .alias("references"),
    )


def order_feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested feed document per order, as JSON text lines."""
    record = _order_record()
    return table(spark, sf_dir, "orders").select(
        F.to_json(F.struct(F.array(F.struct(record.alias("cve"))).alias("vulnerabilities"))).alias(
            "value"
        )
    )


def order_feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents joined to longer ones of up to 500 order numbers each, on several lines.

    Orders are brought together before they become text, so what is shuffled is as narrow as they are.
    """
    orders = table(spark, sf_dir, "orders").withColumn("part", F.floor(F.col("o_orderkey") / 500))
    together = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    joined = together.groupBy("part").agg(
        F.array_join(F.collect_list(F.to_json(F.struct(_order_record().alias("cve")))), ",\n").alias("records")
    )
    return joined.select(F.concat(F.lit('{"vulnerabilities": [\n'), "records", F.lit("\n]}")).alias("value"))


def wide_feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per supplier: 30 configurations of 2 nodes of up to 300 matches, all different."""
    size = (F.col("s_suppkey") % 290 + 11).cast("int")

    def matches(base: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), size - 1),
            lambda i: F.struct(
                F.concat_ws(":", F.lit("cpe:2.3:a"), base, i, base * 1000 + i, F.lit("*")).alias("criteria")
            ),
        )

    def nodes(c: Column) -> Column:
        return F.transform(F.array(c * 2, c * 2 + 1), lambda n: F.struct(matches(n).alias("cpeMatch")))

    configurations = F.transform(
        F.sequence(F.lit(0), F.lit(29)), lambda c: F.struct(nodes(c).alias("nodes"))
    )
    record = F.struct(
        F.concat(F.lit("cve-"), F.col("s_suppkey").cast("string")).alias("id"),
        configurations.alias("configurations"),
    )
    return dealt(spark, sf_dir, "supplier", "s_suppkey").select(
        F.to_json(F.struct(F.array(F.struct(record.alias("cve"))).alias("vulnerabilities"))).alias("value")
    )


def order_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a catalogue table keyed by order number and partitioned by year."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("cve_id"),
        F.col("o_orderdate").alias("last_modified"),
        F.col("o_orderstatus").alias("description"),
        F.year("o_orderdate").alias("published_year"),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes to a part of the orders: new text, every other one moved by a year; plus new keys.

    Each change comes twice, the older version to be ignored.
    """
    orders = order_catalogue(spark, sf_dir)
    number = F.col("cve_id").cast("long")
    changed = orders.where((number % 50 == 0) | (F.col("published_year") == 1995)).select(
        "cve_id",
        F.explode(F.array(F.lit(1), F.lit(2))).alias("version"),
        F.col("last_modified"),
        "published_year",
    )
    moved = (
        F.when(F.col("published_year") == 1995, F.lit(1996))
        .when(number % 100 == 0, F.col("published_year") + 1)
        .otherwise(F.col("published_year"))
    )
    updates = changed.select(
        "cve_id",
        (F.col("last_modified") + F.make_dt_interval(F.col("version"))).alias("last_modified"),
        F.concat(F.lit("changed "), F.col("version").cast("string")).alias("description"),
        moved.alias("published_year"),
    )
    new = orders.where(number % 70 == 0).select(
        F.concat(F.lit("new-"), F.col("cve_id")).alias("cve_id"),
        "last_modified",
        F.lit("new").alias("description"),
        "published_year",
    )
    return updates.unionByName(new)


def part_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the raw exploited list, with line breaks, quotes, blanks and missing values."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" cve-"), F.col("p_partkey").cast("string"), F.lit(" ")).alias("cveID"),
        F.col("p_brand").alias("vendorProject"),
        F.col("p_type").alias("product"),
        F.col("p_name").alias("vulnerabilityName"),
        F.when(size % 10 == 0, F.lit("soon"))
        .otherwise(
            F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), size), "yyyy-MM-dd")
        )
        .alias("dateAdded"),
        F.concat(F.col("p_name"), F.lit(', "quoted"\nnext line')).alias("shortDescription"),
        F.lit("patch, now").alias("requiredAction"),
        F.when(size % 3 == 0, " KNOWN ").when(size % 3 == 1, "Unknown").alias(
            "knownRansomwareCampaignUse"
        ),
    )


def event_probability_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw probability rows, all text, some without a number."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("cve"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.col("value").cast("string"))
        .alias("epss"),
        F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string")).alias("percentile"),
    )
