"""Product views, messages and faulty rows, derived by Spark from the whole test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# User agents with the families they stand for; the versions come from the events.
USER_AGENTS = (
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/%.0.0.0 Safari/537.36", "Chrome", "Windows"),
    ("Mozilla/5.0 (Linux; Android 13; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/%.0.0.0 Mobile Safari/537.36", "Chrome Mobile", "Android"),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/%.0.0.0 Safari/537.36 Edg/%.0.0.0", "Edge", "Windows"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 (KHTML, "
     "like Gecko) Version/%.5 Mobile/15E148 Safari/604.1", "Mobile Safari", "iOS"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like "
     "Gecko) Version/%.5 Safari/605.1.15", "Safari", "Mac OS X"),
    ("Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:%.0) Gecko/20100101 Firefox/%.0",
     "Firefox", "Ubuntu"),
    ("Mozilla/5.0 (X11; CrOS x86_64 14541.0.0) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/%.0.0.0 Safari/537.36", "Chrome", "Chrome OS"),
    ("Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko", "IE", "Windows"),
    ("Mozilla/5.0 (Linux; Android 12; SM-G991B) AppleWebKit/537.36 (KHTML, like Gecko) "
     "SamsungBrowser/%.0 Chrome/%.0.0.0 Mobile Safari/537.36", "Samsung Internet", "Android"),
    ("Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/%.0.0.0 "
     "Safari/537.36 OPR/%.0.0.0", "Opera", "Windows"),
    ("Mozilla/5.0 (iPad; CPU OS 16_5 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "CriOS/%.0.0.0 Mobile/15E148 Safari/604.1", "Chrome Mobile iOS", "iOS"),
    ("Mozilla/5.0 (Android 13; Mobile; rv:%.0) Gecko/%.0 Firefox/%.0", "Firefox Mobile",
     "Android"),
    ("curl/7.%.0", "curl", "Other"),
    ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", "Googlebot",
     "Other"),
    ("no known product %", "Other", "Other"),
)

# Rarer ones: bots, applications, clients and old systems.
RARE_AGENTS = (
    ("Mozilla/5.0 (compatible; AhrefsBot/7.0; +http://ahrefs.com/robot/)", "AhrefsBot", "Other"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_4 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like "
     "Gecko) Version/17.4 Mobile/15E148 Safari/604.1 (Applebot/0.%)", "Applebot", "iOS"),
    ("facebookexternalhit/1.% (+http://www.facebook.com/externalhit_uatext.php)",
     "facebookexternalhit", "Other"),
    ("Mozilla/5.0 (Linux; Android 10; HLK-AL00) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/%.0.0.0 Mobile Safari/537.36 MicroMessenger/8.0.%", "WeChat", "Android"),
    ("Mozilla/5.0 (Linux; Android 13; KFTRWI) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Silk/%.2.1 like Chrome/%.0.0.0 Safari/537.36", "Amazon Silk", "Android"),
    ("Mozilla/5.0 (Mobile; Nokia 8110 4G; rv:48.0) Gecko/48.0 Firefox/48.0 KAIOS/2.5.%",
     "Firefox Mobile", "KaiOS"),
    ("Opera/9.80 (J2ME/MIDP; Opera Mini/7.%; U; en) Presto/2.8.119 Version/11.10", "Opera Mini",
     "Other"),
    ("Mozilla/5.0 (BB10; Touch) AppleWebKit/537.10 (KHTML, like Gecko) Version/10.%.0.2340 "
     "Mobile Safari/537.10", "BlackBerry WebKit", "BlackBerry OS"),
    ("Mozilla/5.0 (X11; OpenBSD amd64; rv:%.0) Gecko/20100101 SeaMonkey/2.%", "SeaMonkey",
     "OpenBSD"),
    ("Mozilla/5.0 (PlayStation 4 3.%) AppleWebKit/537.73 (KHTML, like Gecko)", "Other",
     "PlayStation"),
    ("okhttp/4.%.0", "okhttp", "Other"),
    ("Dalvik/2.1.0 (Linux; U; Android 11; SM-A%)", "Other", "Android"),
    ("an online line of products, chrome too (%)", "Other", "Other"),
    ("Mozilla/5.0 (Web0S; Linux/SmartTV) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/%.0.0.0 Safari/537.36 WebAppManager", "Chrome", "webOS"),
    ("", "unknown", "unknown"),
)

TOPIC = "product_views"
# Dates from here on form the second of two batches.
SECOND_BATCH = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso_time(ts) -> Column:
    """The zone-free timestamp as yyyy-MM-ddTHH:mm:ss."""
    return F.replace(F.substring(F.col(ts).cast("string"), 1, 19), F.lit(" "), F.lit("T"))


def product_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product view per event, with null, empty and typed referrers among them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events")
    page = F.col("user_id") % pages.agg(F.count("*")).scalar()
    user = F.col("user_id")
    return events.withColumn("_page", page).join(
        pages, F.col("_page") == F.col("page_id")
    ).select(
        "event_id",
        iso_time("ts").alias("local_time"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 5).cast("string")
        .alias("product_id"),
        F.when(user % 17 != 2, (user % 10).cast("string")).alias("store_id"),
        F.when(user % 23 == 3, F.lit(None))
        .when(user % 19 == 4, "")
        .when(user % 13 == 5, "direct")
        .when(user % 11 == 6, F.concat(F.lit("https://www.facebook.com/l?u="), "url"))
        .when(user % 7 == 1, F.concat(F.lit("https://www.google.com/search?q="), "event_type"))
        .otherwise(F.col("url")).alias("referrer_url"),
        F.when(F.col("event_id") % 29 != 0, user.cast("string")).alias("device_id"),
    )


def shipped_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product view per order line: a larger table with larger dimensions."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    page = F.col("l_suppkey") % pages.agg(F.count("*")).scalar()
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .withColumn("_page", page).join(pages, F.col("_page") == F.col("page_id"))
        .select(
            F.date_format("l_shipdate", "yyyy-MM-dd'T'00:00:00").alias("local_time"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("s_nationkey").cast("string").alias("store_id"),
            F.col("url").alias("referrer_url"),
            F.col("o_custkey").cast("string").alias("device_id"))
    )


def times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times, some of them no time at all."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(event % 7 == 3, "zgarbage").when(event % 11 == 4, "")
        .when(event % 13 == 5, "2024-02-30T10:00:00")
        .when(event % 17 == 6, F.lit(None))
        .when(event % 19 == 7, F.replace(iso_time("ts"), F.lit("T"), F.lit(" ")))
        .otherwise(iso_time("ts")).alias("local_time"))


def seeded_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product views, some with the last date there is, dates beyond, short forms, garbage."""
    event = F.col("event_id")
    time = (F.when(event % 53 == 1, "9999-12-31T00:00:00").when(event % 53 == 2, "300000-1-1")
            .when(event % 53 == 3, "5000-01-01").when(event % 53 == 4, "nope")
            .when(event % 53 == 5, "2024-1-30").otherwise(F.col("local_time")))
    return product_views(spark, sf_dir).withColumn("local_time", time)


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per product view, over three partitions."""
    return _messages_of(product_views(spark, sf_dir))


def seeded_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages_of(seeded_views(spark, sf_dir))


def agent_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product views whose messages also name a user agent, one kind per device, or none."""
    kind = F.col("device_id").cast("bigint") % 4
    agent = (F.when(kind == 0, "curl/8.0").when(kind == 1, "no known product/1.0").when(
        kind == 2, "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like "
        "Gecko) Chrome/120.0.0.0 Safari/537.36"))
    return _messages_of(product_views(spark, sf_dir).withColumn("user_agent", agent))


def long_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product views of which some have a product id that is too long for the warehouse."""
    long = F.when(F.col("event_id") % 50 == 7, F.repeat("product_id", F.lit(400)))
    views = product_views(spark, sf_dir)
    return _messages_of(views.withColumn("product_id", F.coalesce(long, "product_id")))


def _messages_of(views: DataFrame) -> DataFrame:
    event = F.col("event_id")
    return views.select(
        event.cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*views.columns)).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (event % 3).cast("int").alias("partition"),
        F.floor(event / 3).alias("offset"),
        F.col("local_time").try_cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of every kind: objects, plain text, other JSON, broken JSON, no value."""

    def part(name, partition, key, text):
        return table(spark, sf_dir, name).select(
            F.lit(None).cast("binary").alias("key"), text.cast("binary").alias("value"),
            F.lit("mixed").alias("topic"), F.lit(partition).alias("partition"),
            key.cast("bigint").alias("offset"),
            F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"))

    event = F.col("event_id")
    objects = (
        F.when(event % 29 == 0, F.lit(None))
        .when(event % 23 == 1, F.concat("props", F.lit(" trailing")))
        .when(event % 19 == 2, F.concat(F.lit("  "), "props", F.lit("\n")))
        .when(event % 17 == 3, F.concat(F.lit("["), "props", F.lit("]")))
        .when(event % 13 == 4, F.substring("props", 1, 5))
        .otherwise(F.col("props"))
    )
    return (
        part("events", 0, event, objects)
        .unionByName(part("documents", 1, F.col("doc_id"), F.col("text")))
        .unionByName(part("labels", 2, F.col("doc_id"), F.col("quality").cast("string")))
        .unionByName(part("conversations", 3, F.col("conv_id") * 1000 + F.col("turn"),
                          F.to_json(F.col("text").cast("variant"))))
    )


def mixed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose product is a number, a decimal, text, nested, null or missing."""
    event = F.col("event_id")
    number = F.regexp_extract("props", "([0-9]+)", 1)
    document = (
        F.when(event % 6 == 0, F.concat(F.lit('{"product_id": '), number, F.lit("}")))
        .when(event % 6 == 1, F.concat(F.lit('{"product_id": '), number, F.lit(".50}")))
        .when(event % 6 == 2, F.concat(F.lit('{"product_id": "p'), number, F.lit('"}')))
        .when(event % 6 == 3, F.concat(F.lit('{"product_id": '), "props", F.lit("}")))
        .when(event % 6 == 4, F.lit('{"product_id": null}'))
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select("event_id", document.alias("text"))


def mixed_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of mixed shape as messages of one partition."""
    return mixed_products(spark, sf_dir).select(
        F.lit(None).cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
        F.lit("mixed").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))


def broken_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows shaped like the fact that break its keys, its nulls and its ranges."""
    views = product_views(spark, sf_dir)
    event = F.col("event_id")
    return views.select(
        "event_id",
        F.when(event % 41 != 5, F.replace(F.substring("local_time", 1, 10), F.lit("-"),
                                          F.lit("")).cast("int")).alias("date_key"),
        F.when(event % 31 != 4, F.col("product_id").cast("bigint")).alias("product_key"),
        F.col("store_id").cast("bigint").alias("country_key"),
        F.col("device_id").cast("bigint").alias("device_key"),
        F.when(event % 37 == 6, event * 3_000_000_000).otherwise(event).alias("view_count"),
        F.when(event % 43 == 7, F.lit(123456789012)).otherwise(event).cast("decimal(20,3)")
        .alias("price"))


def country_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses with country labels in several places of the host."""
    page, url = F.col("page_id"), F.col("url")
    rest = F.regexp_replace(url, r"^https?://[^/]*", "")
    host = F.regexp_extract(url, "//([^/]*)", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(page % 9 == 0, F.concat(F.lit("http://"), host, F.lit(".VN"), rest))
        .when(page % 9 == 1, F.concat(F.lit("https://"), host, F.lit(".vn.shop"), rest))
        .when(page % 9 == 2, F.concat(F.lit("//u@"), host, F.lit(".fr?q=1")))
        .when(page % 9 == 3, F.concat(host, F.lit(".de"), rest))
        .when(page % 9 == 4, F.concat(F.lit("http://"), host, F.lit(".co.uk:80"), rest))
        .when(page % 9 == 5, F.concat(F.lit(" \thttp://"), host, F.lit(".us#top")))
        .when(page % 9 == 6, F.concat(F.lit("http://[::1"), rest))
        .when(page % 9 == 7, F.lit(None))
        .otherwise(url).alias("url"))


def _agents_of(spark: SparkSession, sf_dir: str, agents) -> DataFrame:
    templates = F.array(*[F.lit(agent) for agent, _, _ in agents])
    pick = (F.col("event_id") % (len(agents) + 1)).cast("int")
    version = F.regexp_extract("props", "([0-9]+)", 1)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.replace(F.try_element_at(templates, pick + 1), F.lit("%"), version)
        .alias("user_agent"))


def user_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user agent per event."""
    return _agents_of(spark, sf_dir, USER_AGENTS)


def rare_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rarer user agent per event."""
    return _agents_of(spark, sf_dir, RARE_AGENTS)
