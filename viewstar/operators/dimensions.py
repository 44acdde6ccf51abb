"""The five dimensions from the members of their natural keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from viewstar.functions.agents import RULES, UNKNOWN as NO_AGENT, Rule
from viewstar.functions.referrers import referrer_domain, referrer_type
from viewstar.functions.times import calendar, date_key, event_date
from viewstar.operators.agents import with_families
from viewstar.operators.members import distinct_members
from viewstar.operators.numbering import dense_keys, hash_keys
from viewstar.schemas import NATURAL_KEYS
from viewstar.staging import Staging

# Texts the dimensions hold.
PRODUCT_PREFIX = "Product "
COUNTRY_PREFIX = "Country "
UNKNOWN = "Unknown"


def event_dates(events: DataFrame) -> DataFrame:
    """Distinct valid dates of the events."""
    return (events.select(event_date("local_time").alias("date"))
            .filter(F.col("date").isNotNull()).distinct())


def dim_date(dates: DataFrame) -> DataFrame:
    """One row per date with its key and calendar attributes."""
    return dates.select(date_key("date").alias("date_key"), "date",
                        *[value.alias(name) for name, value in calendar("date").items()])


def product_columns(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "product_key", "product_id",
        F.concat(F.lit(PRODUCT_PREFIX), F.col("product_id")).alias("product_name"),
        F.lit(True).alias("is_active"), F.current_date().alias("created_date"))


def country_columns(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "country_key", "store_id",
        F.concat(F.lit(COUNTRY_PREFIX), F.col("store_id")).alias("country_name"),
        F.lit(UNKNOWN).alias("region"), F.current_date().alias("created_date"))


def referrer_columns(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "referrer_key", "referrer_url",
        referrer_domain("referrer_url").alias("referrer_domain"),
        referrer_type("referrer_url").alias("referrer_type"),
        F.current_date().alias("created_date"))


def device_columns(keyed: DataFrame) -> DataFrame:
    """Devices; browser and system are known only where the columns of ``device_families``
    came along."""
    found = "browser" in keyed.columns
    browser = F.coalesce("browser", F.lit(NO_AGENT)) if found else F.lit(UNKNOWN)
    system = [F.coalesce("system", F.lit(NO_AGENT)).alias("os_info")] if found else []
    return keyed.select(
        "device_key", "device_id", F.lit(UNKNOWN).alias("device_type"),
        browser.alias("browser_info"), *system, F.current_date().alias("created_date"))


COLUMNS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "product_id": product_columns,
    "store_id": country_columns,
    "referrer_url": referrer_columns,
    "device_id": device_columns,
}


def device_agents(events: DataFrame) -> DataFrame:
    """Devices with the user agent each one sent last."""
    sent = F.max(F.when(F.col("user_agent").isNotNull(),
                        F.struct("local_time", "user_agent")))
    return (events.filter(F.col("device_id").isNotNull())
            .groupBy("device_id").agg(sent.alias("_sent"))
            .select("device_id", F.col("_sent.user_agent").alias("user_agent")))


def device_families(events: DataFrame, staging: Staging,
                    rules: Sequence[Rule] = RULES) -> DataFrame:
    """Devices with the browser and system of the user agent each one sent last."""
    agents = staging.table(device_agents(events), "agents")
    return with_families(agents, staging, rules=rules).drop("user_agent")


def dimension(events: DataFrame, natural: str, staging: Staging | None = None) -> DataFrame:
    """One dimension by its natural key: dense keys, or hash keys where no staging is given."""
    key = NATURAL_KEYS[natural][1]
    agents = natural == "device_id" and "user_agent" in events.columns
    members = (device_families(events, staging or Staging(events.sparkSession)) if agents
               else distinct_members(events, natural))
    keyed = (hash_keys(members, natural, key) if staging is None
             else dense_keys(members, natural, key, staging))
    return COLUMNS[natural](keyed)


def dim_product(events: DataFrame, staging: Staging | None = None) -> DataFrame:
    return dimension(events, "product_id", staging)


def dim_country(events: DataFrame, staging: Staging | None = None) -> DataFrame:
    return dimension(events, "store_id", staging)


def dim_referrer(events: DataFrame, staging: Staging | None = None) -> DataFrame:
    return dimension(events, "referrer_url", staging)


def dim_device(events: DataFrame, staging: Staging | None = None) -> DataFrame:
    return dimension(events, "device_id", staging)
