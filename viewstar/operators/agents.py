"""Browser and system families of user agents: each distinct text is parsed once."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from viewstar.functions.agents import (
    BROWSER, OTHER, RULE_SCHEMA, RULES, SYSTEM, UNKNOWN, Rule, agent_tokens, known_tokens)
from viewstar.operators.lookup import lookup
from viewstar.staging import Staging


def agent_families(agents: DataFrame, column: str = "user_agent",
                   rules: Sequence[Rule] = RULES) -> DataFrame:
    """(user_agent, families) of the distinct texts that a rule knows.

    Only tokens that rules name go on, so a long text adds at most as many rows as there are
    rules; these are bounded, and are broadcast.
    """
    rows = json.dumps([rule._asdict() for rule in rules])
    table = F.broadcast(agents.sparkSession.range(1).select(F.inline(F.from_json(
        F.lit(rows), f"array<struct<{RULE_SCHEMA}>>"))))
    vocabulary = F.from_json(F.lit(json.dumps(known_tokens(rules))), "array<string>")
    texts = agents.select(F.col(column).alias("user_agent")).where("user_agent <> ''").distinct()
    named = texts.select("user_agent", F.array_intersect(
        agent_tokens("user_agent"), vocabulary).alias("tokens"))
    # Outer, as Catalyst would otherwise ask each row, not each distinct text, for a token.
    held = named.select("*", F.explode_outer("tokens").alias("token")).join(table, "token").where(
        "beside IS NULL OR array_contains(tokens, beside)")

    def first(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct("priority", "family")))["family"]

    return held.groupBy("user_agent").agg(
        F.struct(first(BROWSER).alias("browser"), first(SYSTEM).alias("system")).alias("families"))


def with_families(frame: DataFrame, staging: Staging, column: str = "user_agent",
                  browser: str = "browser", system: str = "system",
                  rules: Sequence[Rule] = RULES, **sizes) -> DataFrame:
    """``frame`` with the two families of ``column``; columns of those names are replaced.

    Null and empty texts are "unknown". Families come back by the size-checked lookup, so few
    distinct texts move no row of ``frame`` and many do not meet at a common text. ``frame`` is
    read more than once: hand over a stored table where it is dear. ``sizes`` goes to ``lookup``.
    """
    frame = frame.drop(browser, system)
    families = staging.table(agent_families(frame, column, rules).withColumnsRenamed(
        {"user_agent": "_agent", "families": "_families"}), "families")
    found = lookup(frame.withColumn("_agent", F.col(column)), families, "_agent", "_families",
                   **sizes)
    none = F.col(column).isNull() | (F.col(column) == "")

    def family(name: str) -> Column:
        return F.when(none, UNKNOWN).otherwise(F.coalesce(F.col("_families")[name], F.lit(OTHER)))

    return found.select(*frame.columns, family("browser").alias(browser),
                        family("system").alias(system))
