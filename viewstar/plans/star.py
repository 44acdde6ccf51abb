"""The star build: events in, five dimensions and the fact out."""

from __future__ import annotations

import contextlib
import datetime
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from viewstar.functions.agents import RULES, Rule
from viewstar.functions.times import date_key, event_date
from viewstar.operators.buckets import MEMBERS, bucket_count, touched
from viewstar.operators.dimensions import COLUMNS, device_families, dim_date
from viewstar.operators.facts import (
    event_views, fact_by_lookup, fact_from_grain, fact_from_hash_keys, hash_keyed_grain,
    keyed_grain, merged_grain, on_report_date, view_grain)
from viewstar.operators.lookup import BROADCAST_BYTES, broadcast_size
from viewstar.operators.members import all_members
from viewstar.operators.numbering import Group, hash_key, number_groups
from viewstar.operators.quality import (
    ConstraintViolation, duplicate_keys, strict as fail_on_any, too_long, violations)
from viewstar.schemas import NATURAL_KEYS, TABLES
from viewstar.sinks.warehouse import (
    GRAIN, SKETCHES, write_dimension, write_fact, write_grain, write_rejected, write_sketches)
from viewstar.sources.warehouse import read_members, read_table
from viewstar.staging import Staging
from viewstar.versions import (
    ATTEMPTS, Conflict, Version, Versions, new_run, partition_value)

DATE_KIND = "date"
KINDS = (DATE_KIND, *NATURAL_KEYS)
FACT = "fact_product_views"
# Events without a valid date, per group of the grain, in the quarantine.
UNDATED = "undated_views"


@dataclass
class StarRun:
    """What one build wrote: rows per table, and rows set aside per table."""

    written: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)


def star_frames(events: DataFrame, staging: Staging, latest_only: bool = False,
                today: Column | None = None) -> dict[str, DataFrame]:
    """The six tables as frames, with fresh dense keys and without a warehouse.

    Events are read once for all dates (twice for the latest date only, as the dimensions
    cover every date): members and fact both come from the combined grain.
    """
    grain, members = _grain_and_members(
        events, staging, latest_only, today,
        # Rows of a date and referrer side by side take less room here and in later shuffles.
        lambda part: staging.table(view_grain(part).sortWithinPartitions(
            "date", "referrer_url", "store_id"), "grain"))
    keyed = number_groups(members, "kind", KINDS, "member", "_number", staging)
    frames = _dimension_frames(keyed, {}, _agents(events, staging))
    frames["fact_product_views"] = fact_from_grain(grain, frames, _sizes(keyed))
    return frames


def build_star(events: DataFrame, warehouse: str, latest_only: bool = True,
               replace: bool = False, strict: bool = True, url_limit: int | None = None,
               hash_keys: bool = False, batch_id: str | None = None,
               today: Column | None = None, day: datetime.date | None = None,
               before: Callable[[str], None] | None = None,
               bucket_members: int = MEMBERS, sketches: bool = False,
               agent_rules: Sequence[Rule] = RULES) -> StarRun:
    """Build the star from ``events`` and make it the warehouse's next version.

    By default the run accumulates: stored members keep their keys, new ones are added,
    the dates in question are replaced and all others stay. ``replace`` leaves only this run's
    rows. Either way all six tables change in one step, at the end: a run that fails at any
    point leaves the warehouse as it was, and readers of the old version are not disturbed.
    Of two runs at a time one commits; the other begins anew on what that one left, so no key is
    given twice and no member gets two. Without events nothing is touched.

    Events without a valid date belong to no date of the fact. They never stop a run: their
    groups go to the quarantine as ``undated_views`` and are counted as rejected.

    ``strict`` fails on the first row that breaks a constraint; otherwise such rows go to
    the quarantine folder. ``url_limit`` also counts longer referrer URLs as broken.
    ``batch_id`` names the run in the fact and the quarantine; a repeated id replaces its own
    quarantine, and without one the run gets an id of its own. ``day`` is the report date
    where the caller knows it.

    ``hash_keys`` takes keys hashed from the natural keys instead of dense ones. Members
    are then not sorted and the fact needs no lookup; the run fails before it writes if
    two members or two rows of the fact share a key. A run with the other sort of keys than
    the warehouse holds fails too, either way.

    ``before`` is called with the name of each step before it begins. ``bucket_members`` is how
    many new members of a dimension share a bucket. ``sketches`` keeps sketches of the devices of
    each date and key (``operators.sketches``); a run without leaves its dates without.
    ``agent_rules`` name the browsers and systems of devices (``functions.agents``).
    """
    def take(staging: Staging, base: Version | None):
        keyed = hash_keyed_grain if hash_keys else keyed_grain
        return _grain_and_members(
            events, staging, latest_only, today,
            lambda part: keyed(view_grain(part), staging), day)

    options = _Options(warehouse, replace, strict, url_limit, hash_keys,
                       batch_id or f"run-{uuid.uuid4().hex}", before or (lambda step: None),
                       bucket_members=bucket_members, sketches=sketches, agent_rules=agent_rules)
    return _until_committed(events, take, options)


def merge_star(events: DataFrame, warehouse: str, stream: str, batch: int,
               events_of_dates: Callable[[list[datetime.date]], DataFrame],
               strict: bool = False, hash_keys: bool = False,
               batch_id: str | None = None, sketches: bool = False,
               agent_rules: Sequence[Rule] = RULES) -> StarRun:
    """Add a batch of events to the star: every date it touches gets the views of both.

    The combined views of each date are kept beside the fact. Those of the touched dates are
    read, merged with the batch's, and written again together with the fact of these dates, so
    a late event costs its batch and one date's combined views, not the date's events. A date
    of the fact without kept views, from a build of another sort, is combined once from
    ``events_of_dates``, which holds all its events, the batch's included.

    The ledger of the version names the last ``batch`` of ``stream``; a batch that comes again
    changes nothing.
    """
    spark = events.sparkSession

    # Events that carry their date lie in folders of the landing table, which do not change: they
    # are combined in the one shuffle that merges them. Others are read once and combined first.
    landed = "event_date" in events.columns

    def take(staging: Staging, base: Version | None):
        delta = event_views(events) if landed else staging.table(view_grain(events), "delta")
        dates = events.select(F.col("event_date").alias("date")) if landed else delta.select("date")
        kept = base.partitions(GRAIN) if base else {}
        built = base.partitions(FACT) if base else {}
        # One value per calendar day of the batch.
        days = [row.date for row in dates.distinct().collect() if row.date]
        names = {day: date_name(day) for day in days}
        unkept = [day for day in days if names[day] in built and names[day] not in kept]
        versions = Versions(spark, warehouse)
        parts = [delta.filter(~F.coalesce(F.col("date").isin(unkept), F.lit(False)))
                 if unkept else delta]
        folders = [folder for day in days for folder in kept.get(names[day], [])]
        if folders:
            parts.append(versions.read(GRAIN, _grain_schema(), folders))
        if unkept:
            parts.append(view_grain(events_of_dates(unkept)))
        whole = merged_grain(*parts) if landed or len(parts) > 1 else delta
        keyed = (hash_keyed_grain if hash_keys else keyed_grain)(whole, staging)
        return keyed, all_members(keyed, KINDS)

    options = _Options(warehouse, False, strict, None, hash_keys,
                       batch_id or f"{stream}-{batch}", lambda step: None, (stream, batch), True,
                       sketches=sketches, agent_rules=agent_rules)
    return _until_committed(events, take, options)


@dataclass(frozen=True)
class _Options:
    warehouse: str
    replace: bool
    strict: bool
    url_limit: int | None
    hash_keys: bool
    batch_id: str
    before: Callable[[str], None]
    batch: tuple[str, int] | None = None
    keep_grain: bool = False
    bucket_members: int = MEMBERS
    sketches: bool = False
    agent_rules: Sequence[Rule] = RULES


def _until_committed(events: DataFrame, take, options: _Options) -> StarRun:
    """Build on the last version; again on a newer one if another run was faster."""
    versions = Versions(events.sparkSession, options.warehouse)
    for _ in range(ATTEMPTS - 1):
        with contextlib.suppress(Conflict):
            return _build(events, take, options, versions)
    return _build(events, take, options, versions)


def _build(events: DataFrame, take, options: _Options, versions: Versions) -> StarRun:
    run, warehouse = StarRun(), options.warehouse
    batch_id, hash_keys, replace = options.batch_id, options.hash_keys, options.replace
    base = versions.latest()
    ledger = base.ledger if base else {}
    if options.batch and ledger.get("batches", {}).get(options.batch[0], -1) >= options.batch[1]:
        return run
    if base and not replace:
        _same_sort_of_keys(base, hash_keys)
    started, name_of_run = [], new_run()
    # What needs no other step is done beside them, so short jobs do not leave the cluster idle.
    with (Staging(events.sparkSession) as staging,
          _dropped_on_failure(versions, name_of_run, started), ThreadPoolExecutor(2) as beside):
        options.before("grain")
        grain, members = take(staging, base)
        undated = grain.filter(F.col("date").isNull())
        groups = grain.agg(F.count("*").alias("all"),
                           F.count_if(F.col("date").isNull()).alias("undated")).first()
        if not groups["all"] and events.isEmpty():
            return run
        run.rejected[UNDATED] = groups["undated"]
        if run.rejected[UNDATED]:
            write_rejected(undated.select(*NATURAL_KEYS, "views", F.array(
                F.lit("local_time: no valid date")).alias("violations")),
                warehouse, UNDATED, batch_id)
        agents = beside.submit(_agents, events, staging, options.agent_rules)
        grain = grain.filter(F.col("date").isNotNull())
        if hash_keys:
            fail_on_any(duplicate_keys(grain.select("fact_key"), ["fact_key"]),
                        "fact hash key collision")

        def write_kept() -> None:
            options.before(GRAIN)
            started.append(GRAIN)
            write_grain(grain.withColumn("date_key", date_key("date")).select(
                "date_key", *_grain_schema().names), warehouse, name_of_run, not hash_keys)

        kept = beside.submit(write_kept) if options.keep_grain else None
        options.before("members")
        known = None
        if base and not replace:
            members = staging.table(members, "members")
            known = staging.table(_known(members, warehouse, base), "known")
            # What the fact will point to: one key per member and one member per key.
            fail_on_any(reduce(DataFrame.unionByName, [
                duplicate_keys(known.select("kind", F.lit(name).alias("column"), F.col(
                    name).cast("string").alias("value")), ["kind", "column", "value"])
                for name in ("member", "key")]), "stored twice")
            members = members.join(known, ["kind", "member"], "left_anti")
        highest = {}
        if hash_keys:
            new = _hashed(members, warehouse, None if replace else base, staging)
        else:
            new = number_groups(members, "kind", KINDS, "member", "_number", staging)
            if known is not None:
                highest = ledger["highest"]
        frames = _dimension_frames(new, highest, agents.result())

        checked = {name: _checked(df, name, options.url_limit) for name, df in frames.items()}
        kinds = dict(zip(frames, KINDS))
        tables = {name: [] if replace or not base else list(base.folders(name))
                  for name in TABLES}

        def write(name: str) -> None:
            if base and not replace and new[kinds[name]].count == 0:
                # No new member: not even an empty file.
                run.written[name] = run.rejected[name] = 0
                return
            options.before(name)
            started.append(name)
            run.written[name], run.rejected[name] = write_dimension(
                checked[name], warehouse, name, name_of_run, options.strict,
                1 if name == "dim_date" else bucket_count(
                    new[kinds[name]].count, options.bucket_members))
            tables[name].append(f"{name}/run={name_of_run}")
            if run.rejected[name]:
                write_rejected(checked[name], warehouse, name, batch_id)

        # Independent writes: small dimensions do not leave the cluster idle one by one.
        with ThreadPoolExecutor(len(frames)) as pool:
            list(pool.map(write, frames))

        # A rejected member is a key without a match, so groups may fall together.
        complete = not any(run.rejected[name] for name in frames)
        # Rows of a dense grain lie by date, and only a lookup by shuffle moves them.
        gathered = False
        if hash_keys and complete:
            fact = fact_from_hash_keys(grain)
        else:
            dims, sizes = _members_of_run(checked, known), _sizes(new, known)
            fact = (fact_from_grain if complete else fact_by_lookup)(grain, dims, sizes)
            gathered = (not hash_keys and complete
                        and max(sizes.values()) <= BROADCAST_BYTES)
        views = _checked(fact.withColumn("batch_id", F.lit(batch_id)), FACT)

        options.before(FACT)
        started.append(FACT)
        run.written[FACT], run.rejected[FACT] = write_fact(
            views, warehouse, name_of_run, options.strict, gathered)
        if run.rejected[FACT]:
            write_rejected(views, warehouse, FACT, batch_id)
        if kept:
            kept.result()
        if options.sketches:
            options.before(SKETCHES)
            started.append(SKETCHES)
            # From what was written: the rows that hold, without the work that made them.
            write_sketches(versions.read(
                FACT, TABLES[FACT].struct(), versions.written(FACT, name_of_run)),
                warehouse, name_of_run)
        # Every group of the grain is a row of the fact, but for those set aside.
        days = {partition_value(folder) for folder in versions.written(FACT, name_of_run)}
        if run.rejected[FACT]:
            days |= {date_name(row.date)
                     for row in grain.select("date").distinct().collect()}
        for name in (FACT, GRAIN, SKETCHES):
            old = {} if replace or not base else base.partitions(name)
            tables[name] = [folder for day, folders in old.items() for folder in folders
                            if day not in days] + versions.written(name, name_of_run)
        options.before("commit")
        versions.commit(base, tables, [], _ledger(ledger, options, highest, new))
    return run


@contextlib.contextmanager
def _dropped_on_failure(versions: Versions, run: str, started: list[str]):
    try:
        yield
    except BaseException:
        versions.drop_run(run, started)
        raise


def _ledger(old: dict, options: _Options, highest: dict[str, int], new: dict[str, Group]) -> dict:
    batches = dict(old.get("batches", {}))
    if options.batch:
        batches[options.batch[0]] = options.batch[1]
    return {"hash_keys": options.hash_keys, "batches": batches, "highest": {
        table: highest.get(table, 0) + new[natural].count
        for natural, (table, _) in NATURAL_KEYS.items()}}


def date_name(day: datetime.date) -> str:
    """A date as its folder names it: the date key."""
    return f"{day.year}{day.month:02d}{day.day:02d}"


def _grain_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "date date, " + ", ".join(f"{name} string" for name in NATURAL_KEYS)
        + ", views long, first_view_time timestamp_ntz, last_view_time timestamp_ntz, "
        "timed_views long, seconds long")


def _same_sort_of_keys(base: Version, hash_keys: bool) -> None:
    """Fail if the stored dimensions hold the other sort of keys."""
    if base.ledger["hash_keys"] != hash_keys:
        raise ConstraintViolation("the warehouse holds " + (
            "hash keys" if base.ledger["hash_keys"] else "dense keys, not hash keys"))


def _grain_and_members(events: DataFrame, staging: Staging, latest_only: bool,
                       today: Column | None, stored: Callable[[DataFrame], DataFrame],
                       day: datetime.date | None = None) -> tuple[DataFrame, DataFrame]:
    """The stored grain of the fact, and the members of all dimensions, dates included."""
    if latest_only:
        dated = events.select(event_date("local_time").alias(DATE_KIND), *NATURAL_KEYS)
        return stored(on_report_date(events, today, day)), all_members(dated, KINDS)
    grain = stored(events)
    return grain, all_members(grain, KINDS)


def _agents(events: DataFrame, staging: Staging, rules: Sequence[Rule] = RULES
            ) -> DataFrame | None:
    """The families of the user agent each device sent last, where events carry one.

    A read of its own: only events with an agent are looked at, and the grain stays an
    aggregate of plain numbers.
    """
    if "user_agent" not in events.columns:
        return None
    return device_families(events.filter(F.col("user_agent").isNotNull()), staging, rules)


def _hashed(members: DataFrame, warehouse: str, base: Version | None, staging: Staging
            ) -> dict[str, Group]:
    """New members with hash keys, after a look for keys that two members share.

    The new ones are compared among themselves, and the stored keys with the new ones, whose
    stored table is small for a small run; stored members are not grouped again.
    """
    spark = members.sparkSession
    keyed = staging.table(members.withColumn("_number", hash_key("member")), "hashed")
    fresh = keyed.filter(F.col("kind") != DATE_KIND).select("kind", "_number")
    fail_on_any(duplicate_keys(fresh, ["kind", "_number"]), "hash key collision")
    if base:
        # Equal hash keys are in one bucket, so the others need no look.
        buckets = touched(keyed.filter(F.col("kind") != DATE_KIND), "kind", "member")
        stored = reduce(DataFrame.unionByName, [
            read_members(spark, warehouse, table, base, buckets.get(natural, ())).select(
                F.lit(natural).alias("kind"), F.col(key).alias("_number"))
            for natural, (table, key) in NATURAL_KEYS.items()])
        fail_on_any(stored.join(fresh, ["kind", "_number"], "left_semi"),
                    "hash key collision")
    sizes = _group_sizes(keyed)
    return {kind: Group(keyed.filter(F.col("kind") == kind).drop("kind"),
                        *sizes.get(kind, (0, 0))) for kind in KINDS}


def _dimension_frames(keyed: dict[str, Group], highest: dict[str, int],
                      agents: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five dimensions from numbered members, numbers going on from the stored keys."""
    dates = keyed[DATE_KIND].rows.select(F.col("member").cast("date").alias("date"))
    frames = {"dim_date": dim_date(dates)}
    for natural, (table, key) in NATURAL_KEYS.items():
        number = F.col("_number") + F.lit(highest.get(table, 0))
        rows = keyed[natural].rows.select(F.col("member").alias(natural), number.alias(key))
        if natural == "device_id" and agents is not None:
            rows = rows.join(agents, "device_id", "left")
        frames[table] = COLUMNS[natural](rows)
    return frames


def _group_sizes(members: DataFrame) -> dict[str, tuple[int, int]]:
    """Rows and bytes of text per kind: one row each."""
    return {row[0]: (row[1], row[2]) for row in members.groupBy("kind").agg(
        F.count("*"), F.sum(F.octet_length("member"))).collect()}


def _sizes(keyed: dict[str, Group], known: DataFrame | None = None) -> dict[str, int]:
    """Broadcast sizes of the member dimensions of a run, from counts already taken."""
    old = {} if known is None else _group_sizes(known)
    sizes = {}
    for natural, (table, _) in NATURAL_KEYS.items():
        rows, text = old.get(natural, (0, 0))
        sizes[table] = broadcast_size(keyed[natural].count + rows,
                                      keyed[natural].text_bytes + text)
    return sizes


def _known(members: DataFrame, warehouse: str, base: Version) -> DataFrame:
    """The members of this run that the warehouse holds, with their keys.

    ``members`` is a stored table, so Catalyst knows its size: a small run is broadcast to
    the scan of the stored dimensions, and everything after it is as small as the run. Only
    the buckets that members of the run can be in are opened.
    """
    spark = members.sparkSession
    buckets = touched(members.filter(F.col("kind") != DATE_KIND), "kind", "member")
    stored = [read_table(spark, warehouse, "dim_date", base).select(
        F.lit(DATE_KIND).alias("kind"), F.col("date").cast("string").alias("member"),
        F.col("date_key").cast("bigint").alias("key"))]
    for natural, (table, key) in NATURAL_KEYS.items():
        stored.append(read_members(
            spark, warehouse, table, base, buckets.get(natural, ())).select(
            F.lit(natural).alias("kind"), F.col(natural).alias("member"),
            F.col(key).alias("key")))
    return reduce(DataFrame.unionByName, stored).join(members, ["kind", "member"])


def _members_of_run(checked: dict[str, DataFrame], known: DataFrame | None
                    ) -> dict[str, DataFrame]:
    """Natural and surrogate keys of the members in this run: new ones kept, and known ones."""
    kept = {name: df.filter(F.size("violations") == 0) for name, df in checked.items()}
    dims = {"dim_date": kept["dim_date"].select("date", "date_key")}
    for natural, (table, key) in NATURAL_KEYS.items():
        dims[table] = kept[table].select(natural, key)
    if known is None:
        return dims

    def of(kind: str, natural: Column, key: Column) -> DataFrame:
        return known.filter(F.col("kind") == kind).select(natural, key)

    member, key = F.col("member"), F.col("key")
    dims["dim_date"] = dims["dim_date"].union(
        of(DATE_KIND, member.cast("date"), key.cast("int")))
    for natural, (table, _) in NATURAL_KEYS.items():
        dims[table] = dims[table].union(of(natural, member, key))
    return dims


def _checked(df: DataFrame, name: str, url_limit: int | None = None) -> DataFrame:
    found = violations(df, TABLES[name])
    if name == "dim_referrer" and url_limit is not None:
        long = F.when(too_long("referrer_url", url_limit), "referrer_url: over the limit")
        found = F.array_compact(F.array_append(found, long))
    return df.withColumn("violations", found)
