"""Topic to landing table: documents, raw text and rejected messages, by date."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from viewstar.functions.documents import DOCUMENT, ERROR, RAW
from viewstar.operators.ingest import before, landed, last_offsets, span, unread, up_to
from viewstar.operators.schemas import key_types, merged, observed_schema
from viewstar.sources.landing import TABLE, landed_rows
from viewstar.staging import Staging
from viewstar.streaming.bridge import run_name
from viewstar.streaming.outcomes import count_routes, observed
from viewstar.versions import Conflict, Version, Versions, new_run, partition_value

#: A date in more folders than this is rewritten by ``compact``.
FOLDERS_PER_DATE = 8


def start_landing(messages: DataFrame, path: str, checkpoint: str,
                  trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start appending envelopes to the landing table.

    Each batch is one version of the table, whose ledger names the batch, so every message
    lands exactly once across restarts. Rejected messages land too, under their route, so nothing
    is lost. Inside ``counted`` the totals per route are kept.
    """
    run = run_name(messages.sparkSession, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        append(batch, path, {"batches": {run: batch_id}})

    return (
        count_routes(landed(messages)).writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def by_date(rows: DataFrame) -> DataFrame:
    """Rows of a date meet; many small ones share a task, a hot one is split to the advised
    size, so tasks and files of a date grow with its rows and with nothing else."""
    return rows.hint("rebalance", "event_date")


class _Run:
    """Rows on their way to the table: written in one part or two, then seen all at once."""

    def __init__(self, versions: Versions):
        self.versions, self.name = versions, new_run()
        self.messages, self.keys = Counter(), {}

    def write(self, rows: DataFrame) -> dict:
        """Write landing rows, and say how many they are per route and the last offset. The keys
        of the documents and their types are seen on the way."""
        seen = Observation("land")
        counts = [F.expr(f"count_if(route = '{name}') AS {name}")
                  for name in (DOCUMENT, RAW, ERROR)]
        documents = F.expr(f"CASE WHEN route = '{DOCUMENT}' THEN document END")
        rows = rows.observe(seen, F.expr("count(1) AS messages"), F.expr("max(offset) AS last"),
                            *counts, observed_schema(documents).alias("schema"))
        # Nobody looks for the mark of a finished write: a version names the folders.
        by_date(rows).write.mode("append").option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(
            "event_date").parquet(f"{self.versions.root}/{TABLE}/run={self.name}")
        part = dict.fromkeys(("messages", DOCUMENT, RAW, ERROR), 0) | observed(seen)
        self.keys = merged(self.keys, key_types(part.pop("schema", None)))
        self.messages.update({name: part[name] for name in part if name != "last"})
        return part

    def commit(self, ledger: Mapping[str, dict]) -> None:
        """Show the rows, with entries of the ledger; drop them if a batch is held already."""
        def change(base: Version | None):
            if taken(base, ledger):
                return None
            old = base.ledger if base else {}
            held = old.get("positions", {})
            for name, (start, _) in ledger.get("positions", {}).items():
                if held.get(name) != start:
                    raise Conflict(f"the position of {name} was moved by another run")
            entries = {"keys": merged(old.get("keys", {}), self.keys),
                       "batches": old.get("batches", {}) | ledger.get("batches", {}),
                       "positions": held | {name: end for name, (_, end) in ledger.get(
                           "positions", {}).items()}}
            written = self.versions.written(TABLE, self.name)
            return {TABLE: (base.tables.get(TABLE, []) if base else []) + written}, written, entries

        if self.versions.commit_with(change) is None:
            self.drop()

    def drop(self) -> None:
        self.versions.drop_run(self.name, [TABLE])
        self.messages, self.keys = Counter(), {}

    def __enter__(self) -> "_Run":
        return self

    def __exit__(self, error, *_) -> None:
        if error is not None:
            self.drop()


def taken(base: Version | None, ledger: Mapping[str, dict]) -> bool:
    """Whether a version holds a batch that the ledger's entries name."""
    known = base.ledger.get("batches", {}) if base else {}
    return any(known.get(name, -1) >= batch
               for name, batch in ledger.get("batches", {}).items())


def append(rows: DataFrame, path: str, ledger: Mapping[str, dict] | None = None) -> dict[str, int]:
    """Add landing rows as one version, with entries of its ledger; returns messages per route.

    A batch that the ledger holds already is left out. Rows are written before they are
    committed, and additions do not disturb each other: losing to another run costs no
    second write. The keys of the documents and their types go to the registry in the ledger
    (``operators.schemas``), as seen while the rows are written.
    """
    versions, ledger = Versions(rows.sparkSession, path), ledger or {}
    if ledger.get("batches") and taken(versions.latest(), ledger):
        return {}
    with _Run(versions) as run:
        run.write(rows)
        run.commit(ledger)
    return dict(run.messages)


def land_batch(messages: DataFrame, path: str,
               ledger: Mapping[str, dict] | None = None) -> dict[str, int]:
    """Append a bounded read of envelopes to a landing table; returns messages per route."""
    return append(landed(messages), path, ledger)


#: A run of so many messages is a short one, whose time is that of its jobs and not of its rows.
SHORT = 1 << 16
#: The landing rows of sources that short runs read, so that each run only asks for other bounds.
#: They come in as many tasks as there are cores, as a run's rows lie in few parts of a source.
_short: WeakKeyDictionary[DataFrame, DataFrame] = WeakKeyDictionary()


def _short_rows(envelope: DataFrame) -> DataFrame:
    if envelope not in _short:
        cores = envelope.sparkSession.sparkContext.defaultParallelism
        _short[envelope] = landed(envelope.coalesce(cores))
    return _short[envelope]


def _next_span(versions: Versions, base: Version | None, envelope: DataFrame, at_most: int,
               start: Mapping[int, int]) -> tuple[str, int, str, int] | None:
    """The partition that short runs are in, with its name and the next offset; None if there is
    none, if messages came before it, or if its offsets have gaps, as the last run tells."""
    held = base.ledger.get("positions", {}) if base else {}
    if not held or not 0 < at_most <= SHORT:
        return None
    topic, partition = max((topic, int(partition)) for topic, _, partition in (
        name.rpartition("/") for name in held))
    name = f"{topic}/{partition}"
    last = versions.before(base)
    if held[name] - (last.ledger.get("positions", {}) if last else {}).get(name, 0) > at_most:
        return None
    if not unread(before(envelope, topic, partition), held, start).isEmpty():
        return None
    return topic, partition, name, max(held[name], start.get(partition, 0))


def land_next(envelope: DataFrame, path: str, at_most: int,
              start: Mapping[int, int] | None = None) -> dict[str, int]:
    """Land the next ``at_most`` messages after those the table holds; returns them per route.

    Where the read ended is committed with the rows, and the next run starts there: each message
    lands once, however often and with whatever cap this is run. ``start`` moves the position
    of partitions forward first. Two such runs at a time do not both commit.

    A short run writes the next ``at_most`` offsets of the partition that the run before ended in,
    and counts them meanwhile: without gaps that is all. Only what is missing then is looked
    for among all positions.
    """
    spark, start = envelope.sparkSession, start or {}
    versions = Versions(spark, path)
    base = versions.latest()
    held = base.ledger.get("positions", {}) if base else {}
    with _Run(versions) as run:
        ends, left = {}, at_most
        if near := _next_span(versions, base, envelope, at_most, start):
            topic, partition, name, first = near
            part = run.write(span(_short_rows(envelope), topic, partition, first, first + at_most))
            if part["messages"] > at_most:
                # Offsets that come twice.
                run.drop()
            elif part["messages"]:
                ends, left = {name: part["last"] + 1}, at_most - part["messages"]
        if left > 0:
            rows = unread(envelope, held | ends, start)
            with Staging(spark) as staging:
                # One entry per topic partition.
                last = last_offsets(rows, left, staging)
            if last:
                run.write(landed(up_to(rows, last)))
                ends |= {name: offset + 1 for name, offset in last.items()}
        if ends:
            run.commit({"positions": {name: (held.get(name), end) for name, end in ends.items()}})
        else:
            run.drop()
    return dict.fromkeys(("messages", DOCUMENT, RAW, ERROR), 0) | run.messages


def compact(spark, path: str, folders_per_date: int = FOLDERS_PER_DATE) -> list[str]:
    """Rewrite every date that is spread over many folders; returns those dates.

    Readers of older versions keep their files. Streams may append meanwhile: what they add
    stays beside the rewritten rows, and if a date was rewritten by another run, this one's
    rows are dropped. Nothing counts as added, so followers of the versions see no new rows.
    """
    versions, run = Versions(spark, path), new_run()
    base = versions.latest()
    old = [folder for folders in (base.partitions(TABLE) if base else {}).values()
           if len(folders) > folders_per_date for folder in folders]
    if not old:
        return []

    def change(current: Version):
        left = [folder for folder in current.tables[TABLE] if folder not in gone]
        if len(left) + len(gone) != len(current.tables[TABLE]):
            raise Conflict("another run has rewritten these dates")
        return {TABLE: left + versions.written(TABLE, run)}, [], None

    gone = set(old)
    try:
        by_date(landed_rows(versions, old)).write.partitionBy("event_date").parquet(
            f"{path}/{TABLE}/run={run}")
        versions.commit_with(change)
    except BaseException:
        versions.drop_run(run, [TABLE])
        raise
    return sorted({partition_value(folder) for folder in old})
