"""Token ids in a grammar-compressed binary format (Re-Pair), written and read by Spark.

Texts are encoded in ascending order of their id, each ends with an end id, and the ids are
written in blocks of whole documents. In a block, frequent pairs of neighbouring symbols are
replaced by nonterminals, round after round until none is left, the more frequent pair first
where two overlap; pairs never cross a document's end. A block stores its rules, the length each nonterminal
expands to, the remaining symbols and each document's first symbol, so that any document, and
any stretch of one (``Block.slice``), is decoded without the rest.

The files are Parquet tables of blocks (columns shard, block, before, n_tokens, doc_ids,
payload). Spark's writer commits them, so a lost executor leaves no half file; no task holds more
than one block. Range partitions follow the ids, so shards and blocks are in order too.

Payload, little-endian: magic ``VSG1``, then five unsigned 32-bit counts (vocabulary, rules,
symbols, documents, ids), then left and right symbol and expansion length of each rule, each
document's first symbol and first id (unsigned 32-bit each), then the symbols as three planes
of bytes, lowest first.

Defined cases: a null or empty text is its end id alone; rows with equal ids follow each other
in the order of their texts; null ids come first; an empty table gives no block and no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from viewstar.llm.bpe import encoder
from viewstar.llm.text import row_chunks

END_ID = 2
VOCABULARY = 50257
BLOCK_BYTES = 2 << 20
#: Pairs beyond that wait for the next round.
RULES_PER_ROUND = 1 << 14
#: A rule takes three numbers in the file, so a rarer pair would not pay.
MIN_COUNT = 4

#: Blocks whose symbols take three bytes, and four.
MAGIC, WIDE = b"VSG1", b"VSG2"
BLOCKS = ("shard string, block int, before long, n_tokens long, doc_ids array<long>, "
          "payload binary")
_SLOTS = 20
#: So few pairs are sorted without a look at their slots.
_FEW = 1 << 16


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)


def _frequent(keys: np.ndarray, slots: np.ndarray):
    """The pairs worth a rule, most frequent first, and the keys that may belong to one.

    Slots with few pairs are left out before the rest is sorted and counted exactly.
    """
    if len(keys) > _FEW:
        held = np.bincount(slots, minlength=1 << _SLOTS) >= MIN_COUNT
        maybe = np.flatnonzero(held[slots])
        ordered = np.sort(keys[maybe])
    else:
        maybe, ordered = slice(None), np.sort(keys)
    if not len(ordered):
        return ordered, maybe
    edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    counts = np.diff(np.append(edges, len(ordered)))
    some = np.flatnonzero(counts >= MIN_COUNT)
    best = some[np.argsort(-counts[some], kind="stable")[:RULES_PER_ROUND]]
    return ordered[edges[best]], maybe


def compress(ids: np.ndarray, first: np.ndarray, vocabulary: int = VOCABULARY):
    """(left, right) of all rules, the symbols left, and each document's first symbol.

    Rounds go on until no pair is frequent. A pair can only be frequent if it was in the round
    before or holds a symbol made there, so later rounds look at those places alone.
    """
    symbols = ids.astype(np.uint32)
    head = np.zeros(len(ids), bool)
    head[first[:-1]] = True
    # Places whose pair (with the next symbol) may be frequent; table: rank of a slot's pair.
    live = np.flatnonzero(~head[1:])
    table = np.full(1 << _SLOTS, -1, np.int32)
    # Rank of the pair at each place, twice as much; none elsewhere. Place p stands at p + 1, so
    # that both ends have a neighbour.
    none = np.iinfo(np.int32).max
    order = np.full(len(symbols) + 2, none, np.int32)
    lefts, rights, known = [], [], 0
    while len(live):
        keys = (symbols[live].astype(np.uint64) << np.uint64(32)) | symbols[live + 1]
        slots = _slots(keys)
        pairs, maybe = _frequent(keys, slots)
        if not len(pairs):
            break
        live, keys, slots = live[maybe], keys[maybe], slots[maybe]
        # Of pairs in one slot the most frequent is replaced now, the others in later rounds.
        own_slots = _slots(pairs)
        table[own_slots[::-1]] = np.arange(len(pairs))[::-1]
        rank = table[slots]
        table[own_slots] = -1
        hit = (rank >= 0) & (pairs[rank] == keys)
        places, rank = live[hit], rank[hit]
        # Of overlapping pairs the more frequent wins; in a run of one symbol, every other.
        order[places + 1] = rank * 2
        follows = np.flatnonzero(order[places] == order[places + 1])
        if len(follows):
            number = np.arange(len(follows))
            begins = np.append(True, follows[1:] != follows[:-1] + 1)
            run = number - np.maximum.accumulate(np.where(begins, number, 0)) + 1
            order[places[follows] + 1] += (run & 1).astype(np.int32)
        own = order[places + 1]
        chosen = (own < order[places]) & (own < order[places + 2])
        order[places + 1] = none
        places, rank = places[chosen], rank[chosen]
        # The most frequent pair has two places at least, so each round gets further.
        used = np.bincount(rank, minlength=len(pairs)) >= 2
        stay = used[rank]
        places, rank = places[stay], rank[stay]
        fresh = np.cumsum(used) - 1 + vocabulary + known
        lefts.append((pairs[used] >> np.uint64(32)).astype(np.int64))
        rights.append((pairs[used] & np.uint64(0xFFFFFFFF)).astype(np.int64))
        known += int(used.sum())
        symbols[places] = fresh[rank]
        look = np.zeros(len(symbols) + 1, bool)
        look[live] = True
        look[places] = True
        kept = np.ones(len(symbols), bool)
        kept[places + 1] = False
        made = places - np.arange(len(places))
        symbols, head, look = symbols[kept], head[kept], look[:-1][kept]
        look[made[made > 0] - 1] = True
        look[:-1] &= ~head[1:]
        live = np.flatnonzero(look[:-1])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(lefts) if lefts else empty,
            np.concatenate(rights) if rights else empty, symbols.astype(np.int64),
            np.flatnonzero(head))


def _expansion_lengths(left: np.ndarray, right: np.ndarray, vocabulary: int) -> np.ndarray:
    """Ids that each symbol stands for; a rule only uses symbols before it."""
    lengths = np.ones(vocabulary + len(left), np.int64)
    done = 0
    while done < len(left):
        # Rules up to the first that uses one of this stretch can be done together.
        late = np.flatnonzero(np.maximum(left[done:], right[done:]) >= vocabulary + done)
        end = done + (int(late[0]) if len(late) else len(left) - done)
        lengths[vocabulary + done:vocabulary + end] = (
            lengths[left[done:end]] + lengths[right[done:end]])
        done = end
    return lengths


def pack(ids: np.ndarray, first: np.ndarray, vocabulary: int = VOCABULARY) -> bytes:
    left, right, symbols, heads = compress(ids, first, vocabulary)
    lengths = _expansion_lengths(left, right, vocabulary)[vocabulary:]
    numbers = np.array([vocabulary, len(left), len(symbols), len(heads), len(ids)], "<u4")
    # Three bytes a symbol, four where one block has so many rules.
    wide = vocabulary + len(left) > 1 << 24
    planes = symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :4 if wide else 3].T
    return b"".join([WIDE if wide else MAGIC, numbers.tobytes(), *[
        part.astype("<u4").tobytes() for part in (left, right, lengths, heads, first[:-1])],
        np.ascontiguousarray(planes).tobytes()])


class Block:
    """A payload opened for reading."""

    def __init__(self, payload: bytes):
        if payload[:4] not in (MAGIC, WIDE):
            raise ValueError("not a block of grammar-compressed ids")
        self.vocabulary, rules, symbols, documents, self.n_tokens = np.frombuffer(
            payload, "<u4", 5, 4).tolist()
        body = np.frombuffer(payload, "<u4", 3 * rules + 2 * documents, 24).astype(np.int64)
        self.left, self.right, self.lengths, self.heads, self.first = np.split(
            body, [rules, 2 * rules, 3 * rules, 3 * rules + documents])
        bytes_ = 4 if payload[:4] == WIDE else 3
        planes = np.frombuffer(payload, np.uint8, bytes_ * symbols, 24 + 4 * len(body))
        wide = np.zeros((symbols, 4), np.uint8)
        wide[:, :bytes_] = planes.reshape(bytes_, symbols).T
        self.symbols = wide.reshape(-1).view("<u4").astype(np.int64)
        self._every = np.concatenate((np.ones(self.vocabulary, np.int64), self.lengths))

    def __len__(self) -> int:
        return len(self.heads)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Replace nonterminals by their pairs until only ids are left."""
        lengths = self._every[symbols]
        places = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), np.uint32)
        while len(symbols):
            open_ = symbols >= self.vocabulary
            out[places[~open_]] = symbols[~open_]
            rules, places = symbols[open_] - self.vocabulary, places[open_]
            left, right = self.left[rules], self.right[rules]
            places = np.concatenate((places, places + self._every[left]))
            symbols = np.concatenate((left, right))
        return out

    def documents(self) -> Iterator[np.ndarray]:
        ids = self.expand(self.symbols)
        yield from np.split(ids, self.first[1:]) if len(self) else ()

    def slice(self, document: int, start: int, end: int) -> np.ndarray:
        """Ids start … end of one document; only the symbols that hold them are expanded."""
        last = self.heads[document + 1] if document + 1 < len(self) else len(self.symbols)
        symbols = self.symbols[self.heads[document]:last]
        after = np.cumsum(self._every[symbols])
        low = int(np.searchsorted(after, start, side="right"))
        high = int(np.searchsorted(after, end, side="left")) + 1
        skipped = int(after[low - 1]) if low else 0
        return self.expand(symbols[low:high])[start - skipped:max(start, end) - skipped]


def _with_end(ids: np.ndarray, first: np.ndarray, end_id: int):
    """Append the end id to each document."""
    out = np.full(len(ids) + len(first) - 1, end_id, np.uint32)
    lengths = np.diff(first)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)] = ids
    return out, first + np.arange(len(first))


def _encode(path: str, end_id: int, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = f"{TaskContext.get().partitionId():09d}"
        block = before = 0
        last = None
        for batch, file, row in _file_runs(batches):
            if file is not None:
                if last is None or last[0] != file or last[1] != row:
                    # Files are cut and dealt to tasks in any order; names and rows tell theirs.
                    shard, block, before = f"{file}#{row:019d}", 0, 0
                last = (file, row + len(batch))
            for start, end in row_chunks(batch.column("text"), BLOCK_BYTES):
                rows = batch.slice(start, end - start)
                ids, first = _with_end(*encoder(path).encode(rows.column("text")), end_id)
                yield pa.record_batch({
                    "shard": pa.array([shard], pa.string()),
                    "block": pa.array([block], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "n_tokens": pa.array([len(ids)], pa.int64()),
                    "doc_ids": pa.array([rows.column("doc_id").to_pylist()],
                                        pa.list_(pa.int64())),
                    "payload": pa.array([pack(ids, first, vocabulary)], pa.binary())})
                block, before = block + 1, before + len(ids)
    return run


def _file_runs(batches: Iterator[pa.RecordBatch]):
    """(rows, file, row of the first in it) for rows that follow each other in one file; no
    file for rows that do not say where they come from."""
    for batch in batches:
        if "file" not in batch.schema.names:
            yield batch, None, 0
            continue
        rows = batch.column("row").to_numpy()
        files = batch.column("file").dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((files[1:] != files[:-1]) | (rows[1:] != rows[:-1] + 1)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
            if end > start:
                yield (batch.slice(start, end - start), batch.column("file")[start].as_py(),
                       int(rows[start]))


def _in_files(docs: DataFrame) -> DataFrame | None:
    """``docs`` with the file and the row each comes from; None if it is not read from files."""
    try:
        return docs.select(F.col("doc_id").cast("long"), "text",
                           F.col("_metadata.file_name").alias("file"),
                           F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return None


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
              vocabulary: int = VOCABULARY, in_file_order: bool = False) -> None:
    """Encode ``docs`` in ascending order of doc_id and write the blocks to ``path``.

    ``in_file_order`` keeps the order of the files that ``docs`` is read from, by name, and of
    the rows in them, such as a stage before has written it; no row moves.
    """
    ordered = _in_files(docs) if in_file_order else None
    if ordered is None:
        ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(
            "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_encode(tokenizer, end_id, vocabulary), BLOCKS).write.option(
        "compression", "zstd").parquet(path)


DOCUMENTS = "doc_id long, shard string, place long, n_tokens long, ids_crc32 long"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            block = Block(batch.column("payload")[row].as_py())
            documents = list(block.documents())
            yield pa.record_batch({
                "doc_id": batch.column("doc_ids")[row].values,
                "shard": pa.array([batch.column("shard")[row].as_py()] * len(block), pa.string()),
                "place": pa.array(block.first + batch.column("before")[row].as_py(), pa.int64()),
                "n_tokens": pa.array([len(d) for d in documents], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(d.astype("<u4").tobytes())
                                       for d in documents], pa.int64())})


def open_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def read_documents(blocks: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    A block knows the ids before it in its shard, so only the shards' totals are summed: one
    row per range partition or part of a file, whatever the number of documents.
    """
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    found = blocks.select("shard", "before", "doc_ids", "payload").mapInArrow(_decode, DOCUMENTS)
    return found.join(F.broadcast(totals), "shard").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
