"""Best-fit packing of documents' tokens into sequences, in a tree of rounds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.llm.tables import written
from cartstream.llm.text import slices
from cartstream.llm.tokens import tokenizer

# Items that one task packs.
ITEMS_PER_TASK = 50_000

# Bytes of text that are encoded together: a worker also holds the tokenizer and the
# pieces it knows, so its arrays are kept small.
ENCODED_BYTES = 1 << 20

# A sequence with no more room than this is nearly full and leaves the tree.
SLACK = 4

PIECE = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, item long"
)


def _piece_maker(path: str, capacity: int, end_id: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        item = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", limit=ENCODED_BYTES):
                ids, bounds = model.encode(part.column("text"))
                # Each text's ids and its end id, end to end.
                all_ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                lengths = np.diff(bounds)
                n_pieces = -(-lengths // capacity)
                owner = np.repeat(np.arange(len(lengths)), n_pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                # The first piece takes what full pieces leave.
                first = lengths - (n_pieces - 1) * capacity
                start = np.where(number == 0, 0, first[owner] + (number - 1) * capacity)
                length = np.where(number == 0, first[owner], capacity)
                at = bounds[:-1][owner] + start
                raw = memoryview(all_ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at + length, strict=True)]
                yield pa.record_batch(
                    [
                        part.column("doc_id").take(pa.array(owner)).cast(pa.int64()),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(item + np.arange(len(owner)), pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "item"],
                )
                item += len(owner)

    return pieces


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each item its bin, the place in it, and how full that bin gets.

    Largest first, each into the fullest bin that has room. Bit r of `rooms`
    says that some bin has room r, so the best fit is one bit operation away.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, places = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    used: list[int] = []
    rooms = 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = waiting[room].pop()
            if not waiting[room]:
                rooms &= ~(1 << room)
        else:
            b = len(used)
            used.append(0)
        bins[i], places[i] = b, used[b]
        used[b] += size
        room = capacity - used[b]
        if room:
            waiting[room].append(b)
            rooms |= 1 << room
    return bins, places, np.array(used, np.int64)


def _packer(capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column("item").to_numpy(), b.column("size").to_numpy()) for b in batches]
        if not rows:
            return
        items, sizes = (np.concatenate(x) for x in zip(*rows, strict=True))
        order = np.argsort(items)  # rows arrive in any order
        items, sizes = items[order], sizes[order]
        bins, places, used = best_fit(sizes, capacity)
        # A bin is named after the item at its start.
        names = np.empty(len(used), np.int64)
        names[bins[places == 0]] = items[places == 0]
        yield pa.record_batch(
            [pa.array(items), pa.array(names[bins]), pa.array(places), pa.array(used[bins])],
            ["item", "bin", "place", "used"],
        )

    return pack


def pack_items(items: DataFrame, capacity: int) -> DataFrame:
    """(item, sequence, offset) for `items` of (item, size), sizes 1 to `capacity`.

    Each round deals its items to tasks of about ITEMS_PER_TASK, which pack
    their own by best fit. Sequences with at most SLACK room are done; the
    others are the items of the next round, dealt anew, without those that not
    even the smallest fits. So each round can join some, and the last one leaves
    no two open sequences that fit together. A task's memory is set by ITEMS_PER_TASK. Which
    sequence an item gets does not depend on the order in which rows arrive.
    """
    rounds: list[DataFrame] = []
    n = items.count()
    while n:
        tasks = ceil(n / ITEMS_PER_TASK)
        packed = written(
            items.repartition(tasks, F.xxhash64("item", F.lit(len(rounds)))).mapInArrow(
                _packer(capacity), "item long, bin long, place long, used long"
            ),
            f"packed-{len(rounds)}",
        )
        rounds.append(packed)
        items = packed.where(f"place = 0 and used < {capacity - SLACK}").select(
            F.col("bin").alias("item"), F.col("used").alias("size")
        )
        n = 0
        if tasks > 1:
            least = [row["size"] for row in items.orderBy("size").limit(2).collect()]
            if len(least) == 2 and sum(least) <= capacity:
                items = items.where(F.col("size") <= capacity - least[0])
                n = items.count()
    if not rounds:
        return items.select("item", F.col("item").alias("sequence"), F.lit(0).cast("long").alias("offset"))
    result = rounds[0].select("item", F.col("bin").alias("sequence"), F.col("place").alias("offset"))
    for later in rounds[1:]:
        moved = later.select(F.col("item").alias("sequence"), "bin", "place")
        result = result.join(moved, "sequence", "left").select(
            "item",
            F.coalesce("bin", "sequence").alias("sequence"),
            (F.col("offset") + F.coalesce("place", F.lit(0))).alias("offset"),
        )
    return result


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and `end_id`, so an empty or null text is one
    token long. Longer documents than `capacity` are cut into pieces of that
    length, the first taking the rest; no other is cut. Full pieces are
    sequences of their own, the others are packed by `pack_items`. Repeated rows
    are packed like any other; an empty table gives no rows; other columns are
    not read. doc_id is taken as a whole number and may be null.
    """
    pieces = written(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
        ).mapInArrow(_piece_maker(path, capacity, end_id), PIECE),
        "pieces",
    )
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    packed = pack_items(rest.select("item", F.col("length").alias("size")), capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return (
        full.withColumn("sequence_id", F.col("item"))
        .withColumn("offset", F.lit(0).cast("long"))
        .select(columns)
        .unionByName(
            rest.join(packed.withColumnRenamed("sequence", "sequence_id"), "item").select(columns)
        )
    )
