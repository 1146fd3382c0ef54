"""How filters interact: what each removes alone, after the others and in every order, from additive mask counts.

1. **Flags.** One pass over the texts gives a narrow row per document: part, a bit per failed filter, a 64-bit hash and
   the SHA-256 of the whole text. Texts never leave their task; what follows moves narrow rows only.
2. **Counting-Bloom prepass.** A hash names a segment of about ``CAPACITY`` texts and ``PROBES`` of its ``SLOTS`` counters.
   Tasks send sparse partial sketches, which merge by segment with counters that stop at two. A text one of whose
   counters is one is unique for sure. The number of segments grows with the rows, so no sketch does, and nothing is
   broadcast or collected.
3. **Exact minimum ids.** Only possible repeats go on: rows whose hash a task meets twice, and those that the sketch does
   not clear. They meet by their text's digest, pre-aggregated, so a text that a third of all rows share is a row per task.
4. **Mask counts.** Rows per part, mask and label are counted; repeats found in step 3 move from their mask to the one
   with the duplicate bit. The counts of 32 masks give all 120 orders.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import written
from souk.llm.words import constants, mixed

#: Filters by letter; bit i of a mask is the i-th. The last is set by the duplicate search.
LETTERS = "ABCDE"
#: Texts per segment of the sketch, counters per segment, and counters per text: 0.2 % of unique texts are not cleared.
CAPACITY, SLOTS, PROBES = 1 << 13, 1 << 17, 4
#: Rows that a task looks at together.
ROWS = 1 << 17
#: Fewest words, least share of distinct words and largest share of capitals (both in percent).
WORDS, DISTINCT, CAPITALS = 100, 80, 10

_NARROW = "part string, mask int, good boolean, toxic boolean, doc bigint, digest binary"


def failures(text: Column) -> list[Column]:
    """Filters A to D as conditions that are true where a text fails; the text is not null."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        n < WORDS, 100 * F.size(F.array_distinct(words)) < DISTINCT * n, 100 * capitals > CAPITALS * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def narrow(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``(part, mask, good, toxic, doc, digest, h)`` per row: a text is read once and leaves only its digest."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("text"))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failures(F.col("text")))]
    rows = rows.select(
        "doc", "part", sum(bits[1:], bits[0]).alias("mask"), F.xxhash64("text").alias("h"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
    )
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    return rows.join(known, "doc", "left").select(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "doc", "digest", "h"
    )


def _segments(h: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(h ^ np.uint64(0x5EED)) % np.uint64(segments)).astype(np.int32)


def _slots(h: np.ndarray) -> np.ndarray:
    """The counters of each hash, one row per hash; equal ones of a hash count once."""
    factors = constants(PROBES, 41)
    at = np.sort((mixed(h[:, None] * factors[None, :]) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64), axis=1)
    at[:, 1:][at[:, 1:] == at[:, :-1]] = -1
    return at


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together up to ``ROWS`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _h(table: pa.Table) -> np.ndarray:
    return table.column("h").to_numpy().view(np.uint64)


def _pack(slots: np.ndarray, counts: np.ndarray) -> bytes:
    return (slots.astype(np.uint32) * np.uint32(4) + np.minimum(counts, 2).astype(np.uint32)).tobytes()


def _partials(segments: int):
    """Sparse partial sketches of a task's rows: per segment, the counters touched and their counts up to two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _hashes(batches):
            h = _h(table)
            slots = _slots(h)
            keys = (_segments(h, segments).astype(np.int64)[:, None] * SLOTS + slots)[slots >= 0]
            keys, counts = np.unique(keys, return_counts=True)
            segment = keys // SLOTS
            cuts = np.flatnonzero(np.diff(segment)) + 1
            starts, stops = np.append(0, cuts), np.append(cuts, len(keys))
            sketches = [_pack(keys[a:b] % SLOTS, counts[a:b]) for a, b in zip(starts, stops)]
            yield pa.RecordBatch.from_arrays([pa.array(segment[starts], pa.int32()), pa.array(sketches, pa.binary())], ["segment", "sketch"])

    return run


def _merged(table: pa.Table) -> np.ndarray:
    """The dense counters of one segment, from all its partial sketches."""
    counters = np.zeros(SLOTS, np.uint8)
    for sketch in table.column("sketch").to_pylist():
        entries = np.frombuffer(sketch, np.uint32)
        slots = entries >> np.uint32(2)
        counters[slots] = np.minimum(counters[slots] + (entries & np.uint32(3)).astype(np.uint8), 2)
    return counters


def _merge(table: pa.Table) -> pa.Table:
    counters = _merged(table)
    slots = np.flatnonzero(counters)
    return pa.table({"segment": table.column("segment").slice(0, 1), "sketch": pa.array([_pack(slots, counters[slots])], pa.binary())})


def _sifted(segments: int):
    """Marks rows whose hash comes twice among those a task holds; of the others, the sketch has to tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _hashes(batches):
            h = _h(table)
            _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
            table = table.append_column("segment", pa.array(_segments(h, segments))).append_column("seen", pa.array(counts[inverse] > 1))
            yield from table.combine_chunks().to_batches()

    return run


def _uncleared(rows: pa.Table, sketches: pa.Table) -> pa.Table:
    """Rows none of whose counters is one."""
    if not rows.num_rows:
        return rows
    counters = _merged(sketches)
    slots = _slots(_h(rows))
    low = np.where(slots >= 0, counters[slots], 2).min(axis=1)
    return rows.filter(pa.array(low > 1))


def possible_repeats(rows: DataFrame, n: int) -> DataFrame:
    """The rows of ``narrow`` (``n`` of them, written) whose text may come more than once; the others are unique for sure."""
    segments = max(1, -(-n // CAPACITY))
    sketches = rows.select("h").mapInArrow(_partials(segments), "segment int, sketch binary").groupBy("segment").applyInArrow(
        _merge, "segment int, sketch binary"
    )
    schema = f"{_NARROW}, h bigint, segment int, seen boolean"
    sifted = rows.mapInArrow(_sifted(segments), schema)
    asked = sifted.filter(~F.col("seen")).groupBy("segment").cogroup(sketches.groupBy("segment")).applyInArrow(_uncleared, schema)
    return sifted.filter("seen").union(asked).drop("segment", "seen", "h")


def moved_by_repeats(repeats: DataFrame) -> DataFrame:
    """Per part, mask and labels: how many rows have a text that a smaller id has too. Rows without id never do."""
    group = ["digest", "part", "mask", "good", "toxic"]
    by_id = repeats.filter("doc is not null").groupBy(*group, "doc").agg(F.count(F.lit(1)).alias("n"))
    by_group = by_id.groupBy(*group).agg(F.min(F.struct("doc", "n")).alias("first"), F.sum("n").alias("n"))
    least = F.min("first.doc").over(Window.partitionBy("digest"))
    later = F.col("n") - F.when(F.col("first.doc") == least, F.col("first.n")).otherwise(0)
    return by_group.select(*group[1:], later.alias("n")).groupBy(*group[1:]).agg(F.sum("n").alias("n"))


def mask_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``(part, mask, n, good, toxic)``: rows per part and exact set of failed filters, and how many are labelled so."""
    rows = written(narrow(docs, labels, key, text, part), "audit")
    moved = moved_by_repeats(possible_repeats(rows, rows.count()))
    group = ["part", "mask", "good", "toxic"]
    flagged = F.col("mask").bitwiseOR(F.lit(1 << LETTERS.index("E")))
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).union(moved.select(*group, (-F.col("n")).alias("n"))).union(
        moved.select("part", flagged.alias("mask"), "good", "toxic", "n")
    )
    return counts.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def orders(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, list]:
    """All orders of the filters and their steps, from the rows, good rows and toxic rows per mask."""
    masks = np.arange(1 << len(LETTERS))
    size = np.array([m.bit_count() for m in masks])
    every = list(permutations(range(len(LETTERS))))
    out = {c: [] for c in ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}
    # of a row's failed filters each comes first in an equal share of the orders
    shapley = [int((counts * len(every) // np.maximum(size, 1))[(masks >> i) & 1 == 1].sum()) for i in range(len(LETTERS))]
    for order in every:
        before = 0
        for step, i in enumerate(order, 1):
            fails, new = (masks >> i) & 1 == 1, masks & before == 0
            before |= 1 << i
            out["filter_order"].append("".join(LETTERS[j] for j in order))
            out["step"].append(step)
            out["kept"].append(int(counts[masks & before == 0].sum()))
            out["removed"].append(int(counts[fails & new].sum()))
            out["redundant"].append(int(counts[fails & ~new].sum()))
            out["unique_fails"].append(int(counts[1 << i]))
            out["good_lost"].append(int(good[fails & new].sum()))
            out["toxic_lost"].append(int(toxic[fails & new].sum()))
            out["shapley"].append(shapley[i])
    return out


REPORT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, "
    "toxic_lost bigint, shapley bigint"
)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = orders(*(np.array(row[c], np.int64) for c in ("n", "good", "toxic")))
            columns = [pa.array([row["part"]] * len(found["step"]), pa.string())]
            columns += [pa.array(v, pa.string() if c == "filter_order" else pa.int32() if c == "step" else pa.int64()) for c, v in found.items()]
            yield pa.RecordBatch.from_arrays(columns, ["part", *found])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per part, order of the filters and step: what is kept, removed, redundant, failed by it alone, and lost by label.

    A null text counts as empty, a null part as the empty string. Equal texts are told by their SHA-256; rows without id have
    no smaller id and are none. An id that is labelled twice is good or toxic if one of its labels says so. Repeated rows count
    as often as they come (an id is not smaller than itself), an empty table gives no rows, and other columns are not read.
    """
    counts = mask_counts(docs, labels, key, text, part)
    masks = range(1 << len(LETTERS))
    by_part = counts.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0).cast("bigint")) for m in masks]).alias(c)
        for c in ("n", "good", "toxic")
    ])
    return by_part.mapInArrow(_report, REPORT)
