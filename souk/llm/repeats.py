"""Repeated word passages by prefix-partitioned suffix trees.

A suffix is what follows a word position. Two windows of ``width`` equal words share the node of depth ``width`` in
the suffix tree of the whole corpus; the tree is never built whole, but in one subtree per prefix.

1. **Prefixes.** In every window the run of ``PREFIX`` words of smallest hash is its prefix; equal windows have equal
   prefixes at equal offsets. Neighbouring windows mostly share one, so a row stands for a *cell*: all consecutive
   windows with one prefix occurrence (about one row per eight words). A task drops cells it has seen.
2. **Pruning.** Rows meet by prefix. A prefix that occurs once has no inner node below it. Of equal cells all but the
   first repeat in whole. What remains is the first of each *different* cell under a shared prefix.
3. **Subtrees.** These cells' suffixes are dealt by prefix. A prefix with more than ``SUBTREE`` cells is replaced by
   the longer prefixes of ``width`` words, so that every group fits a task's memory. A group's suffixes are sorted,
   which lists the leaves of its subtree; neighbours whose common prefix reaches ``width`` words are leaves of one
   deep node, whose first leaf stays and whose other leaves repeat.

Maximal repeats are the merged stretches of repeating windows of a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import map_batches, written
from souk.llm.words import WordHasher, constants, grams, mixed
from souk.session import cut_lineage

#: Words of a window, of a prefix, and cells below one prefix from which longer prefixes take its place.
WIDTH, PREFIX = 20, 6
SUBTREE = 20_000
#: Suffix words that a task sorts at a time.
SORTED = 1 << 21


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost position of the smallest of every ``width`` consecutive values, by doubling."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at


def cells(hashes: np.ndarray, first: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """All cells of a group of texts: text, first window, number of windows, prefix hash and hash of the cell's words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return {c: np.empty(0, np.uint64 if c in ("prefix", "cell") else np.int64) for c in ("text", "start", "n", "prefix", "cell")}
    prefix = grams(hashes, PREFIX)
    anchor = _sliding_argmin(prefix, width - PREFIX + 1)
    text = np.searchsorted(first, np.arange(n), "right") - 1
    whole = np.arange(n) + width <= first[text + 1]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
    starts = np.flatnonzero(new & whole)
    stops = np.append(np.flatnonzero(new | ~whole), n)
    n_windows = stops[np.searchsorted(stops, starts, "right")] - starts
    power = np.cumprod(np.full(len(hashes) + 1, constants(1, 23)[0], np.uint64), dtype=np.uint64)
    inverse = np.cumprod(np.full(len(hashes) + 1, np.uint64(pow(int(constants(1, 23)[0]), -1, 1 << 64)), np.uint64), dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes) * power[:-1], dtype=np.uint64)])
    words = (sums[starts + n_windows + width - 1] - sums[starts]) * inverse[starts]
    shape = (n_windows * 64 + anchor[starts] - starts).astype(np.uint64)
    return {
        "text": text[starts], "start": starts - first[text[starts]], "n": n_windows,
        "prefix": prefix[anchor[starts]], "cell": mixed(words ^ mixed(shape)),
    }


def _cells(docs: DataFrame, width: int) -> DataFrame:
    """Cells of all documents; ``again`` marks those that a task has seen in an earlier place."""

    def start():
        hasher = WordHasher()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for row, hashes, first in hasher.groups(batch.column("text")):
                group = cells(hashes, first, width)
                group["text"] = group["text"] + row
                found.append(group)
            rows = {c: np.concatenate([g[c] for g in found]) for c in found[0]}
            doc = batch.column("doc").to_numpy()[rows["text"]]
            order = np.lexsort((rows["start"], doc, rows["cell"], rows["prefix"]))
            rows, doc = {c: v[order] for c, v in rows.items()}, doc[order]
            again = np.zeros(len(doc), bool)
            again[1:] = (rows["prefix"][1:] == rows["prefix"][:-1]) & (rows["cell"][1:] == rows["cell"][:-1])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["prefix"].view(np.int64)), pa.array(rows["cell"].view(np.int64)), pa.array(doc),
                    pa.array(rows["start"]), pa.array(rows["n"].astype(np.int16)), pa.array(again),
                ],
                ["prefix", "cell", "doc", "start", "n", "again"],
            )

        return step

    return map_batches(docs, start, "prefix bigint, cell bigint, doc bigint, start bigint, n smallint, again boolean")


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From cells sorted by prefix, cell and place: ``repeat`` for all but the first of equal cells, and the first of
    each cell whose prefix has several. One row is held back: the first of a prefix, until a second cell comes.
    Cells that a task saw before repeat wherever they are dealt to, so those of a hot prefix are spread."""
    held, last = None, None
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names]
        seen = columns[5]
        if seen.any():  # these come first, from any prefix
            yield _pruned([tuple(columns[i][seen] for i in (2, 3, 4, 0)) + (np.ones(seen.sum(), bool),)])
        prefix, cell, doc, start, n, _ = (c[~seen] for c in columns)
        size = len(prefix)
        same_prefix, same_cell = np.zeros(size, bool), np.zeros(size, bool)
        same_prefix[1:] = prefix[1:] == prefix[:-1]
        same_cell[1:] = same_prefix[1:] & (cell[1:] == cell[:-1])
        if last is not None and size:
            same_prefix[0] = prefix[0] == last[0]
            same_cell[0] = same_prefix[0] and cell[0] == last[1]
        repeat = same_cell
        heads = np.flatnonzero(~same_cell)  # the first of each cell
        later = same_prefix[heads]  # another cell of its prefix came before
        shared = later.copy()
        shared[:-1] |= later[1:]  # or comes next
        out = [(doc[repeat], start[repeat], n[repeat], prefix[repeat], np.ones(repeat.sum(), bool))]
        if held is not None and len(heads) and later[0]:
            out.append(held)
            held = None
        elif held is not None and len(heads):
            held = None
        chosen = heads[shared]
        out.append((doc[chosen], start[chosen], n[chosen], prefix[chosen], np.zeros(len(chosen), bool)))
        if len(heads) and not shared[-1]:
            at = heads[-1:]
            held = (doc[at], start[at], n[at], prefix[at], np.zeros(1, bool))
        if size:
            last = (prefix[-1], cell[-1])
        yield _pruned(out)


def _pruned(parts: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], ["doc", "start", "n", "prefix", "repeat"])


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed in their own rows, since they are shuffled."""

    def start():
        pack = zstandard.ZstdCompressor(level=3)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [pack.compress(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.binary())], ["doc", "packed"])

        return step

    return map_batches(docs, start, "doc bigint, packed binary")


def _unpacked(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([unpack.decompress(p) for p in column.to_pylist()], pa.binary())


def _suffixes(rows: DataFrame, width: int) -> DataFrame:
    """``(group, doc, start, n, words)`` of ``(doc, packed, cells)``: a cell's words, or each window's under a long prefix."""

    def start():
        hasher = WordHasher()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            docs, wanted = batch.column("doc").to_pylist(), batch.column("cells").to_pylist()
            out: list[tuple] = []
            for row, hashes, first in hasher.groups(_unpacked(batch.column("packed"))):
                windows = grams(hashes, width, 29)
                for t in range(len(first) - 1):
                    for cell in wanted[row + t]:
                        at = int(first[t]) + cell["start"]
                        if cell["wide"]:
                            out += [
                                (int(windows[i].view(np.int64)), docs[row + t], cell["start"] + i - at, 1, hashes[i : i + width].tobytes())
                                for i in range(at, at + cell["n"])
                            ]
                        else:
                            out.append((cell["prefix"], docs[row + t], cell["start"], cell["n"], hashes[at : at + cell["n"] + width - 1].tobytes()))
            columns = list(zip(*out)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["group", "doc", "start", "n", "words"])

        return step

    return map_batches(rows, start, "group bigint, doc bigint, start bigint, n bigint, words binary")


def subtree_repeats(group: np.ndarray, doc: np.ndarray, start: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Which suffixes (rows of ``width`` word hashes) are leaves of a deep node with an earlier leaf.

    Sorting the suffixes of a group lists its subtree's leaves; a run of neighbours with a common prefix of full
    width is a deep node, and its first leaf in corpus order is kept.
    """
    width = suffixes.shape[1]
    order = np.lexsort((start, doc, *(suffixes[:, j] for j in range(width - 1, -1, -1)), group))
    ranked = suffixes[order]
    equal = np.zeros(len(order), bool)
    equal[1:] = (group[order][1:] == group[order][:-1]) & (ranked[1:] == ranked[:-1]).all(axis=1)
    out = np.zeros(len(order), bool)
    out[order] = equal
    return out


def _subtrees(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            parts.append(batch)
            size += batch.column("words").nbytes // 8
            if size < SORTED:
                continue
            table = pa.Table.from_batches(parts).combine_chunks()
            group = table.column("group").to_numpy()
            changes = np.flatnonzero(group[1:] != group[:-1])
            if len(changes):
                cut = int(changes[-1]) + 1
                yield _repeating(table.slice(0, cut), width)[0]
                parts = table.slice(cut).to_batches()
            elif pc.max(table.column("n")).as_py() == 1:  # one long prefix: only its first leaf matters from here on
                found, repeat = _repeating(table, width)
                yield found
                parts = table.filter(pa.array(~repeat)).to_batches()
            size = sum(p.column("words").nbytes for p in parts) // 8
        if parts:
            yield _repeating(pa.Table.from_batches(parts), width)[0]

    return run


def _repeating(table: pa.Table, width: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The repeating windows of whole groups, and which they are."""
    n = table.column("n").to_numpy()
    words = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
    suffixes = np.concatenate([np.lib.stride_tricks.sliding_window_view(w, width) for w in words])
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    group, doc = np.repeat(table.column("group").to_numpy(), n), np.repeat(table.column("doc").to_numpy(), n)
    start = np.repeat(table.column("start").to_numpy(), n) + offset
    found = subtree_repeats(group, doc, start, suffixes)
    columns = [pa.array(doc[found]), pa.array(start[found]), pa.array(np.ones(found.sum(), np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["doc", "start", "n"]), found


def _numbered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    """``(doc, doc_id, text)`` where ``doc`` is a whole number in document order: the id itself, or if ids repeat or
    are null, a number by id and text (nulls first). Says which as well."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    whole = dict(rows.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint")
    repeated = rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if whole and repeated.isEmpty():
        return rows.select(F.col("doc_id").cast("bigint").alias("doc"), "doc_id", "text"), "id"
    placed = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    return cut_lineage(placed.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text")), "number"


def repeating_windows(numbered: DataFrame, packed: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc, start, n)``: stretches of windows whose words also start at an earlier place."""
    found = _cells(numbered.select("doc", "text"), width)
    target = F.when(F.col("again"), F.xxhash64("doc", "start")).otherwise(F.col("prefix"))
    dealt = found.repartition(target).sortWithinPartitions(F.desc("again"), "prefix", "cell", "doc", "start")
    pruned = written(dealt.mapInArrow(_prune, "doc bigint, start bigint, n smallint, prefix bigint, repeat boolean"), "cells")
    left = pruned.filter(~F.col("repeat"))
    wide = left.groupBy("prefix").count().filter(F.col("count") > SUBTREE).select("prefix", F.lit(True).alias("wide"))
    wanted = left.join(wide, "prefix", "left").groupBy("doc").agg(
        F.collect_list(F.struct("start", "n", "prefix", F.coalesce("wide", F.lit(False)).alias("wide"))).alias("cells")
    )
    suffixes = _suffixes(packed.join(wanted, "doc").select("doc", "packed", "cells"), width)
    dealt = suffixes.repartition("group").sortWithinPartitions("group")
    deep = written(dealt.mapInArrow(_subtrees(width), "doc bigint, start bigint, n bigint"), "deep")
    return pruned.filter("repeat").select("doc", "start", F.col("n").cast("bigint").alias("n")).unionByName(deep)


def _covered(n_words: int, marks: list[dict], width: int) -> np.ndarray:
    """Which words are in a repeating window."""
    edges = np.zeros(n_words + 1, np.int64)
    for mark in marks:
        edges[mark["start"]] += 1
        edges[min(n_words, mark["start"] + mark["n"] + width - 1)] -= 1
    return np.cumsum(edges[:-1]) > 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``, and with ``with_text`` also ``kept`` and ``repeats``.

    Words covered by a window of ``width`` words that also starts at an earlier place (smaller id, or the same
    document further left) go; windows are those of the input. ``kept`` are the words left, joined by one space;
    ``repeats`` the maximal repeats as ``(start, stop)`` in words. A text without words (also null) has none and the
    digest of the empty string; texts shorter than a window lose nothing. Rows whose id repeats or is null follow
    one another by text, nulls first, so the second of two equal rows is a repeat. An empty table gives no rows and
    other columns are ignored.
    """
    numbered, by = _numbered(docs, key, text)
    kind = dict(numbered.dtypes)["doc_id"]
    packed = _packed(numbered.select("doc", "text"))
    marks = repeating_windows(numbered, packed, width).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    rows = packed.join(marks, "doc", "left")
    extra = ", kept string, repeats array<struct<start: bigint, stop: bigint>>" if with_text else ""

    def start():
        unpack = zstandard.ZstdDecompressor()

        def one(packed: bytes, found: list[dict] | None) -> tuple:
            words = unpack.decompress(packed).split()
            stretches = []
            gone = 0
            if found:
                covered = _covered(len(words), found, width)
                edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                stretches = [{"start": int(a), "stop": int(b)} for a, b in zip(edges[::2], edges[1::2])]
                gone = int(covered.sum())
                n = len(words)
                words = [w for w, c in zip(words, covered.tolist()) if not c]
            else:
                n = len(words)
            kept = b" ".join(words)
            return n, gone, hashlib.sha256(kept).hexdigest(), kept.decode(), stretches

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = list(zip(*map(one, batch.column("packed").to_pylist(), batch.column("marks").to_pylist())))
            arrays = [batch.column("doc"), pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2])]
            names = ["doc", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                arrays, names = [*arrays, pa.array(found[3]), pa.array(found[4], kind)], [*names, "kept", "repeats"]
            return pa.RecordBatch.from_arrays(arrays, names)

        return step

    out = map_batches(rows.select("doc", "packed", "marks"), start, f"doc bigint, n_words bigint, n_removed bigint, kept_sha256 string{extra}")
    if by == "id":
        return out.withColumn("doc", F.col("doc").cast(kind)).withColumnRenamed("doc", "doc_id")
    return out.join(numbered.select("doc", "doc_id"), "doc").select("doc_id", *[c for c in out.columns if c != "doc"])
