"""Near-duplicate documents by min-max hashing.

Every document's set of word shingles is hashed under each permutation once, and both the smallest and the largest
value are kept: two unbiased estimators of Jaccard similarity for one evaluation. Bands of two permutations (four
values) are the buckets.

Links are confirmed on full sets and none between different texts is lost to the way candidates are tried:

1. documents with equal sets form a class, and only its smallest id goes on;
2. in each bucket every class is compared with the bucket's smallest id (a star, so a group of n copies costs n);
3. in buckets that still hold several components, all classes of different components are compared by signature,
   in blocks; classes that are plausibly similar, directly or in turn, form a cluster;
4. in each cluster all classes of different components are compared on full sets, again in blocks.

Pairs inside a component need no link of their own. Steps 3 and 4 hand on a spanning forest of the pairs that they
find in a block, so their output grows with the rows and not with the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import components, map_batches, written, released
from souk.llm.words import WordHasher, constants, grams, joined, mixed

#: Permutations; two signature values each, of which one byte is kept beside the bands. At 48 and four values a band, similarity 0.80 meets in none of the 24 bands
#: with probability 3e-6, and 0.85 with 2e-8.
PERMUTATIONS = 48
BAND = 4
#: A pair is compared on full sets unless so few signature values agree that its similarity is below the threshold by
#: more than this many standard deviations.
DEVIATIONS = 5.0
#: Rows of a bucket or of a star that one comparison block holds.
BLOCK = 256
#: Shingles hashed at a time, and columns of a block's table of shingles.
CHUNK = 1 << 18
WIDE = 4096


def shingle_sets(column: pa.Array, k: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each whole text, A-Z in lower case; with fewer than ``k`` words, one for them all."""
    for _, hashes, first in hasher.groups(column):
        shingles = grams(hashes, k, k)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= k:
                yield np.unique(shingles[a : b - k + 1])
            else:
                yield grams(hashes[a:b], b - a, b - a) if b > a else np.empty(0, np.uint64)


def signatures(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """Per set its minimum and maximum under each permutation, as 32-bit values; rows of zeros for empty sets."""
    out = np.zeros((len(sets), 2 * permutations), np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    factors, salts = constants(permutations, 7), constants(permutations, 11)
    at = 0
    while at < len(filled):
        stop, total = at, 0
        while stop < len(filled) and (stop == at or total + len(sets[filled[stop]]) <= CHUNK):
            total += len(sets[filled[stop]])
            stop += 1
        rows = filled[at:stop]
        values = joined(sets[i] for i in rows)
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in rows])[:-1]])
        for j in range(permutations):
            hashed = (values ^ salts[j]) * factors[j]
            hashed ^= hashed >> np.uint64(29)
            hashed *= factors[j]
            out[rows, 2 * j] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
            out[rows, 2 * j + 1] = np.maximum.reduceat(hashed, starts) >> np.uint64(32)
        at = stop
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature row; different bands have different keys."""
    rows, width = signature.shape
    parts = signature.astype(np.uint64).reshape(rows, width // BAND, BAND)
    return mixed((parts * constants(BAND, 13)).sum(axis=2, dtype=np.uint64) ^ constants(width // BAND, 31))


def least_agreement(percent: int, values: int) -> int:
    """Agreeing signature values below which a pair of the threshold's similarity is not to be expected."""
    share = percent / 100
    return max(0, int(values * share - DEVIATIONS * (values * share * (1 - share)) ** 0.5))


def _signed(docs: DataFrame, key: str, text: str, k: int, permutations: int) -> DataFrame:
    kept = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))

    def start():
        hasher = WordHasher(fold=True)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = list(shingle_sets(batch.column("text"), k, hasher))
            signature = signatures(sets, permutations)
            one = np.array([int(s.sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
            two = np.array([int(mixed(s).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
            buckets = bands(signature).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(one), pa.array(two),
                    pa.array(list(buckets), pa.list_(pa.int64())), pa.array([r.tobytes() for r in signature.astype(np.uint8)], pa.binary()),
                ],
                ["id", "n", "s1", "s2", "bands", "signature"],
            )

        return step

    return map_batches(kept, start, "id bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>, signature binary")


def _confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """``(a, b)`` of the pairs whose full sets reach the threshold.

    A star's centre ``a`` goes with each block of its ``b``, so that no task holds more than one set and one row.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("_blocks")).filter("_blocks > 1")
    blocked = pairs.join(sizes, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("_blocks", F.lit(1))).alias("block"))
    members = blocked.select(F.col("b").alias("id"), "a", "block", F.lit(1).alias("member"))
    centres = blocked.select(F.col("a").alias("id"), "a", "block", F.lit(0).alias("member")).distinct()
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows = members.unionByName(centres).join(texts, "id").select("a", "block", "member", "id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, at, sets = WordHasher(fold=True), None, []
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("a", "block", "member", "id")]
            for a, block, member, b, own in zip(*columns, shingle_sets(batch.column("text"), k, hasher)):
                if at != (a, block):
                    at, sets = (a, block), []
                if not member:
                    sets.append(own)
                    continue
                for other in sets:
                    both = len(np.intersect1d(other, own, assume_unique=True))
                    if 100 * both >= percent * (len(other) + len(own) - both):
                        found.append((a, b))
                        break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return rows.repartition("a", "block").sortWithinPartitions("a", "block", "member").mapInArrow(released(compare), "a bigint, b bigint")


def _cells(rows: DataFrame, key: str) -> DataFrame:
    """``(key, id, component)`` rows dealt to cells, each of two blocks of about ``BLOCK`` rows.

    Rows of a key's largest component need no comparison among themselves, so one block of a cell holds rows of
    other components, and a component of any size with s rows beside it costs s times its size and not its square.
    """
    parts = rows.groupBy(key, "component").agg(F.count("*").alias("size"))
    shapes = parts.groupBy(key).agg(
        F.max_by("component", F.struct("size", "component")).alias("major"), F.max("size").alias("majors"), F.sum("size").alias("size")
    ).filter("size > majors").select(
        key, "major", F.ceil((F.col("size") - F.col("majors")) / BLOCK).cast("int").alias("nm"), F.ceil(F.col("majors") / BLOCK).cast("int").alias("nb")
    )
    code = F.xxhash64("id")
    own = F.when(F.col("component") == F.col("major"), F.col("nm") + F.pmod(code, "nb")).otherwise(F.pmod(code, "nm")).cast("int")
    last = F.when(F.col("own") >= F.col("nm"), F.col("nm")).otherwise(F.col("nm") + F.col("nb")) - 1
    dealt = rows.join(shapes, key).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return dealt.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")).drop("other", "major", "nm", "nb")


def _by_cell(cells: DataFrame, key: str, start) -> DataFrame:
    """Edges ``(a, b)`` that a function finds in each cell; ``start`` makes one such function per task."""
    names = [key, "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held = start(), None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            new = np.ones(table.num_rows, bool)
            columns = [table.column(c).to_numpy() for c in names]
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            starts = np.flatnonzero(new).tolist()
            if len(starts) > 1:
                yield _edge_batch([find(table.slice(a, b - a)) for a, b in zip(starts[:-1], starts[1:])])
            held = table.slice(starts[-1]).combine_chunks().to_batches()[0]
        if held is not None:
            yield _edge_batch([find(pa.Table.from_batches([held]))])

    return cells.repartition(*names).sortWithinPartitions(*names).mapInArrow(released(run), "a bigint, b bigint")


def _edge_batch(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    arrays = [pa.array(joined((f[i] for f in found), np.int64).astype(np.int64)) for i in range(2)]
    return pa.RecordBatch.from_arrays(arrays, ["a", "b"])


def _forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each id to the smallest that the pairs (i, j) of rows connect it with."""
    rank = np.argsort(np.argsort(ids, kind="stable"))
    by_rank = np.sort(ids, kind="stable")
    label, i, j = np.arange(len(ids)), rank[i], rank[j]
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    own = np.flatnonzero(label != np.arange(len(ids)))
    return by_rank[label[own]], by_rank[own]


def _sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    own = cell.column("own").to_numpy()
    return np.flatnonzero(own == cell.column("x")[0].as_py()), np.flatnonzero(own == cell.column("y")[0].as_py())


def _apart(cell: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs of different components, which also leaves out a row and itself."""
    component = cell.column("component").to_numpy()
    return component[left][:, None] != component[right][None, :]


def _plausible(members: DataFrame, percent: int, permutations: int) -> DataFrame:
    """Edges within buckets that connect all classes of different components whose signatures may belong to a link."""
    least = least_agreement(percent, 2 * permutations)

    def find(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        left, right = _sides(cell)
        n = cell.column("n").to_numpy()
        signature = np.frombuffer(b"".join(cell.column("signature").to_pylist()), np.uint8).reshape(cell.num_rows, -1)
        small, large = np.minimum(n[left][:, None], n[right][None, :]), np.maximum(n[left][:, None], n[right][None, :])
        i, j = np.nonzero(_apart(cell, left, right) & (100 * small >= percent * large))
        parts = [slice(s, s + 8192) for s in range(0, len(i), 8192)]
        agree = joined(((signature[left[i[p]]] == signature[right[j[p]]]).sum(axis=1) for p in parts), np.int64)
        near = agree >= least
        return _forest(cell.column("id").to_numpy(), left[i[near]], right[j[near]])

    cells = _cells(members, "band").select("band", "x", "y", "own", "id", "n", "component", "signature")
    return _by_cell(cells, "band", lambda: find)


def _linked(clusters: DataFrame, docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """Edges between different components of each cluster that are links on full sets, as forests of the blocks."""
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    cells = _cells(clusters, "cluster").join(texts, "id").select("cluster", "x", "y", "own", "id", "component", "text")

    def start():
        hasher = WordHasher(fold=True)

        def find(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            left, right = _sides(cell)
            sets = list(shingle_sets(cell.column("text").combine_chunks(), k, hasher))
            sizes = np.array([len(s) for s in sets])
            values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(len(sets)), sizes)
            shared = count[column] > 1
            column, row = (np.cumsum(count > 1) - 1)[column[shared]], row[shared]
            order = np.argsort(column, kind="stable")
            column, row = column[order], row[order]
            both = np.zeros((len(left), len(right)), np.float32)
            for s in range(0, int(column[-1]) + 1 if len(column) else 0, WIDE):
                a, b = np.searchsorted(column, [s, s + WIDE])
                holds = np.zeros((len(sets), WIDE), np.float32)
                holds[row[a:b], column[a:b] - s] = 1
                both += holds[left] @ holds[right].T
            union = sizes[left][:, None] + sizes[right][None, :] - both
            i, j = np.nonzero(_apart(cell, left, right) & (100 * both >= percent * union) & (union > 0))
            return _forest(cell.column("id").to_numpy(), left[i], right[j])

        return find

    return _by_cell(cells, "cluster", start)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, permutations: int = PERMUTATIONS
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reached by links) and ``kept``.

    Two documents are linked if ``100 * intersection >= percent * union`` of their sets of ``k``-word shingles. A
    text without words (also null) has an empty set and no link. Ids are whole numbers; an id that repeats stands for
    all its rows' texts, each row with its own set size. A row with a null id is linked with nothing, keeps a null
    component and is kept. Equal rows give equal rows, an empty table gives none, other columns are ignored.
    """
    signed = written(_signed(docs, key, text, k, permutations), "signatures")
    filled = signed.filter("n > 0 and id is not null")
    classes = written(
        filled.groupBy("n", "s1", "s2").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "classes"
    )
    buckets = classes.select("id", F.explode("bands").alias("band"))
    hubs = buckets.groupBy("band").agg(F.min("id").alias("a"), F.count("*").alias("size")).filter("size > 1")
    shared = written(buckets.join(hubs, "band"), "buckets")
    sizes = classes.groupBy("id").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    stars = shared.filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    sized = stars.join(sizes.withColumnRenamed("id", "b"), "b").join(
        sizes.select(F.col("id").alias("a"), F.col("low").alias("hub_low"), F.col("high").alias("hub_high")), "a"
    )
    fits = F.expr(f"100 * least(high, hub_high) >= {percent} * greatest(low, hub_low)")
    links = written(_confirmed(sized.filter(fits).select("a", "b"), docs, key, text, k, percent), "links")
    first = components(links)

    named = shared.filter("size > 2").join(first, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    split = named.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("band")
    open_ = named.join(split, "band").join(classes.select("id", "n", "signature"), "id")
    plausible = components(_plausible(open_, percent, permutations)).withColumnRenamed("component", "cluster")
    clusters = plausible.join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    more = written(_linked(clusters, docs, key, text, k, percent), "more")

    sames = filled.join(classes.select("n", "s1", "s2", F.col("id").alias("a")), ["n", "s1", "s2"]).filter("id <> a").select("a", F.col("id").alias("b"))
    found = components(links.unionByName(more).unionByName(sames))
    rows = signed.select("id", "n").join(found, "id", "left")
    component = F.coalesce("component", "id")
    return rows.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns: of every group of linked documents the one with the smallest id.

    Texts that are null or without words are linked with nothing and stay, as do rows with a null id; repeated rows of one id go or
    stay together, and an empty table gives no rows.
    """
    gone = near_duplicates(docs, key, text, **settings).filter(~F.col("kept")).select(F.col("doc_id").alias("__souk_gone")).distinct()
    return docs.join(gone, F.col(key) == F.col("__souk_gone"), "left_anti")
