"""Benchmark items in documents, within a word edit distance, by CGK embedding and bit-sampling LSH.

The CGK random walk reads a word sequence with one pointer: at each step it writes the word under the pointer and
then, by a random bit drawn for the step and the word, moves on or stays. Two sequences at a small edit distance
meet again after each edit, so their outputs differ in few positions: edit distance becomes Hamming distance.
Every repetition draws a walk of its own and samples ``SAMPLED`` output positions as an LSH key; the number of
repetitions follows from the target recall (``repetitions``). Windows of an item's size whose key equals the item's
are verified by an exact semi-global edit distance.

An item of n words within d edits leaves one of d + 1 pieces untouched. Only windows around such a piece are
embedded: no other window can be within the distance, so nothing is lost by that.

Walks drift apart as edits add up, so an item of more than ``LONGEST`` words is searched by parts of about equal size.
An item within its share of edits has a part within the part's own share; where one meets, the whole item is verified.
"""

from __future__ import annotations

import functools
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm.common import released
from souk.llm.words import WordHasher, constants, joined, mixed

#: Edits allowed per hundred words of an item, and the shortest item that may have any: shorter ones are found word for word.
PERCENT, SHORTEST = 20, 8
#: Output positions in a key, steps of the walk per word, and the recall to reach at the largest distance.
SAMPLED, STEPS, RECALL = 3, 2, 0.995
#: Words in the longest sequence that is embedded: the number of walks is fitted up to it.
LONGEST = 64
#: Words of items that one pass over the documents holds; more items take more passes.
ITEM_WORDS = 1 << 20
#: Windows embedded at a time.
CHUNK = 1 << 14

PUNCTUATION = string.punctuation.encode()


def plain_hasher() -> WordHasher:
    """Words compare without case (A-Z) and without ASCII punctuation; punctuation alone is no word."""
    return WordHasher(fold=True, ignored=PUNCTUATION)


def edits(n: int) -> int:
    return n * PERCENT // 100


def _bits(repetition: int, steps: int) -> np.ndarray:
    return constants(steps, 1000 + repetition)


def _sampled(repetition: int, steps: int) -> np.ndarray:
    order = np.argsort(constants(steps, 5000 + repetition))
    return np.sort(order[:SAMPLED])


def walk_keys(hashes: np.ndarray, starts: np.ndarray, size: int, repetition: int) -> np.ndarray:
    """LSH keys of the windows ``[start, start + size)``: one CGK walk, read at the sampled steps.

    Beyond its window a walk reads a fixed padding word.
    """
    steps = STEPS * size
    moves, wanted = _bits(repetition, steps), _sampled(repetition, steps)
    factors = constants(SAMPLED, 9000 + repetition)
    at = starts.astype(np.int64)
    stop = np.minimum(at + size, len(hashes))
    padded = np.append(hashes, np.uint64(0x5BD1E995))
    keys, taken = np.zeros(len(at), np.uint64), 0
    for step in range(int(wanted[-1]) + 1):
        word = padded[np.where(at < stop, at, len(hashes))]
        if step == wanted[taken]:
            keys += word * factors[taken]
            taken += 1
        at += (((word ^ moves[step]) * moves[step]) >> np.uint64(63)).astype(np.int64)
    return mixed(keys)


@functools.cache
def repetitions(target: float = RECALL, sizes: tuple[int, ...] = (16, 32, LONGEST)) -> int:
    """Walks needed for the target recall at the largest allowed distance, from simulated edits of random sequences.

    Each trial spreads the largest allowed number of edits (a third each of replacements, removals, insertions) over
    a random sequence; the mean of the miss probabilities over trials falls with the number of walks.
    """
    rng = np.random.default_rng(5)
    most, trials = 128, 60
    hits = []
    for n in sizes:
        clean = rng.integers(1, 1 << 62, (trials, n)).astype(np.uint64)
        other = np.zeros_like(clean)
        for row in range(trials):
            edited = list(clean[row])
            for kind, at in zip(rng.integers(0, 3, edits(n)), np.sort(rng.choice(n, edits(n), replace=False))[::-1]):
                edited[at : at + (kind != 2)] = [] if kind == 1 else [np.uint64(rng.integers(1, 1 << 62))]
            other[row, : len(edited)] = edited[:n]
        starts = np.arange(trials) * n
        same = [walk_keys(clean.ravel(), starts, n, r) == walk_keys(other.ravel(), starts, n, r) for r in range(most)]
        hits.append(np.array(same).T)
    hits = np.concatenate(hits)
    found = np.maximum.accumulate(hits, axis=1).mean(axis=0)
    enough = np.flatnonzero(found >= target)
    if not len(enough):
        raise ValueError("the target recall needs more walks than were tried")
    return int(enough[0]) + 1


def best_match(item: np.ndarray, part: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance between an item and any run of ``part``, and where the first such run ends.

    The bit-parallel form of the semi-global dynamic programme, with one bit per item word.
    """
    n = len(item)
    where: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        where[word] = where.get(word, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, distance = full, 0, n
    best, end = n, 0
    for j, word in enumerate(part.tolist()):
        equal = where.get(word, 0)
        x = equal | minus
        d = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | (~(d | plus) & full), plus & d
        distance += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (~(x | up) & full), up & x
        if distance < best:
            best, end = distance, j + 1
    return best, end


@dataclass
class Items:
    """Benchmark items as word hashes, in parts of at most ``LONGEST`` words, with the parts' pieces and LSH keys."""

    ids: list[int]
    words: list[np.ndarray]
    walks: int

    def __post_init__(self):
        self.owners: list[int] = []
        self.offsets: list[int] = []
        self.parts: list[np.ndarray] = []
        for i, item in enumerate(self.words):
            n, parts = len(item), -(-len(item) // LONGEST)
            for p in range(parts):
                low, high = n * p // parts, n * (p + 1) // parts
                self.owners.append(i)
                self.offsets.append(low)
                self.parts.append(item[low:high])
        by_piece: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for i, item in enumerate(self.parts):
            n, pieces = len(item), edits(len(item)) + 1
            offsets = np.array([n * p // pieces for p in range(pieces)])
            size = n // pieces
            by_piece.setdefault(size, []).append((_runs(item, size)[offsets], np.full(pieces, i), offsets))
        self.pieces = {}
        for size, parts in by_piece.items():
            keys, owners, offsets = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(keys, kind="stable")
            low = np.zeros(1 << 16, bool)
            low[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.pieces[size] = (keys[order], owners[order], offsets[order], low)
        self.keys = np.zeros((len(self.parts), self.walks), np.uint64)
        sizes = np.array([len(w) for w in self.parts])
        for n in np.unique(sizes):
            same = np.flatnonzero(sizes == n)
            flat = joined(self.parts[i] for i in same)
            for r in range(self.walks):
                self.keys[same, r] = walk_keys(flat, np.arange(len(same)) * n, int(n), r)

    def windows(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(part, text, starts)`` of the windows around untouched pieces; text t has the words from ``first[t]`` on."""
        owners, starts, texts = [], [], []
        for size, (keys, owner, offset, low) in self.pieces.items():
            runs = _runs(hashes, size)
            near = np.flatnonzero(low[(runs & np.uint64(0xFFFF)).astype(np.int64)])
            low_at, high_at = np.searchsorted(keys, runs[near], "left"), np.searchsorted(keys, runs[near], "right")
            counts = high_at - low_at
            if not counts.any():
                continue
            hit = np.repeat(near, counts)
            entry = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low_at, counts)
            owners.append(owner[entry])
            starts.append(hit - offset[entry])
            texts.append(np.searchsorted(first, hit, "right") - 1)
        if not owners:
            return
        owner, start, text = np.concatenate(owners), np.concatenate(starts), np.concatenate(texts)
        order = np.lexsort((start, owner, text))
        owner, start, text = owner[order], start[order], text[order]
        cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(text) != 0)) + 1
        for part, i, t in zip(np.split(start, cuts), owner[np.append(0, cuts)].tolist(), text[np.append(0, cuts)].tolist()):
            spread = edits(len(self.parts[i]))
            around = np.unique((part[:, None] + np.arange(-spread, spread + 1)).ravel())
            yield i, t, np.unique(np.clip(around, first[t], max(first[t], first[t + 1] - 1)))

    def search(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """``(text, item_id, item words, distance, end)`` of every item within its distance, at its best place.

        Windows that overlap are verified as one stretch of text, as soon as one of them meets the part's key. An item
        of several parts may be yielded for each of them.
        """
        for i, t, starts in self.windows(hashes, first):
            item, before = self.words[self.owners[i]], self.offsets[i]
            n, allowed = len(self.parts[i]), edits(len(item))
            after = len(item) - before
            begin, stop = int(first[t]), int(first[t + 1])
            own = hashes[begin:stop]
            stretch = np.concatenate([[0], np.cumsum(np.diff(starts) > n)])
            places = starts - begin
            best, open_ = None, np.ones(len(starts), bool)
            for r in range(self.walks):
                if not open_.any():
                    break
                left = np.flatnonzero(open_)
                met = np.concatenate([
                    walk_keys(own, places[left[a : a + CHUNK]], n, r) == self.keys[i, r] for a in range(0, len(left), CHUNK)
                ])
                for s in np.unique(stretch[left[met]]):
                    inside = places[stretch == s]
                    low = max(0, int(inside[0]) - before - allowed)
                    distance, end = best_match(item, own[low : int(inside[-1]) + after + allowed])
                    if distance <= allowed and (best is None or (distance, low + end) < best):
                        best = (distance, low + end)
                    open_ &= stretch != s
            if best is not None:
                yield t, self.ids[self.owners[i]], len(item), *best


class Verbatim:
    """Items of fewer than ``SHORTEST`` words, as sorted run hashes per length."""

    def __init__(self, ids: list[int], words: list[np.ndarray]):
        self._of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({len(w) for w in words}):
            pairs = sorted({(int(_runs(w, n)[0]), i) for i, w in zip(ids, words) if len(w) == n})
            self._of[n] = np.array([h for h, _ in pairs], np.uint64), np.array([i for _, i in pairs], np.int64)

    def search(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """``(text, item_id, item words, 0, end)`` of every item that a text holds, at its first place."""
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for n, (known, ids) in self._of.items():
            runs = _runs(hashes, n)
            low, high = np.searchsorted(known, runs, "left"), np.searchsorted(known, runs, "right")
            at = np.flatnonzero((high > low) & (text[: len(runs)] == text[n - 1 :]))
            _, once = np.unique(np.stack([text[at], low[at]]), axis=1, return_index=True)  # the first place of each
            for place in at[once]:
                t = int(text[place])
                for item in ids[low[place] : high[place]].tolist():
                    yield t, item, n, 0, int(place - first[t]) + n


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = constants(size, 3)
    total = hashes[:n] * factors[0]
    for j in range(1, size):
        total += hashes[j : j + n] * factors[j]
    return total ^ (total >> np.uint64(32))


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size, so that what a pass sends to every task is bounded too."""
    rows = benchmark.select(F.col(item).cast("bigint").alias("i"), F.col(text).alias("t")).filter("i is not null and t is not null")
    block, words = [], 0
    for row in rows.distinct().orderBy("i", "t").toLocalIterator():
        block.append((row["i"], row["t"]))
        words += len(row["t"].split())
        if words >= ITEM_WORDS:
            yield block
            block, words = [], 0
    if block:
        yield block


def leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(doc_id, item_id, n_words, distance, end)`` of every benchmark item found in a document's whole text.

    An item is found if some run of the text is within ``PERCENT`` edits (words inserted, removed, replaced) per
    hundred item words; ``distance`` is the smallest and ``end`` the number of words up to the end of its first
    place. Items of fewer than ``SHORTEST`` words are found word for word only. Null or empty texts hold nothing, and null
    items and those without words are in no text; rows with a null id are searched and reported under it. Of repeated rows or items each finds its own matches, of
    which equal ones are reported once. Empty tables give no rows, other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, item_id bigint, n_words bigint, distance bigint, end bigint"
    found = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item, item_text):
        found = found.unionByName(rows.mapInArrow(released(_searcher(block)), schema))
    best = F.min(F.struct("distance", "end", "n_words")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.n_words", "m.distance", "m.end")


def _searcher(block: list[tuple[int, str]]):
    hashes, first = plain_hasher().hash([t.encode("utf-8", "surrogatepass") for _, t in block])
    words = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
    known = [(i, w) for (i, _), w in zip(block, words) if len(w) >= SHORTEST]
    short = [(i, w) for (i, _), w in zip(block, words) if 0 < len(w) < SHORTEST]
    verbatim = Verbatim([i for i, _ in short], [w for _, w in short])
    items = Items([i for i, _ in known], [w for _, w in known], repetitions())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = plain_hasher()
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            found = [
                (keys[row + t], *match)
                for row, hashes, first in hasher.groups(batch.column("text"))
                for t, *match in (*items.search(hashes, first), *verbatim.search(hashes, first))
            ]
            if found:
                columns = list(zip(*found))
                types = [batch.schema.field("doc_id").type, *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "item_id", "n_words", "distance", "end"]
                )

    return search


def remove_leaking(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns; rows with a null id go if any such row leaks.

    Rows of one id go together if one of them leaks; null and empty texts hold nothing and stay unless another row of their id
    leaks; without items all rows stay, and an empty table gives none.
    """
    bad = leaks(docs, benchmark, key, text).select(F.col("doc_id").alias("__souk_leak")).distinct()
    return docs.join(bad, F.col(key).eqNullSafe(F.col("__souk_leak")), "left_anti")
