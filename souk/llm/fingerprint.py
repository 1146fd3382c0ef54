"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps one modular prefix array per modulus. Any span's hash is a difference of two entries scaled by
a power of the base, so span equality is constant work and the longest common extension of two positions is a
binary search. A fingerprint is the text's length, its whole-text hash and a bottom-k sketch of the hashes of all
its spans of ``SPAN`` code points (``SHORT_SPAN`` as well, for texts so short that most long spans hold an edit).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Moduli (primes near 2^31), base, span lengths in code points, sketch size.
MODULI = (2147483647, 2147483629)
BASE = 1_000_003
SPAN, SHORT_SPAN = 8, 2
SHORT_TEXT = 64
SKETCH = 64


class Powers:
    """Powers of the base and of its inverse under one modulus, grown by doubling."""

    def __init__(self, modulus: int):
        self.modulus = modulus
        self.up, self.down = np.ones(1, np.int64), np.ones(1, np.int64)
        self._inverse = pow(BASE, -1, modulus)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * pow(BASE, m, self.modulus) % self.modulus])
            self.down = np.concatenate([self.down, self.down * pow(self._inverse, m, self.modulus) % self.modulus])


_POWERS: dict[int, Powers] = {}


def powers(modulus: int) -> Powers:
    return _POWERS.setdefault(modulus, Powers(modulus))


class PrefixHash:
    """Prefix arrays of one text: entry i sums ``(code + 1) * base^j`` over the first i code points j."""

    def __init__(self, codes: np.ndarray):
        self.n, self._sums = len(codes), []
        values = codes.astype(np.int64) + 1
        for modulus in MODULI:
            table = powers(modulus)
            table.reach(self.n + 1)
            terms = values * table.up[: self.n] % modulus
            sums = np.zeros(self.n + 1, np.int64)
            np.cumsum(terms, out=sums[1:])  # below 2^63 for texts of up to 2^32 code points
            self._sums.append(sums % modulus)

    def spans(self, length: int) -> np.ndarray:
        """The 62-bit hashes of all spans of one length, by start."""
        starts = self.n - length + 1
        if starts <= 0:
            return np.empty(0, np.uint64)
        halves = [
            (s[length:] - s[:starts]) % m * powers(m).down[:starts] % m for s, m in zip(self._sums, MODULI)
        ]
        return (halves[0].astype(np.uint64) << np.uint64(31)) | halves[1].astype(np.uint64)

    def span(self, start: int, stop: int) -> int:
        halves = [int(s[stop] - s[start]) % m * int(powers(m).down[start]) % m for s, m in zip(self._sums, MODULI)]
        return halves[0] << 31 | halves[1]

    def common_extension(self, start: int, other: PrefixHash, other_start: int) -> int:
        """Length of the longest equal run from the two positions, by binary search on span equality."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, start + middle) == other.span(other_start, other_start + middle):
                low = middle
            else:
                high = middle - 1
        return low


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mixed(values: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit values, so that the smallest are a fair sample of a text's spans."""
    x = values * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _lowest(values: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct values; a threshold keeps the sort short, and is raised when it kept too few."""
    share = 4 * SKETCH / max(len(values), 1)
    while share < 1:
        near = values[values < np.uint64(int(share * 2**64))]
        near = np.unique(near)
        if len(near) >= SKETCH:
            return near[:SKETCH]
        share *= 8
    return np.unique(values)[:SKETCH]


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Span hashes with the number of the repeat mixed in."""
    ordered = np.sort(hashes)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return ordered
    places = np.arange(len(ordered))
    repeat = places - np.maximum.accumulate(np.where(new, places, 0))
    return ordered ^ (repeat.astype(np.uint64) * np.uint64(0x94D049BB133111EB))


def sketch(prefix: PrefixHash) -> np.ndarray:
    """Bottom-k sketch of a text's spans; a text shorter than a span is one span of its own length."""
    parts = [_numbered(prefix.spans(min(SPAN, prefix.n)))] if prefix.n else []
    if 0 < prefix.n < SHORT_TEXT:
        parts.append(_numbered(prefix.spans(min(SHORT_SPAN, prefix.n))) ^ np.uint64(1 << 63))
    return _lowest(_mixed(np.concatenate(parts))) if parts else np.empty(0, np.uint64)


def written(prefix: PrefixHash, values: np.ndarray) -> str:
    """``length-hash-sketch`` in hex; equal texts have equal fingerprints."""
    return f"{prefix.n:x}-{prefix.span(0, prefix.n):016x}-" + values.astype(">u8").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Estimated share of common spans (Jaccard) of two fingerprints; 1 for equal ones, 0 if only one is empty."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s.rsplit("-", 1)[1]), ">u8") for s in (a, b))
    return _likeness(x, y)


def _likeness(x: np.ndarray, y: np.ndarray) -> float:
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    lowest = np.union1d(x, y)[:SKETCH]
    return float(np.isin(lowest, np.intersect1d(x, y)).sum() / len(lowest))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per row: fingerprints of its text and of its edited text, and their likeness (see ``likeness``).

    The edited text replaces the last quarter (floor) of the code points by the first as many of the next row's
    text, in ascending ``key`` order (a number) with ties by text and null keys first; after the last row comes the
    first. A null text is empty; an empty table gives no rows; a table of one row is followed by itself. Repeated
    rows follow one another. ``common_prefix`` is the longest common extension of both texts from their starts.

    Rows are dealt to ``ranges`` intervals of the key (four for each shuffle partition unless given), whose borders
    are quantiles, and sorted within; the first row of an interval is copied to the one before. The driver sees
    only the borders. A task holds two texts at a time, however many rows an interval has.
    """
    spark = df.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = rows.select("doc_id", F.col("doc_id").cast("double").alias("v"))
    borders = sorted(set(ids.approxQuantile("v", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    place = F.coalesce(F.size(F.filter(F.lit(borders), lambda b: b <= F.col("doc_id").cast("double"))), F.lit(0)) if borders else F.lit(0)
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(place)
    firsts = ids.groupBy(place.alias("part")).agg(F.min_by("doc_id", F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first"))
    starts = [(r["part"], r["first"]) for r in firsts.orderBy("part").collect()]
    kind = dict(rows.dtypes)["doc_id"]
    ends = [(first, starts[i - 1][0]) for i, (_, first) in enumerate(starts)]
    earlier = spark.createDataFrame(ends, f"first {kind}, before int")
    spread = rows.join(F.broadcast(earlier), F.col("doc_id").eqNullSafe(F.col("first")), "left").select(
        "doc_id", "text",
        F.inline(F.filter(F.array(
            F.struct(place.cast("int").alias("part"), F.lit(0).alias("late")),
            F.struct(F.col("before").alias("part"), F.lit(1).alias("late")),
        ), lambda x: x["part"].isNotNull())),
    )
    dealt = spread.repartition("part").sortWithinPartitions("part", "late", F.col("doc_id").asc_nulls_first(), "text")
    return dealt.mapInArrow(
        _pairs, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, common_prefix bigint"
    )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by interval; each own row is paired with the row after it, own or copied."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix"]
    held = None
    kind = None
    for batch in batches:
        kind = kind or batch.schema.field("doc_id").type
        out = []
        for i in range(batch.num_rows):
            part, late = batch.column("part")[i].as_py(), batch.column("late")[i].as_py()
            if late and (held is None or held[0] != part):
                continue  # only the first copied row follows the last own row
            text = batch.column("text")[i].as_py()
            codes = codes_of(text)
            prefix = PrefixHash(codes)
            marks = sketch(prefix)
            if held is not None and held[0] == part:
                out.append(_compared(held, text, codes, marks))
            held = None if late else (part, batch.column("doc_id")[i].as_py(), text, codes, prefix, marks)
        if out:
            columns = list(zip(*out))
            types = [kind, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _compared(row: tuple, next_text: str, next_codes: np.ndarray, next_marks: np.ndarray) -> tuple:
    _, key, text, codes, prefix, marks = row
    cut = prefix.n // 4
    edited = text[: prefix.n - cut] + next_text[:cut]
    edited_prefix = PrefixHash(np.concatenate([codes[: prefix.n - cut], next_codes[:cut]]))
    edited_marks = sketch(edited_prefix)
    one, two = written(prefix, marks), written(edited_prefix, edited_marks)
    near = 1.0 if one == two else _likeness(marks, edited_marks)
    near_next = 1.0 if text == next_text else _likeness(marks, next_marks)
    digest = hashlib.sha256(edited.encode("utf-8")).hexdigest()
    return key, prefix.n, digest, one, two, near, near_next, prefix.common_extension(0, edited_prefix, 0)
