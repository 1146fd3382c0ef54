"""Quality rules: simple counts per document, and bands of n-gram perplexity per language.

The language model is modified Kneser-Ney over runs of ``ORDER`` characters, one per value of the language column, counted by
Spark over every text.

1. **Counts.** Tasks sort the n-gram hashes of their texts, add up equal ones and send each n-gram once with its count;
   Spark sums them. Contexts and continuation counts follow by aggregations over distinct n-grams.
2. **Model.** Each level is interpolated with the one below by joins, so every n-gram that the corpus holds ends with its
   own probability and needs no back-off. Hashes and logarithms are stored in ``slices`` of sorted arrays of at most about
   ``SLICE`` entries: one slice at a time is broadcast, and a text's logarithms add up over the slices.
3. **Bands.** Per language, the median of the documents' cross-entropy and the median deviation from it give a lower and an
   upper bound. Both come from counts per bin, so no task holds all documents of a language. A text is out of its band if it
   is so by more than its own standard error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import written
from souk.llm.words import GROUP, WordHasher, constants, grams, mixed

#: Characters of an n-gram.
ORDER = 5
#: The character before a text, and the one that stands for it and NUL where a text holds them.
PAD, OTHER = 1, 0xFFFD
#: Distinct n-grams that a task holds before it sends them, and entries of a model slice: 12 bytes each when broadcast.
HELD, SLICE = 1 << 20, 1 << 22
#: Words of a window, fewest words, and most words in repeated windows (percent).
WINDOW, FEWEST, REPEATED = 5, 10, 20
SYMBOLS = "#*$%&|<>"
#: Bins per nat of cross-entropy.
BINS = 1000
#: Parts into which a language's n-grams are dealt to meet its discounts.
SALT = 64


@dataclass(frozen=True)
class Bands:
    """Deviations (scaled medians) below and above the median that are kept, the least half-width in nats, and the standard
    errors by which a short text may be farther off: its mean is uncertain by the deviation of a character over the root of
    their number."""

    below: float = 3.0
    above: float = 3.0
    least: float = 0.02
    errors: float = 1.0


def _strings(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Consecutive groups of texts of about ``GROUP`` bytes, with the row where each starts; null texts are empty."""
    texts = [t or "" for t in column.to_pylist()]
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= GROUP):
            size += len(texts[stop])
            stop += 1
        yield at, texts[at:stop]
        at = stop


@dataclass
class Letters:
    """The words of a group of texts: letters, where words begin among them, and the word at which each text starts."""

    codes: np.ndarray
    begins: np.ndarray
    first: np.ndarray

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of one value per letter."""
        sums = np.append(0, np.cumsum(values))
        return np.diff(sums[np.append(self.begins, len(self.codes))[self.first]])


def letters(texts: list[str]) -> Letters:
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = (codes != 32) & ((codes < 9) | (codes > 13))
    starts = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    before = np.cumsum(inside) - inside
    return Letters(codes[inside], before[starts], np.append(0, np.searchsorted(starts, ends)))


def gram_hashes(found: Letters, salts: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, text, stream, start)`` of every run of ``order`` characters of texts whose words are joined by one space.

    A text begins with ``order - 1`` pads, so each of its characters ends one n-gram. ``salts`` has a value per text.
    """
    n_words = np.diff(found.first)
    held = np.flatnonzero(n_words)
    gap = np.ones(len(found.begins), np.int64)
    gap[found.first[held]] = order - 1
    places = np.cumsum(gap) + found.begins
    stream = np.full(len(found.codes) + int(gap.sum()), 32, np.uint32)
    sizes = np.diff(np.append(found.begins, len(found.codes)))
    stream[np.arange(len(found.codes)) + np.repeat(places - found.begins, sizes)] = np.where(found.codes <= PAD, OTHER, found.codes)
    opening = places[found.first[held]]
    for back in range(1, order):
        stream[opening - back] = PAD
    ends = np.flatnonzero(stream != PAD)
    text = np.repeat(held, np.diff(np.append(opening, len(stream) + order - 1)) - order + 1)
    start = ends - order + 1
    values, total = mixed(stream.astype(np.uint64)), np.zeros(len(stream), np.uint64)
    for i, factor in enumerate(constants(order, 53)):
        total[: len(stream) - i] += values[i:] * factor
    return mixed(total[start] ^ salts[text]), text, stream, start


def salt(lang: str) -> int:
    """A language's part of the hash."""
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _salts(langs: list[str | None]) -> np.ndarray:
    known = {lang: salt(lang or "") for lang in set(langs)}
    return np.array([known[lang] for lang in langs], np.uint64)


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts, and where runs of equal hashes start in it."""
    order = np.argsort(hashes)
    ranked = hashes[order]
    return order, np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])


class _Counter:
    """Distinct n-grams of a task: hash, count, characters and language; sent and dropped when there are ``HELD``."""

    def __init__(self):
        self._parts, self._n = [], 0

    def add(self, hashes: np.ndarray, counts: np.ndarray, codes: np.ndarray, langs: np.ndarray) -> Iterator[pa.RecordBatch]:
        self._parts.append((hashes, counts, codes, langs))
        self._n += len(hashes)
        if self._n >= HELD:
            self._merge()
            if self._n >= HELD // 2:
                yield from self.send()

    def _merge(self) -> None:
        hashes, counts, codes, langs = (np.concatenate(x) for x in zip(*self._parts))
        order, starts = _grouped(hashes)
        first = order[starts]
        self._parts = [(hashes[first], np.add.reduceat(counts[order], starts), codes[first], langs[first])]
        self._n = len(first)

    def send(self) -> Iterator[pa.RecordBatch]:
        if self._n:
            self._merge()
            (_, counts, codes, langs), = self._parts
            self._parts, self._n = [], 0
            text = np.ascontiguousarray(codes).view(f"<U{codes.shape[1]}").ravel()
            for at in range(0, len(text), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs[part], pa.string()), pa.array(text[part].tolist(), pa.string()), pa.array(counts[part])], ["lang", "g", "n"]
                )


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, g, n)``: every n-gram of ``(text, lang)`` rows and how often it comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            salts, names = _salts(langs), np.array([lang or "" for lang in langs], object)
            for row, texts in _strings(batch.column("text")):
                hashes, text, stream, start = gram_hashes(letters(texts), salts[row : row + len(texts)], order)
                if not len(hashes):
                    continue
                by_hash, starts = _grouped(hashes)
                first = by_hash[starts]
                counts = np.diff(np.append(starts, len(hashes)))
                codes = stream[start[first][:, None] + np.arange(order)[None, :]]
                yield from counter.add(hashes[first], counts, codes, names[row + text[first]])
        yield from counter.send()

    return docs.mapInArrow(run, "lang string, g string, n bigint").groupBy("lang", "g").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """``(lang, salt, d1, d2, d3)``: what is taken from counts of one, two, and three or more."""
    of = {i: F.sum((F.col("n") == i).cast("double")) for i in (1, 2, 3, 4)}
    counts = level.groupBy("lang").agg(*[of[i].alias(f"n{i}") for i in of])
    share = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def amount(i: int) -> Column:
        fitted = i - (i + 1) * share * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        return F.when((F.col("n1") > 0) & fitted.between(0, i), fitted).otherwise(i / 2)  # too few n-grams to tell

    return counts.select(
        "lang", *[amount(i).alias(f"d{i}") for i in (1, 2, 3)], F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    )


def _level(counts: DataFrame, below: DataFrame | None, k: int) -> DataFrame:
    """``(lang, g, p)`` for the n-grams of ``k`` characters; ``below`` has those of ``k - 1``."""
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("g"), F.lit(SALT)).cast("int")).join(_discounts(counts), ["lang", "salt"])
    off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    context = Window.partitionBy("lang", F.substring("g", 1, k - 1))
    share = salted.select("lang", "g", (F.col("n") - off).alias("left"), off.alias("off"), "n").select(
        "lang", "g", (F.col("left") / F.sum("n").over(context)).alias("own"), (F.sum("off").over(context) / F.sum("n").over(context)).alias("rest"),
        F.count(F.lit(1)).over(context).alias("kinds"),
    )
    if below is None:  # below single characters all known ones and one unknown are alike
        return share.select("lang", "g", (F.col("own") + F.col("rest") / (F.col("kinds") + 1)).alias("p"))
    shorter = below.select("lang", F.col("g").alias("end"), F.col("p").alias("p_below"))
    return share.withColumn("end", F.substring("g", 2, k - 1)).join(shorter, ["lang", "end"]).select(
        "lang", "g", (F.col("own") + F.col("rest") * F.col("p_below")).alias("p")
    )


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, g, p)`` of the n-grams counted: modified Kneser-Ney, interpolated down to single characters."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):  # kinds of characters that come before
        levels[k] = written(levels[k + 1].groupBy("lang", F.substring("g", 2, k).alias("g")).agg(F.count(F.lit(1)).alias("n")), f"grams{k}")
    p = None
    for k in range(1, order + 1):
        p = _level(levels[k], p, k)
    return p


@dataclass
class Model:
    """The stored model: a table of ``(slice, h, logp)`` and its number of slices."""

    table: DataFrame
    slices: int

    def arrays(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """One slice as sorted hashes and their logarithms."""
        part = self.table.filter(F.col("slice") == i).select("h", "logp").toArrow()
        hashes, logs = part.column("h").to_numpy().view(np.uint64), part.column("logp").to_numpy()
        order = np.argsort(hashes)
        return hashes[order], logs[order]


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int32)


def train(docs: DataFrame, order: int = ORDER, entries: int = SLICE) -> Model:
    """The model of ``(text, lang)`` rows, with as many slices as its n-grams need."""
    counts = written(count_grams(docs, order), "grams")
    slices = max(1, -(-counts.count() // (entries * 9 // 10)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = constants(order, 53)
        for batch in batches:
            codes = np.array(batch.column("g").to_pylist(), f"<U{order}").view(np.uint32).reshape(-1, order)
            total = (mixed(codes.astype(np.uint64)) * factors[None, :]).sum(axis=1, dtype=np.uint64)
            h = mixed(total ^ _salts(batch.column("lang").to_pylist()))
            logs = np.log(batch.column("p").to_numpy()).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(slice_of(h, slices)), pa.array(h.view(np.int64)), pa.array(logs)], ["slice", "h", "logp"])

    table = kneser_ney(counts, order).mapInArrow(run, "slice int, h bigint, logp float")
    return Model(written(table, "model"), slices)


def log_sums(texts: list[str], salts: np.ndarray, hashes: np.ndarray, logs: np.ndarray, order: int = ORDER) -> dict[str, np.ndarray]:
    """Per text, the sum of the logarithms that a slice holds, the sum of their squares, and the number of characters."""
    h, text, _, _ = gram_hashes(letters(texts), salts, order)
    sums, squares, n = np.zeros(len(texts)), np.zeros(len(texts)), np.bincount(text, minlength=len(texts))
    if len(h) and len(hashes):
        by_hash, starts = _grouped(h)
        kinds = h[by_hash[starts]]
        at = np.minimum(np.searchsorted(hashes, kinds), len(hashes) - 1)
        each = np.repeat(np.where(hashes[at] == kinds, logs[at], 0).astype(np.float64), np.diff(np.append(starts, len(h))))
        values = np.empty(len(h))
        values[by_hash] = each
        sums, squares = np.bincount(text, values, len(texts)), np.bincount(text, values * values, len(texts))
    return {"logp": sums, "logp2": squares, "chars": n}


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    return len(lines) - len(set(lines))


def _repeat_words(hashes: np.ndarray, first: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Per text, the words in windows that come twice or more in it."""
    n = len(hashes) - width + 1
    out = np.zeros(len(first) - 1, np.int64)
    if n <= 0:
        return out
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.flatnonzero(text[:n] == text[width - 1 :])
    keys = mixed(grams(hashes, width)[whole] ^ mixed(text[whole].astype(np.uint64) + np.uint64(1)))
    order, starts = _grouped(keys)
    sizes = np.diff(np.append(starts, len(keys)))
    again = whole[order[np.repeat(sizes > 1, sizes)]]
    marks = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(marks, again, 1)
    np.add.at(marks, again + width, -1)
    return out + np.bincount(text, np.cumsum(marks[:-1]) > 0, len(out)).astype(np.int64)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_IS_SYMBOL = np.isin(np.arange(128), [ord(c) for c in SYMBOLS])


def base_counts(texts: list[str]) -> dict[str, np.ndarray]:
    """The five counts of the base rules, per text."""
    found = letters(texts)
    hashes, first = WordHasher().hash([t.encode() for t in texts])
    symbols = _IS_SYMBOL[np.minimum(found.codes, 127)] & (found.codes < 127)
    return {
        "n_words": np.diff(found.first), "word_chars": found.per_text(np.ones(len(found.codes), np.int64)), "n_symbols": found.per_text(symbols),
        "n_dup_lines": np.array([_dup_lines(t) for t in texts], np.int64), "n_repeat_words": _repeat_words(hashes, first),
    }


def _score(model: Model, i: int, rows: DataFrame, order: int) -> DataFrame:
    """Logarithms of slice ``i`` per row, and the base counts with the first slice."""
    arrays = rows.sparkSession.sparkContext.broadcast(model.arrays(i))
    names = ["logp", "logp2", *([*_COUNTS, "chars"] if i == 0 else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salts, parts = _salts(batch.column("lang").to_pylist()), []
            for row, texts in _strings(batch.column("text")):
                sums = log_sums(texts, salts[row : row + len(texts)], *arrays.value, order)
                parts.append(sums | base_counts(texts) if i == 0 else sums)
            if parts:
                columns = [batch.column(c) for c in ("doc_id", "lang", "th")]
                columns += [pa.array(np.concatenate([p[c] for p in parts]).astype(np.float64 if c in names[:2] else np.int64)) for c in names]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "th", *names])

    types = "".join(f", {c} {'double' if c in names[:2] else 'bigint'}" for c in names)
    return rows.mapInArrow(run, f"doc_id bigint, lang string, th bigint{types}")


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER) -> DataFrame:
    """Per row: ``doc_id``, ``lang``, the base counts, ``chars``, ``entropy``, the mean of minus the logarithm, and ``squares``, that of
    its square (both null without words)."""
    rows = _texts(docs, key, text, lang).withColumn("th", F.xxhash64("text") if model.slices > 1 else F.lit(0).cast("bigint"))
    out = written(_score(model, 0, rows, order), "scored")
    for i in range(1, model.slices):  # equal rows have equal sums
        more = _score(model, i, rows, order).groupBy("doc_id", "lang", "th").agg(F.max("logp").alias("logp"), F.max("logp2").alias("logp2"))
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("doc_id", "lang", "th")]
        joined = out.alias("a").join(more.alias("b"), same[0] & same[1] & same[2])
        added = {c: (F.col(f"a.{c}") + F.col(f"b.{c}")).alias(c) for c in ("logp", "logp2")}
        out = written(joined.select(*[added.get(c, F.col(f"a.{c}")) for c in out.columns]), "scored")
    return out.select(
        "doc_id", "lang", *_COUNTS, "chars", F.try_divide(-F.col("logp"), F.col("chars")).alias("entropy"),
        F.try_divide("logp2", F.col("chars")).alias("squares"),
    )


def _texts(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"))


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))


def _median(bins: DataFrame, value: str) -> DataFrame:
    """``(lang, value)``: the lower median of counted whole numbers."""
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy(value))
    whole = F.sum("n").over(Window.partitionBy("lang"))
    return bins.groupBy("lang", value).agg(F.sum("n").alias("n")).select("lang", value, upto.alias("upto"), whole.alias("whole")).filter(
        2 * F.col("upto") >= F.col("whole")
    ).groupBy("lang").agg(F.min(value).alias(value))


def bands(rows: DataFrame, width: Bands = Bands()) -> DataFrame:
    """``(lang, lower, upper, off)``: bounds of the cross-entropy of the rows that pass the base rules, and the deviation of a character."""
    bins = rows.filter(~base_failed()).groupBy("lang", F.round(F.col("entropy") * BINS).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    middle = _median(bins, "bin").withColumnRenamed("bin", "middle")
    spread = _median(bins.join(middle, "lang").select("lang", F.abs(F.col("bin") - F.col("middle")).alias("away"), "n"), "away")

    def half(times: float) -> Column:
        return F.greatest(F.lit(width.least), F.lit(times * 1.4826 / BINS) * F.col("away"))

    def mean(column: str) -> Column:
        return F.sum(F.col(column) * F.col("chars")) / F.sum("chars")

    each = rows.filter(~base_failed()).groupBy("lang").agg(F.sqrt(F.greatest(F.lit(0.0), mean("squares") - mean("entropy") ** 2)).alias("off"))
    return middle.join(spread, "lang").join(each, "lang").select(
        "lang", (F.col("middle") / BINS - half(width.below)).alias("lower"), (F.col("middle") / BINS + half(width.above)).alias("upper"), "off"
    )


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", width: Bands = Bands(), order: int = ORDER, entries: int = SLICE
) -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed``, ``kept``, ``perplexity`` and its language's bounds.

    A row is kept if it passes the base rules and its perplexity per character is within its language's band, or outside by no more
    than ``width.errors`` of its own standard errors. A null text
    counts as empty, has no perplexity and fails the base rules; a null language counts as the empty one. Repeated rows and
    ids are judged row by row, an empty table gives no rows, and other columns are not read.
    """
    model = train(_texts(docs, key, text, lang).select("text", "lang"), order, entries)
    rows = scored(docs, model, key, text, lang, order)
    bounds = bands(rows, width).select("lang", "lower", "upper", "off", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "entropy"), F.lit(SALT)).cast("int"))
    error = F.try_divide(width.errors * F.col("off"), F.sqrt("chars"))
    inside = F.col("entropy").between(F.col("lower") - error, F.col("upper") + error)
    return dealt.join(bounds, ["lang", "salt"], "left").select(
        "doc_id", *_COUNTS, base_failed().alias("base_failed"), (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp("entropy").alias("perplexity"), F.exp("lower").alias("lower"), F.exp("upper").alias("upper"),
    )
