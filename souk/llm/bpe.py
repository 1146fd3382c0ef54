"""Byte-pair encoding as a streaming transducer with a bounded lookahead, and decoding as a state machine.

**Lookahead.** In a merge list where no merge precedes the ones that make its parts, text that follows can
change earlier token borders only through a chain of merges of rising rank: a merge that takes (or does not
take) the token right of a border frees (or binds) the token left of it, which is then the start of the right
part of a later merge. ``sufficient_lookahead`` finds the longest such chain over the merge list. A border at
least that many symbols before the end of what has been read is final, so its tokens go out at once and the
buffer never holds more than the lookahead plus one chunk.

**Decoding** turns ids to bytes and bytes to text piece by piece; an unfinished UTF-8 sequence is the only state.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import itertools
import json
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import map_batches

#: Characters read at a time, and symbols added to the transducer's buffer at a time.
BLOCK = 1 << 16
CHUNK = 4096
#: Words whose ids a task keeps, in two halves of which the older is dropped, and the longest (in characters) that it keeps.
MEMORY, KEPT = 1 << 19, 48
#: Symbols up to which a list is merged by scanning, and beyond by a heap.
SHORT = 48


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = itertools.count(0x100)
    shown = set(plain)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Decoder:
    """Ids to text, a few at a time: ``feed`` gives the text that is complete, ``close`` the rest."""

    def __init__(self, pieces: dict[int, bytes], separator: bytes = b""):
        self._pieces, self._separator, self._begun = pieces, separator, False
        self._text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        new = self._separator.join(map(self._pieces.__getitem__, ids))
        if new and self._separator:
            if self._begun:
                new = self._separator + new
            self._begun = True
        return self._text.decode(new)

    def close(self) -> str:
        return self._text.decode(b"", final=True)


class Bpe:
    """A byte-level BPE model read from a ``tokenizers`` JSON file (normaliser: NFC, white space, lower case)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError(f"{path} is not a plain BPE model")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self._load_merges(model["merges"])
        self._load_text_rules(spec)
        letters = byte_alphabet()
        self._symbol = [self.vocab[letter] for letter in letters]
        self._last = [self.vocab[letter + self.suffix] for letter in letters]
        self._memory: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self.pieces = {i: token.encode() for token, i in self.vocab.items()} | {i: s.encode() for s, i in self.special.items()}

    def _load_merges(self, merges: list) -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        made: dict[str, int] = {}
        self._merge: dict[tuple[int, int], int] = {}  # rank and new id in one number
        for rank, (left, right) in enumerate(pairs):
            made[left + right] = rank
            self._merge[self.vocab[left], self.vocab[right]] = rank << 32 | self.vocab[left + right]
        if any(made.get(part, -1) >= rank for rank, pair in enumerate(pairs) for part in pair):
            raise ValueError("a merge precedes the merge that makes its part, so no lookahead is sufficient")

    def _load_text_rules(self, spec: dict) -> None:
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._words = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None

    def _symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            body = token[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    @functools.cached_property
    def lookahead(self) -> int:
        """Symbols after which a border can no longer move: the longest chain of merges, from the last rank down."""
        longest: dict[str, int] = {}
        most, names = 1, {i: token for token, i in self.vocab.items()}
        pairs = ((names[a], names[b]) for a, b in self._merge)  # from the first rank on
        for left, right in reversed(list(pairs)):
            reach = len(self._symbols(left)) + longest.get(left, 0)
            most = max(most, reach)
            start = ""
            for symbol in self._symbols(right):
                start += symbol
                if longest.get(start, 0) < reach:
                    longest[start] = reach
        return most

    def _merged(self, ids: list[int]) -> list[int]:
        """All merges, lowest rank first and left before right, over one list of symbols."""
        if len(ids) <= SHORT:
            return self._merged_short(ids)
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(found, i, *pair) for i, pair in enumerate(itertools.pairwise(ids)) if (found := self._merge.get(pair)) is not None]
        heapq.heapify(heap)
        end, ids, gone = len(ids), ids[:], -1
        while heap:
            found, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= end or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = found & 0xFFFFFFFF, gone, after[j]
            if after[i] < end:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < end and (found := self._merge.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (found, a, ids[a], ids[b]))
        return [x for x in ids if x != gone]

    def _merged_short(self, ids: list[int]) -> list[int]:
        """The same for a short list: one rank per pair, of which a merge changes two."""
        get, none = self._merge.get, 1 << 62
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            new = best & 0xFFFFFFFF
            ids[at : at + 2] = [new]
            del ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], new), none)
            if at < len(ranks):
                ranks[at] = get((new, ids[at + 1]), none)
        return ids

    @functools.cached_property
    def _length(self) -> dict[int, int]:
        return {i: len(self._symbols(token)) for token, i in self.vocab.items()}

    def transduce(self, word: str) -> Iterator[list[int]]:
        """Ids of one word of any length, in lists that go out as soon as their borders are final."""
        data = word.encode()
        if not data:
            return
        held: list[int] = []
        for start in range(0, len(data), CHUNK):
            chunk = data[start : start + CHUNK]
            held += [self._symbol[b] for b in chunk]
            if start + CHUNK >= len(data):
                held[-1] = self._last[data[-1]]
                yield self._merged(held)
                return
            final, used, tokens = len(held) - self.lookahead, 0, []
            for token in self._merged(held):
                if used + self._length[token] > final:
                    break
                used += self._length[token]
                tokens.append(token)
            held = held[used:]
            yield tokens

    def _recall(self, words: list[str]) -> set[str]:
        """Bring the ids of these words into memory, each from the transducer or from the older half; returns those too long for it."""
        if len(self._memory) > MEMORY // 2:
            self._older, self._memory = self._memory, {}
        memory, older = self._memory, self._older
        missing = set(words).difference(memory)
        long = {word for word in missing if len(word) > KEPT}
        for word in missing - long if long else missing:
            memory[word] = older.get(word) or tuple(itertools.chain.from_iterable(self.transduce(word)))
        return long

    def _blocks(self, text: str) -> Iterator[str]:
        """Parts that end before an ASCII space, which nothing composes or joins across."""
        at = 0
        while at < len(text):
            end = at + BLOCK
            if end < len(text):
                end = text.find(" ", end)
                end = len(text) if end < 0 else end
            yield text[at:end]
            at = end

    def _plain(self, text: str) -> Iterator[list[int]]:
        for block in self._blocks(text):
            if not block.isascii():
                block = unicodedata.normalize("NFC", block).replace("Σ", "σ")  # no final form of sigma
            words = self._words.findall(block.lower())
            long, memory = self._recall(words), self._memory
            if not long:
                yield list(itertools.chain.from_iterable(map(memory.__getitem__, words)))
                continue
            for word in words:
                if word in long:
                    yield from self.transduce(word)
                else:
                    yield list(memory[word])

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of a whole text in bounded lists; special tokens are found in the raw text."""
        for part in self._special.split(text) if self._special else [text]:
            if part in self.special:
                yield [self.special[part]]
            elif part:
                yield from self._plain(part)

    def encode(self, text: str) -> list[int]:
        return list(itertools.chain.from_iterable(self.stream(text)))

    def decoder(self) -> Decoder:
        """Tokens as the vocabulary spells them, joined by one space: the file names no decoder of its own."""
        return Decoder(self.pieces, b" ")

    def text_decoder(self) -> Decoder:
        """Readable text: vocabulary characters back to bytes, word ends to spaces."""
        back = {letter: bytes([b]) for b, letter in enumerate(byte_alphabet())}

        def piece(token: str) -> bytes:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            return b"".join(back[c] for c in body) + (b" " if ends else b"")

        return Decoder({i: piece(t) for t, i in self.vocab.items()} | {i: s.encode() for s, i in self.special.items()})

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids and SHA-256 of the ids and of the decoded text, each fed list by list."""
        n, ids_sum, text_sum, decoder = 0, hashlib.sha256(), hashlib.sha256(), self.decoder()
        for ids in self.stream(text):
            if ids:
                ids_sum.update(((" " if n else "") + " ".join(map(str, ids))).encode())
                text_sum.update(decoder.feed(ids).encode())
                n += len(ids)
        text_sum.update(decoder.close().encode())
        return n, ids_sum.hexdigest(), text_sum.hexdigest()


def encode(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids array<int>`` of each row's whole text; a null or empty text has no ids.

    ``path`` is the vocabulary file, which every executor must be able to open.
    """
    kept = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c != "_text") + ", ids array<int>"

    def start():
        model = Bpe(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = pa.array([model.encode(t.as_py()) for t in batch.column("_text")], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"])

        return step

    return map_batches(kept, start, schema)


def decode(df: DataFrame, path: str, ids: str | Column = "ids", keep: tuple[str, ...] = ("doc_id",), readable: bool = True) -> DataFrame:
    """``keep`` columns and the decoded ``text``; null ids give an empty text."""
    kept = df.select(*keep, F.coalesce(F.col(ids) if isinstance(ids, str) else ids, F.array().cast("array<int>")).alias("_ids"))
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c != "_ids") + ", text string"

    def start():
        model = Bpe(path)

        def one(row: list[int]) -> str:
            decoder = model.text_decoder() if readable else model.decoder()
            return decoder.feed(row) + decoder.close()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = pa.array([one(x.as_py()) for x in batch.column("_ids")], pa.string())
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*batch.schema.names[:-1], "text"])

        return step

    return map_batches(kept, start, schema)


def bpe_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of the whole text.

    A null text counts as empty: no ids, and the digests of the empty string. Repeated rows give repeated rows,
    a null key stays null, other columns are ignored. Nothing is shuffled, and a task holds one batch of rows.
    """
    kept = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def start():
        model = Bpe(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [model.digest(t.as_py()) for t in batch.column("text")]
            n, ids, decoded = zip(*found)
            arrays = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    schema = f"doc_id {dict(kept.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(kept, start, schema)
