"""Quality rules against brute force: the base counts, the model, its slices, and the bands."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import quality

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    words, lines = words_of(text), (text or "").split("\n")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    dups = sum(bool(line.strip(SPACES)) and line in lines[:i] for i, line in enumerate(lines))
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dups, len(covered))
    return *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def entropies(rows, order=quality.ORDER):
    """Mean minus log probability per text, by modified Kneser-Ney with dictionaries."""
    seen = defaultdict(Counter)
    streams = []
    for text, lang in rows:
        s = " ".join(words_of(text)).replace("\x00", "�").replace("\x01", "�")
        s = "\x01" * (order - 1) + s if s else ""
        runs = [s[i : i + order] for i in range(len(s) - order + 1)]
        streams.append((lang or "", runs))
        seen[lang or ""].update(runs)
    levels = {}
    for lang, top in seen.items():
        counts = {order: top}
        for k in range(order - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        for k, c in counts.items():
            n = Counter(c.values())
            fitted = []
            for i in (1, 2, 3):
                d = i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i] if n[1] and n[i] else -1
                fitted.append(d if 0 <= d <= i else i / 2)
            contexts = defaultdict(lambda: [0, 0.0, 0])
            for g, m in c.items():
                at = contexts[g[:-1]]
                at[0] += m
                at[1] += fitted[min(m, 3) - 1]
                at[2] += 1
            levels[lang, k] = (c, fitted, contexts)

    def p(lang, g):
        c, fitted, contexts = levels[lang, len(g)]
        total, off, kinds = contexts[g[:-1]]
        own = (c[g] - fitted[min(c[g], 3) - 1]) / total
        return own + off / total * (p(lang, g[1:]) if len(g) > 1 else 1 / (kinds + 1))

    return [-sum(math.log(p(lang, g)) for g in runs) / len(runs) if runs else None for lang, runs in streams]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    parts = {"en": ["the", "of", "ti", "on", "er", "ing"], "de": ["der", "sch", "ung", "ein", "pf", "ß"]}
    rows = []
    for i in range(90):
        lang = ("en", "de", None)[i % 3]
        words = ["".join(rnd.choices(parts[lang or "en"], k=rnd.randint(1, 4))) for _ in range(rnd.randint(0, 120))]
        rows.append((i, " ".join(words).replace("onon", "on\n"), lang))
    rows += [(90, "same line\n\nsame line\n \nsame line \n" * 3, "en"), (91, "a b c d e x a b c d e y z w v u t s r q p o n m l k", "en")]
    rows += [(92, "zq#xj$kv|wq" * 60 + " QX" * 40, "en"), (93, "nul\x00 \x01 and \U0001f600 漢字 " + "w v " * 9, "de"), (94, None, "en"), (95, "", None), (95, "  ", None)]
    return rows


def test_judge_by_brute_force(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").repartition(5)
    expected = {(i, t): (base(t), e) for (i, t, _), e in zip(texts, entropies([(t, g) for _, t, g in texts]))}
    for entries in (quality.SLICE, 700):
        got = quality.judge(docs, entries=entries)
        assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
        rows = got.collect()
        assert len(rows) == len(texts)
        for r in rows:
            if r.doc_id == 95:
                assert r[1:8] == (0, 0, 0, 0, 0, True, False) and r.perplexity is None
                continue
            want, entropy = expected[next(k for k in expected if k[0] == r.doc_id)]
            assert r[1:7] == want, r.doc_id
            assert r.perplexity == (None if entropy is None else pytest.approx(math.exp(entropy), rel=1e-4))
            if want[5] or r.lower <= r.perplexity <= r.upper:
                assert r.kept != want[5]
            elif not r.lower / 3 < r.perplexity < r.upper * 3:
                assert not r.kept
        assert not next(r for r in rows if r.doc_id == 92).kept and sum(r.kept for r in rows) > 60


def test_counts_grow_with_every_text_and_are_merged(spark, texts, monkeypatch):
    docs = spark.createDataFrame([(t, g or "") for _, t, g in texts], "text string, lang string")
    monkeypatch.setattr(quality, "HELD", 50)
    got = {(r.lang, r.g): r.n for r in quality.count_grams(docs.repartition(3)).collect()}
    want = Counter()
    for _, text, lang in texts:
        s = " ".join(words_of(text)).replace("\x00", "�").replace("\x01", "�")
        s = "\x01" * 4 + s if s else ""
        want.update((lang or "", s[i : i + 5]) for i in range(len(s) - 4))
    assert got == dict(want)


def test_bands_are_medians(spark):
    rows = [("en", float(x), x * x + 4.0, 9, 50, 0) for x in (1.0, 1.1, 1.2, 1.3, 9.0)] + [("de", 2.0, 5.0, 9, 50, 0), ("de", 7.0, 0.0, 9, 5, 0)]
    table = spark.createDataFrame(rows, "lang string, entropy double, squares double, chars long, n_words long, n_repeat_words long")
    got = {r.lang: (r.lower, r.upper, r.off) for r in quality.bands(table, quality.Bands(2, 3, 0.01)).collect()}
    assert got["en"] == pytest.approx((1.2 - 2 * 0.14826, 1.2 + 3 * 0.14826, np.sqrt(4 + np.var([1.0, 1.1, 1.2, 1.3, 9.0]))))
    assert got["de"] == pytest.approx((1.99, 2.01, 1.0))


def test_odd_tables(odd_docs, no_docs):
    rows = quality.judge(odd_docs.withColumn("lang", F.col("lang"))).collect()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert len(rows) == 13 and len(by_id[None]) == 2 and by_id[4][0].n_words == 30_000 and by_id[4][0].n_repeat_words == 0
    assert by_id[6][0] == by_id[6][1] and {r.n_words for r in by_id[7]} == {2, 6} and by_id[8][0].base_failed
    assert quality.judge(no_docs).count() == 0


def test_one_very_long_word():
    found = quality.letters(["x" * 300_000, "", "a b"])
    h, text, stream, start = quality.gram_hashes(found, np.zeros(3, np.uint64))
    assert np.bincount(text).tolist() == [300_000, 0, 3] and found.first.tolist() == [0, 1, 1, 3] and len(np.unique(h)) == 5 + 3
