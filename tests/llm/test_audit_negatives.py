"""The filter audit and the hard negatives against brute force, and on odd tables."""

import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import audit, negatives


def flags(rows):
    """Failed filters per (doc_id, text): a set of letters."""
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append({
            letter for letter, fails in zip("ABCDE", (
                len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
                any(c in "#$%&*|" for c in text), i is not None and least[text] < i,
            )) if fails
        })
    return out


def audited(rows, good, toxic):
    failed, out = flags(rows), {}
    parts = defaultdict(list)
    for row, bad in zip(rows, failed):
        parts[row[2] or ""].append((row[0], bad))
    for part, members in parts.items():
        shares = defaultdict(int)
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                shares[letter] += sum(letter in bad and not bad & set(order[: step - 1]) for _, bad in members)
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [(i, bad) for i, bad in members if letter in bad and not bad & before]
                out[part, "".join(order), step] = (
                    sum(not bad & (before | {letter}) for _, bad in members), len(here), sum(letter in bad and bool(bad & before) for _, bad in members),
                    sum(bad == {letter} for _, bad in members), sum(i in good for i, _ in here), sum(i in toxic for i, _ in here), shares[letter],
                )
    return out


def test_audit_by_brute_force(spark, odd_docs, no_docs):
    labels = [(1, 1, 0), (3, 1, None), (3, 0, 1), (5, None, 1), (6, 1, 1), (None, 1, 1), (7, 0, 0), (9, 1, 0), (21, 1, 1)]
    rows = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    long = " ".join(f"w{i}" for i in range(120))
    rows += [(20, long, "en"), (21, long, "de"), (22, long.upper(), "en"), (23, "a " * 200, "fr"), (24, f"{long} $", ""), (20, long, "en"), (19, f"{long} ", "en")]
    more = odd_docs.select("doc_id", "text", "lang").union(spark.createDataFrame(rows[13:], "doc_id bigint, text string, lang string"))
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in audit.audit(more.withColumn("part", F.lit(1)), table).collect()}
    assert got == audited(rows, {1, 3, 6, 9, 21}, {3, 5, 6, 21}) and len(got) == 600 * 4
    assert audit.audit(no_docs, table).count() == 0
    assert {r.good_lost for r in audit.audit(more, table.limit(0)).collect()} == {0}


def test_no_repeat_is_cleared_by_small_sketches(spark, monkeypatch):
    monkeypatch.setattr(audit, "ROWS", 64)
    rows = [(i, f"text {i % 700}", "x") for i in range(1000)] + [(i, "same", "x") for i in range(1000, 1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    narrow = audit.narrow(docs, labels).cache()
    for n in (1500, 40 * audit.CAPACITY):
        left = audit.possible_repeats(narrow, n).collect()
        ids = [r.doc for r in left]
        assert len(ids) == len(set(ids)) and set(range(300)) | set(range(700, 1500)) <= set(ids) and len(ids) < 1150
    assert audit.moved_by_repeats(audit.possible_repeats(narrow, 1500)).agg(F.sum("n")).first()[0] == 799
    narrow.unpersist()


@pytest.mark.parametrize("shape", [(1, 1, 1), (64, 64, 64), (33, 65, 127), (5, 200, 40), (100, 0, 3), (130, 70, 36)])
def test_strassen_is_exact(shape):
    rnd = np.random.default_rng(3)
    n, k, m = shape
    for most in (1 << 8, 1 << 29):
        a, b = rnd.integers(-most, most, (n, k)), rnd.integers(-most, most, (k, m))
        assert (negatives.strassen(a, b, 8) == a @ b).all()


def mined(rows, positives=5, count=5):
    rows = [(i, (y + 1) % 10 if i % 7 == 0 else y, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, y, v in rows]
    out = []
    for i, y, v in rows:
        if i % 100:
            continue
        scored = sorted((-int(v @ w), j, z) for j, z, w in rows if j != i)
        for s, p, _ in [x for x in scored if x[2] == y][:positives]:
            window = [(t, j) for t, j, z in scored if z != y and 80 * -s <= 100 * -t <= 100 * -s][:count]
            out += [(i, p, rank, j, -s, -t) for rank, (t, j) in enumerate(window, 1)]
    return sorted(out)


def test_negatives_by_brute_force(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, int(rnd.integers(0, 3)), [float(np.float32(x)) for x in rnd.normal(size=9) * 0.2]) for i in range(-200, 700)]
    rows += [(i, 1, rows[3][2]) for i in range(700, 900)]
    odd = [(1000, None, rows[0][2]), (1100, 1, None), (1200, 1, [float("nan")] * 9), (1300, 1, [float("inf")] * 9), (1400, 1, [None] * 9), (None, 1, rows[0][2])]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, label int, embedding array<float>").withColumn("row", F.lit("clash")).withColumn("id", F.lit("clash"))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))

    def run(df, **sizes):
        return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("id") % 100 == 0, label=shifted, **sizes).collect())

    expected = mined(rows)
    assert len(expected) > 50 and run(table, anchors=4, candidates=64) == expected == run(table.repartition(3))
    assert run(table.limit(0)) == []


def test_negatives_of_repeated_and_short_rows(spark):
    rows = [(0, 1, [1.0, 1.0]), (0, 1, [1.0, 1.0]), (1, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.9, 0.0, 5.0]), (3, 2, []), (4, 1, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    got = [tuple(r) for r in negatives.hard_negatives(table, F.col("id") % 100 == 0).collect()]
    near, one = 256 * 230, 256 * 256
    assert sorted(got) == sorted([(0, 1, 1, 2, one, near)] * 2 + [(0, 4, 1, 3, 0, 0)])
    with pytest.raises(Exception, match="too long"):
        negatives.hard_negatives(table.withColumn("embedding", F.array(F.lit(3e6), F.lit(0.0))), F.col("id") == 0).collect()
