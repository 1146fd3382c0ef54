"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib

import corpus_pipeline
import pytest
from souk.llm import bpe, chats, fingerprint, leaks, lines, minhash, pages, repeats, secrets, toxicity
from souk.llm.queries import vocabulary
from souk.session import scratch_path

EMPTY = hashlib.sha256(b"").hexdigest()


def by_id(df, *columns):
    out = {}
    for row in df.collect():
        out.setdefault(row[df.columns[0]], []).append(tuple(row[c] for c in columns))
    return out


def test_bpe(odd_docs, no_docs):
    got = by_id(bpe.bpe_digests(odd_docs, vocabulary()), "n_tokens", "ids_sha256", "decoded_sha256")
    assert got[2] == got[3] == got[8] == [(0, EMPTY, EMPTY)] and len(got[None]) == 2 and got[4] == got[5] and len(got[6]) == 2
    assert bpe.bpe_digests(no_docs, vocabulary()).count() == 0
    texts = by_id(bpe.decode(bpe.encode(odd_docs.filter("doc_id in (1, 2, 9)"), vocabulary()), vocabulary()), "text")
    assert texts[1] == [("one two three four five six seven eight ",)] and texts[2] == [("",)]


def test_repeats(odd_docs, no_docs):
    got = by_id(repeats.remove_repeats(odd_docs), "n_words", "n_removed", "kept_sha256")
    assert sum(map(len, got.values())) == 13 and got[2] == got[3] == got[8] == [(0, 0, EMPTY)]
    assert got[4][0][1] == 0 and got[5] == [(30_000, 30_000, EMPTY)] and got[6] == [got[6][0]] * 2
    assert repeats.remove_repeats(no_docs).count() == 0


def test_secrets(spark, odd_docs, no_docs):
    got = by_id(secrets.secrets_by_row(odd_docs, scratch_path(spark, "ledger")), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert sum(map(len, got.values())) == 13 and got[2] == [(0, 0, 0, EMPTY, "")] and len(got[None]) == 2
    assert secrets.secrets_by_row(no_docs, scratch_path(spark, "ledger")).count() == 0


def test_fingerprints(odd_docs, no_docs):
    got = by_id(fingerprint.fingerprints(odd_docs), "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next")
    assert sum(map(len, got.values())) == 13 and got[4][0][2] == got[5][0][2] and got[4][0][4] == 1.0
    assert all(0 <= x <= 1 for rows in got.values() for r in rows for x in r[3:])
    assert fingerprint.fingerprints(no_docs).count() == 0
    assert by_id(fingerprint.fingerprints(odd_docs.filter("doc_id = 1")), "near_next")[1] == [(1.0,)]


def test_lines(odd_docs, no_docs):
    got = by_id(lines.line_digests(odd_docs, sites=2, shortest=4), "n_lines", "n_removed", "kept_sha256")
    assert got[2] == got[3] == [(0, 0, EMPTY)] and got[4][0][1] == 0 and got[5] == [(1, 1, EMPTY)] and len(got[None]) == 2
    assert lines.line_digests(no_docs).count() == 0


def test_toxicity(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (3, None), (3, 0), (3, 0)], "doc_id bigint, toxic int")
    for docs, known in ((odd_docs, labels), (odd_docs, labels.limit(0)), (no_docs, labels)):
        grammar, curve = toxicity.learn(docs, known)
        rows = toxicity.score(docs, grammar, curve).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)


def test_minhash(odd_docs, no_docs):
    got = by_id(minhash.near_duplicates(odd_docs, k=3, percent=85), "n_shingles", "component_id", "kept")
    assert got[2] == [(0, 2, True)] and got[5][0][1:] == (4, False) and got[6] == [(1, 6, True)] * 2 and len(got[None]) == 2
    assert all(c is None and kept for _, c, kept in got[None]) and {n for n, _, _ in got[7]} == {1, 4}
    assert minhash.near_duplicates(no_docs).count() == 0


def test_leaks(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, "one two three four five six seven eight"), (2, None), (None, "one two three four five six seven eight"), (3, ""), (4, "two three")] * 2,
        "item_id bigint, text string",
    )
    got = leaks.leaks(odd_docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(1, 1, 0), (1, 4, 0)]
    assert leaks.leaks(no_docs, items).count() == leaks.leaks(odd_docs, items.limit(0)).count() == 0
    assert leaks.remove_leaking(odd_docs, items).count() == 12


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, None, "<p>text</p>"), (3, "u", "plain"), (3, "u", "plain"), (4, "u", "<div>" * 3000 + "deep"), (5, "u", "<b><p>&am")]
    got = by_id(pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")), "text", "n_chars")
    assert got[1] == got[2] == [("", 0)] and got[3] == [("plain", 5)] * 2 and got[None] == [("text", 4)] and got[4] == [("deep", 4)] and got[5] == [("&am", 3)]


def test_chats(spark):
    rows = [
        (1, 0, "user", "q" * 80), (1, 1, "assistant", "answer"), (1, 2, "user", None), (1, 0, "user", "q" * 80), (None, 1, "user", "x"), (2, None, "user", "x"),
        (2, 0, None, "x"), (3, 0, "user", ""), (1, 4, "user", "z" * 70),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.call_id: r for r in chats.format_chats(table).collect()}
    assert set(got) == {"c1-0", "c1-2", "c1-4", "c3-0"} and got["c1-0"].linked and not got["c1-4"].linked
    assert got["c1-0"].valid and not got["c1-2"].valid and (got["c1-0"].level, got["c1-4"].level) == (0, 1)
    assert chats.format_chats(table.limit(0)).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, odd_docs, no_docs, tmp_path, name, stage):
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight"), (None, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, odd_docs, str(tmp_path))
    left = out.count()
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == odd_docs.columns
    assert left == {"toxicity": 13, "line_dedup": 13, "minhash_near_dedup": 12, "decontamination": 12, "bpe": 13}[name]
    assert stage(spark, no_docs, str(tmp_path)).count() == 0
