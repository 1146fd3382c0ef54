"""Cases in which an operator once did less than its whole job."""

import json
import random
import time
import zlib

from souk.llm import chats, leaks, lines, pages, queries, toxicity


def test_short_lines_on_many_sites_go(spark):
    rows = [(i, f"Read more\nown line {i}\n\n\r\n\t\nrare", f"s{i}") for i in range(12)] + [(20 + i, "Seldom", f"s{i}") for i in range(9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.remove_boilerplate(table).collect()}
    assert got[0] == "Read more\nown line 0\n\n\r\n\t\nrare"
    assert all(got[i] == f"own line {i}\n\n\r\n\t" for i in range(1, 12))
    assert all(got[20 + i] == "Seldom" for i in range(9))


WORDS = "This paragraph holds enough plain words to count as a part of the article, and it goes on for a while."


def test_marked_words_do_not_hide_the_article():
    for mark in ("layout with-sidebar", "has-sidebar", "no-sidebar", "withSidebar", "sidebar"):
        assert pages.main_text(f'<body><div class="{mark}"><p>{WORDS}</p><p>{WORDS}</p></div></body>').count(WORDS) == 2
    page = f"""<body><article><h1>Title</h1><p>{WORDS}</p><section id="discussion"><h2 id="related-work">Related work</h2><p>{WORDS} A</p></section>
    <h2 id="social-impact">Social impact</h2><p>{WORDS} B</p><div id="notice-of-meeting"><p>{WORDS} C</p></div><h2 id="discussion">Discussion</h2>
    <div class="share-buttons">Share</div><p>Go on <span class="ad">Buy</span> here.</p></article><div id="comments"><p>{WORDS} D</p></div></body>"""
    assert pages.main_text(page).split("\n\n") == [
        "Title", WORDS, "Related work", f"{WORDS} A", "Social impact", f"{WORDS} B", f"{WORDS} C", "Discussion", "Go on here.",
    ]
    assert pages.main_text(page.replace("article>", "div>")).split("\n\n")[2:4] == ["Related work", f"{WORDS} A"]


def test_region_holds_the_whole_cluster():
    for inner in ("section", "ul", "blockquote", "pre", "table", "div"):
        row = {"ul": "li", "table": "td"}.get(inner, "p")
        middle = "".join(f"<{row}>{WORDS} {i}</{row}>" for i in range(6))
        text = pages.main_text(f"<body><div><p>{WORDS} before</p><{inner}>{middle}</{inner}><p>{WORDS} after</p><p>Short end.</p></div></body>")
        assert f"{WORDS} before" in text and f"{WORDS} 5" in text and f"{WORDS} after" in text and "Short end." in text
    parts = [f"<article><p>{WORDS} {i}</p><p>{WORDS}</p><p>Short {i}.</p></article>" for i in range(2)]
    text = pages.main_text(f"<body>{parts[0]}<p>{WORDS} third</p>{parts[1]}<div>x</div></body>")
    assert all(x in text for x in (f"{WORDS} 0", f"{WORDS} 1", "Short 0.", "Short 1."))
    text = pages.main_text(f"<body><article><p>{WORDS} 0</p>{f'<p>{WORDS}</p>' * 5}</article><article><p>{WORDS} 1</p><p>{WORDS}</p></article></body>")
    assert f"{WORDS} 0" in text and f"{WORDS} 1" in text


def test_long_items_with_edits_are_found(spark):
    rnd = random.Random(8)
    items, texts = [], []
    for i in range(24):
        n = (100, 256, 512, 800)[i % 4]
        words = [f"w{rnd.randrange(5000)}" for _ in range(n)]
        items.append((i, " ".join(words)))
        for at in sorted(rnd.sample(range(n), leaks.edits(n)), reverse=True):
            kind = rnd.randrange(3)
            words[at : at + (kind != 2)] = [] if kind == 1 else [f"new{rnd.randrange(999)}"]
        around = [f"o{rnd.randrange(5000)}" for _ in range(60)]
        texts.append((i, " ".join(around + words + around)))
    found = leaks.leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in sorted(found)] == [(i, i) for i in range(24)]
    assert all(r.distance <= leaks.edits(r.n_words) for r in found)


def test_every_turn_is_in_the_output(spark):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "q"), (1, 1, "user", "other q"), (1, 2, "assistant", "a"), (1, 2, "assistant", "b"), (1, 2, "assistant", "c"),
        (1, 3, "assistant", "second"), (1, 4, "tool", "t"), (None, 1, "user", "x"), (2, None, "assistant", "y"), (2, 0, None, None),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [(r.conv_id, r.call_id, r.linked, json.loads(r.record)) for r in chats.format_chats(table, whole=True).collect()]
    calls = sorted((x["arguments"]["query"], x.get("entry", 1), x["result"], linked) for _, _, linked, x in got if "arguments" in x)
    assert calls == [("other q", 1, "a", True), ("q", 2, "b", True)]
    assert [(c, i, x) for c, i, _, x in got if "result" in x and "name" not in x] == [(1, "c1-1", {"id": "c1-1", "result": "c", "entry": 3})]
    turns = [(c, i, linked, x["turn"], x["role"], x["content"]) for c, i, linked, x in got if "role" in x]
    assert sorted(turns, key=repr) == sorted([
        (1, None, False, 0, "system", "be brief"), (1, None, False, 3, "assistant", "second"), (1, None, False, 4, "tool", "t"),
        (None, None, False, 1, "user", "x"), (2, None, False, None, "assistant", "y"), (2, None, False, 0, None, None),
    ], key=repr)
    whole = queries.op5_chat_format(spark, "/root/testdata/sf0.001").collect()
    assert sum(json.loads(r.record).get("role") == "system" for r in whole) == 5


def test_orphan_results_and_null_identifiers_are_rows(spark):
    calls = spark.createDataFrame([(1, 0, None, "t", "{}"), (1, 1, "a", "t", "{}")], "conv_id long, turn long, call_id string, name string, arguments string")
    results = spark.createDataFrame([("zz", "lost"), (None, "no id")], "call_id string, content string")
    tools = spark.createDataFrame([("t", "{}")], "name string, schema string")
    got = chats.link(calls, results, tools, spark.createDataFrame([], "call_id string, needs string")).collect()
    assert sorted(((r.call_id, r.linked, r.problem) for r in got), key=str) == [
        ("a", False, None), ("zz", False, "no call"), (None, False, "no call"), (None, False, None),
    ]


def levels_of(ids, references):
    """Levels by plain peeling; None on and behind a cycle."""
    needs = {c: {n for v, n in references if v == c and n in ids} for c in ids}
    found = {}
    while ready := [c for c in ids if c not in found and needs[c] <= set(found)]:
        found |= {c: 1 + max((found[n] for n in needs[c]), default=-1) for c in ready}
    return {c: found.get(c) for c in ids}


def test_levels_of_any_references(spark):
    rnd = random.Random(5)
    ids, references = [], [("gone", "r0-0"), ("r0-0", "gone"), (None, "r0-0"), ("r0-1", None)]
    for graph in range(12):
        n = 14
        own = [f"r{graph}-{i}" for i in range(n)]
        ids += own
        for i in range(1, n):
            for _ in range(rnd.choice((0, 1, 1, 1, 2, 3))):
                references.append((own[i], own[rnd.randrange(i)]))
        if graph % 3 == 0:
            at = rnd.randrange(n - 3)
            references.append((own[at], own[at + rnd.randrange(3)]))
    ids += [f"l{i}" for i in range(41)]  # a ladder: every call needs the two before it
    references += [(f"l{i}", f"l{i - k}") for i in range(41) for k in (1, 2) if i >= k]
    ids += [f"o{i}" for i in range(7)]  # a cycle of odd length and a call behind it
    references += [(f"o{i}", f"o{(i + 1) % 7}") for i in range(7)] + [("l3", "l3x"), ("r0-2", "o0")]
    calls = spark.createDataFrame([(x,) for x in ids], "call_id string")
    got = chats.levels(calls, spark.createDataFrame(references, "call_id string, needs string")).collect()
    assert len(got) == len(ids) and {r.call_id: r.level for r in got} == levels_of(set(ids), references)


def test_long_chains_of_calls_end(spark):
    n = 200
    calls = spark.createDataFrame([(1, i, f"c{i}", "t", "{}") for i in range(n)], "conv_id long, turn long, call_id string, name string, arguments string")
    none, tools = spark.createDataFrame([], "call_id string, content string"), spark.createDataFrame([("t", "{}")], "name string, schema string")
    needs = spark.createDataFrame([(f"c{i}", f"c{i + 1}") for i in range(n - 1)], "call_id string, needs string")
    got = chats.link(calls, none, tools, needs).collect()
    assert {r.call_id: (r.level, r.position) for r in got} == {f"c{i}": (n - 1 - i, n - i) for i in range(n)}


def test_chats_take_few_jobs_and_read_their_turns_once(spark):
    spark.sparkContext.setJobGroup("chats", "chats")
    try:
        queries.op5_chat_format(spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    infos = [status.getJobInfo(job) for job in status.getJobIdsForGroup("chats")]
    assert 0 < len(infos) < 60 and sum(len(x.stageIds) for x in infos) < 100


def test_pages_inside_side_elements_keep_their_article():
    article = f"<h1>Title</h1><p>{WORDS} 0</p><p>{WORDS} 1</p><p>{WORDS} 2</p>"
    want = ["Title", *[f"{WORDS} {i}" for i in range(3)]]
    links = "".join(f"<li><a href='/{i}'>Section {i}</a></li>" for i in range(6))
    for inner in (article, f"<article>{article}</article>", f"<main><div>{article}</div></main>"):
        form = f'<body><form id="aspnetForm" method="post"><input name="v"><ul>{links}</ul><div>{inner}</div><footer>© 2024 All rights reserved.</footer></form></body>'
        nav = f"<body><nav><ul>{links}</ul><div>{inner}</div></body>"
        aside = f"<body><div>{inner}</div><aside><p>Other news of the day.</p></aside><form><p>Your mail address</p><input></form><nav>{links}</nav></body>"
        for page in (form, nav, aside):
            assert pages.main_text(page).split("\n\n") == want, page
    assert pages.main_text(f"<body><nav><ul>{links}</ul></nav><footer>© 2024</footer></body>") == ""


def test_deep_and_broken_pages_take_linear_time():
    start = time.monotonic()
    n = 100_000
    deep = pages.main_text("<div>" * n + f"<p>{WORDS}</p>")
    stray = pages.main_text(f"<body><p>{WORDS}</p>" + "<div>" * 2000 + "</section></b>" * n + "</body>")
    texts = pages.main_text("".join(f"<div>{WORDS} {i}" for i in range(n // 10)))
    assert deep == stray == WORDS and texts.count(WORDS) == n // 10
    assert time.monotonic() - start < 60


def test_short_items_are_found_word_for_word(spark):
    items = [(1, "Three small words!"), (2, "one"), (3, "seven words in a row are these"), (4, "three small words"), (5, "..."), (6, "words here")]
    texts = [(1, "x three, small words here; three small words"), (2, "three small word one"), (3, "seven words in a row were these"), (4, "three small\nwords"), (5, "")]
    found = leaks.leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.n_words, r.distance, r.end) for r in found) == [
        (1, 1, 3, 0, 4), (1, 4, 3, 0, 4), (1, 6, 2, 0, 5), (2, 2, 1, 0, 4), (4, 1, 3, 0, 3), (4, 4, 3, 0, 3),
    ]


def test_more_learned_words_than_any_list(spark):
    """2,500 insults in five orders, a hundred in a toxic row."""
    rnd, free = random.Random(3), (i for i in range(10**6) if zlib.crc32(str(i).encode()) % 3 != 1)
    words, rows = [f"bad{i}word" for i in range(2500)], []
    for _ in range(5):
        rnd.shuffle(words)
        rows += [(next(free), " ".join(words[i : i + 100]), 1) for i in range(0, 2500, 100)]
    rows += [(next(free), f"fine day number {i} here", 0) for i in range(2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    learned = toxicity.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic"))[0].insults
    assert len(set(words) - set(learned)) < 100  # those that stand beside the same word twice


def test_a_very_long_labelled_text_is_learned_from(spark):
    long = " ".join(f"w{i % 50_000}" for i in range(200_000))
    docs = spark.createDataFrame([(1, long), (2, "short text"), (3, long[:100])], "doc_id long, text string")
    start = time.monotonic()
    toxicity.learn(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int"))
    assert time.monotonic() - start < 60
