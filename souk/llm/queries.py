"""The text operators as registered queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import audit, bpe, chats, fingerprint, leaks, lines, minhash, negatives, pages, quality, repeats, secrets, toxicity
from souk.llm.common import table
from souk.session import scratch_path

#: The vocabulary file that the queries use, by its name in the public tokenizers package.
VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, folder, "documents"), vocabulary())


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets_by_row(table(spark, folder, "documents"), scratch_path(spark, "ledger"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, folder, "documents"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chats.format_chats(table(spark, folder, "conversations"), whole=True)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_digests(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    grammar, curve = toxicity.learn(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, grammar, curve)


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), k=3, percent=85)


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label=shifted)


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe, op2_substring_dedup, op3_secret_scan, op4_fingerprints, op5_chat_format, op6_line_dedup, op7_toxicity, op8_minhash,
        op9_html_text, op10_decontaminate, op11_filter_audit, op12_hard_negatives, op13_quality_rules,
    )
}


def _scan_sql(rank: int, rule: secrets.Rule) -> str:
    """Matches of one rule per document, and the pieces of text between them."""
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, '{pattern}' AS pattern, {rule.least} AS least,
      regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS p FROM d"""


#: The span of a match follows from the lengths of the pieces and matches before it.
SECRETS_SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
  r AS ({" UNION ALL ".join(_scan_sql(i, r) for i, r in enumerate(secrets.RULES))}),
  i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM r),
  s AS (SELECT doc_id, kind, rank, m[i] AS v, list_sum([length(x) for x in p[:i]]) + coalesce(list_sum([length(x) for x in m[:i - 1]]), 0) AS a
    FROM i WHERE length(CASE WHEN kind = 'assign' THEN regexp_extract(m[i], pattern, 2) ELSE m[i] END) >= least),
  t AS (SELECT *, kind || ':' || a::BIGINT || ':' || (a + length(v))::BIGINT AS span FROM s)
  SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    sha256(coalesce(string_agg(span, ',' ORDER BY a, rank) FILTER (rank < {len(secrets.BASE)}), '')) AS base_sha256,
    coalesce(string_agg(span, ',' ORDER BY a, rank), '') AS spans
  FROM d LEFT JOIN t ON d.doc_id = t.doc_id GROUP BY d.doc_id"""

#: Masks of failed filters per document, then every order of the filters over them.
AUDIT_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
    f AS (SELECT part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(min(d.doc_id) OVER (PARTITION BY t) < d.doc_id, false)::INT AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
    m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
    o AS (SELECT '' AS filter_order, 0 AS before UNION ALL SELECT filter_order || c, before + (1 << (ascii(c) - 65)) FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c)
      WHERE before & (1 << (ascii(c) - 65)) = 0),
    s AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
        list_sum([1 << (ascii(x) - 65) for x in string_split(filter_order[:step], '')])::INT - (1 << (ascii(filter_order[step]) - 65)) AS before
      FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o WHERE length(filter_order) = 5)),
    r AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost FROM m, s GROUP BY 1, 2, 3, 4)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""

ORACLE = {
    "op11_filter_audit": AUDIT_SQL,
    "op12_hard_negatives": """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
      a AS (SELECT DISTINCT * FROM e WHERE vec_id % 100 = 0),
      s AS (SELECT a.vec_id AS anchor_id, a.v AS av, a.label AS al, e.vec_id AS id, e.label, list_inner_product(a.v, e.v)::BIGINT AS score FROM a, e WHERE a.vec_id <> e.vec_id),
      p AS (SELECT anchor_id, av, al, id, score, row_number() OVER (PARTITION BY anchor_id, av, al ORDER BY score DESC, id) AS nth FROM s WHERE label = al QUALIFY nth <= 5),
      n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
          row_number() OVER (PARTITION BY p.anchor_id, p.av, p.al, p.nth ORDER BY s.score DESC, s.id)::INT AS rank
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND p.av = s.av AND p.al = s.al
        WHERE s.label <> p.al AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
      SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
    "op3_secret_scan": SECRETS_SQL,
    "op5_chat_format": r"""WITH RECURSIVE t AS (SELECT conv_id, turn, role, min(coalesce(text, '')) AS text FROM conversations GROUP BY 1, 2, 3),
      u AS (SELECT * FROM t WHERE role = 'user'),
      c AS (SELECT u.conv_id, u.turn, u.text, h.turn AS half, r.text AS content, 'c' || u.conv_id || '-' || u.turn AS call_id FROM u
        LEFT JOIN u h ON u.conv_id = h.conv_id AND u.turn // 2 = h.turn AND h.turn < u.turn
        LEFT JOIN t r ON r.role = 'assistant' AND u.conv_id = r.conv_id AND r.turn = u.turn + 1),
      l AS (SELECT conv_id, turn, 0 AS level FROM c WHERE half IS NULL
        UNION ALL SELECT c.conv_id, c.turn, l.level + 1 FROM l JOIN c ON c.conv_id = l.conv_id AND c.half = l.turn),
      j AS (SELECT c.conv_id, c.turn, call_id, level, content IS NOT NULL AS linked, length(c.text) >= 60 AS valid,
        '{"arguments":{"query":' || to_json(c.text) || CASE WHEN half IS NULL THEN '' ELSE ',"refs":["c' || c.conv_id || '-' || half || '"]' END
        || '},"id":"' || call_id || '","name":"answer","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS record
        FROM c JOIN l ON c.conv_id = l.conv_id AND c.turn = l.turn
        UNION ALL
        SELECT DISTINCT o.conv_id, o.turn, NULL, NULL, false, NULL, '{"content":' || coalesce(to_json(o.text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(o.role)::VARCHAR, 'null')
          || ',"turn":' || coalesce(o.turn::VARCHAR, 'null') || '}' FROM conversations o LEFT JOIN u ON o.conv_id = u.conv_id AND o.turn = u.turn + 1
        WHERE NOT coalesce(o.role = 'user' AND o.conv_id IS NOT NULL AND o.turn IS NOT NULL, false) AND NOT coalesce(o.role = 'assistant' AND u.turn IS NOT NULL, false))
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY level NULLS LAST, turn, call_id) AS position, call_id, level, linked, valid,
        CASE WHEN NOT valid THEN '$.query: length' END AS problem, record, sha256(record) AS record_sha256 FROM j""",
    "op8_minhash": r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
      g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s FROM w),
      e AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM g),
      l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.s = b.s AND a.doc_id <> b.doc_id
        GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
      r AS (SELECT doc_id, doc_id AS c FROM g UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.c = l.a),
      k AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1)
      SELECT g.doc_id, len(s) AS n_shingles, component_id, g.doc_id = component_id AS kept FROM g JOIN k ON g.doc_id = k.doc_id""",
    "op2_substring_dedup": r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
      s AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d),
      r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(words[i:i + 19], ' ') ORDER BY doc_id, i) AS nth FROM s),
      gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r WHERE nth > 1),
      w AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
      k AS (SELECT w.doc_id, count(*) AS n, count(g.i) AS n_gone, string_agg(word, ' ' ORDER BY w.i) FILTER (g.i IS NULL) AS kept
        FROM w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY 1)
      SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(n_gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
      FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op6_line_dedup": """WITH l AS (SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents),
      b AS (SELECT trim(line, ' ') AS k, min(doc_id) AS first_id FROM l WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY 1 HAVING count(DISTINCT site) >= 10),
      k AS (SELECT l.doc_id, i, line, b.k IS NOT NULL AND l.doc_id <> b.first_id AS gone FROM l LEFT JOIN b ON trim(l.line, ' ') = b.k)
      SELECT doc_id, CASE WHEN count(*) = 1 AND max(line) = '' THEN 0 ELSE count(*) END AS n_lines, count(*) FILTER (gone) AS n_removed,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM k GROUP BY doc_id""",
}
