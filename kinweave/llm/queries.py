"""The registered queries: each operator over its whole table, in the contract's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import (
    codes,
    exact,
    language,
    mixture,
    packing,
    passages,
    personal,
    quality,
    repair,
    simhash,
    strings,
    topk,
    urls,
)
from kinweave.llm.registry import QUERIES, SQL, query, table

__all__ = ["QUERIES", "SQL"]

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS kept,
       sha256(body) AS text_sha256
FROM d
"""


@query("op9_exact_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact.exact_groups(docs).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@query("op6_mix_sources")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixture.mix_sources(table(spark, sf_dir, "documents"))
    return mixture.taken_words(mix)


def _op2_sql() -> str:
    steps = ["""WITH RECURSIVE p AS (
  SELECT page_id, html,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), j AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%'
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%'
      THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/'
  END AS rule FROM p
), v AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
                 WHEN rule IS NOT NULL THEN 'block' END AS ruled FROM j
), a AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?([^"''\\s>]+)', 1)) AS link
  FROM p
), l AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT src, translate(coalesce(regexp_extract(
             CASE WHEN link LIKE '//%' THEN ':' || link ELSE link END,
             '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM a)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), m AS (
  SELECT 't' AS kind, src AS host, dst AS goal, n / sum(n) OVER (PARTITION BY src) AS share FROM l
  UNION ALL
  SELECT 'd', dst, src, n / sum(n) OVER (PARTITION BY src) FROM l
), h AS (
  SELECT host, avg(coalesce((ruled = 'allow')::DOUBLE, 0)) AS t,
         avg(coalesce((ruled = 'block')::DOUBLE, 0)) AS d FROM v WHERE host <> '' GROUP BY host
), s0 AS (
  SELECT 't' AS kind, host, 0.15::DOUBLE * t AS score FROM h WHERE t > 0
  UNION ALL SELECT 'd', host, 0.15::DOUBLE * d FROM h WHERE d > 0
)"""]
    for step in range(1, urls.STEPS + 1):
        steps.append(f"""s{step} AS (
  SELECT kind, host, sum(score) AS score FROM (
    SELECT * FROM s0 UNION ALL
    SELECT kind, goal, score * share * 0.85 FROM s{step - 1} JOIN m USING (kind, host))
  GROUP BY kind, host
)""")
    steps.append(f"""bad AS (
  SELECT host FROM s{urls.STEPS} GROUP BY host
  HAVING round(coalesce(sum(score) FILTER (kind = 'd'), 0)
         - coalesce(sum(score) FILTER (kind = 't'), 0), 9) > 0.075
)""")
    return ", ".join(steps) + """
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END)
         AS verdict
FROM v"""


@query("op2_url_filters", _op2_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def _remainder(divisor: int) -> Column:
    """Of the crc32 of the id as text; 0 for a NULL id, so such a row is not held out."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(divisor)), F.lit(0))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.label_languages(docs, _remainder(3) != 1, keep=["doc_id"])
    return found.select(
        "doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score"
    )


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score_quality(docs, labels, _remainder(4) != 2, keep=["doc_id"])
    return scored.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score", "predicted")


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         list_inner_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id,
       (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id, score
FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query("op3_exact_topk", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_passages(table(spark, sf_dir, "documents"))


@query("op10_suffix_array_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strings.remove_strings(table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    steps = [f"""WITH v AS MATERIALIZED (
  SELECT vec_id, label,
         list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, label, pos, v[pos * (len(v) // 8) + 1 : (pos + 1) * (len(v) // 8)] AS part
  FROM v, range(8) AS t(pos)
), c0 AS MATERIALIZED (
  SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS entry, part AS e
  FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {codes.ENTRIES})
)"""]
    for n in range(codes.ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT vec_id, label, pos, part, key % {codes.ENTRIES} AS entry, key // {codes.ENTRIES} AS d
  FROM (SELECT vec_id, label, pos, part, min({codes.ENTRIES} * list_sum(list_transform(
          list_zip(part, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT + entry) AS key
        FROM p JOIN c{n} USING (pos) GROUP BY ALL)
)""")
        if n < codes.ROUNDS:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT pos, entry, coalesce(m, e) AS e FROM c{n} LEFT JOIN (
    SELECT pos, entry, list((s - (s % k + k) % k) // k ORDER BY i) AS m FROM (
      SELECT pos, entry, i, sum(x)::BIGINT AS s, count(*) AS k FROM (
        SELECT pos, entry, unnest(part) AS x, generate_subscripts(part, 1) AS i FROM a{n})
      GROUP BY pos, entry, i)
    GROUP BY pos, entry) USING (pos, entry)
)""")
    return ", ".join(steps) + f""", r AS (
  SELECT vec_id, label, string_agg(lower(printf('%02x', entry)), '' ORDER BY pos) AS code,
         sum(d)::BIGINT AS error
  FROM a{codes.ROUNDS} GROUP BY vec_id, label
)
SELECT vec_id, code, error,
       (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY pos, entry))
        FROM c{codes.ROUNDS}) AS codebooks_sha256
FROM r"""


@query("op13_vector_codes", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id",
        "code",
        "error",
        "label_error",
        F.lit(codes.books_digest(books)).alias("codebooks_sha256"),
    )


def _op12_sql() -> str:
    moves = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    full = {"u": "user", "a": "assistant"}

    def struct(cost: str, letter: str, line: str, goal: str) -> str:
        line = f"{line} || chr(10) || {goal}.o" if line else f"{goal}.o"
        return f"{{'c': {cost} + {goal}.c, 'a': '{letter}' || {goal}.a, 'o': {line}}}"

    def best(choices: list[str]) -> str:
        return f"list_sort([{', '.join(choices)}])[1]"

    def closed(source: str) -> str:
        """States after inserts before the row."""
        user = best(["p2", struct("5", "I", "'assistant:'", "p3")])
        other = best(["p3", struct("5", "I", "'user:'", "p2")])
        return f"""SELECT conv_id, i,
         {best(["p0", struct("5", "I", "'user:'", "n2")])} AS s0,
         {best(["p1", struct("5", "I", "'user:'", "n2")])} AS s1, n2 AS s2, n3 AS s3
       FROM (SELECT *, {user} AS n2, {other} AS n3 FROM ({source}))"""

    never = "{'c': 1000000000::BIGINT, 'a': '', 'o': ''}"
    ended = "{'c': 0::BIGINT, 'a': '', 'o': ''}"
    states = []
    for state, onward in moves.items():
        choices = [struct("2", "D", "", f"r.s{state}")]
        for initial, goal in onward.items():
            extra = "(CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END)"
            keep = struct(extra, "K", "f.role || ':' || f.text", f"r.s{goal}")
            free = "fault IS DISTINCT FROM 'blank' AND fault IS DISTINCT FROM 'duplicate'"
            choices.append(f"CASE WHEN {free} AND initial = '{initial}' THEN {keep} ELSE {never} END")
            if initial in full:
                line = f"'{full[initial]}:' || f.text"
                other = struct(f"1 + {extra}", "R", line, f"r.s{goal}")
                choices.append(f"CASE WHEN {free} THEN {other} ELSE {never} END")
        states.append(f"{best(choices)} AS p{state}")
    last = f"SELECT conv_id, n + 1 AS i, {ended} AS p0, {never} AS p1, {never} AS p2, {ended} AS p3 FROM z"
    step = f"""SELECT r.conv_id, r.i - 1 AS i, {", ".join(states)}
         FROM r JOIN f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = r.i - 1"""
    return f"""WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), w AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda x: ord(x)::BIGINT)), lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])),
      4294967295) % 20 AS w
  FROM conversations, t
), d AS (
  SELECT conv_id, turn, CASE WHEN w = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN w = 1 THEN '' WHEN w = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
              ELSE text END AS text,
         unnest(CASE w WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS rep
  FROM w
), f AS MATERIALIZED (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(solid, '[.!?]$') THEN 'truncated' END AS fault
  FROM (SELECT *, left(role, 1) AS initial,
          regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS solid,
          row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, rep) AS nth,
          row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, role, sha256(text), rep) AS i
        FROM d)
), z AS MATERIALIZED (
  SELECT c.conv_id, count(f.i) AS n,
         count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps
  FROM (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN f ON c.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY c.conv_id
), r AS (
  {closed(last)}
  UNION ALL
  {closed(step)}
), g AS (
  SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM f)
  GROUP BY conv_id
)
SELECT z.conv_id, gaps, blank, duplicate, truncated, coalesce(illegal, 0) AS illegal,
       s0.c AS cost, s0.a AS audit, sha256(left(s0.o, -1)) AS repaired_sha256
FROM z JOIN r ON z.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = 1
LEFT JOIN g ON z.conv_id IS NOT DISTINCT FROM g.conv_id"""


@query("op12_conversation_repair", _op12_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(table(spark, sf_dir, "conversations"))


def _op11_sql() -> str:
    def mentions(place: str, words: str) -> str:
        return f"regexp_matches({place}, '(?i)(^|[^A-Za-z])({words})([^A-Za-z]|$)')"

    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    turned = "substr(replace(hit, ' ', ''), 5) || left(replace(hit, ' ', ''), 4)"
    places = f"list_reverse(list_transform(string_split({digits}, ''), lambda x: x::INTEGER))"
    apart = "NOT regexp_matches(before, '({})$') AND NOT regexp_matches(after, '^({})')"
    checks = {
        "email": "true",
        "ip": "len(list_filter(string_split(hit, '.'), lambda x: length(ltrim(x, '0')) > 3 "
        "OR coalesce(try_cast(ltrim(x, '0') AS INTEGER), 0) > 255)) = 0",
        "card": f"CASE WHEN length({digits}) BETWEEN 14 AND 19 THEN list_sum(list_transform({places}, "
        "lambda x, i: CASE WHEN i % 2 = 1 THEN x WHEN x > 4 THEN 2 * x - 9 ELSE 2 * x END)) % 10 = 0 "
        "ELSE false END",
        "phone": f"length({digits}) BETWEEN 10 AND 15",
        "iban": f"""CASE WHEN length(replace(hit, ' ', '')) BETWEEN 15 AND 34 AND
          {apart.format("[A-Za-z0-9]", "[A-Za-z0-9]")} THEN list_reduce(list_prepend(0::BIGINT,
          list_transform(string_split({turned}, ''), lambda x: ascii(x)::BIGINT)),
          lambda a, x: CASE WHEN x > 57 THEN (a * 100 + x - 55) % 97 ELSE (a * 10 + x - 48) % 97 END) = 1
          ELSE false END""",
        "national_id": apart.format(r"[0-9][\x20-]?", r"[\x20-]?[0-9]"),
        "local_phone": apart.format(r"[0-9+][\x20().-]*", r"[.-]?[0-9]"),
    }
    parts = []
    for rank, kind in enumerate(personal.KINDS):
        least = "true" if kind.base else f"score >= {personal.THRESHOLD}"
        parts.append(f"""SELECT n, {rank} AS rank, '{kind.name}' AS kind, start, start + length(hit) AS stop
  FROM (SELECT *, {kind.prior} + CASE WHEN {mentions('near', kind.favour)} THEN {personal.FAVOUR} ELSE 0 END
           - CASE WHEN {mentions('before', kind.against)} THEN {personal.AGAINST} ELSE 0 END AS score
    FROM (SELECT *, before || ' ' || after AS near
      FROM (SELECT n, hit, start,
          CASE WHEN i > 1 AND gap = '' THEN '0' ELSE right(gap, {personal.BEFORE}) END AS before,
          left(next, {personal.AFTER}) AS after
        FROM (SELECT n, i, hits[i] AS hit, gaps[i] AS gap, gaps[i + 1] AS next,
            (sum(length(gaps[i])) OVER w + coalesce(sum(length(hits[i])) OVER (PARTITION BY n
              ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
          FROM (SELECT n, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
            FROM (SELECT n, regexp_extract_all(text, '{kind.plain}') AS hits,
                string_split_regex(text, '{kind.plain}') AS gaps FROM t))
          WINDOW w AS (PARTITION BY n ORDER BY i)))))
  WHERE {least} AND {checks[kind.name]}""")
    union = "\n  UNION ALL ".join(parts)
    one = "kind || ':' || start || ':' || stop"
    base = ", ".join(f"'{kind.name}'" for kind in personal.KINDS if kind.base)
    counts = ",\n       ".join(
        f"count(*) FILTER (kind = '{kind.name}') AS n_{kind.name}"
        for kind in personal.KINDS
        if kind.base
    )
    return f"""WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents
), s AS (
  {union}
)
SELECT doc_id, {counts},
       sha256(coalesce(string_agg({one}, ',' ORDER BY start, rank) FILTER (kind IN ({base})), ''))
         AS base_sha256,
       coalesce(string_agg({one}, ',' ORDER BY start, rank), '') AS spans
FROM t LEFT JOIN s ON t.n = s.n GROUP BY t.n, doc_id"""


@query("op11_personal_data", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [kind.name for kind in personal.KINDS if kind.base]
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(F.size(personal.of_kinds(spans, [n])).cast("long").alias(f"n_{n}") for n in base),
        F.sha2(personal.joined(personal.of_kinds(spans, base)), 256).alias("base_sha256"),
        personal.joined(spans).alias("spans"),
    )
