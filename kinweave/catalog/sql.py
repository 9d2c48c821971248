"""Checking SQL: the flat tables seen as the shapes of :mod:`kinweave.catalog.shapes`.

Written on the flat tables, without the nested detour the operators take.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    # --- tree ---
    "tree_lines": """
        SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, s_name
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "entry": """
        SELECT CAST(o_orderkey AS VARCHAR) AS entry_id, o_orderkey,
               c_name, c_mktsegment, CAST(year(o_orderdate) AS INTEGER) AS yr
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "children": """
        SELECT entry_id, 0 AS pos, c_name AS name, 'laureate' AS type,
               c_mktsegment AS category, yr AS year FROM entry""",
    "parents": """
        SELECT entry_id, row_number() OVER (PARTITION BY entry_id
                   ORDER BY l_linenumber, l_suppkey, l_partkey) - 1 AS pos,
               s_name AS name, 'scholar' AS type,
               CAST(NULL AS VARCHAR) AS category, CAST(NULL AS INTEGER) AS year
        FROM entry e JOIN tree_lines t ON t.l_orderkey = e.o_orderkey""",
    "entities_all": """
        SELECT name, type, category, year FROM children UNION ALL
        SELECT p.name, p.type, p.category, p.year FROM entry e LEFT JOIN parents p USING (entry_id)""",
    "entities": "SELECT DISTINCT name, type, category, year FROM entities_all",
    "scholar_ids": """
        SELECT name, 's' || row_number() OVER (ORDER BY name) AS id
        FROM entities WHERE type = 'scholar'""",
    "laureate_ids": """
        SELECT c_name AS name, 'l' || max(c_custkey) AS id
        FROM customer WHERE c_acctbal >= 0 GROUP BY c_name""",
    "elements": """
        SELECT entry_id, 'children' AS grp, pos, c.name, type, category, year, i.id
        FROM children c LEFT JOIN laureate_ids i ON i.name = c.name UNION ALL
        SELECT entry_id, 'parents', pos, p.name, type, category, year, i.id
        FROM parents p LEFT JOIN scholar_ids i ON i.name = p.name""",
    "id_entities": "SELECT DISTINCT name, type, category, year, id FROM elements",
    "pairs": """
        SELECT p.name AS parent_name, c.name AS child_name
        FROM children c LEFT JOIN parents p USING (entry_id)""",
    "mentor_rows": """
        SELECT parent_name, child_name, a.id AS parent_id, b.id AS child_id
        FROM pairs LEFT JOIN id_entities a ON a.name = parent_name
        LEFT JOIN id_entities b ON b.name = child_name""",
    # --- reference records ---
    "place": """
        SELECT n_nationkey, n_name, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "record": """
        SELECT c.*, n_name, r_name FROM customer c JOIN place ON c_nationkey = n_nationkey""",
    "prize": """
        SELECT o_custkey AS custkey, o_orderkey,
               CAST(year(o_orderdate) AS VARCHAR) AS award_year,
               CASE o_orderkey % 5 WHEN 0 THEN 'Physics' WHEN 1 THEN 'Chemistry'
                    WHEN 2 THEN 'Physiology or Medicine' WHEN 3 THEN 'Economic Sciences'
                    ELSE 'Peace' END AS category,
               CASE o_orderkey % 5 WHEN 0 THEN 'physics' WHEN 1 THEN 'chemistry'
                    WHEN 2 THEN 'medicine' WHEN 3 THEN 'economics' ELSE 'peace' END AS short,
               '1/' || (1 + o_orderkey % 4) AS portion,
               strftime(o_orderdate, '%Y-%m-%d') AS awarded, o_orderpriority AS motivation,
               CAST(floor(o_totalprice) AS BIGINT) AS amount
        FROM orders JOIN customer ON c_custkey = o_custkey
        JOIN place ON c_nationkey = n_nationkey""",
    "affiliation": """
        SELECT custkey, p.o_orderkey, award_year, s.s_name AS name_now,
               'City ' || s_nationkey AS city, CASE s_suppkey % 3 WHEN 1 THEN r_name END AS state,
               'City ' || s_nationkey || CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN ', ' || r_name
                    ELSE ', ' || r_name || ', X' END AS raw_city,
               n_name AS country, r_name AS continent
        FROM prize p JOIN tree_lines t ON t.l_orderkey = p.o_orderkey
        JOIN supplier s ON s_suppkey = l_suppkey JOIN place ON s_nationkey = n_nationkey""",
    "persons": """
        SELECT 'l' || c_custkey AS id, c_custkey, c_name AS name,
               CASE c_custkey % 2 WHEN 0 THEN 'female' ELSE 'male' END AS gender,
               CASE c_custkey % 7 WHEN 0 THEN '1898-01-01' WHEN 1 THEN '1898-07-01' WHEN 2 THEN NULL
                    WHEN 3 THEN NULL ELSE (1900 + c_custkey % 90) || '-02-03' END AS birth_date,
               'City ' || c_nationkey AS city, CASE c_custkey % 2 WHEN 0 THEN r_name END AS state,
               CASE WHEN c_nationkey % 5 <> 0 THEN n_name END AS country
        FROM record""",
    "affiliations": """
        SELECT DISTINCT 'l' || custkey AS person, name_now, city, state, country, continent
        FROM affiliation""",
    "prizes": """
        SELECT 'l' || custkey AS person, award_year || '_' || short AS prize_id, * FROM prize""",
    # --- graph tables ---
    "g_prize": """
        SELECT prize_id AS id, award_year, short AS category, awarded, motivation, amount
        FROM (SELECT *, row_number() OVER (PARTITION BY prize_id ORDER BY person DESC, award_year DESC,
                     short DESC, awarded DESC, motivation DESC, amount DESC) AS rk FROM prizes)
        WHERE rk = 1""",
    "g_birth_city": """
        SELECT city AS name, state FROM (SELECT city, state, row_number() OVER (PARTITION BY city
               ORDER BY id DESC, state DESC NULLS LAST) AS rk FROM persons) WHERE rk = 1""",
    "g_aff_city": """
        SELECT city AS name, state FROM (SELECT city, state, row_number() OVER (PARTITION BY city
               ORDER BY state DESC NULLS LAST) AS rk FROM affiliations) WHERE rk = 1""",
    "g_city": """
        SELECT coalesce(a.name, b.name) AS name,
               CASE WHEN a.name IS NOT NULL THEN a.state ELSE b.state END AS state
        FROM g_birth_city b FULL JOIN g_aff_city a ON a.name = b.name""",
    "g_country": "SELECT DISTINCT country AS name FROM persons WHERE country IS NOT NULL",
    "g_scholar": """
        SELECT DISTINCT id, 'laureate' AS scholar_type, name, name AS full_name, gender, birth_date
        FROM persons UNION ALL
        SELECT id, 'scholar', name, NULL, NULL, NULL FROM scholar_ids""",
    "g_mentored": """
        SELECT DISTINCT parent_id AS src, child_id AS dst FROM mentor_rows
        WHERE parent_id IN (SELECT id FROM g_scholar) AND child_id IN (SELECT id FROM g_scholar)""",
    "g_city_in_birth": """
        SELECT DISTINCT city AS src, country AS dst FROM persons WHERE country IS NOT NULL""",
    "g_city_in": """
        SELECT src, dst FROM g_city_in_birth UNION
        SELECT city, country FROM affiliations WHERE country IN (SELECT name FROM g_country)""",
    "g_country_in": """
        SELECT DISTINCT country AS src, continent AS dst FROM affiliations
        WHERE country IN (SELECT name FROM g_country)""",
    # --- texts and vectors ---
    "doc_texts": """
        SELECT lang, lower(text) AS t, min(doc_id) AS id FROM documents GROUP BY ALL""",
    "names": """
        SELECT 2 * c_custkey AS id, c_custkey, c_nationkey, 'left' AS side,
               lower(regexp_replace(c_name, '#0*', ' ')) AS t FROM customer UNION ALL
        SELECT 2 * c_custkey + 1, c_custkey, c_nationkey, 'right', lower(c_name) FROM customer""",
    "vec": "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings",
    "vec_near": """
        SELECT source_id, target_id, label, sc, rk FROM (
            SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY sc DESC, target_id) AS rk
            FROM (SELECT a.vec_id AS source_id, b.vec_id AS target_id, b.label,
                         round(list_cosine_similarity(a.e, b.e), 12) AS sc
                  FROM vec a JOIN vec b ON a.vec_id <> b.vec_id))
        WHERE rk <= 3""",
}


def gram_views(source: str, dim: int, step: int = 31) -> dict[str, str]:
    """Views ``<source>_grams`` (id, bucket, n) and ``<source>_vectors`` (id, v, f): hashed
    trigram counts of the texts ``t``, as counts and as unit vectors of 32-bit floats."""
    chars = f"SELECT id, regexp_extract_all(' ' || t || ' ', '(?s).') AS cs FROM {source}"
    return {
        f"{source}_chars": chars,
        f"{source}_codes": f"""
            SELECT id, i, unicode(c) AS a FROM (
                SELECT id, unnest(cs) AS c, unnest(range(len(cs))) AS i FROM {source}_chars)""",
        f"{source}_grams": f"""
            SELECT id, (a * {step * step} + b * {step} + c) % {dim} AS bucket, count(*) AS n
            FROM (SELECT id, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c
                  FROM {source}_codes WINDOW w AS (PARTITION BY id ORDER BY i))
            WHERE c IS NOT NULL GROUP BY ALL""",
        f"{source}_vectors": f"""
            SELECT id, list(n ORDER BY bucket)::DOUBLE[] AS v,
                   list(CAST(n / sqrt(sq) AS FLOAT) ORDER BY bucket)::DOUBLE[] AS f
            FROM (SELECT k.id, k.bucket, coalesce(g.n, 0) AS n,
                         sum(coalesce(g.n, 0) * coalesce(g.n, 0)) OVER (PARTITION BY k.id) AS sq
                  FROM (SELECT t.id, r.bucket FROM {source} t, range({dim}) r(bucket)) k
                  LEFT JOIN {source}_grams g ON g.id = k.id AND g.bucket = k.bucket)
            WHERE sq > 0 GROUP BY id""",
    }


def build(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the views it needs."""
    views = {**VIEWS, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b[a-z_]+\b", text):
            if word in views and word not in needed and re.search(rf"\b(FROM|JOIN)\s+{word}\b", text):
                visit(views[word])
                if word not in needed:
                    needed.append(word)

    visit(body)
    if not needed:
        return body
    return "WITH " + ", ".join(f"{name} AS ({views[name]})" for name in needed) + " " + body
