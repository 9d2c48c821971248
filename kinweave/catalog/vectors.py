"""Queries for similarity search and resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinweave.catalog import shapes
from kinweave.catalog.columns import text_year
from kinweave.catalog.registry import query
from kinweave.catalog.shapes import table
from kinweave.catalog.sql import build, gram_views
from kinweave.functions.checks import vector_ok
from kinweave.operators.approximate import approximate_topk, build_vector_index
from kinweave.operators.inverted import build_inverted_index, inverted_topk, query_inverted
from kinweave.operators.embed import DIM, embed, embed_rows, ngram_counts, ngram_vectors
from kinweave.operators.keyed import keyed_source
from kinweave.operators.neighbours import query_index, similar_edges, topk_similarity
from kinweave.operators.reshape import laureate_keys
from kinweave.operators.resolve import (
    candidates,
    edit_similarity,
    judge_by_function,
    judge_by_score,
    resolve,
)
from kinweave.operators.similar import cosine_pairs, edit_pairs, word_grams
from kinweave.operators.upsert import merge_edges
from kinweave.session import materialise

DOC_GRAMS = gram_views("doc_texts", DIM)
NAME_GRAMS = gram_views("names", DIM)


@query(
    "h1_embed",
    build(
        """SELECT doc_id, n_buckets, checksum FROM
           (SELECT doc_id, lang, lower(text) AS t FROM documents) d
           JOIN (SELECT t, lang, n_buckets, checksum FROM doc_texts x JOIN (
               SELECT id, count(*) AS n_buckets, round(sum(w * (bucket + 1)), 6) AS checksum FROM (
                   SELECT id, unnest(f) AS w, unnest(range(len(f))) AS bucket FROM doc_texts_vectors)
               WHERE w <> 0 GROUP BY id) v ON v.id = x.id) y
           ON y.t = d.t AND y.lang = d.lang""",
        DOC_GRAMS,
    ),
)
def h1(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("t"))
    rows = embed(docs, "t").select("doc_id", F.posexplode("vector").alias("bucket", "w"))
    return (
        rows.filter("w <> 0")
        .groupBy("doc_id")
        .agg(
            F.count(F.lit(1)).alias("n_buckets"),
            F.round(F.sum(F.col("w").cast("double") * (F.col("bucket") + 1)), 6).alias("checksum"),
        )
    )


@query(
    "h2_ngram_counts",
    build("SELECT id AS doc_id, CAST(bucket AS BIGINT) AS bucket, n FROM doc_texts_grams", DOC_GRAMS),
)
def h2_counts(spark, d):
    counts = ngram_counts(shapes.texts(spark, d), "doc_id", "text")
    return counts.select("doc_id", F.col("bucket").cast("long").alias("bucket"), "n")


@query(
    "h2_ngram_cosine",
    build(
        """SELECT source_id, target_id, round(sc, 6) AS score, rk AS rank FROM (
               SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY sc DESC, target_id) AS rk
               FROM (SELECT a.id AS source_id, b.id AS target_id,
                            round(list_cosine_similarity(a.v, b.v), 12) AS sc
                     FROM (SELECT v.id, v, lang FROM doc_texts_vectors v JOIN doc_texts t ON t.id = v.id) a
                     JOIN (SELECT v.id, v, lang FROM doc_texts_vectors v JOIN doc_texts t ON t.id = v.id) b
                     ON a.lang = b.lang AND a.id <> b.id)) WHERE rk <= 3""",
        DOC_GRAMS,
    ),
)
def h2(spark, d):
    # Read twice, for the vectors and for the languages: stored, whole texts are moved only once.
    texts = materialise(shapes.texts(spark, d), "texts")
    vectors = materialise(count_vectors(texts), "grams")
    near = topk_similarity(
        vectors, vectors, 3, left_id="doc_id", right_id="doc_id", block=["lang"], exclude_self=True
    )
    return rounded(near)


WORD_GRAMS = {
    "gram_words": r"""
        SELECT id, lang, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
        FROM doc_texts""",
    "gram_terms": """
        SELECT id, lang, array_to_string(ws[i : i + 2], ' ') AS term, count(*) AS n FROM (
            SELECT *, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM gram_words
            WHERE len(ws) > 0) GROUP BY ALL""",
    "gram_norms": "SELECT id, sqrt(sum(n * n)) AS norm FROM gram_terms GROUP BY id",
    "gram_dots": """
        SELECT p.id AS a, q.id AS b, sum(p.n * q.n) AS dot FROM gram_terms p
        JOIN gram_terms q ON p.term = q.term AND p.lang = q.lang AND p.id < q.id GROUP BY ALL""",
}


@query(
    "h2_gram_pairs",
    build(
        """SELECT a, b, round(dot / (x.norm * y.norm), 6) AS score FROM gram_dots
           JOIN gram_norms x ON x.id = a JOIN gram_norms y ON y.id = b
           WHERE round(dot / (x.norm * y.norm), 12) >= 0.9""",
        WORD_GRAMS,
    ),
)
def h2_pairs(spark, d):
    """Texts of one language whose word trigrams are nearly the same."""
    # Read twice, for the runs of words and for the languages: whole texts are moved only once.
    texts = materialise(shapes.texts(spark, d), "texts")
    block = texts.filter("lang IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("lang").alias("block"))
    pairs = cosine_pairs(word_grams(texts, "doc_id", "text"), 0.9, block)
    return pairs.withColumn("score", F.round("score", 6))


def count_vectors(texts):
    """Trigram count vectors with the language of each text."""
    return ngram_vectors(texts, "doc_id", "text").join(texts.select("doc_id", "lang"), "doc_id")


def rounded(near):
    return near.select(
        "source_id",
        "target_id",
        F.round("score", 6).alias("score"),
        F.col("rank").cast("long").alias("rank"),
    )


def vec(spark, d):
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )


@query(
    "h3_vector_dims",
    """SELECT label, count(*) AS n,
              CAST(sum(CASE WHEN len(embedding) = 64 THEN 1 ELSE 0 END) AS BIGINT) AS n_valid
       FROM embeddings GROUP BY label""",
)
def h3(spark, d):
    ok = vector_ok(F.col("vector"), 64)
    return vec(spark, d).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_valid")
    )


@query(
    "h4_topk_similarity",
    build("SELECT source_id, target_id, round(sc, 6) AS score, rk AS rank FROM vec_near"),
)
def h4(spark, d):
    rows = vec(spark, d)
    return rounded(topk_similarity(rows, rows, 3, exclude_self=True))


@query(
    "h4_topk_partitioned",
    build("SELECT source_id, target_id, round(sc, 6) AS score, rk AS rank FROM vec_near"),
)
def h4_partitioned(spark, d):
    """The form for two large sides, on the same input."""
    rows = vec(spark, d)
    return rounded(topk_similarity(rows, rows, 3, exclude_self=True, small_rows=0))


@query("h5_approximate_topk")
def h5(spark, d):
    rows = vec(spark, d)
    index = build_vector_index(rows, tables=8)
    return rounded(approximate_topk(rows, index, 3, exclude_self=True))


# Ids of planted copies begin here.
COPY = 1_000_000_000


def with_copies(rows, factor=1.0):
    """The vectors and a copy of each, scaled, under another id."""
    scaled = F.transform("vector", lambda x: (x * F.lit(factor)).cast("float"))
    copies = rows.select((F.col("id") + COPY).alias("id"), scaled.alias("vector"), "label")
    return rows.unionByName(copies)


def copies_sql(metrics: dict[str, float]) -> str:
    """The nearest row of each vector among all others and the planted copies."""
    score = {
        "cosine": "list_cosine_similarity(a.e, b.e)",
        "l2": "1 - list_distance(a.e, b.e)",
        "dot": "list_inner_product(a.e, b.e)",
    }
    parts = [
        f"""SELECT '{metric}' AS metric, source_id, target_id, round(sc, 6) AS score FROM (
              SELECT a.vec_id AS source_id, b.vec_id AS target_id, {score[metric]} AS sc,
                     row_number() OVER (PARTITION BY a.vec_id
                                        ORDER BY round({score[metric]}, 9) DESC, b.vec_id) AS rk
              FROM vec a JOIN (
                SELECT vec_id, e FROM vec UNION ALL
                SELECT vec_id + {COPY}, list_transform(e, lambda x: (x * {factor})::FLOAT::DOUBLE) FROM vec
              ) b ON a.vec_id <> b.vec_id) WHERE rk = 1"""
        for metric, factor in metrics.items()
    ]
    return " UNION ALL ".join(parts)


METRIC_COPIES = {"cosine": 3.0, "l2": 1.0, "dot": 2.0}


@query("h5_planted_copies", build(copies_sql(METRIC_COPIES)))
def h5_copies(spark, d):
    """The approximate search of each metric finds the copy of every vector."""
    rows, out = vec(spark, d), None
    for metric, factor in METRIC_COPIES.items():
        index = build_vector_index(with_copies(rows, factor), metric=metric)
        near = rounded(approximate_topk(rows, index, 1, exclude_self=True))
        near = near.select(F.lit(metric).alias("metric"), "source_id", "target_id", "score")
        out = near if out is None else out.unionByName(near)
    return out


@query("h5_inverted_copies", build(copies_sql({"cosine": 3.0, "l2": 1.0})))
def h5_inverted(spark, d):
    """The same through the inverted file."""
    rows, out = vec(spark, d), None
    for metric, factor in (("cosine", 3.0), ("l2", 1.0)):
        index = build_inverted_index(with_copies(rows, factor), metric=metric)
        near = rounded(inverted_topk(rows, index, 1, exclude_self=True))
        near = near.select(F.lit(metric).alias("metric"), "source_id", "target_id", "score")
        out = near if out is None else out.unionByName(near)
    return out


@query(
    "h6_indexed_query",
    build(f"""SELECT vec_id AS id, label, round(1 - sc, 6) AS distance FROM (
                 SELECT b.vec_id, b.label, round(list_cosine_similarity(a.e, b.e), 9) AS sc
                 FROM (SELECT vec_id, label, e FROM vec UNION ALL
                       SELECT vec_id + n * {COPY}, label,
                              list_transform(e, lambda x: (x * n)::FLOAT::DOUBLE)
                       FROM vec, range(1, 5) AS t(n)) b,
                      (SELECT e FROM vec ORDER BY vec_id LIMIT 1) a)
             ORDER BY 1 - sc, vec_id LIMIT 5"""),
)
def h6_indexed(spark, d):
    """One vector against the partitions of its nearest cells; copies of it are all there is near."""
    rows = vec(spark, d)
    whole = rows
    for n in range(1, 5):
        scaled = F.transform("vector", lambda x: (x * F.lit(float(n))).cast("float"))
        whole = whole.unionByName(rows.select((F.col("id") + n * COPY).alias("id"), scaled.alias("vector"), "label"))
    index = build_inverted_index(whole, payload=["label"])
    first = rows.orderBy("id").select("vector").first()
    near = query_inverted(index, list(first[0]), 5, columns=["id", "label"])
    return near.withColumn("distance", F.round("distance", 6))


@query(
    "h6_single_query",
    build("""SELECT vec_id AS id, label, round(1 - sc, 6) AS distance FROM (
                 SELECT b.vec_id, b.label, round(list_cosine_similarity(a.e, b.e), 12) AS sc
                 FROM vec b, (SELECT e FROM vec ORDER BY vec_id LIMIT 1) a)
             ORDER BY 1 - sc, vec_id LIMIT 5"""),
)
def h6(spark, d):
    rows = vec(spark, d)
    first = rows.orderBy("id").select("vector").first()
    near = query_index(rows, list(first[0]), 5, columns=["id", "label"])
    return near.withColumn("distance", F.round("distance", 6))


PEOPLE = """(SELECT *, row_number() OVER (PARTITION BY source_id, label ORDER BY rk) AS again
             FROM vec_near)"""


@query(
    "h7_candidates",
    build(f"""SELECT source_id, label, row_number() OVER (PARTITION BY source_id
                     ORDER BY md5(label || ':7')) AS position FROM {PEOPLE} WHERE again = 1"""),
)
def h7(spark, d):
    rows = vec(spark, d)
    near = topk_similarity(rows, rows, 3, exclude_self=True)
    lists = candidates(near, rows, "id", ["label"], record_id="label", seed=7)
    return lists.select(
        "source_id", F.posexplode("candidates").alias("at", "c")
    ).select("source_id", "c.label", (F.col("at") + 1).cast("long").alias("position"))


@query(
    "e5_shuffle_candidates",
    build("""SELECT source_id, string_agg(target_id, ',' ORDER BY md5(target_id || ':3')) AS listed
             FROM vec_near GROUP BY source_id"""),
)
def e5(spark, d):
    rows = vec(spark, d)
    near = topk_similarity(rows, rows, 3, exclude_self=True)
    lists = candidates(near, rows, "id", ["id"], seed=3)
    return lists.select(
        "source_id",
        F.array_join(F.transform("candidates", lambda c: c["id"].cast("string")), ",").alias("listed"),
    )


def names(spark, d):
    """Two spellings of each customer name."""
    people = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    left = people.select(
        F.col("c_custkey").alias("id"),
        F.lower(F.regexp_replace("c_name", "#0*", " ")).alias("name"),
        "c_nationkey",
    )
    right = people.select(
        F.col("c_custkey").alias("id"),
        F.lower("c_name").alias("knownName"),
        F.lower("c_name").alias("fullName"),
        F.col("c_mktsegment").alias("category"),
        "c_nationkey",
    )
    return left, right


# Names that one task embeds.
NAMES_OF_TASK = 20_000


def name_candidates(spark, d):
    left, right = names(spark, d)
    # Many names make a small file; a vector is far larger than a name.
    tasks = max(spark.sparkContext.defaultParallelism, -(-left.count() // NAMES_OF_TASK))
    sides = [
        embed_rows(df, "id", text, partitions=tasks).join(df.select("id", "c_nationkey"), "id")
        for df, text in ((left, "name"), (right, "fullName"))
    ]
    # The right side is measured before it is searched; stored, it is embedded only once.
    near = topk_similarity(sides[0], materialise(sides[1], "names"), 3, block=["c_nationkey"])
    lists = candidates(near, right, "id", ["id", "knownName", "fullName", "category"])
    return left.join(lists, F.col("id") == F.col("source_id"), "left").drop("source_id")


NAME_VIEWS = {
    **NAME_GRAMS,
    "name_near": """
        SELECT l.c_custkey AS source_id, l.t AS name, r.c_custkey AS target_id, r.t AS target,
               row_number() OVER (PARTITION BY l.c_custkey
                   ORDER BY round(list_cosine_similarity(l.f, r.f), 12) DESC, r.c_custkey) AS rk
        FROM (SELECT n.*, f FROM names n JOIN names_vectors v ON v.id = n.id WHERE side = 'left') l
        JOIN (SELECT n.*, f FROM names n JOIN names_vectors v ON v.id = n.id WHERE side = 'right') r
        ON l.c_nationkey = r.c_nationkey""",
    "name_scored": """
        SELECT source_id, name, target_id, row_number() OVER w AS pick, score,
               score - coalesce(lead(score) OVER w, 0) AS lead
        FROM (SELECT *, round(1 - levenshtein(name, target)
                     / CAST(greatest(length(name), length(target)) AS DOUBLE), 6) AS score
              FROM name_near WHERE rk <= 3)
        WINDOW w AS (PARTITION BY source_id ORDER BY score DESC, target_id)""",
}


@query(
    "h8_resolve",
    build(
        """SELECT name, target_id AS matched_id, score,
                  CASE WHEN score >= 0.5 AND round(lead, 6) >= 0.05 THEN 'high' ELSE 'low' END
                      AS confidence
           FROM name_scored WHERE pick = 1""",
        NAME_VIEWS,
    ),
)
def h8(spark, d):
    judged = judge_by_score(
        name_candidates(spark, d),
        lambda c: edit_similarity(F.col("name"), c["fullName"]),
        threshold=0.5,
        margin=0.05,
    )
    done = resolve(judged, source=["name"], keep=["score"])
    return done.matched.select(
        "source.name", F.col("matched_record.id").alias("matched_id"), "score", "confidence"
    )


@query(
    "h8_edit_candidates",
    """WITH n AS (SELECT DISTINCT lower(c_name) AS t FROM customer)
       SELECT a.t AS source, b.t AS target, CAST(levenshtein(a.t, b.t) AS INTEGER) AS distance
       FROM n a JOIN n b ON levenshtein(a.t, b.t) <= 1""",
)
def h8_edits(spark, d):
    """Customer names at most one edit apart; most of each name is the same in all of them."""
    people = table(spark, d, "customer").select(F.lower("c_name").alias("text"))
    return edit_pairs(people, people, 1)


def same_number(sample, listed):
    """A judge as a plain function: the candidate with the same number, else none."""
    number = sample["name"].removeprefix("customer").strip() or "0"
    for record in listed:
        if int(record["fullName"].rsplit("#", 1)[1]) == int(number):
            return record["id"], "high"
    return -1, "low"


@query(
    "h9_function_judge",
    build(
        """SELECT name, CAST(max(CASE WHEN source_id = target_id THEN target_id END) AS VARCHAR)
                  AS matched_id,
                  CASE WHEN bool_or(source_id = target_id) THEN 'high'
                       ELSE 'answer is not a candidate' END AS outcome
           FROM (SELECT * FROM name_near WHERE rk <= 3) GROUP BY source_id, name""",
        NAME_VIEWS,
    ),
)
def h9(spark, d):
    judged = judge_by_function(name_candidates(spark, d), same_number, sample=["name"], concurrency=4)
    done = resolve(judged, source=["name"])
    matched = done.matched.select(
        "source.name",
        F.col("matched_record.id").cast("string").alias("matched_id"),
        F.col("confidence").alias("outcome"),
    )
    return matched.unionByName(
        done.rejected.select(
            "source.name", F.lit(None).cast("string").alias("matched_id"), F.col("reason").alias("outcome")
        )
    )


@query(
    "h10_keyed_load",
    build("""SELECT name, category, CAST(min(year) AS VARCHAR) AS year,
                    lower(name) || ' ' || lower(category) AS pk
             FROM entities WHERE type = 'laureate' GROUP BY name, category"""),
)
def h10(spark, d):
    kept = keyed_source(laureate_keys(shapes.tree(spark, d)))
    return text_year(kept).select("name", "category", "year", "pk")


@query(
    "g19_similar_to",
    build("SELECT source_id AS src, target_id AS dst, round(sc, 4) AS score FROM vec_near"),
)
def g19(spark, d):
    rows = vec(spark, d)
    near = topk_similarity(rows, rows, 3, exclude_self=True)
    edges = merge_edges(None, similar_edges(near), rows, "id", rows, "id", ["similarity_score"]).table
    return edges.select(
        "src", "dst", F.round(F.col("similarity_score").cast("double"), 4).alias("score")
    )



@query(
    "h3_improper_vectors",
    build("SELECT source_id, target_id, round(sc, 9) AS score, rk AS rank FROM vec_near"),
)
def h3_improper(spark, d):
    """Beside every vector a faulty copy of it is planted, with a NaN, NULL or infinite element;
    such rows are on neither side, and the search over all others is as without them."""
    rows = vec(spark, d).select("id", "vector")
    fault = (
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).when(F.col("id") % 3 == 1, F.lit(float("inf")))
    )
    faulty = rows.select(
        (F.col("id") + COPY).alias("id"),
        F.concat(F.array(fault.cast("float")), F.slice("vector", 2, 1 << 20)).alias("vector"),
    )
    both = rows.unionByName(faulty)
    found = topk_similarity(both, both, 3, exclude_self=True)
    return found.select(
        "source_id", "target_id", F.round("score", 9).alias("score"), F.col("rank").cast("long").alias("rank")
    )
