"""URL filter: written rules first, then trust and distrust spread over the links of hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.session import materialise

# The rules of the filter, as (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?([^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Share of a host's score that comes from its neighbours.
DAMPING = 0.85
STEPS = 20
# Steps between two writes of the scores.
WRITE_EVERY = 5
# A host is blocked if its distrust exceeds its trust by more than this. A host of blocked
# pages alone starts with 1 - DAMPING, and a host all of whose links lead there has 0.85 of
# that, however many others link there too; with half of its links it stays below.
THRESHOLD = 0.075


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _longest_rule(rules: tuple[tuple[str, str], ...], host: str, path: str) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; NULL if none."""

    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        of_host = (F.col(host) == name) | F.endswith(F.col(host), F.lit(f".{name}"))
        return of_host & F.startswith(F.col(path), F.lit(slash + rest))

    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    return F.coalesce(
        *(
            F.when(
                fits(rule),
                F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")),
            )
            for verdict, rule in ordered
        )
    )


def host_links(pages: DataFrame, html_col: str = "html", host: str = "_host") -> DataFrame:
    """(src, dst, links): links from pages of one host to other hosts."""
    links = pages.select(
        F.col(host).alias("src"),
        F.explode(F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1))).alias("_link"),
    )
    full = F.when(F.startswith("_link", F.lit("//")), F.concat(F.lit(":"), "_link"))
    return (
        links.withColumn("dst", url_host(F.coalesce(full, F.col("_link"))))
        .filter("dst <> '' AND src <> '' AND dst <> src")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def spread(
    seeds: DataFrame, links: DataFrame, damping: float = DAMPING, steps: int = STEPS
) -> DataFrame:
    """Personalised PageRank from (host, trust, distrust) over (src, dst, links).

    Trust follows links; distrust goes against them, to the hosts that link to bad ones. Either
    way a link counts as its share of all links out of the host it is on: a host hands on its
    trust by these shares, and takes on distrust as the mean of what its links lead to, which
    the number of other links to a bad host does not thin out. Both walk in the same join. A
    host without onward links keeps nothing back: its share leaves the walk, so no sum over
    all hosts is needed. Scores are written every few steps. Returns (host, trust, distrust)
    of the hosts that any score reaches.
    """
    kinds = [("trust", "src", "dst"), ("distrust", "dst", "src")]
    # Stored, so that the join is of two plain shuffles and a host with very many links splits.
    total = materialise(links.groupBy("src").agg(F.sum("links").alias("_all")), "url-totals")
    shares = links.join(total, "src").withColumn("share", F.col("links") / F.col("_all"))
    moves = None
    for kind, start, end in kinds:
        part = shares.select(
            F.lit(kind).alias("kind"), F.col(start).alias("host"), F.col(end).alias("to"), "share"
        )
        moves = part if moves is None else moves.unionByName(part)
    moves = materialise(moves, "url-moves")
    start = None
    for kind, _, _ in kinds:
        part = seeds.filter(F.col(kind) > 0).select(
            F.lit(kind).alias("kind"), "host", (F.col(kind) * (1 - damping)).alias("score")
        )
        start = part if start is None else start.unionByName(part)
    start = scores = materialise(start, "url-seeds")
    for step in range(1, steps + 1):
        moved = scores.join(moves, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), (F.col("score") * F.col("share") * damping).alias("score")
        )
        scores = (
            start.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        )
        if step % WRITE_EVERY == 0 or step == steps:
            scores = materialise(scores, "url-scores")
    return scores.groupBy("host").agg(
        *(
            F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
            for kind, _, _ in kinds
        )
    )


def judge_urls(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    rules: tuple[tuple[str, str], ...] = RULES,
    threshold: float = THRESHOLD,
    damping: float = DAMPING,
    steps: int = STEPS,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every page.

    The longest rule that fits a page judges it. Other pages are judged by their host: the
    shares of its pages that rules allow and block are its seeds of trust and distrust,
    which spread over links between hosts; a host whose distrust exceeds its trust by more
    than ``threshold`` is blocked. A URL that is NULL or has no ``://`` has an empty host and
    path, fits no rule, takes no part in the graph and is allowed. NULL html has no links.
    Columns of these names in the input are replaced; repeated rows are judged alike and
    count again; an empty input gives no rows.
    """
    out = ["host", "path", "rule", "verdict"]
    pages = pages.drop(*out)
    # The input's columns travel in one, so that none can be taken for a column made here.
    judged = pages.select(
        F.struct(*pages.columns).alias("_page"),
        F.col(html_col).alias("_html"),
        url_host(F.col(url_col)).alias("_host"),
        url_path(F.col(url_col)).alias("_path"),
    ).withColumn("_rule", _longest_rule(rules, "_host", "_path"))
    share = {
        kind: F.avg(F.coalesce(F.col("_rule.verdict") == verdict, F.lit(False)).cast("double"))
        for kind, verdict in (("trust", "allow"), ("distrust", "block"))
    }
    seeds = (
        judged.filter("_host <> ''")
        .groupBy(F.col("_host").alias("host"))
        .agg(*(c.alias(kind) for kind, c in share.items()))
    )
    scores = spread(seeds, materialise(host_links(judged, "_html"), "url-links"), damping, steps)
    bad = (
        scores.filter(F.round(F.col("distrust") - F.col("trust"), 9) > threshold)
        .select(F.col("host").alias("_bad"))
    )
    return judged.join(bad, F.col("_host") == F.col("_bad"), "left").select(
        *(F.col("_page").getField(name).alias(name) for name in pages.columns),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce(
            "_rule.verdict", F.when(F.col("_bad").isNotNull(), "block").otherwise("allow")
        ).alias("verdict"),
    )
