"""Mixing sources to target weights by multinomial slots and permuted block indexes."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinweave.llm.words import SPACE_CLASS, running_total, word_count
from kinweave.operators.numbering import assign_index
from kinweave.session import materialise

# Words of a block; a source misses its target by about one block.
BLOCK_WORDS = 32
WEIGHTS = (5, 2, 1)
# Times a block may be taken.
MOST_REPEATS = 3
SHARD_SLOTS = 4096
# Documents of a source whose places one task sums.
PLACED_ROWS = 20_000
ROUNDS = 10
SEED = 20_240_611


@dataclass
class Mix:
    """``rows``: the input's ``_id`` (and ``_doc``) with ``_row``, ``_sid``, ``_size``, ``_start`` (place in its
    source's stream of words); ``sources``: one row per source; ``slots``: the mix, one row
    per slot with its shard, source and block."""

    rows: DataFrame
    sources: DataFrame
    slots: DataFrame
    block_words: int


def _targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Add the target of each source.

    Shares by weight of all words; a source above ``most`` times its size stops there, and
    what it leaves is shared again by weight. Only sums over the sources reach the driver.
    """
    total, all_weight = sizes.agg(F.sum("_source_size"), F.sum("_weight")).first()
    cap = F.col("_source_size") * most
    level = total / all_weight if all_weight else 0.0
    while all_weight:
        above = F.col("_weight") * F.lit(level) > cap
        capped, rest = sizes.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0)),
        ).first()
        if not rest or (total - capped) / rest <= level:
            break
        level = (total - capped) / rest
    want = F.col("_weight") * F.lit(float(level))
    return sizes.withColumn("_target", F.least(want, cap.cast("double")))


def source_table(
    rows: DataFrame, source_col: str, weights: tuple[int, ...], most: int, block_words: int
) -> DataFrame:
    """One row per source: number, size, weight, target, blocks, slots and running sums."""
    sizes = rows.groupBy(source_col).agg(F.sum("_size").alias("_source_size"))
    numbered = assign_index(
        sizes.withColumn("_last", F.col(source_col).isNull()), ["_last", source_col], "_sid"
    )
    pick = F.array(*(F.lit(w) for w in weights))
    weighed = numbered.withColumns(
        {
            "_sid": F.col("_sid") - 1,
            "_weight": F.element_at(
                pick, (F.pmod(F.col("_sid") - 1, F.lit(len(weights))) + 1).cast("int")
            ),
        }
    ).drop("_last")
    aimed = _targets(materialise(weighed, "mix-sources"), weights, most)
    blocks = F.ceil(F.col("_source_size") / block_words).cast("long")
    # In blocks of the source's mean length, so that a source of a few words counts right.
    slots = F.when(
        F.col("_source_size") > 0, F.round(F.col("_target") * blocks / F.col("_source_size"))
    ).otherwise(0)
    counted = aimed.withColumns({"_blocks": blocks, "_slots": slots.cast("long")})
    return materialise(running_total(counted, "_sid", "_slots", "_from"), "mix-targets")


def _places(rows: DataFrame) -> DataFrame:
    """Add ``_start``, each document's first word in its source's stream.

    The stream is in the order of a hash of the id; rows of one id, and those without any, come
    by a hash of their content, so only equal rows depend on how files are split. Its leading bits cut a source into
    parts that are summed in parallel, so a source with a third of all rows is spread too.
    """
    n = rows.count()
    bits = min(30, max(0, math.ceil(math.log2(max(1, n / PLACED_ROWS)))))
    part = F.shiftright("_order", 64 - bits) if bits else F.lit(0).cast("long")
    cut = rows.withColumn("_part", part)
    before = (
        Window.partitionBy("_sid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    base = (
        cut.groupBy("_sid", "_part")
        .agg(F.sum("_size").alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    inner = (
        Window.partitionBy("_sid", "_part")
        .orderBy("_order", "_tie", "_row")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        cut.withColumn("_upto", F.sum("_size").over(inner) - F.col("_size"))
        .join(base, ["_sid", "_part"])
        .withColumn("_start", F.col("_base") + F.col("_upto"))
        .drop("_part", "_base", "_upto", "_order", "_tie")
    )


def _look_up(points: DataFrame, point: str, ranges: DataFrame, total: int) -> DataFrame:
    """Join each point of [0, total) to the range [_lo, _hi) that holds it.

    Both sides meet by equal bins; the ranges part [0, total), so a bin holds few of them.
    """
    width = max(1, math.ceil(total / max(1024, 4 * ranges.count())))
    bins = ranges.filter("_lo < _hi").withColumn(
        "_bin",
        F.explode(
            F.sequence(
                F.floor(F.col("_lo") / width).cast("long"),
                F.floor((F.col("_hi") - 1) / width).cast("long"),
            )
        ),
    )
    return (
        points.withColumn("_bin", F.floor(F.col(point) / width).cast("long"))
        .join(bins, "_bin")
        .filter((F.col(point) >= F.col("_lo")) & (F.col(point) < F.col("_hi")))
        .drop("_bin", "_lo", "_hi")
    )


def _permuted(x: Column, n: Column, keys: list[str], seed: int) -> Column:
    """``x`` under a pseudorandom permutation of [0, n) chosen by ``keys``.

    Swap-or-not rounds: a keyed reflection pairs the indexes, and a keyed bit of the pair
    says whether they change places. Each round is its own inverse, so none can collide.
    The rounds are a fold, as chained columns would double in size with each round.
    """

    def step(at: Column, r: Column) -> Column:
        mate = F.pmod(F.pmod(F.xxhash64(*keys, F.lit(seed), r), n) - at, n)
        coin = F.xxhash64(F.greatest(at, mate), *keys, F.lit(seed), r, F.lit("swap"))
        return F.when(coin.bitwiseAND(F.lit(1)) == 1, mate).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, step)


def _slots(sources: DataFrame, seed: int) -> DataFrame:
    """The mix: ``slot``, ``shard``, ``_sid``, ``_block``.

    Each slot draws a source with the targets' odds by a hash of its number; the counts of a
    shard are thus multinomial. Draws of a source beyond its number of slots go to sources
    that are short of theirs, so the totals are exact. The n-th slot of a source is block
    n of its permutation; each pass over the blocks has a permutation of its own.
    """
    spark = sources.sparkSession
    total = sources.agg(F.sum("_slots")).first()[0] or 0
    shard = max(SHARD_SLOTS, math.isqrt(total))
    ranges = sources.select("_sid", F.col("_from").alias("_lo"), (F.col("_from") + F.col("_slots")).alias("_hi"))
    tickets = spark.range(total).withColumns(
        {
            "slot": F.col("id"),
            "shard": F.floor(F.col("id") / shard).cast("long"),
            "_ticket": F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(max(1, total))),
        }
    ).drop("id")
    drawn = materialise(_look_up(tickets, "_ticket", ranges, total).drop("_ticket"), "mix-draws")
    before = Window.partitionBy("_sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        drawn.groupBy("_sid", "shard")
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("_base", F.coalesce(F.sum("_count").over(before), F.lit(0)))
    )
    inner = Window.partitionBy("_sid", "shard").orderBy("slot")
    facts = sources.select("_sid", "_slots", "_blocks")
    numbered = (
        drawn.withColumn("_nth", F.row_number().over(inner) - 1)
        .join(counts.drop("_count"), ["_sid", "shard"])
        .withColumn("_nth", F.col("_base") + F.col("_nth"))
        .drop("_base")
        .join(facts, "_sid")
    )
    got = counts.groupBy("_sid").agg(F.sum("_count").alias("_got"))
    balance = facts.join(got, "_sid", "left").withColumn("_got", F.coalesce("_got", F.lit(0)))
    balance = balance.withColumns(
        {
            "_over": F.greatest(F.col("_got") - F.col("_slots"), F.lit(0)),
            "_short": F.greatest(F.col("_slots") - F.col("_got"), F.lit(0)),
        }
    )
    balance = running_total(balance, "_sid", "_over", "_over_from")
    balance = materialise(running_total(balance, "_sid", "_short", "_lo"), "mix-balance")
    moved = balance.agg(F.sum("_over")).first()[0] or 0
    extra = (
        numbered.filter("_nth >= _slots")
        .join(balance.select("_sid", "_over_from"), "_sid")
        .select(
            "slot",
            "shard",
            (F.col("_over_from") + F.col("_nth") - F.col("_slots")).alias("_extra"),
        )
    )
    short = balance.select(
        "_sid", "_slots", "_blocks", "_got", F.col("_lo").alias("_first"), "_lo",
        (F.col("_lo") + F.col("_short")).alias("_hi"),
    )
    handed = _look_up(extra, "_extra", short, moved).select(
        "slot",
        "shard",
        "_sid",
        (F.col("_got") + F.col("_extra") - F.col("_first")).alias("_nth"),
        "_slots",
        "_blocks",
    )
    filled = numbered.filter("_nth < _slots").unionByName(handed).withColumn(
        "_pass", F.floor(F.col("_nth") / F.col("_blocks")).cast("long")
    )
    n = F.col("_blocks")
    block = _permuted(F.pmod(F.col("_nth"), n), n, ["_sid", "_pass"], seed)
    return filled.select("slot", "shard", "_sid", block.alias("_block"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    whole: bool = False,
) -> Mix:
    """Mix the words of all documents so that every source nears its target.

    Sources in code-point order, NULL last, take the weights in turn; ``_targets`` says
    what a source may take. A source's documents form one stream of words in a pseudorandom
    order, cut into blocks; ``slots`` names a block for each place of the mix. A block is
    taken at most ``most`` times, and so is each word of a document. NULL and empty texts
    have no words and are never taken; repeated rows are rows of their own; an empty input
    gives an empty mix. The input is read once: its rows are written with a row number, as
    ``_id`` and, if ``whole``, as ``_doc`` with all columns.
    """
    document = [F.struct(*docs.columns).alias("_doc")] if whole else []
    numbered = materialise(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("_of"),
            word_count(F.col(text_col)).alias("_size"),
            F.xxhash64(id_col, source_col, text_col).alias("_tie"),
            *document,
        ).withColumn("_row", F.monotonically_increasing_id()),
        "mix-rows",
    )
    sources = source_table(numbered, "_of", weights, most, block_words)
    order = F.when(F.col("_id").isNull(), F.col("_tie")).otherwise(F.xxhash64("_id"))
    by_source = sources.select(F.col("_of").alias("_name"), "_sid")
    narrow = numbered.select("_of", "_row", "_size", "_tie", order.alias("_order"))
    placed = _places(
        narrow.join(by_source, F.col("_of").eqNullSafe(F.col("_name"))).drop("_of", "_name")
    )
    # Both are read more than once, and short plans keep the driver's memory free.
    placed, slots = materialise(placed, "mix-places"), materialise(_slots(sources, seed), "mix-slots")
    return Mix(numbered.drop("_size", "_tie").join(placed, "_row"), sources, slots, block_words)


def taken_pieces(mix: Mix) -> DataFrame:
    """Per document and block: ``_row``, ``_at`` (first word), ``_words``, ``_times``.

    Joins the slots to the blocks by index; a block nobody took has no row.
    """
    size = F.lit(mix.block_words)
    times = mix.slots.groupBy("_sid", "_block").agg(F.count(F.lit(1)).alias("_times"))
    first = F.floor(F.col("_start") / size).cast("long")
    last = F.floor((F.col("_start") + F.col("_size") - 1) / size).cast("long")
    pieces = (
        mix.rows.filter("_size > 0")
        .select("_row", "_sid", "_start", "_size", F.explode(F.sequence(first, last)).alias("_block"))
        .withColumn("_at", F.greatest(F.col("_block") * size, F.col("_start")))
        .withColumn(
            "_words",
            F.least((F.col("_block") + 1) * size, F.col("_start") + F.col("_size")) - F.col("_at"),
        )
        .withColumn("_at", F.col("_at") - F.col("_start"))
    )
    return pieces.join(times, ["_sid", "_block"]).select("_row", "_at", "_words", "_times")


def taken_words(mix: Mix, id_col: str = "doc_id") -> DataFrame:
    """(id, size, source_size, target, taken) of every row."""
    taken = taken_pieces(mix).groupBy("_row").agg(
        F.sum(F.col("_words") * F.col("_times")).alias("taken")
    )
    facts = mix.sources.select(
        "_sid", F.col("_source_size").alias("source_size"), F.col("_target").alias("target")
    )
    return (
        mix.rows.join(facts, "_sid")
        .join(taken, "_row", "left")
        .select(
            F.col("_id").alias(id_col),
            F.col("_size").alias("size"),
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The mix as documents with the input's columns.

    A document appears once for each time that some of its words are taken; the copy has the
    words taken at least so often, joined by a blank. A copy that takes them all has the text
    unchanged. Documents without words are not taken.
    """
    mix = mix_sources(docs, id_col, text_col, source_col, whole=True)
    original = F.col("_doc").getField(text_col)
    copies = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    spans = (
        taken_pieces(mix)
        .select("_row", copies.alias("_copy"), F.struct("_at", "_words").alias("_span"))
        .groupBy("_row", "_copy")
        .agg(
            F.sort_array(F.collect_list("_span")).alias("_spans"),
            F.sum("_span._words").alias("_got"),
        )
    )
    trimmed = F.regexp_replace(original, f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")

    def joined_spans(words: Column) -> Column:
        parts = F.transform(
            "_spans",
            lambda s: F.slice(words, (s["_at"] + 1).cast("int"), s["_words"].cast("int")),
        )
        return F.array_join(F.flatten(parts), " ")

    # Bound to a variable, so that the text is split once and not for every span.
    words = F.array(F.split(trimmed, f"{SPACE_CLASS}+"))
    cut = F.get(F.transform(words, joined_spans), F.lit(0))
    joined = mix.rows.join(spans, "_row")
    text = F.when(F.col("_got") < F.col("_size"), cut).otherwise(original)
    return joined.select(
        *(
            (text if name == text_col else F.col("_doc").getField(name)).alias(name)
            for name in docs.columns
        )
    )
