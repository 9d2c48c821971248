"""Conversation repair: cheapest edits found on an automaton that shares the ends of conversations."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm.words import SPACES
from kinweave.session import materialise

# What the remainder of a row's crc32 does to it.
DROP, EMPTY, UNEND, REPEAT, REROLE = range(5)
DAMAGE_OF = 20
BLANK = " "
# Costs of the edits, and what a truncated row that is not deleted adds.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
# States of the grammar (s?(ua)+)?, as state -> {role initial: next state}.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ACCEPTING = (START, ASSISTANT)
FULL_ROLE = {"u": "user", "a": "assistant"}
# A row's sign: its role's initial (``o`` for any other), upper-case if truncated; ``x`` if it
# must be deleted.
GONE, OTHER = "x", "o"
IMPOSSIBLE = 1 << 60
INSERT = ord("I")
# Conversations that a task sends on together.
BATCH_ROWS = 1000


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(_conv, _turn, _role, _text, _row) of all rows after damage; ``_row`` is NULL if dropped.

    A dropped row stays with a NULL ``_row``, so that its conversation is not lost. A repeated
    row is there twice.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(BLANK))

    key = F.concat(filled(conv), F.lit(":"), filled(turn))
    what = F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(DAMAGE_OF))
    copies = F.when(what == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.when(what != DROP, F.lit(0)))
    )
    return rows.select(
        F.col(conv).alias("_conv"),
        F.col(turn).alias("_turn"),
        F.when(what == REROLE, "user").otherwise(filled(role)).alias("_role"),
        F.when(what == EMPTY, "")
        .when(what == UNEND, F.translate(filled(text), ".!?", ""))
        .otherwise(filled(text))
        .alias("_text"),
        F.explode(copies).alias("_row"),
    )


def _order() -> list[Column]:
    return [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_digest"), F.col("_row")]


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_digest", F.unhex(F.sha2("_text", 256)))


def signed(rows: DataFrame) -> DataFrame:
    """Each damaged row without its text: its place in the order, its sign and its fault.

    Only hashes of texts are shuffled. Both orders are sorts of the one partitioning by
    conversation, which spill and hold no conversation in memory.
    """
    narrow = _hashed(rows).select(
        "_conv",
        "_turn",
        "_role",
        "_digest",
        "_row",
        F.right(F.rtrim("_text", F.lit(SPACES)), F.lit(1)).alias("_last"),
    )
    narrow = narrow.withColumns(
        {
            "_is_blank": F.col("_last") == "",
            "_is_cut": ~F.col("_last").isin(".", "!", "?"),
            "_initial": F.substring("_role", 1, 1),
        }
    )
    seen = F.row_number().over(
        Window.partitionBy("_conv", "_role", "_digest").orderBy(
            F.col("_row").isNull(), F.col("_turn").asc_nulls_first(), "_row"
        )
    )
    fault = (
        F.when(F.col("_is_blank"), "blank")
        .when(F.col("_nth") > 1, "duplicate")
        .when(F.col("_is_cut"), "truncated")
    )
    initial = F.when(F.col("_initial").isin(*"sua"), F.col("_initial")).otherwise(OTHER)
    sign = (
        F.when(F.col("_fault").isin("blank", "duplicate"), GONE)
        .when(F.col("_fault") == "truncated", F.upper(initial))
        .otherwise(initial)
    )
    return (
        narrow.repartition("_conv")
        .withColumn("_nth", seen)
        .withColumn("_fault", fault)
        .withColumn("_sign", sign)
        .select("_conv", "_turn", "_role", "_digest", "_row", "_initial", "_fault", "_sign")
    )


class _Counts:
    """What is counted of a conversation while its rows pass by."""

    def __init__(self, conv: object) -> None:
        self.conv = conv
        self.signature = bytearray()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.least = self.most = self.before = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: str | None, sign: str) -> None:
        if self.signature and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.signature += sign.encode()
        if fault:
            self.faults[fault] += 1
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn

    def row(self) -> tuple:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return (self.conv, self.signature.decode(), gaps, *self.faults.values(), self.illegal)


def conversations(rows: DataFrame) -> DataFrame:
    """(_conv, signature, gaps, blank, duplicate, truncated, illegal) of each conversation.

    The rows of a task pass by in order; of a conversation only its signature is kept, a byte
    for each row.
    """
    names = ["_conv", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"]
    schema = T.StructType(
        [
            rows.schema["_conv"],
            T.StructField("signature", T.StringType()),
            *(T.StructField(name, T.LongType()) for name in names[2:]),
        ]
    )
    arrow = [pa.string(), *[pa.int64()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, done, kind = None, [], None

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, [kind, *arrow])], names=names
            )

        for batch in batches:
            kind = batch.column(0).type
            for conv, turn, row, initial, fault, sign in zip(
                *(batch.column(k).to_pylist() for k in range(6))
            ):
                if counts is None or conv != counts.conv:
                    if counts is not None:
                        done.append(counts.row())
                    counts = _Counts(conv)
                if row is not None:
                    counts.add(turn, initial, fault, sign)
            if len(done) >= BATCH_ROWS:
                yield batch_of(done)
                done = []
        if counts is not None:
            done.append(counts.row())
        if done:
            yield batch_of(done)

    ordered = signed(rows).sortWithinPartitions("_conv", *_order())
    return ordered.select("_conv", "_turn", "_row", "_initial", "_fault", "_sign").mapInArrow(
        run, schema
    )


class Automaton:
    """The shared ends of signatures that come in the order of their reversed text.

    A node is the end of a signature from one row on, the same for all signatures with that
    end. For each state of the grammar it has the least cost from here, the first edit of the
    cheapest audit, and the state that leads to; the rest of the audit is that of the next
    node, so ends are never written out twice. Possible edits differ in their letter, so the
    least letter among equal costs begins the ASCII-least audit.

    Only the path of the latest signature is kept, 40 bytes a row: a signature takes the nodes
    of the end it shares with the one before and adds its own. In that order a node left
    behind does not come again, so each is made once.
    """

    def __init__(self) -> None:
        self.costs, self.edits, self.goals = array("q"), bytearray(), bytearray()
        self.latest = ""
        self._add([(0 if state in ACCEPTING else IMPOSSIBLE, "\0", state) for state in range(4)])

    def _add(self, best: list[tuple[int, str, int]]) -> None:
        """A node, from the best of each state without inserts before its row.

        From USER and ASSISTANT two inserts lead back, so one is enough; START and SYSTEM go
        through USER.
        """
        plain = list(best)
        for state, goal in ((USER, ASSISTANT), (ASSISTANT, USER)):
            best[state] = min(plain[state], (INSERT_COST + plain[goal][0], "I", goal))
        for state in (START, SYSTEM):
            best[state] = min(plain[state], (INSERT_COST + best[USER][0], "I", USER))
        self.costs.extend(cost for cost, _, _ in best)
        self.edits.extend(ord(letter) for _, letter, _ in best)
        self.goals.extend(goal for _, _, goal in best)

    def audit(self, reverse: str) -> tuple[int, str]:
        """Cost and letters of the cheapest edits of a signature."""
        shared = 0
        for mine, other in zip(reverse, self.latest):
            if mine != other:
                break
            shared += 1
        for kept in (self.costs, self.edits, self.goals):
            del kept[4 * (shared + 1) :]
        self.latest = reverse
        for sign in reverse[shared:]:
            after = self.costs[-4:]
            self._add([min(_edits(sign, state, after)) for state in range(4)])
        state, node, letters = START, len(reverse), bytearray()
        while letter := self.edits[4 * node + state]:
            letters.append(letter)
            state = self.goals[4 * node + state]
            node -= letter != INSERT
        return self.costs[4 * len(reverse) + START], letters.decode()


def _edits(sign: str, state: int, after: Sequence[int]) -> Iterator[tuple[int, str, int]]:
    """(cost with all that follows, letter, next state) of what can be done with a row."""
    yield DELETE_COST + after[state], "D", state
    if sign == GONE:
        return
    extra = TRUNCATED_COST if sign.isupper() else 0
    for initial, goal in MOVES[state].items():
        if initial == sign.lower():
            yield extra + after[goal], "K", goal
        if initial in FULL_ROLE:
            yield extra + REROLE_COST + after[goal], "R", goal


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of each distinct signature.

    Reversed signatures are shuffled by ranges, so those that share an end share a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            reverses = batch.column(0).to_pylist()
            found = [automaton.audit(reverse) for reverse in reverses]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([reverse[::-1] for reverse in reverses], pa.string()),
                    pa.array([cost for cost, _ in found], pa.int64()),
                    pa.array([letters for _, letters in found], pa.string()),
                ],
                names=["signature", "cost", "audit"],
            )

    return (
        signatures.select(F.reverse("signature").alias("_reverse"))
        .distinct()
        .repartitionByRange("_reverse")
        .sortWithinPartitions("_reverse")
        .mapInArrow(run, "signature string, cost long, audit string")
    )


class Repair:
    """Applies an audit to the rows of a conversation as they pass by."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START
        self.sha, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        if self.lines:
            self.sha.update(b"\n")
        self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1
        self.state = MOVES[self.state][role[:1]]

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._line(self._wanted(), "")
            self.at += 1

    def _wanted(self) -> str:
        return FULL_ROLE["a" if self.state == USER else "u"]

    def row(self, role: str, text: str) -> None:
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self._line(role if letter == "K" else self._wanted(), text)

    def digest(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The rows of ``plans`` with ``repaired_sha256``: one shuffle of the texts.

    A conversation's plan comes before its rows, which pass by in order and are not kept. The
    hash runs over a conversation from its first row to its last, so one task must see it all.
    """
    names = [name for name in plans.columns if name != "_conv"]
    digests = T.StructType([plans.schema["_conv"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, repair, kind = None, None, None
        for batch in batches:
            kind = batch.column(0).type
            convs, found = [], []
            for owner, letters, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if letters is None:
                    repair.row(role, text)
                    continue
                if repair is not None:
                    convs.append(conv)
                    found.append(repair.digest())
                conv, repair = owner, Repair(letters)
            yield pa.RecordBatch.from_arrays(
                [pa.array(convs, kind), pa.array(found, pa.string())], names=digests.names
            )
        if repair is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), pa.array([repair.digest()])], names=digests.names
            )

    texts = _hashed(rows.filter(F.col("_row").isNotNull()))
    both = plans.select("_conv", "audit").unionByName(texts, allowMissingColumns=True)
    done = (
        both.repartition("_conv")
        .sortWithinPartitions("_conv", F.col("audit").isNull(), *_order())
        .select("_conv", "audit", "_role", "_text")
        .mapInArrow(run, digests)
        .withColumnRenamed("_conv", "_of")
    )
    return plans.join(done, F.col("_conv").eqNullSafe(F.col("_of"))).select(
        "_conv", *names, "repaired_sha256"
    )


def repair_conversations(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: its faults after damage, the cheapest edits and their result.

    Returns (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).
    A NULL in any column counts as one space, and all rows with a NULL conversation are one.
    Rows of one turn come in the order of their role and their text's SHA-256; a NULL turn comes
    first and is no turn for ``gaps``. Repeated rows are duplicates. A role that begins neither
    with s, u nor a can only be changed or deleted. A conversation without rows has zeros, an
    empty audit and the hash of nothing; an empty input gives no rows. Other columns are not read.
    """
    whole = damaged(rows, conv, turn, role, text)
    found = materialise(conversations(whole), "repair-conversations")
    known = materialise(audits(found.select("signature")), "repair-audits")
    # Both are stored tables, so a signature that very many conversations share can be split.
    plans = materialise(found.join(known, "signature").drop("signature"), "repair-plans")
    return repaired(whole, plans).withColumnRenamed("_conv", conv)
