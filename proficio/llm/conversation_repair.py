"""Repair of the turn structure of conversations by the cheapest edits.

A repaired conversation's role initials read ``(s?(ua)+)?``: perhaps a system
message, then user and assistant in turn, or nothing.  A row may be kept (0),
given the role user or assistant (1), or deleted (2); an empty message of
the user or assistant may be inserted anywhere (5).  Blank and repeated rows
must go; a truncated row that stays costs 5.

Rows are dealt by conversation and sorted by turn, the last first, and
stream through the tasks: the cheapest costs of the four states (nothing
yet, system, user, assistant) are carried from row to row and from Arrow
batch to Arrow batch, and every row leaves a back pointer of two bits a
state.  At a conversation's first row the pointers are followed to its last.
What a conversation has left behind goes to a temporary file in chunks once
it is over ``SPILL_BYTES``, so a giant one needs no more memory than others.
Copies of a row are merged before the shuffle, and whether a row repeats an
earlier one is found by an aggregate of digests, never in a task's memory.

Defined cases: a null role or text counts as one space; null conversation
ids are one conversation; null turns come first; rows of one turn come in
the order of role and text.  Ties between edits go to the audit (initials of
the edits, in order) that is least in ASCII order.  Empty texts are blank;
very long ones are streamed like others.  An empty table gives an empty
result.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SPILL_BYTES = 8 << 20
BATCH_BYTES = 4 << 20

DELETE, INSERT, KEEP, REROLE = range(4)
EDITS = "DIKR"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or reroled message leads from each state; a kept one must have that role's initial.
NEXT = (USER, USER, ASSISTANT, USER)
FAR = 1 << 60
ROLES = {USER: "user", ASSISTANT: "assistant"}


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def is_truncated(text: Column) -> Column:
    """Whether the last character that is no space is none of ``.!?``."""
    return ~F.substring(F.rtrim(text, F.lit(SPACE)), -1, 1).isin(".", "!", "?")


def marked(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Every distinct row with its copies and first fault (``blank``, ``duplicate``, ``truncated`` or null).

    Equal rows meet in a partial aggregate.  The first turn of every (role,
    text) of a conversation comes from a second one, over digests, and joins
    back on a key that is unique on both sides.
    """
    conv, turn = F.col(conv_col), F.col(turn_col)
    rows = conversations.select(
        conv.isNotNull().cast("int").alias("has_conv"), F.coalesce(conv.cast("string"), F.lit("")).alias("conv_key"),
        turn.isNotNull().cast("int").alias("has_turn"), F.coalesce(turn.cast("bigint"), F.lit(0)).alias("turn_key"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.sha2("text", 256))
    same = ["has_conv", "conv_key", "role", "digest"]
    merged = rows.groupBy(*same, "has_turn", "turn_key").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    earliest = (rows.groupBy(*same).agg(F.min(F.struct("has_turn", "turn_key")).alias("at"))
                .select(*same, "at.has_turn", "at.turn_key", F.lit(True).alias("first")))
    fault = (F.when(is_blank(F.col("text")), "blank").when(F.col("first").isNull(), "duplicate")
             .when(is_truncated(F.col("text")), "truncated"))
    return merged.join(earliest, [*same, "has_turn", "turn_key"], "left").withColumn("fault", fault).drop("first", "digest")


def streamed(rows: DataFrame) -> DataFrame:
    """The marked rows dealt by conversation, and in each task every conversation from its last row to its first."""
    return (rows.repartition("has_conv", "conv_key")
            .sortWithinPartitions("has_conv", "conv_key", F.desc("has_turn"), F.desc("turn_key"), F.desc("role"), F.desc("text"))
            .select("has_conv", "conv_key", "has_turn", "turn_key", "role", "text", "fault", "copies"))


def kept_state(state: int, initial: str) -> int | None:
    """The state after a message of this initial is kept, or None where it can't be."""
    if state == NOTHING and initial == "s":
        return SYSTEM
    to = NEXT[state]
    return to if ROLES[to][0] == initial else None


def relax(cost: list[int], pointer: list[int]) -> tuple[tuple[int, ...], int]:
    """Costs and packed pointers of the four states once insertions before this row are allowed too."""
    for state in (USER, ASSISTANT, NOTHING, SYSTEM):
        other = COST[INSERT] + cost[NEXT[state]]
        if other < cost[state] or (other == cost[state] and pointer[state] > INSERT):
            cost[state], pointer[state] = other, INSERT
    return tuple(cost), sum(p << (2 * s) for s, p in enumerate(pointer))


#: Cheapest edits once no row is left: nothing where the conversation may end, else insertions.
END, END_POINTER = relax([0, FAR, FAR, 0], [DELETE] * 4)


def step(after: tuple[int, ...], initial: str, truncated: bool) -> tuple[tuple[int, ...], int]:
    """Costs and pointers before a row that need not be deleted, from those after it."""
    cost, pointer = [], []
    for state in range(4):
        stays = TRUNCATED_COST if truncated else 0
        options = [(COST[DELETE] + after[state], DELETE), (COST[REROLE] + stays + after[NEXT[state]], REROLE)]
        to = kept_state(state, initial)
        if to is not None:
            options.append((COST[KEEP] + stays + after[to], KEEP))
        best = min(options)
        cost.append(best[0])
        pointer.append(best[1])
    return relax(cost, pointer)


class Conversation:
    """What is known of one conversation while its rows stream by, the last row first."""

    def __init__(self, conv, steps: dict):
        self.conv, self.steps = conv, steps
        self.base, self.cost = 0, END
        self.chunk: list[tuple] = []
        self.size, self.file, self.places = 0, None, []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.later: str | None = None
        self.turns, self.last_turn, self.max_turn = 0, None, None

    def add(self, turn: int | None, role: str, text: str, fault: str | None, copies: int) -> None:
        initial = role[:1]
        if self.later is not None and initial + self.later not in ("su", "ua", "au"):
            self.illegal += 1
        if copies > 1:
            self.illegal += copies - 1          # a role after itself
        self.later = initial
        if turn is not None and turn != self.last_turn:
            self.turns, self.last_turn = self.turns + 1, turn
            self.max_turn = turn if self.max_turn is None else self.max_turn
        gone = copies - 1 if fault in (None, "truncated") else copies
        if fault == "blank":
            self.blank += copies
        else:
            self.duplicate += copies - (fault != "duplicate")
            self.truncated += fault == "truncated"
        if gone:                                # later copies come first in this order
            self.base += COST[DELETE] * gone
            self.chunk.append((None, gone, None))
        if gone < copies:
            key = (self.cost, initial, fault == "truncated")
            found = self.steps.get(key)
            if found is None:
                cost, pointer = step(*key)
                found = self.steps[key] = (min(cost), tuple(c - min(cost) for c in cost), pointer)
            self.base += found[0]
            self.cost = found[1]
            self.chunk.append((found[2], role, text))
            self.size += len(text)
        self.size += 64
        if self.size > SPILL_BYTES:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.places.append(self.file.tell())
        pickle.dump(self.chunk, self.file)
        self.chunk, self.size = [], 0

    def records(self) -> Iterator[tuple]:
        """What was noted of the rows, the first row first."""
        yield from reversed(self.chunk)
        for place in reversed(self.places):
            self.file.seek(place)
            yield from reversed(pickle.load(self.file))

    def edits(self) -> Iterator[tuple[int, int, str, str]]:
        """(edit, times, role, text) in order, along the pointers; role and text are those of the repaired message."""
        state = NOTHING
        for pointer, role, text in self.records():
            if pointer is None:
                yield DELETE, role, "", ""
                continue
            while (edit := pointer >> (2 * state) & 3) == INSERT:
                state = NEXT[state]
                yield INSERT, 1, ROLES[state], ""
            if edit == DELETE:
                yield DELETE, 1, "", ""
            elif edit == KEEP:
                state = kept_state(state, role[:1])
                yield KEEP, 1, role, text
            else:
                state = NEXT[state]
                yield REROLE, 1, ROLES[state], text
        while state not in (NOTHING, ASSISTANT):
            state = NEXT[state]
            yield INSERT, 1, ROLES[state], ""

    def report(self) -> tuple:
        audit, digest, first = [], hashlib.sha256(), True
        for edit, times, role, text in self.edits():
            audit.append(EDITS[edit] * times)
            if edit != DELETE:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        gaps = 0 if self.max_turn is None else self.max_turn - self.last_turn + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.base + self.cost[NOTHING],
                "".join(audit), digest.hexdigest())

    def messages(self) -> Iterator[tuple]:
        place = 0
        for edit, _, role, text in self.edits():
            if edit != DELETE:
                yield self.conv, place, EDITS[edit], role, text
                place += 1

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


REPORT = ["gaps bigint", "blank bigint", "duplicate bigint", "truncated bigint", "illegal bigint", "cost bigint", "audit string",
          "repaired_sha256 string"]
MESSAGES = ["place bigint", "edit string", "role string", "text string"]


def _finished(parts: Iterator[pd.DataFrame]) -> Iterator[Conversation]:
    """Each conversation of a task once its first row has come; the state lives on from batch to batch."""
    steps: dict = {}
    now, key = None, None
    for part in parts:
        for has_conv, conv, has_turn, turn, role, text, fault, copies in part.itertuples(index=False, name=None):
            if (has_conv, conv) != key:
                if now is not None:
                    yield now
                now, key = Conversation(conv if has_conv else None, steps), (has_conv, conv)
            now.add(turn if has_turn else None, role, text, fault if isinstance(fault, str) else None, copies)
    if now is not None:
        yield now


def _stream(conversations: DataFrame, conv_col: str, kind: list[str], rows_of, **columns: str) -> DataFrame:
    names = ["conv", *[c.split()[0] for c in kind]]

    def repair(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for conversation in _finished(parts):
            for row in rows_of(conversation):
                out.append(row)
                size += 64 + sum(len(x) for x in row if isinstance(x, str))
                if size > BATCH_BYTES:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
            conversation.close()
        if out:
            yield pd.DataFrame(out, columns=names)

    rows = streamed(marked(conversations, conv_col, **columns))
    found = rows.mapInPandas(repair, f"conv string, {', '.join(kind)}")
    return found.select(F.col("conv").cast(conversations.schema[conv_col].dataType).alias(conv_col), *names[1:])


def repair_report(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """One row per conversation: its faults, the cost and audit of its repair, and the digest of the repaired rows."""
    return _stream(conversations, conv_col, REPORT, lambda c: [c.report()], turn_col=turn_col, role_col=role_col,
                   text_col=text_col)


def repaired_messages(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """The repaired conversations: place from 0, the edit's initial, role and text of every message."""
    return _stream(conversations, conv_col, MESSAGES, lambda c: c.messages(), turn_col=turn_col, role_col=role_col,
                   text_col=text_col)


def damaged(conversations: DataFrame) -> DataFrame:
    """The test damage: by crc32(``conv_id:turn``) % 20 a row is dropped, emptied, stripped of ``.!?``, repeated or given to the user."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("harm"))
    return (rows.where("harm <> 0")
            .withColumn("text", F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", ""))
                        .otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")))
            .withColumn("copy", F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
            .select("conv_id", "turn", "role", "text"))


def damage_report(conversations: DataFrame) -> DataFrame:
    """:func:`repair_report` of the damaged rows for every original conversation, zeros for those that lost all rows."""
    nothing = hashlib.sha256(b"").hexdigest()
    found = repair_report(damaged(conversations)).withColumnRenamed("conv_id", "found_id")
    ids = conversations.select("conv_id").distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    zero = {"audit": F.lit(""), "repaired_sha256": F.lit(nothing)}
    return joined.select("conv_id", *[F.coalesce(c, zero.get(c, F.lit(0).cast("bigint"))).alias(c)
                                      for c in (x.split()[0] for x in REPORT)])
