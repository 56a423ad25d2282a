"""Repair of the role structure of conversations by a grammar-compressed dynamic program.

Rows of a conversation are taken by turn (nulls first), role and MD5 of the text. Every row has a
*sign*: the class of its role (by the first character: s, u, a or another) and its first fault: blank
(nothing visible in the text), duplicate (role and text seen earlier) or truncated (the last visible
character is none of ``.!?``). Edits turn the roles into ``(s?(ua)+)?``:

==========  ====  =================================================================
K keep      0     not for blank and duplicate rows
R rerole    3     to user or assistant, whichever the pattern asks for
D delete    4     the only choice for blank and duplicate rows
I insert    3     a row with an empty text, anywhere, user or assistant
==========  ====  =================================================================

A truncated row that stays costs 3 more. Of the cheapest ways the one with the least letters wins.

Method: a conversation is a string of signs. Re-Pair over the distinct strings of the corpus replaces
the most frequent pairs of neighbours by new symbols, a bounded number of them. A symbol has one
min-plus transfer matrix over the states of the pattern (nothing yet, after s, after u, after a) whose
cells hold the cost and a rope of edit letters; a rule's matrix is the product of its two parts. So a
run of signs that many conversations share is evaluated once. Matrices are a monoid: conversations
longer than ``BLOCK`` rows are blocks whose matrices are multiplied in a tree. Inserts belong to the
row behind them, so neither of two ways through the same rows is a prefix of the other, and the least
letters of a product are the least letters of its parts.

Equal rows of a conversation are one counted row before anything is shuffled. The text moves once, in
the pass that applies the edits: rows stream behind the edits of their conversation, nothing of them
is held.

Nulls in role and text stand for one space; a null turn sorts first; rows without a conversation id
are one conversation. A conversation without rows has no edits. An empty table gives an empty result;
extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from textmill.storage import stage_table

#: Rows of a conversation that are one string of signs.
BLOCK = 1024
#: Rounds of Re-Pair and rules a round adds at most.
ROUNDS, RULES = 8, 32
#: Matrices multiplied by one task.
FAN = 64

CLASSES, FAULTS = "sua", ("", "blank", "duplicate", "truncated")
STATES = 4  # nothing yet, after s, after u, after a
_FIRST = 0x100  # signs and symbols are characters from here on
_FAR = 1 << 60

# ---- matrices -----------------------------------------------------------------------------------


class Rope:
    """Letters as a tree; written out once, when they are compared or read."""

    __slots__ = ("_parts", "_text")

    def __init__(self, text: str = "", parts=None):
        self._text, self._parts = (None, parts) if parts else (text, None)

    def __add__(self, other: Rope) -> Rope:
        return Rope(parts=(self, other))

    def __str__(self) -> str:
        if self._text is None:
            out, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope._text is None:
                    todo += (rope._parts[1], rope._parts[0])
                else:
                    out.append(rope._text)
            self._text, self._parts = "".join(out), None
        return self._text


Matrix = list[list[tuple[int, Rope] | None]]


def _better(one, two):
    if one is None or two is None:
        return one or two
    if one[0] != two[0]:
        return one if one[0] < two[0] else two
    return one if str(one[1]) <= str(two[1]) else two


def product(left: Matrix, right: Matrix) -> Matrix:
    made: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        for j in range(STATES):
            best = None
            for k in range(STATES):
                one, two = left[i][k], right[k][j]
                if one and two and (best is None or one[0] + two[0] <= best[0]):
                    best = _better(best, (one[0] + two[0], one[1] + two[1]))
            made[i][j] = best
    return made


_INSERTS: Matrix = [[None] * STATES for _ in range(STATES)]
for _i in range(STATES):
    _INSERTS[_i][_i] = (0, Rope())
for _i, _j, _n in ((0, 2, 1), (0, 3, 2), (1, 2, 1), (1, 3, 2), (2, 3, 1), (3, 2, 1)):
    _INSERTS[_i][_j] = (3 * _n, Rope("I" * _n))


def sign(role_class: int, fault: int) -> str:
    return chr(_FIRST + 4 * role_class + fault)


def _row_matrix(role_class: int, fault: int) -> Matrix:
    step: Matrix = [[None] * STATES for _ in range(STATES)]

    def offer(i, j, cost, letter):
        step[i][j] = _better(step[i][j], (cost, Rope(letter)))

    for i in range(STATES):
        offer(i, i, 4, "D")
    if FAULTS[fault] not in ("blank", "duplicate"):
        more = 3 if FAULTS[fault] == "truncated" else 0
        for i, j in ((0, 2), (1, 2), (3, 2), (2, 3)):
            offer(i, j, 3 + more, "R")
            if role_class < 3 and CLASSES[role_class] == "..ua"[j]:
                offer(i, j, more, "K")
        if role_class == 0:
            offer(0, 1, more, "K")
    return product(_INSERTS, step)


class Summary:
    """What is known of a run of rows: matrix, classes at both ends, numbers of faults and of
    neighbours that may not stand together."""

    __slots__ = ("matrix", "first", "last", "numbers")

    def __init__(self, matrix: Matrix, first: int, last: int, numbers: tuple):
        self.matrix, self.first, self.last, self.numbers = matrix, first, last, numbers

    @classmethod
    def of_row(cls, role_class: int, fault: int) -> Summary:
        return cls(_row_matrix(role_class, fault), role_class, role_class, tuple(int(fault == f) for f in (1, 2, 3)) + (0,))

    def __mul__(self, other: Summary) -> Summary:
        apart = (self.last, other.first) not in ((0, 1), (1, 2), (2, 1))
        numbers = tuple(a + b for a, b in zip(self.numbers, other.numbers))
        return Summary(product(self.matrix, other.matrix), self.first, other.last, (*numbers[:3], numbers[3] + apart))

    def best(self) -> tuple[int, str]:
        """Cost and letters of the cheapest way from nothing to an accepted end."""
        ended = product(self.matrix, _INSERTS)[0]
        cost, rope = _better(ended[0], ended[3])
        return cost, str(rope)


_ROW = {sign(c, f): (c, f) for c in range(4) for f in range(4)}


def summaries_of(rules: list[tuple[str, str]]) -> dict[str, Summary]:
    """Summary of every sign and, bottom-up, of every rule ``(pair, symbol)``."""
    known = {s: Summary.of_row(c, f) for s, (c, f) in _ROW.items()}
    for pair, made in rules:
        known[made] = known[pair[0]] * known[pair[1]]
        for row in known[made].matrix:
            for cell in row:
                if cell:
                    str(cell[1])  # written once here, shared by all that use the rule
    return known


def compressed(signs: str, rules: list[tuple[str, str]]) -> str:
    for pair, made in rules:
        signs = signs.replace(pair, made)
    return signs


def evaluate(signs: str, rules, known) -> Summary:
    symbols = compressed(signs, rules)
    total = known[symbols[0]]
    for symbol in symbols[1:]:
        total = total * known[symbol]
    return total


# ---- Re-Pair ------------------------------------------------------------------------------------


def repair_rules(strings: DataFrame, rounds: int = ROUNDS, rules_per_round: int = RULES) -> list[tuple[str, str]]:
    """Rules ``(pair, symbol)`` in order, from the distinct strings in column ``signs``. A round
    counts neighbours over all strings; pairs that share no symbol become rules together."""
    rules: list[tuple[str, str]] = []

    def counted(batches):
        found: Counter = Counter()
        for batch in batches:
            for signs in batch.column(0).to_pylist():
                symbols = compressed(signs, rules)
                found.update(map("".join, zip(symbols, symbols[1:])))
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["pair", "n"])

    for _ in range(rounds):
        counts = strings.select("signs").mapInArrow(counted, "pair string, n bigint")
        # there are at most (16 + rounds * rules_per_round) ** 2 pairs
        top = counts.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "pair").limit(8 * rules_per_round).collect()
        used: set[str] = set()
        fresh = []
        for row in top:
            if len(fresh) < rules_per_round and not used & set(row.pair):
                used |= set(row.pair)
                fresh.append((row.pair, chr(_FIRST + 16 + len(rules) + len(fresh))))
        if not fresh:
            break
        rules = rules + fresh
    return rules


# ---- tables -------------------------------------------------------------------------------------

_SUMMARY = "first int, last int, numbers array<bigint>, costs array<bigint>, letters array<string>"


def _written(summary: Summary) -> dict:
    cells = [cell for row in summary.matrix for cell in row]
    return {
        "first": summary.first, "last": summary.last, "numbers": list(summary.numbers),
        "costs": [c[0] if c else _FAR for c in cells], "letters": [str(c[1]) if c else "" for c in cells],
    }


def _read(row) -> Summary:
    cells = [(int(c), Rope(t)) if c < _FAR else None for c, t in zip(row.costs, row.letters)]
    matrix = [cells[STATES * i : STATES * (i + 1)] for i in range(STATES)]
    return Summary(matrix, int(row.first), int(row.last), tuple(map(int, row.numbers)))


def _rows(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``key, turn, role, text, md5``; the key is a string, empty for a missing id."""
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit("")).alias("key"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("md5", F.unhex(F.md5("text")))


def _signed(rows: DataFrame) -> DataFrame:
    """``key, turn, role, md5, c, first_sign, more_sign``: ``c`` equal rows, the first of which has
    ``first_sign`` and the others ``more_sign``."""
    visible = F.regexp_replace("text", r"[ \t-\r]+\z", "")
    fault = F.when(visible == "", 1).when(F.substring(visible, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    narrow = rows.select("key", "turn", "role", "md5", fault.alias("fault"))
    narrow = narrow.groupBy("key", "turn", "role", "md5", "fault").agg(F.count(F.lit(1)).alias("c"))
    narrow = stage_table(narrow, "turns")
    # the least turn; a null turn comes first. Only rows that occur at several turns have an entry
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = stage_table(
        narrow.groupBy("key", "role", "md5").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("least")).filter("n > 1").drop("n"), "again"
    )
    found = narrow.join(again, ["key", "role", "md5"], "left")
    repeated = F.col("least").isNotNull() & ~order.eqNullSafe(F.col("least"))
    initial = F.substring("role", 1, 1)
    role_class = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)

    def as_sign(fault):
        return (4 * role_class + fault).cast("int")

    faulty = F.when(F.col("fault") == 1, 1)
    return found.select(
        "key", "turn", "role", "md5", "c",
        as_sign(faulty.when(repeated, 2).otherwise(F.col("fault"))).alias("first_sign"),
        as_sign(faulty.otherwise(2)).alias("more_sign"),
    )


def _blocks(signed: DataFrame, block: int) -> DataFrame:
    """``key, part, signs``: the signs of a conversation in order, at most ``block`` at a time;
    ``part`` counts from 0. A long conversation lies in several tasks."""

    def run(partition, batches):
        held: list[str] = []
        key, number, size = None, 0, 0

        def out(last):
            nonlocal held, number, size
            signs = "".join(held)
            cut = len(signs) if last else len(signs) - len(signs) % block
            pieces = [signs[i : min(i + block, cut)] for i in range(0, cut, block)]
            made = [(key, (partition << 32) + number + i, p) for i, p in enumerate(pieces)]
            number += len(pieces)
            held, size = [signs[cut:]], len(signs) - cut
            return made

        for batch in batches:
            made: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for own, c, first, more in zip(*columns):
                if own != key:
                    made += out(True) if key is not None else []
                    key, number = own, 0
                left = c - 1
                held.append(chr(_FIRST + first))
                size += 1
                while left or size >= block:
                    part = min(left, 16 * block)
                    held.append(chr(_FIRST + more) * part)
                    left, size = left - part, size + part
                    if size >= block:
                        made += out(False)
                        if len(made) > 1000:
                            yield _table(made)
                            made = []
            yield _table(made)
        if key is not None:
            yield _table(out(True))

    def start(batches):
        yield from run(TaskContext.get().partitionId(), batches)

    def _table(made):
        columns = list(zip(*made)) if made else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string()))], ["key", "place", "signs"])

    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("md5")]
    ordered = signed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "c", "first_sign", "more_sign")
    blocks = stage_table(ordered.mapInArrow(start, "key string, place bigint, signs string"), "blocks")
    # numbers only where a conversation has several blocks: one row per block
    several = stage_table(blocks.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "long_ones")
    dense = (F.row_number().over(Window.partitionBy("key").orderBy("place")) - 1).cast("bigint")
    long_ones = blocks.join(several, "key", "left_semi").withColumn("part", dense)
    short = blocks.join(several, "key", "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    return stage_table(short.unionByName(long_ones).select("key", "part", "signs"), "numbered")


def _evaluated(blocks: DataFrame, rounds: int, rules_per_round: int) -> DataFrame:
    """``key, part`` and the summary of every block; equal strings are evaluated once."""
    strings = stage_table(blocks.select("signs").distinct(), "strings")
    rules = repair_rules(strings, rounds, rules_per_round)

    def run(batches):
        known = summaries_of(rules)
        for batch in batches:
            made = [{"signs": s, **_written(evaluate(s, rules, known))} for s in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    schema = "signs string, " + _SUMMARY
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    table = stage_table(strings.mapInArrow(run, schema), "summaries")
    # one row per string on this side, which is staged: a string that very many blocks share is split
    return stage_table(blocks.join(table, "signs").drop("signs"), "block_summaries")


def _multiplied(blocks: DataFrame) -> DataFrame:
    """``key, cost, audit, numbers`` of every conversation that has rows."""
    schema = "key string, part bigint, " + _SUMMARY

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        total = None
        for row in group.sort_values("part").itertuples():
            one = _read(row)
            total = one if total is None else total * one
        return pd.DataFrame([{"key": group["key"].iloc[0], "part": int(group["part"].min()) // FAN, **_written(total)}])

    most = blocks.agg(F.max("part")).first()[0] or 0
    current = blocks
    if most:
        several = stage_table(blocks.filter("part > 0").select("key").distinct(), "tall_ones")
        whole = blocks.join(several, "key", "left_anti")
        tall = blocks.join(several, "key", "left_semi")
        while most:
            grouped = tall.groupBy("key", F.floor(F.col("part") / FAN).alias("_up"))
            tall = stage_table(grouped.applyInPandas(lambda group: multiply(group), schema), "products")
            most //= FAN
        current = whole.unionByName(tall)

    def run(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for row in pd.DataFrame(batch.to_pylist()).itertuples() if batch.num_rows else ():
                one = _read(row)
                for column, value in zip(columns, (row.key, *one.best(), list(one.numbers))):
                    column.append(value)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "cost", "audit", "numbers"])

    return stage_table(current.mapInArrow(run, "key string, cost bigint, audit string, numbers array<bigint>"), "audits")


# ---- applying edits -----------------------------------------------------------------------------


def _edited(batches):
    """``(key, letter, role, text)`` of sorted rows that follow the edits of their conversation; the
    letter is empty where a conversation begins."""
    key, audit, at, state = None, "", 0, 0

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = 3 if state == 2 else 2
            at += 1
            yield key, "I", "user" if state == 2 else "assistant", ""

    for batch in batches:
        for own, letters, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if letters is not None:
                yield from inserts()
                key, audit, at, state = own, letters, 0, 0
                yield key, "", None, None
                continue
            yield from inserts()
            letter = audit[at]
            at += 1
            if letter == "D":
                yield key, "D", role, text
                continue
            if letter == "R":
                state = 3 if state == 2 else 2
                role = "user" if state == 2 else "assistant"
            else:
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            yield key, letter, role, text
    yield from inserts()


def _streamed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows behind the edits of their conversation. A conversation is one stream, read once."""
    none = F.lit(None).cast("string")
    lead = audits.select("key", F.col("audit").alias("letters"), none.alias("role"), none.alias("text"),
                         F.lit(0).alias("_kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("binary").alias("md5"))
    own = rows.select("key", none.alias("letters"), "role", "text", F.lit(1).alias("_kind"), "turn", "md5")
    both = lead.unionByName(own).repartition("key")
    ordered = both.sortWithinPartitions("key", "_kind", F.col("turn").asc_nulls_first(), "role", "md5")
    return ordered.select("key", "letters", "role", "text")


class Repair:
    """The repair of a table of turns. ``audits`` has a row per conversation that has rows: ``key, cost,
    audit, numbers`` (blank, duplicate, truncated, neighbours that may not stand together)."""

    def __init__(self, rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 block: int = BLOCK, rounds: int = ROUNDS, rules: int = RULES):
        self._rows = _rows(rows, conv_id, turn, role, text)
        self.audits = _multiplied(_evaluated(_blocks(_signed(self._rows), block), rounds, rules))

    def repaired(self) -> DataFrame:
        """``key, position, edit, role, text``: the rows that stay and the inserted ones in order."""

        def run(batches):
            position = 0
            made: list[tuple] = []

            def out():
                columns = list(zip(*made)) if made else [()] * 5
                made.clear()
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "position", "edit", "role", "text"])

            for key, letter, role, text in _edited(batches):
                if not letter:
                    position = 0
                elif letter != "D":
                    made.append((key, position, letter, role, text))
                    position += 1
                    if len(made) >= 2000:
                        yield out()
            yield out()

        return _streamed(self._rows, self.audits).mapInArrow(run, "key string, position bigint, edit string, role string, text string")

    def digests(self) -> DataFrame:
        """``key, repaired_sha256`` over ``role:text`` of the repaired rows, joined by line breaks."""

        def run(batches):
            done: list[tuple] = []
            hashed, key, first = None, None, True

            def out():
                columns = list(zip(*done)) if done else [(), ()]
                done.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["key", "repaired_sha256"])

            for own, letter, role, text in _edited(batches):
                if not letter:
                    if hashed is not None:
                        done.append((key, hashed.hexdigest()))
                        if len(done) >= 5000:
                            yield out()
                    hashed, key, first = hashlib.sha256(), own, True
                elif letter != "D":
                    hashed.update((("" if first else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    first = False
            if hashed is not None:
                done.append((key, hashed.hexdigest()))
            yield out()

        return _streamed(self._rows, self.audits).mapInArrow(run, "key string, repaired_sha256 string")


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Drops, empties, cuts, repeats or reroles rows by a checksum of their id and turn. Nulls in
    these columns count as one space."""

    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", filled(conv_id), filled(turn))) % 20
    new_text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(filled(text), "[.!?]", "")).otherwise(filled(text))
    marked = rows.select(conv_id, turn, filled(role).alias(role), filled(text).alias(text), kind.alias("_kind")).filter("_kind <> 0")
    changed = marked.select(
        conv_id, turn, F.when(F.col("_kind") == 4, "user").otherwise(F.col(role)).alias(role), new_text.alias(text),
        F.when(F.col("_kind") == 3, 2).otherwise(1).alias("_times"),
    )
    return changed.select(conv_id, turn, role, text, F.explode(F.array_repeat(F.lit(1), F.col("_times"))).alias("_one")).drop("_one")


def audit(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", **options) -> DataFrame:
    """Damage and repair of every conversation of ``rows``: ``conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256``."""
    id_type = rows.schema[conv_id].dataType
    work = rows.select(conv_id, turn, role, text)
    left = damage(work, conv_id, turn, role, text)
    repair = Repair(left, conv_id, turn, role, text, **options)
    key = F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit("")).alias("key")
    turns = left.select(key, F.col(turn).cast("bigint").alias("turn")).distinct()
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    spans = turns.groupBy("key").agg(gaps.cast("bigint").alias("gaps"))
    everyone = work.select(key, F.col(conv_id).alias("conv_id")).groupBy("key").agg(F.min("conv_id").alias("conv_id"))
    joined = everyone.join(spans, "key", "left").join(repair.audits, "key", "left").join(repair.digests(), "key", "left")
    zero = F.lit(0).cast("bigint")

    def number(i):
        return F.coalesce(F.col("numbers")[i], zero)

    return joined.select(
        F.col("conv_id").cast(id_type).alias(conv_id), F.coalesce("gaps", zero).alias("gaps"),
        number(0).alias("blank"), number(1).alias("duplicate"), number(2).alias("truncated"), number(3).alias("illegal"),
        F.coalesce("cost", zero).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
