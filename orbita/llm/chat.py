"""Transcript parsing by a hidden Markov model, and canonical rendering of the turns.

A transcript is plain text in which speakers take turns, mostly announced by markers
("User:", "### Response:", a name) and often by blank lines, sometimes by neither.
Hidden states are a role, whether the line begins its turn, and a habit that a transcript keeps throughout: markers may be left out,
or every turn has one (then an unmarked paragraph goes on with the turn before).  A line is observed
through its marker, a blank line before it, its length, a closing question mark, its form (code, list or prose) and whether
the line before it ends with a colon.  Probabilities are counted on labelled transcripts, in which turns also have paragraphs
and code; Viterbi recovers the states, and each
turn is rendered as ``<|role|>``, its lines, ``<|end|>``.  Inside a turn all lines stay as they
are, blank ones too; a turn loses only blank lines at its borders and the marker that announces it,
with one space after it.  A known marker announces turns of its own role; any other name does if no
known marker begins a turn of that role, it is the most frequent name that does (of equals the
first), and it does so twice or the transcript's turns have no known markers at all.

The result has one row per recovered turn, whatever the length of a conversation.  Inside, a conversation is cut into chunks
(parts of ``PART_TURNS`` turn numbers, crowded ones into pieces of consecutive rows), which are decoded as one transcript: each
chunk gives a table of the best score of every way from the state before it to its last one.  Tables of ``FAN``
neighbouring chunks are multiplied (maximum of sums) to one, level by level, until a conversation has ``FAN`` or fewer; the states
at the borders are then found from the top down, ``FAN`` tables at a time.  Chunks are decoded between these, and pieces of a turn that runs
over a border are put together.  Of ways of equal likelihood any may be taken.  No task holds more than ``FAN`` tables or one turn of a conversation.

Defined cases: a null or blank transcript has one row without turn number and role, of empty text; unknown roles are
left out of the training; without labelled lines all states are equally likely at first;
null conv_ids and turns are transcripts of one row; repeated rows count once; rows that share a
turn are put in order of their role and text as written; very long texts are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import bound_batches, text_or_empty, written

ROLES = ("system", "user", "assistant")
#: A role, whether the line begins its turn, and the transcript's habit (0: a marker may be left out, 1: every turn has one).
STATES = [(r, begins, habit) for habit in (0, 1) for r in ROLES for begins in (True, False)]
#: Turn numbers of one transcript part, and different rows in it before it is split.
PART_TURNS, PART_ROWS = 256, 4096
#: Tables of one conversation that are multiplied in one row.
FAN = 256

# What speakers are called.
MARKERS = {
    "system": "system|system prompt|system message|sys|instructions|context|setup",
    "user": "user|human|customer|question|q|instruction|prompt|me|client|input",
    "assistant": "assistant|ai|bot|answer|a|response|model|gpt|agent|chatbot|output|support",
}
_KNOWN = {name: role for role, names in MARKERS.items() for name in names.split("|")}
_MARKER = re.compile(r"^\s*(?:#{1,4}\s*|\*\*|<\|?|\[)?\s*([A-Za-z][A-Za-z .]{0,19}?)\s*(?:\*\*\s*:|:\s*\*\*|\|?>|\]:?|:(?=\s|$))[^\S\n]?(.*)$", re.S)
_KINDS = {"none": 0, "system": 1, "user": 2, "assistant": 3, "name": 4}
_CODE = re.compile(r"^(?: {4}|\t|```|~~~)|[;{}]\s*$|^\s*(?:def|class|import|return|for|if) .*[:)]\s*$")
_LIST = re.compile(r"^\s*(?:[-*+•] |\d{1,3}[.)] |>|\|)")
OBSERVATIONS = (len(_KINDS), 2, 4, 2, 3, 2)


def lines_of(text: str | None, before: int = 1) -> list[tuple[str, tuple[int, ...], str, str]]:
    """Non-blank lines as (line, observation, line without its marker, name in the marker); ``before``: 1 if the line before
    is blank, and 2 more if the last one that is not ends with a colon."""
    out = []
    blank, colon = bool(before & 1), before > 1
    for line in (text or "").split("\n"):
        if not line.strip():
            blank = True
            continue
        m = _MARKER.match(line)
        kind, name = "none", ""
        if m:
            name = " ".join(m[1].lower().split())
            kind = _KNOWN.get(name, "name")
        bare = m[2] if m else line
        words = len(bare.split())
        out.append((line, (_KINDS[kind], int(blank), 0 if words < 8 else 1 if words < 20 else 2 if words < 50 else 3,
                           int(bare.rstrip().endswith("?")), 1 if _CODE.search(line) else 2 if _LIST.match(line) else 0, int(colon)),
                    bare, name))
        blank, colon = False, line.rstrip().endswith(":")
    return out


def announcing(begun: list[tuple[str, str]]) -> set[tuple[str, str]]:
    """The (role, name) that announce turns, of (role, name in its marker) of every begun turn."""
    votes = Counter(x for x in begun if x[1])
    out = {x for x in votes if _KNOWN.get(x[1]) == x[0]}
    known = {role for role, _ in out}
    for role in ROLES:
        names = [x for x in votes if x[0] == role and x[1] not in _KNOWN]
        best = max(names, key=votes.get, default=None)  # of equals the first
        if best and role not in known and (votes[best] > 1 or not known):
            out.add(best)
    return out


def joined(rows: list[str]) -> str:
    """The lines of a turn without blank ones at its borders."""
    full = [k for k, x in enumerate(rows) if x.strip()]
    return "\n".join(rows[full[0]:full[-1] + 1]) if full else ""


class Model:
    """Log probabilities of the first state, of steps and of each part of an observation."""

    def __init__(self, first: Counter, steps: Counter, seen: Counter):
        n = len(STATES)
        self.first = self._logs(np.array([first[s] for s in range(n)], float))
        self.steps = self._logs(np.array([[steps[a, b] for b in range(n)] for a in range(n)], float))
        # A turn is begun before it goes on, what goes on keeps its role, and a transcript its habit.
        for a, (role, _, habit) in enumerate(STATES):
            for b, (other, begins, same) in enumerate(STATES):
                if habit != same or (not begins and role != other):
                    self.steps[a, b] = -np.inf
        self.first[[s for s, (_, begins, _) in enumerate(STATES) if not begins]] = -np.inf
        self.seen = [self._logs(np.array([[seen[k, s, v] for v in range(size)] for s in range(n)], float))
                     for k, size in enumerate(OBSERVATIONS)]

    @staticmethod
    def _logs(counts: np.ndarray) -> np.ndarray:
        return np.log((counts + 0.1) / (counts + 0.1).sum(axis=-1, keepdims=True))

    def emission(self, observation: tuple[int, ...]) -> np.ndarray:
        return sum(table[:, v] for table, v in zip(self.seen, observation))

    def decode(self, observations: list[tuple[int, ...]], start: int | None = None, end: int | None = None) -> list[int]:
        """Viterbi, from the state before and to the last one if given; ties go to the state that comes first."""
        if not observations:
            return []
        best, back = (self.first if start is None else self.steps[start]) + self.emission(observations[0]), []
        for o in observations[1:]:
            ways = best[:, None] + self.steps
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + self.emission(o)
        path = [int(best.argmax()) if end is None else end]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]

    def ways(self, observations: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Best scores from each state before (the last row: none) to each state of the last line, and
        whether the first line begins a turn on that way."""
        best = np.vstack([self.steps, self.first]) + self.emission(observations[0])
        begins = np.tile([b for _, b, _ in STATES], (len(STATES) + 1, 1))
        for o in observations[1:]:
            step = best[:, :, None] + self.steps
            begins = np.take_along_axis(begins, step.argmax(axis=1), axis=1)
            best = step.max(axis=1) + self.emission(o)
        return best, begins

    def turns(self, text: str | None) -> list[tuple[str, str]]:
        """Recovered (role, text) turns."""
        return [(role, joined(rows)) for role, rows in self.chunk(text)[0]]

    def chunk(self, text: str | None, blank: int = 1, start: int | None = None, end: int | None = None,
              announced: set | None = None) -> tuple[list[tuple[str | None, list[str]]], list[tuple[str, str]]]:
        """(role, lines) of each turn, and (role, name in the marker) of those begun here.  The first role is
        None for lines that go on with a turn begun before."""
        rows, lines = (text or "").split("\n"), lines_of(text, blank)
        between = () if start is None and end is None else (start, end)
        states = [STATES[s][:2] for s in self.decode([o for _, o, _, _ in lines], *between)]
        begun = [(role, name) for (role, begins), (*_, name) in zip(states, lines) if begins]
        announced = announcing(begun) if announced is None else announced
        found = iter(zip(states, lines))
        out: list[tuple[str | None, list[str]]] = [] if start is None else [(None, [])]
        for row in rows:
            if row.strip():
                (role, begins), (_, _, bare, name) = next(found)
                if begins:
                    out.append((role, []))
                    row = bare if (role, name) in announced else row
            if out:
                out[-1][1].append(row)
        return out, begun


def product(tables: list[np.ndarray | None]) -> np.ndarray | None:
    """The table of consecutive chunks as one: the best way through all of them (None: none has lines)."""
    out = None
    for t in tables:
        if t is not None:
            t = np.reshape(t, (len(STATES) + 1, len(STATES)))
            out = t if out is None else (out[:, :, None] + t[None, :-1, :]).max(axis=1)
    return out


def stitch(tables: list, start: int | None = None, end: int | None = None) -> list[tuple[int | None, int | None]]:
    """Of each table in order (None without lines): the state before it and its last state.  ``start`` is the state
    before the first (None: there is none), ``end`` the last one if it is known."""
    n = len(STATES)
    score, back = np.full(n + 1, -np.inf), []
    score[n if start is None else start] = 0.0
    for best in tables:
        if best is None:
            back.append(None)
            continue
        step = score[:, None] + np.reshape(best, (n + 1, n))
        back.append(step.argmax(axis=0))
        score = np.append(step.max(axis=0), -np.inf)
    at, out = int(score.argmax()) if end is None else end, []
    for b in reversed(back):
        before = at if b is None else int(b[at])
        out.append((None if before == n else before, None if at == n else at))
        at = before
    return out[::-1]


def turn_pieces(turns: list[tuple[str | None, list[str]]], goes_on: bool) -> list[tuple[str | None, str]]:
    """(role, text) of a chunk's turns, role None for a piece of a turn begun before.  What a turn lacks at a border,
    the next chunk has."""
    out = []
    for k, (role, rows) in enumerate(turns):
        full = [i for i, x in enumerate(rows) if x.strip()]
        last = k == len(turns) - 1
        if role is not None:
            rows = rows[full[0]:] if full else []
        if last and goes_on:
            text = "".join(x + "\n" for x in rows)
        elif role is None and not full:
            continue  # the turn ended in an earlier chunk
        else:
            text = joined(rows) if role is not None else "\n".join(rows[:full[-1] + 1])
        out.append((role, text))
    return out


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in turns)


def true_states(turns: list[tuple[str, str]], habit: int = 0) -> list[int | None]:
    """The state of each line of (role, raw text of the turn); None under unknown roles."""
    return [STATES.index((role, k == 0, habit)) if role in ROLES else None
            for role, raw in turns for k in range(sum(1 for x in raw.split("\n") if x.strip()))]


def count_lines(turns: list[tuple[str, str]], blank: int = 1, last: int | None = None, habit: int = 0) -> tuple[Counter, Counter, Counter]:
    """First states, steps and observations of one transcript given as (role, raw text of the turn), or of
    a chunk with what stands before it."""
    first, steps, seen = Counter(), Counter(), Counter()
    lines = lines_of("\n".join(t for _, t in turns), blank)
    states = true_states(turns, habit)
    for (_, observation, _, _), s in zip(lines, states):
        if s is None:
            last = None
            continue
        if last is None:
            first[s] += 1
        else:
            steps[last, s] += 1
        for k, v in enumerate(observation):
            seen[k, s, v] += 1
        last = s
    return first, steps, seen


# How raw transcripts are written from a table of turns: markers of each style (system, user, assistant),
# and whether a blank line parts the turns.  Fixed values.
STYLES = [(("System: ", "User: ", "Assistant: "), True), (("System prompt: ", "Human: ", "AI: "), True),
          (("Instructions: ", "Q: ", "A: "), False), (("### System:\n", "### Instruction:\n", "### Response:\n"), True),
          (("Note: ", "Maria: ", "Tom: "), True)]


def habit_of(conv: str) -> Column:
    """The habit in which a conversation's transcript is written: 1 for every second one."""
    return F.coalesce(F.pmod(F.xxhash64(F.lit("habit"), conv), F.lit(2)), F.lit(0)).cast("int")


def written_text(conv: str, turn: str, role: str, text: str) -> Column:
    """A turn's text as written.  Where every turn has a marker, one in four gets a blank line behind its first sentence (some of these paragraphs begin with
    a name of their own speaker), one in twelve ends with a piece of code."""
    body, dice = text_or_empty(text), F.pmod(F.xxhash64(F.lit("form"), conv, turn), F.lit(24))
    own = F.when((F.col(role) == "assistant") & (dice == 0), F.lit("Answer: ")).when(
        (F.col(role) == "user") & (dice == 0), F.lit("Question: ")).otherwise(F.lit(""))
    parted = F.concat(F.regexp_extract(body, r"(?s)^([^.!?]*[.!?]) (.*)$", 1), F.lit("\n\n"), own,
                      F.regexp_extract(body, r"(?s)^([^.!?]*[.!?]) (.*)$", 2))
    coded = F.concat(body, F.lit("\nLike this:\n\n    x = f(1)\n\n    return x"))
    return F.when(habit_of(conv) == 0, body).when((dice < 6) & body.rlike(r"(?s)^[^.!?]*[.!?] \S"), parted).when((dice >= 22) & (body != ""), coded).otherwise(body)


def written_turn(conv: str, turn: str, role: str, text: str) -> Column:
    """A turn as it stands in its transcript: a style and a habit by conversation; with habit 0 one marker in five is left out
    where a blank line parts the turns."""
    style = F.pmod(F.xxhash64(F.lit("style"), conv), F.lit(len(STYLES)))
    out = None
    for k, (markers, blank) in enumerate(STYLES):
        marker = F.lit("")
        for r, m in zip(ROLES, markers):
            marker = F.when(F.col(role) == r, F.lit(m)).otherwise(marker)
        if blank:
            marker = F.when((habit_of(conv) == 0) & (F.pmod(F.xxhash64(F.lit("marker"), conv, turn), F.lit(5)) == 0), F.lit("")).otherwise(marker)
        whole = F.concat(F.lit("\n" if blank else ""), marker, written_text(conv, turn, role, text))
        out = F.when(style == k, whole) if out is None else out.when(style == k, whole)
    return out


def transcripts(turns: DataFrame) -> DataFrame:
    """``conv_id, part, piece, turns``: one row per chunk of a transcript, its (turn, role, raw) in order.

    Parts of a conversation hold ``PART_TURNS`` turn numbers; a part of more than ``PART_ROWS`` different
    rows is cut into pieces of ``PART_ROWS`` consecutive ones, so no group grows without bound.
    """
    rows = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).agg(
        F.lit(1).alias("one")).select("conv_id", "turn", "role", written_turn("conv_id", "turn", "role", "text").alias("raw"))
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    rows = written(rows.withColumn("part", F.floor(F.col("turn") / PART_TURNS)).withColumn(
        "alone", F.when(alone, F.xxhash64("turn", "role", "raw")).otherwise(0)), "chat-rows")
    group = ["conv_id", "part"]
    crowded = written(rows.where(~alone).groupBy(*group).count().where(F.col("count") > PART_ROWS).select(*group), "chat-crowded")
    # Ranks in a part of many tasks: places in sorted ranges, and what earlier ranges hold of the part.
    order = ["conv_id", "turn", "role", "raw"]
    ranged = written(rows.join(crowded, group, "left_semi").repartitionByRange(shuffle_partitions(turns.sparkSession), *order)
                     .sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
                     .withColumn("range", F.shiftright("at", 33)), "chat-ranges")
    earlier = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = ranged.groupBy(*group, "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("least"))
    held = held.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("least")).drop("n", "least")
    pieces = ranged.join(held, [*group, "range"]).withColumn(
        "piece", F.floor((F.col("at") + F.col("before")) / PART_ROWS)).select(*rows.columns, "piece")
    rows = rows.join(crowded, group, "left_anti").withColumn("piece", F.lit(0).cast("long")).unionByName(pieces)
    return rows.groupBy("conv_id", "part", "piece", "alone").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "raw"))).alias("turns")).select("conv_id", "part", "piece", "turns")


CHUNK = ["conv_id", "part", "piece"]


def with_borders(chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``blank, last`` (what stands before, as in ``lines_of``, and which true state, -1 for none)
    in conversations of several chunks; null elsewhere."""

    def ends(batches):
        for batch in batches:
            rows = [[(t["role"], t["raw"]) for t in turns] for turns in batch.column(3).to_pylist()]
            states = [true_states(t, h) for t, h in zip(rows, batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([not t[-1][1].split("\n")[-1].strip() for t in rows], pa.bool_()), pa.array(
                    [next((x.rstrip().endswith(":") for _, raw in reversed(t) for x in reversed(raw.split("\n")) if x.strip()), None)
                     for t in rows], pa.bool_()),
                 pa.array([(-1 if s[-1] is None else s[-1]) if s else None for s in states], pa.int64())], names=[*CHUNK, "blank", "colon", "last"])

    whole = chunks.where(F.col("part").isNotNull() & F.col("conv_id").isNotNull())
    several = whole.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv_id")
    found = written(whole.join(several, "conv_id", "left_semi").select(*CHUNK, "turns", habit_of("conv_id").alias("habit")).mapInArrow(
        ends, "conv_id long, part long, piece long, blank boolean, colon boolean, last long"), "chat-borders")
    order = Window.partitionBy("conv_id").orderBy("part", "piece")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    colon = F.coalesce(F.last("colon", ignorenulls=True).over(earlier), F.lit(False)).cast("int")
    before = found.select(*CHUNK, (F.coalesce(F.lag("blank").over(order), F.lit(True)).cast("int") + 2 * colon).alias("blank"), F.coalesce(
        F.last("last", ignorenulls=True).over(earlier), F.lit(-1)).alias("last"))
    return chunks.join(before, CHUNK, "left")


def is_held_out(conv: str = "conv_id") -> Column:
    return F.coalesce(F.crc32(F.col(conv).cast("string")) % 5 == 0, F.lit(False))


def train(labelled: DataFrame) -> Model:
    """Count all labelled transcripts (``turns``); a table of bounded size reaches the driver."""

    def counted(batches):
        for batch in batches:
            total = Counter()
            for turns, blank, last, habit in zip(*(c.to_pylist() for c in batch.columns)):
                before = (1, None) if blank is None else (blank, None if last < 0 else last)
                for kind, c in enumerate(count_lines([(t["role"], t["raw"]) for t in turns], *before, habit)):
                    for key, n in c.items():
                        key = key if isinstance(key, tuple) else (key,)
                        total[(kind, *key, *[-1] * (3 - len(key)))] += n
            cols = list(zip(*[(*k, n) for k, n in total.items()])) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["kind", "a", "b", "c", "n"])

    rows = (labelled.select("turns", "blank", "last", habit_of("conv_id").alias("habit")).mapInArrow(counted, "kind long, a long, b long, c long, n long")
            .groupBy("kind", "a", "b", "c").agg(F.sum("n").alias("n")).collect())
    return Model(Counter({r.a: r.n for r in rows if r.kind == 0}), Counter({(r.a, r.b): r.n for r in rows if r.kind == 1}),
                 Counter({(r.a, r.b, r.c): r.n for r in rows if r.kind == 2}))


TABLES = "conv_id long, rank long, best array<double>"


def _groups(tables: DataFrame) -> DataFrame:
    """``FAN`` neighbouring tables of a conversation in one row."""
    return tables.groupBy("conv_id", F.floor(F.col("rank") / FAN).alias("group")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "best"))).alias("c"))


def multiplied(tables: DataFrame) -> DataFrame:
    """The next level of ``tables``: one for each group."""

    def products(batches):
        for batch in batches:
            found = [product([x["best"] for x in c]) for c in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([None if t is None else t.ravel().tolist() for t in found],
                                                                            pa.list_(pa.float64()))], names=["conv_id", "rank", "best"])

    return _groups(tables).mapInArrow(products, TABLES)


def stitched(tables: DataFrame, above: DataFrame | None) -> DataFrame:
    """``conv_id, rank, start, end`` of ``tables``, between the states that ``above`` found for their groups."""

    def run(batches):
        for batch in batches:
            out = []
            for conv, c, start, end in zip(*(x.to_pylist() for x in batch.columns)):
                out += [(conv, t["rank"], *x) for t, x in zip(c, stitch([t["best"] for t in c], start, end))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(4)],
                                             names=["conv_id", "rank", "start", "end"])

    groups = _groups(tables)
    if above is None:
        groups = groups.withColumn("start", F.lit(None).cast("long")).withColumn("end", F.lit(None).cast("long"))
    else:
        groups = groups.join(above.withColumnRenamed("rank", "group"), ["conv_id", "group"])
    return groups.select("conv_id", "c", "start", "end").mapInArrow(run, "conv_id long, rank long, start long, end long")


def border_states(raw: DataFrame, model: Model) -> DataFrame:
    """``start, end, goes_on`` of the chunks of ``raw(conv_id, part, piece, transcript, blank)``."""

    def tables(batches):
        for batch in batches:
            found = [model.ways([o for _, o, _, _ in lines]) if lines else (None, None) for lines in (
                lines_of(t, b) for t, b in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array([None if x[k] is None else x[k].ravel().tolist() for x in found], pa.list_(kind))
                                       for k, kind in enumerate((pa.float64(), pa.bool_())))], names=[*CHUNK, "best", "begins"])

    order = Window.partitionBy("conv_id").orderBy("part", "piece")
    one = written(raw.select(*CHUNK, "transcript", "blank").mapInArrow(
        tables, "conv_id long, part long, piece long, best array<double>, begins array<boolean>")
        .withColumn("rank", (F.row_number().over(order) - 1).cast("long")), "chat-tables")
    levels = [one.select("conv_id", "rank", "best")]
    most = one.agg(F.max("rank")).first()[0] or 0
    while most >= FAN:
        levels.append(written(multiplied(levels[-1]), "chat-products"))
        most //= FAN
    states = None
    for level in reversed(levels):
        states = written(stitched(level, states), "chat-borders-of-level")
    n = len(STATES)
    begun = F.get("begins", F.coalesce(F.col("start"), F.lit(n)) * n + F.col("end"))  # null for a chunk without lines
    behind = Window.partitionBy("conv_id").orderBy(F.desc("part"), F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    return one.join(states, ["conv_id", "rank"]).withColumn("begun", begun).select(
        *CHUNK, "start", "end", F.coalesce(~F.last("begun", ignorenulls=True).over(behind), F.lit(False)).alias("goes_on"))


def announced_names(raw: DataFrame, model: Model) -> DataFrame:
    """``conv_id, names``: what ``announcing`` says of whole conversations, from their chunks' begun turns."""

    def begun(batches):
        for batch in batches:
            out = []
            for conv, part, piece, text, blank, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                found: dict[tuple[str, str], list[int]] = {}
                for k, x in enumerate(model.chunk(text, blank, start, end, set())[1]):
                    if x[1]:
                        found.setdefault(x, [0, k])[0] += 1
                out += [(conv, *x, n, part, piece, k) for x, (n, k) in found.items()]
            types = [pa.int64(), pa.string(), pa.string()] + [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)],
                                             names=["conv_id", "role", "name", "n", "part", "piece", "k"])

    votes = (raw.select(*CHUNK, "transcript", "blank", "start", "end").mapInArrow(
        begun, "conv_id long, role string, name string, n long, part long, piece long, k long")
        .groupBy("conv_id", "role", "name").agg(F.sum("n").alias("n"), F.min(F.struct("part", "piece", "k")).alias("first")))
    known = F.create_map(*[F.lit(x) for pair in _KNOWN.items() for x in pair])[F.col("name")]
    votes = votes.withColumn("own", F.coalesce(known == F.col("role"), F.lit(False))).where(F.col("own") | known.isNull())
    # Of each role: its known names (a fixed set), and of the others the most frequent, of equals the first.
    best = votes.groupBy("conv_id", "role").agg(
        F.collect_set(F.when(F.col("own"), F.col("name"))).alias("known"),
        F.min(F.when(~F.col("own"), F.struct((-F.col("n")).alias("minus"), "first", "name"))).alias("other"))
    return best.groupBy("conv_id").agg(F.collect_list(F.struct("role", "known", F.col("other.name").alias("name"), (
        -F.col("other.minus")).alias("n"))).alias("names"))


def _announced(names: list[dict]) -> set[tuple[str, str]]:
    known = {(x["role"], name) for x in names for name in x["known"]}
    return known | {(x["role"], x["name"]) for x in names
                    if x["name"] and not x["known"] and (x["n"] > 1 or not known)}


TURN = "conv_id long, part long, piece long, k long, begun long, role string, text string"


def parse(raw: DataFrame, model: Model) -> DataFrame:
    """``conv_id, turn_no, role, text, rendered`` of every recovered turn of ``raw(conv_id, part, piece, transcript, blank)``;
    ``blank`` is null where a chunk is the whole transcript."""

    def parsed(batches):
        for batch in batches:
            out = []
            for *key, text, blank, start, end, goes_on, names in zip(*(c.to_pylist() for c in batch.columns)):
                given = (1,) if blank is None else (blank, start, end, _announced(names or []))
                pieces = turn_pieces(model.chunk(text, *given)[0], bool(goes_on))
                begun = 0
                for role, x in pieces:
                    begun += role is not None
                    out.append((*key, len(out), begun, role, x))
                if not pieces and blank is None:
                    out.append((*key, len(out), None, None, ""))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)],
                                             names=[c.split()[0] for c in TURN.split(", ")])

    long = raw.where(F.col("blank").isNotNull())
    states = written(border_states(long, model), "chat-states")
    names = written(announced_names(long.join(states, CHUNK), model), "chat-names")
    found = written(raw.join(states, CHUNK, "left").join(names, "conv_id", "left").select(
        *CHUNK, "transcript", "blank", "start", "end", "goes_on", "names").mapInArrow(parsed, TURN), "chat-turns")
    several = states.select("conv_id").distinct()
    whole = found.join(several, "conv_id", "left_anti").select("conv_id", (F.col("begun") - 1).alias("turn_no"), "role", "text")
    # A turn's number: what earlier chunks began, and what its own chunk did up to it.
    parts = found.join(several, "conv_id", "left_semi")
    order = Window.partitionBy("conv_id").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.groupBy(*CHUNK).agg(F.max("begun").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).drop("n")
    runs = parts.join(before, CHUNK).groupBy("conv_id", (F.col("before") + F.col("begun") - 1).alias("turn_no")).agg(
        F.max("role").alias("role"), F.sort_array(F.collect_list(F.struct("part", "piece", "k", "text"))).alias("t"))
    runs = runs.select("conv_id", "turn_no", "role", F.array_join(F.col("t.text"), "").alias("text"))
    rendered = F.when(F.col("role").isNull(), "").otherwise(F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n")))
    return whole.unionByName(runs).withColumn("rendered", rendered)


def format_chats(conversations: DataFrame) -> DataFrame:
    """Write the table's conversations as raw transcripts, train on those not held out, and parse all."""
    bound_batches(conversations.sparkSession)
    table = with_borders(written(transcripts(conversations), "chat-chunks"))
    model = train(table.where(~is_held_out()))
    raw = table.select(*CHUNK, F.concat_ws("\n", F.col("turns.raw")).alias("transcript"), "blank")
    return parse(raw, model)
