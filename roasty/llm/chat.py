"""Chat formatting: roles of a flat transcript, recovered line by line.

A transcript comes in parts (rows with a conversation id and an order), each
holding lines. A hidden Markov model reads the lines: its states are a role
with 'first line of a turn' or 'further line', what it sees of a line is its
speaker marker, length and punctuation, and whether a part begins with it. Viterbi finds the likeliest states;
markers are taken off, turns put together and rendered in one canonical form.

Lines are laid out over range partitions of conversation and order, so a long
conversation is spread over many tasks: each task gives its stretch's best
score from any state to any other, those small tables are multiplied up a tree
along the conversation, states are handed down it again, and every stretch is
then decoded between known states. No table per stretch reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import stored

ROLES = ("system", "user", "assistant")
#: State 2 * role is a turn's first line, 2 * role + 1 a further one.
STATES = 2 * len(ROLES)

#: Words that name a speaker, by role.
SPEAKERS = {
    "system": "system sys instructions",
    "user": "user human question q prompter customer",
    "assistant": "assistant ai bot gpt answer a response model",
}
_ANY = "|".join(w for words in SPEAKERS.values() for w in words.split())
MARKER = re.compile(rf"^\s*(?:(?:#{{1,4}} *)({_ANY})\s*:?\s*$|<\|({_ANY})\|>\s*|\[({_ANY})\]:?\s*|\**({_ANY})\**\s*:\s*)", re.IGNORECASE)
NAME = re.compile(r"^\s*[A-Z][a-z]{1,15}: ")
ROLE_OF = {w: r for r, words in enumerate(SPEAKERS.values()) for w in words.split()}

#: Markers: none, one per role, another name. Lengths in words up to 0, 3, 12,
#: 40, more. Ends in a question mark or not. Opens a part or not.
SYMBOLS = 5 * 5 * 2 * 2
LENGTHS = (0, 3, 12, 40)
#: How sure a part's beginning can be of a turn's, either way: transcripts may
#: come in one part, or in parts cut anywhere.
SUREST = 0.95

#: Lines of a range partition, about.
BLOCK_LINES = 50_000
#: Tables that one node of the tree takes in.
FAN = 64


def marker(line: str) -> tuple[int, str]:
    """The line's marker class, and the line without a known marker."""
    m = MARKER.match(line)
    if m:
        return 1 + ROLE_OF[next(g for g in m.groups() if g).lower()], line[m.end():]
    return (4 if NAME.match(line) else 0), line


def symbol(line: str, opens: bool) -> int:
    kind, rest = marker(line)
    n = len(rest.split())
    size = sum(n > k for k in LENGTHS)
    return ((kind * 5 + size) * 2 + rest.rstrip().endswith("?")) * 2 + opens


def symbols_of(rows: list[dict]) -> list[int]:
    return [symbol(r["text"], r["line"] == 0) for r in rows]


class Model:
    """Log probabilities: of a first state, from state to state, of a symbol
    in a state. Counts are smoothed, so nothing is impossible but a further
    line of another role's turn."""

    def __init__(self, start: np.ndarray, step: np.ndarray, seen: np.ndarray):
        allowed = np.array([[b % 2 == 0 or a // 2 == b // 2 for b in range(STATES)] for a in range(STATES)])
        first = np.array([s % 2 == 0 for s in range(STATES)])
        self.start = self._log(start + 1.0 * first)
        self.step = np.stack([self._log(step[a] + 1.0 * allowed[a]) for a in range(STATES)])
        by_form = seen.reshape(STATES, SYMBOLS // 2, 2)
        form = np.stack([self._log(by_form[s].sum(axis=1) + 0.5) for s in range(STATES)])
        opens = (by_form[:, :, 1].sum(axis=1) + 0.5) / (by_form.sum(axis=(1, 2)) + 1)
        opens = np.clip(opens, 1 - SUREST, SUREST)
        opening = np.log(np.stack([1 - opens, opens], axis=1))
        self.seen = (form[:, :, None] + opening[:, None, :]).reshape(STATES, SYMBOLS)

    @staticmethod
    def _log(counts: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(counts / counts.sum())

    def across(self, symbols: list[int]) -> np.ndarray:
        """Best score from each state before the stretch to each at its end."""
        best = np.full((STATES, STATES), -np.inf)
        np.fill_diagonal(best, 0.0)
        for s in symbols:
            best = (best[:, :, None] + self.step[None]).max(axis=1) + self.seen[:, s]
        return best

    def viterbi(self, symbols: list[int], before: int | None, last: int | None) -> list[int]:
        """The likeliest states after ``before`` (None: a conversation starts)
        that end in ``last`` (None: any); of equal paths the lower state."""
        if not symbols:
            return []
        score = (self.start if before is None else self.step[before]) + self.seen[:, symbols[0]]
        back = []
        for s in symbols[1:]:
            through = score[:, None] + self.step
            back.append(through.argmax(axis=0))
            score = through.max(axis=0) + self.seen[:, s]
        now = int(score.argmax()) if last is None else last
        out = [now]
        for b in reversed(back):
            now = int(b[now])
            out.append(now)
        return out[::-1]


def multiplied(tables: list[np.ndarray]) -> np.ndarray:
    """The table of stretches in a row: best scores through all of them."""
    out = tables[0]
    for t in tables[1:]:
        out = (out[:, :, None] + t[None]).max(axis=1)
    return out


def join_stretches(tables: list[np.ndarray], before: int | None = None, last: int | None = None) -> list[tuple[int | None, int]]:
    """For stretches in a row, the states before and at the end of each on the
    likeliest path from ``before`` (None: a conversation starts, whose first
    table has the start scores in every row) to ``last`` (None: any)."""
    score, back = tables[0][before or 0], []
    for t in tables[1:]:
        through = score[:, None] + t
        back.append(through.argmax(axis=0))
        score = through.max(axis=0)
    ends = [int(score.argmax()) if last is None else last]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    ends.reverse()
    return list(zip([before, *ends[:-1]], ends, strict=True))


def _tables(pieces: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    rows = sorted(pieces.select(["idx", "best"]).to_pylist(), key=lambda r: r["idx"])
    return [r["idx"] for r in rows], [np.array(r["best"]).reshape(STATES, STATES) for r in rows]


def _states_between(tables: DataFrame) -> DataFrame:
    """``key, idx, before, last``: for the stretches ``key, idx, best`` of each
    cut conversation, numbered from 0, the states around them.

    Tables are multiplied up, FAN a node, until one is left of each
    conversation; then each node tells its children their states."""

    def up(pieces: pa.Table) -> pa.Table:
        idx, some = _tables(pieces)
        best = multiplied(some).ravel().tolist()
        return pa.table({"key": [pieces["key"][0].as_py()], "idx": pa.array([idx[0] // FAN], pa.int64()), "best": [best]})

    levels = [tables]
    most = tables.agg(F.max("idx").alias("m")).collect()[0]["m"] or 0  # one number: the tree's height
    node = F.expr(f"idx div {FAN}").alias("node")
    while most > 0:
        most //= FAN
        levels.append(stored(levels[-1].withColumn("node", node).groupBy("key", "node").applyInArrow(up, "key string, idx long, best array<double>"), "chat-tree"))

    schema = pa.schema([("key", pa.string()), ("idx", pa.int64()), ("before", pa.int32()), ("last", pa.int32())])

    def down(key: tuple, pieces: pa.Table, above: pa.Table) -> pa.Table:
        if not pieces.num_rows:
            return schema.empty_table()
        idx, some = _tables(pieces)
        of = above.to_pylist()[0] if above.num_rows else {"before": None, "last": None}
        found = join_stretches(some, of["before"], of["last"])
        return pa.Table.from_pylist([{"key": key[0].as_py(), "idx": i, "before": b, "last": z} for i, (b, z) in zip(idx, found, strict=True)], schema)

    known = tables.sparkSession.createDataFrame([], "key string, idx long, before int, last int")
    for level in reversed(levels):
        nodes = known.select("key", F.col("idx").alias("node"), "before", "last")
        known = stored(
            level.withColumn("node", node).groupBy("key", "node").cogroup(nodes.groupBy("key", "node"))
            .applyInArrow(down, "key string, idx long, before int, last int"),
            "chat-states",
        )
    return known


def _lines(parts: DataFrame, conv_col: str, order_col: str, text_col: str, extra: list[str]) -> DataFrame:
    """Distinct parts as sorted lines: ``conv, part, tie, line, text, block``.
    A stored table; lines of a block belong together and blocks are in order."""
    own = parts.select(
        F.col(conv_col).cast("string").alias("conv"), F.col(order_col).alias("part"), F.col(text_col).alias("whole"),
        *[F.col(c) for c in extra],
    ).filter(F.col("whole").isNotNull())
    rows = own.dropDuplicates(["conv", "part", "whole"]).select(
        "conv", "part", F.xxhash64("whole").alias("tie"), F.posexplode(F.split("whole", "\n")).alias("line", "text"), *extra
    )
    rows = stored(rows, "chat-lines")
    n = rows.agg(F.count(F.lit(1)).alias("n")).collect()[0]["n"]
    key = ["conv", "part", "tie", "line"]
    dealt = rows.repartitionByRange(max(1, -(-n // BLOCK_LINES)), *key)
    return stored(dealt.withColumn("block", F.spark_partition_id()), "chat-blocks")


def _by_block(lines: DataFrame) -> DataFrame:
    """Each block in one task, its lines in order."""
    blocks = lines.agg(F.max("block").alias("b")).collect()[0]["b"]
    return lines.repartition((blocks or 0) + 1, "block").sortWithinPartitions("block", "conv", "part", "tie", "line")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, str], list[dict]]]:
    """The lines of each (block, conversation) in turn."""
    rows = (r for b in batches for r in b.to_pylist())
    for key, some in groupby(rows, key=lambda r: (r["block"], r["conv"])):
        yield key, list(some)


def fitted(conv: Column) -> Column:
    """Three conversations in four, by a hash of the id: those a model may be
    fitted on when it is to be judged by the others."""
    return F.coalesce(F.crc32(conv.cast("string")) % 4 != 2, F.lit(True))


def fit(parts: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", text_col: str = "text", role_col: str = "role") -> Model:
    """A model from the counts of all labelled ``parts``, one part a turn.
    Parts with another role or none are left out of the counts. The driver
    gets the counts, one number for a pair of states or of state and symbol."""
    known = parts.filter(F.col(role_col).isin(*ROLES))
    lines = _by_block(_lines(known, conv_col, order_col, text_col, [role_col]).withColumnRenamed(role_col, "role"))
    schema = pa.schema([("kind", pa.string()), ("block", pa.int32()), ("conv", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[tuple, int] = {}
        ends: dict[int, list] = {}

        def add(*key) -> None:
            tally[key] = tally.get(key, 0) + 1

        for (block, conv), rows in _stretches(batches):
            states = [2 * ROLES.index(r["role"]) + (r["line"] > 0) for r in rows]
            for s, r in zip(states, rows, strict=True):
                add("seen", None, None, s, symbol(r["text"], r["line"] == 0))
            for a, b in zip(states, states[1:]):
                add("step", None, None, a, b)
            ends.setdefault(block, []).append((conv, states[0], states[-1]))
            if len(ends[block]) > 2:  # neither first nor last of its block
                add("start", None, None, ends[block].pop(1)[1], 0)
        out = [(*k, n) for k, n in tally.items()]
        for block, some in ends.items():
            out += [("end", block, conv, a, b, k) for k, (conv, a, b) in enumerate(some)]
        columns = zip(*out, strict=True) if out else [[] for _ in schema]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    got = stored(lines.mapInArrow(count, "kind string, block int, conv string, a int, b int, n long"), "chat-counts")
    # The first and last conversation of each block: a step from the block
    # before, or a start.
    earlier = F.expr("lag(b) OVER (PARTITION BY conv ORDER BY block)")
    ends = got.filter("kind = 'end'").withColumn("earlier", earlier).select(
        F.when(F.col("earlier").isNull(), "start").otherwise("step").alias("kind"), F.coalesce("earlier", "a").alias("x"),
        F.when(F.col("earlier").isNull(), 0).otherwise(F.col("a")).alias("b"), F.lit(1).cast("long").alias("n"),
    ).withColumnRenamed("x", "a")
    counts = got.filter("kind != 'end'").select("kind", "a", "b", "n").unionByName(ends).groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    start, step, seen = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, SYMBOLS))
    for r in counts.collect():
        if r["kind"] == "start":
            start[r["a"]] += r["n"]
        else:
            (step if r["kind"] == "step" else seen)[r["a"], r["b"]] += r["n"]
    return Model(start, step, seen)


TURN = pa.schema([("conv", pa.string()), ("block", pa.int32()), ("local", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("starts", pa.int32())])


def parse(parts: DataFrame, model: Model, conv_col: str = "conv_id", order_col: str = "turn", text_col: str = "text") -> DataFrame:
    """One row per recovered turn: ``conv_col`` (as text), ``turn`` from 0,
    ``role, text, rendered``.

    Parts are read in their order, equal ones by the text's hash; repeated
    rows (same conversation, order and text) count once; null texts hold no
    lines, an empty one holds one empty line; a null conversation id is one
    conversation, a null order comes first. Other columns are ignored."""
    lines = _lines(parts, conv_col, order_col, text_col, [])
    # Blocks are ranges, so a block boundary cuts one conversation at most:
    # what follows has a row or two per block.
    edge = pa.schema([("conv", pa.string()), ("block", pa.int32()), ("first", pa.list_(pa.float64())), ("best", pa.list_(pa.float64()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(block, conv, symbols) -> pa.RecordBatch:
            one = (model.start + model.seen[:, symbols[0]])[:, None] + model.across(symbols[1:])
            first = np.tile(one.max(axis=0), (STATES, 1))
            return pa.RecordBatch.from_pylist([{"conv": conv, "block": block, "first": first.ravel().tolist(), "best": model.across(symbols).ravel().tolist()}], edge)

        last = None
        for (block, conv), rows in _stretches(batches):
            if last is None or last[0] != block:
                if last is not None and last[2] is not None:
                    yield told(*last)
                yield told(block, conv, symbols_of(rows))
                last = (block, conv, None)
            else:
                last = (block, conv, symbols_of(rows))
        if last is not None and last[2] is not None:
            yield told(*last)

    edges = stored(_by_block(lines).mapInArrow(measure, "conv string, block int, first array<double>, best array<double>"), "chat-edges")
    key = F.coalesce(F.concat(F.lit("="), F.col("conv")), F.lit("-"))
    keyed = edges.withColumn("key", key)
    over = keyed.groupBy("key").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).filter("lo != hi").select(F.col("key").alias("_key"), "lo")
    tables = stored(
        keyed.join(over, F.col("key") == F.col("_key")).select(
            "key", (F.col("block") - F.col("lo")).cast("long").alias("idx"), F.when(F.col("block") == F.col("lo"), F.col("first")).otherwise(F.col("best")).alias("best"), "block"
        ),
        "chat-cut",
    )
    between = _states_between(tables.select("key", "idx", "best"))
    ends = tables.select("key", "idx", "block").join(between, ["key", "idx"]).select("key", "block", "before", "last")

    def decode(_block: tuple, some: pa.Table, known: pa.Table) -> pa.Table:
        ends = {r["key"]: (r["before"], r["last"]) for r in known.to_pylist()}
        order = [("conv", "ascending"), ("part", "ascending"), ("tie", "ascending"), ("line", "ascending")]
        rows = some.take(pc.sort_indices(some, sort_keys=order, null_placement="at_start")).to_pylist()
        out: list[dict] = []
        for (block, conv), rows in groupby(rows, key=lambda r: (r["block"], r["conv"])):
            rows = list(rows)
            before, last = ends.get("-" if conv is None else f"={conv}", (None, None))
            states = model.viterbi(symbols_of(rows), before, last)
            turns: list[list] = []
            for s, r in zip(states, rows, strict=True):
                if s % 2 == 0 or not turns:
                    turns.append([s, []])
                text = marker(r["text"])[1] if s % 2 == 0 else r["text"]
                turns[-1][1].append(text)
            opens = states[0] % 2 == 0
            starts = len(turns) - (not opens)
            for k, (s, text) in enumerate(turns):
                # Without any text left a fragment is null: it adds no line.
                if s % 2 == 0 and (opens or k) and not text[0].strip():
                    text = text[1:]  # the marker had a line of its own
                out.append({"conv": conv, "block": block, "local": k + opens, "role": ROLES[s // 2], "text": "\n".join(text) if text else None, "starts": starts})
        return pa.Table.from_pylist(out, TURN)

    found = lines.select("block", "conv", "part", "tie", "line", "text").groupBy("block").cogroup(ends.groupBy("block")).applyInArrow(
        decode, "conv string, block int, local int, role string, text string, starts int"
    )
    found = stored(found, "chat-turns").withColumn("key", key)
    # Turns of a cut conversation are counted on from its earlier blocks.
    per = found.groupBy(F.col("key").alias("_key"), F.col("block").alias("_block")).agg(F.max("starts").alias("n")).join(
        over.select(F.col("_key").alias("_cut")), F.col("_key") == F.col("_cut"), "left_semi"
    )
    offset = F.expr("coalesce(sum(n) OVER (PARTITION BY _key ORDER BY _block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    known = stored(per.select("_key", "_block", offset.alias("offset")), "chat-offsets")
    placed = found.join(known, (F.col("key") == F.col("_key")) & (F.col("block") == F.col("_block")), "left")
    turn = (F.coalesce("offset", F.lit(0)) + F.col("local") - 1).alias("turn")
    whole = (
        placed.select("conv", turn, "block", "role", "text")
        .groupBy("conv", "turn")
        .agg(F.max("role").alias("role"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n").alias("text"))
    )
    return whole.select(F.col("conv").alias(conv_col), "turn", "role", "text", render(F.col("role"), F.col("text")).alias("rendered"))


def render(role: Column, text: Column) -> Column:
    """A turn in canonical form; its own marks cannot end it early."""
    safe = F.replace(F.replace(text, F.lit("<|im_start|>"), F.lit("<|im_ start|>")), F.lit("<|im_end|>"), F.lit("<|im_ end|>"))
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), F.trim(safe), F.lit("<|im_end|>\n"))


#: Ways to mark a speaker that transcripts use, by role; None: no marker.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("### Instructions:\n", "### Human:\n", "### Assistant:\n"),
    ("<|system|>", "<|user|>", "<|assistant|>"),
    ("[sys] ", "[customer] ", "[bot] "),
    ("SYSTEM: ", "Q: ", "A: "),
)
#: One turn in so many has lost its marker.
UNMARKED = 12


def as_transcript(turns: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", text_col: str = "text", role_col: str = "role") -> DataFrame:
    """``turns`` as parts of flat transcripts: the text of each gets the
    marker that its conversation uses, but for one turn in UNMARKED; places
    and styles follow from hashes of the ids."""
    style = F.pmod(F.xxhash64(F.col(conv_col)), F.lit(len(STYLES)))
    lost = F.pmod(F.xxhash64(F.col(conv_col), F.col(order_col)), F.lit(UNMARKED)) == 0
    mark = F.lit("")
    for k, of in enumerate(STYLES):
        for role, m in zip(ROLES, of, strict=True):
            mark = F.when((style == k) & (F.col(role_col) == role) & ~lost, F.lit(m)).otherwise(mark)
    return turns.withColumn(text_col, F.concat(mark, F.col(text_col)))
