"""Chat formatting (operator 9): budgeted windows of whole turns.

Template.  A turn is ``<s>[INST] role [/INST]text</s>``.  Inside roles and texts
a backslash is doubled and a control string gets one after its first character,
so no control string of a text survives and taking the backslashes away gives
the text back.

Windows.  Prefix sums of the turns' token counts choose spans of whole turns:
a span ends before the first turn that would take the window, with what it
repeats, over ``budget`` tokens (a turn that alone is over it gets a window of
its own).  A window repeats the conversation's system turn and, as far as
``HISTORY_TOKENS`` go, up to ``HISTORY_TURNS`` turns before its span.  The loss
mask covers the assistant texts of the span; repeated turns are masked out, so
each target is learned once.

Scale.  A conversation is cut into blocks of ``BLOCK`` turn numbers, each with
copies of the system turn and of the turns before it, so a conversation that
holds a third of all rows is formatted by many tasks; a task streams its sorted
rows.  Reading back streams a conversation's windows, as its digest needs.

Cases: null role and text are empty; null turns come first; rows of equal turn
are ordered by role and text, and all kept; a null conv_id is a conversation.
Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewatch.llm.bpe_tree import coder

BUDGET, HISTORY_TURNS, HISTORY_TOKENS = 1024, 2, 256
BLOCK = 256

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_SPECIAL = re.compile(r"\\|<s>|</s>|\[INST\]|\[/INST\]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The turn as it stands in a window, and where its text begins."""
    head = f"<s>[INST] {escape(role)} [/INST]"
    return f"{head}{escape(text)}</s>", len(head)


def parse_window(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn."""
    out, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


class Turn:
    __slots__ = ("role", "text", "start", "tokens")

    def __init__(self, role: str, text: str, count: Callable[[str], int]):
        self.role = role
        self.text, self.start = format_turn(role, text)
        self.tokens = count(self.text)


class Windows:
    """Windows of one block; ``system`` and ``past`` are what it may repeat."""

    def __init__(self, budget: int):
        self.budget, self.system, self.past, self.made = budget, None, [], 0

    def history(self) -> list[Turn]:
        out, held = [], 0
        for turn in reversed(self.past):
            if turn is self.system or held + turn.tokens > HISTORY_TOKENS:
                break
            out.append(turn)
            held += turn.tokens
        return out[::-1]

    def remember(self, turns: list[Turn]) -> None:
        self.past = (self.past + turns)[-HISTORY_TURNS:]

    def format(self, turns: list[Turn]) -> Iterator[tuple]:
        """(window, n_repeat, text, loss spans, tokens) of the next turns of the block."""
        ends = np.cumsum([t.tokens for t in turns])
        at = 0
        while at < len(turns):
            repeated = ([self.system] if self.system else []) + self.history()
            room = self.budget - sum(t.tokens for t in repeated)
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + room, "right")))
            span, text, loss = turns[at:to], [], []
            length = 0
            for k, turn in enumerate(repeated + span):
                if k >= len(repeated) and turn.role == "assistant":
                    loss.append({"start": length + turn.start, "end": length + len(turn.text) - len("</s>")})
                text.append(turn.text)
                length += len(turn.text)
            yield self.made, len(repeated), "".join(text), loss, int(ends[to - 1]) - before + sum(t.tokens for t in repeated)
            if self.made == 0 and not repeated and span[0].role == "system":
                self.system = span[0]
            self.made += 1
            self.remember(span)
            at = to


WINDOWS = "conv_id long, block long, window long, n_repeat int, text string, loss array<struct<start:int,end:int>>, n_tokens long"
_WINDOW_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("window", pa.int64()), ("n_repeat", pa.int32()), ("text", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("n_tokens", pa.int64())])


def _formatter(path: str, pattern: str, budget: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        key, windows, held, rows = None, Windows(budget), [], []

        def flush() -> None:
            if held:
                rows.extend((*key, *w) for w in windows.format(held))
                held.clear()

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _WINDOW_SCHEMA, strict=True)],
                                             schema=_WINDOW_SCHEMA)
            rows.clear()
            return out

        for part in parts:
            for conv_id, block, kind, _, role, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if (conv_id, block) != key:
                    flush()
                    key, windows = (conv_id, block), Windows(budget)
                turn = Turn(role or "", text or "", lambda t: len(bpe.encode(t)))
                if kind == 0:
                    windows.system = turn
                elif kind == 1:
                    windows.remember([turn])
                else:
                    held.append(turn)
                    if len(held) >= BLOCK:  # many rows of equal turn numbers
                        flush()
                if len(rows) >= 1000:
                    yield batch()
        flush()
        if rows:
            yield batch()
    return run


def format_conversations(turns: DataFrame, path: str, pattern: str, budget: int = BUDGET) -> DataFrame:
    """Windows of the conversations in ``turns`` (conv_id, turn, role, text): see ``WINDOWS``."""
    turns = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                         turns["role"].cast("string").alias("role"), turns["text"].cast("string").alias("text"))
    turns = turns.withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK).cast("long"))
    own = turns.select("conv_id", "block", F.lit(2).alias("kind"), "turn", "role", "text")

    # what the later blocks of long conversations repeat
    blocks = turns.select("conv_id", "block").distinct()
    order = Window.partitionBy("conv_id").orderBy("block")
    follows = blocks.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"),
                            F.lead("block").over(order).alias("next"),
                            F.first("block").over(order).alias("first")).filter("next is not null")
    last = Window.partitionBy("conv_id", "block").orderBy(F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"))
    in_long = turns.join(follows, turns["conv_id"].eqNullSafe(follows["_conv"]) & (turns["block"] == follows["_block"]))
    past = in_long.withColumn("back", F.row_number().over(last)).filter(F.col("back") <= HISTORY_TURNS).select(
        "conv_id", F.col("next").alias("block"), F.lit(1).alias("kind"), "turn", "role", "text")
    opening = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    system = in_long.filter("block = first").withColumn("n", F.row_number().over(opening)).filter(
        "n = 1 and role = 'system'").select(F.col("conv_id").alias("_of"), "turn", "role", "text")
    system = follows.join(system, follows["_conv"].eqNullSafe(system["_of"])).select(
        F.col("_conv").alias("conv_id"), F.col("next").alias("block"), F.lit(0).alias("kind"), "turn", "role", "text")

    rows = own.unionByName(past).unionByName(system)
    return rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "turn", "role", "text").mapInArrow(
        _formatter(path, pattern, budget), WINDOWS)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                          ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_back(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    key, started = None, False
    n_turns = loss_chars = chars = 0
    turns, loss = hashlib.sha256(), hashlib.sha256()

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ_SCHEMA, strict=True)],
                                         schema=_READ_SCHEMA)
        rows.clear()
        return out

    for part in parts:
        for conv_id, n_repeat, text, spans in zip(*(part.column(c).to_pylist() for c in ("conv_id", "n_repeat", "text", "loss")), strict=True):
            if not started or conv_id != key:
                if started:
                    rows.append((key, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                key, started, n_turns, loss_chars, chars = conv_id, True, 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            for role, said in parse_window(text)[n_repeat:]:
                turns.update(f"{role}\n{said}\n".encode())
                n_turns += 1
            for span in spans:
                target = unescape(text[span["start"]:span["end"]])
                loss.update(target.encode())
                loss_chars += len(target)
            chars += len(text)
        if len(rows) >= 1000:
            yield batch()
    if started:
        rows.append((key, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        yield batch()


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the windows alone: see ``READ``."""
    return windows.select("conv_id", "block", "window", "n_repeat", "text", "loss").repartition("conv_id").sortWithinPartitions(
        "conv_id", "block", "window").mapInArrow(_read_back, READ)
