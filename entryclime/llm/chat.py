r"""Operator 7, chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role\ntext<|im_end|>\n``. The rendered turn is parsed again by a deterministic
parser, and the recovered role and text are compared with the source; where they differ, the conflicting content is
escaped and the turn rendered again, until they are identical. The escape puts one more backslash between ``<`` and
``|`` (``<|`` becomes ``<\|``, ``<\|`` becomes ``<\\|``), so no control string is left inside a text, and parsing takes
one away. A turn without such signs is rendered as it is. In roles, backslashes and line ends are escaped as well.

A conversation is a stream of turns in order, and its formatted text a stream of parts, cut between turns. Both passes
(format and write; read and parse) keep one turn and running digests in memory, so a conversation of any length fits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.session import write_stage

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
#: Characters after which a part of a conversation is closed (a single longer turn is a part by itself).
PART_CHARS = 65_536
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Turns of a formatted text as (role, text, start, end), the last two being where the text lies.

    Raises ValueError where the text does not follow the template.
    """
    turns, at = [], 0
    while at < len(rendered):
        line = rendered.find("\n", at)
        end = rendered.find(END + "\n", line + 1)
        if not rendered.startswith(START, at) or line < 0 or end < 0:
            raise ValueError(f"no turn at character {at}")
        role, body = rendered[at + len(START):line], rendered[line + 1:end]
        if START in role or END in role or START in body or END in body:
            raise ValueError(f"a control string inside the turn at character {at}")
        turns.append((_unescape_role(role), unescape(body), line + 1, end))
        at = end + len(END) + 1
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn rendered so that parsing gives it back, and where its text lies in it."""
    for header, body in ((role, text), (role, escape(text)), (_escape_role(role), text),
                         (_escape_role(role), escape(text))):
        rendered = f"{START}{header}\n{body}{END}\n"
        try:
            turns = parse(rendered)
        except ValueError:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return rendered, *turns[0][2:]
    raise AssertionError("the fully escaped turn does not parse back")


_FORMATTED = "conv_id {id}, part long, formatted string, loss_starts array<int>, loss_ends array<int>"
_RESULT = ("conv_id {id}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, dict]]:
    """Rows in order, each with its conversation."""
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        names = batch.schema.names
        for row in zip(*columns, strict=True):
            yield row[0], dict(zip(names, row, strict=True))


def format_conversations(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Formatted conversations: ``conv_id, part, formatted, loss_starts, loss_ends`` (a loss mask as text spans).

    Turns are ordered by turn, role and text, nulls first; null roles and texts count as empty; a null conversation is
    one of its own. Repeated rows are turns of their own. An empty table gives no rows. Other columns are not read.
    Concatenating a conversation's parts gives its whole text.
    """
    rows = (turns.select("conv_id", F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_type, out = None, []
        held: dict = {"conv": None, "part": 0, "texts": [], "size": 0, "starts": [], "ends": []}

        def close(conv: object) -> None:
            if held["texts"]:
                out.append((conv, held["part"], "".join(held["texts"]), held["starts"], held["ends"]))
                held.update(part=held["part"] + 1, texts=[], size=0, starts=[], ends=[])

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = [own_type, pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              ["conv_id", "part", "formatted", "loss_starts", "loss_ends"])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal own_type
            for b in batches:
                own_type = b.schema.field(0).type
                yield b

        first = True
        for conv, row in _runs(typed()):
            if first or conv != held["conv"]:
                close(held["conv"])
                held.update(conv=conv, part=0)
                first = False
            rendered, start, end = render_turn(row["role"], row["text"])
            if held["size"] and held["size"] + len(rendered) > part_chars:
                close(conv)
            if row["role"] == LOSS_ROLE:
                held["starts"].append(held["size"] + start)
                held["ends"].append(held["size"] + end)
            held["texts"].append(rendered)
            held["size"] += len(rendered)
            if sum(len(o[2]) for o in out[-200:]) > 4_000_000 or len(out) >= 2000:
                yield batch()
        close(held["conv"])
        if out:
            yield batch()

    return rows.mapInArrow(run, _FORMATTED.format(id=id_type))


def read_back(formatted: DataFrame) -> DataFrame:
    """What parsing recovers from formatted conversations:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Roles and texts come from the parser, the loss text from the stored spans.
    """
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(state: dict) -> tuple:
            return (state["conv"], state["n"], state["turns"].hexdigest(), state["loss_n"], state["loss"].hexdigest(),
                    state["chars"])

        def batch(done: list[tuple]) -> pa.RecordBatch:
            types = [own_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)

        own_type, state, done = None, None, []

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal own_type
            for b in batches:
                own_type = b.schema.field(0).type
                yield b

        for conv, row in _runs(typed()):
            if state is None or conv != state["conv"]:
                if state:
                    done.append(result(state))
                state = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_n": 0,
                         "chars": 0}
            text = row["formatted"]
            state["chars"] += len(text)
            for role, body, _, _ in parse(text):
                state["n"] += 1
                state["turns"].update(f"{role}\n{body}\n".encode())
            for start, end in zip(row["loss_starts"], row["loss_ends"], strict=True):
                masked = unescape(text[start:end])
                state["loss_n"] += len(masked)
                state["loss"].update(masked.encode())
            if len(done) >= 5000:
                yield batch(done)
                done = []
        if state:
            done.append(result(state))
        if done:
            yield batch(done)

    return rows.mapInArrow(run, _RESULT.format(id=id_type))


def round_trip(turns: DataFrame) -> DataFrame:
    """Format, write, read and parse: ``read_back`` of the written ``format_conversations``."""
    return read_back(write_stage(format_conversations(turns), "chat_formatted"))
