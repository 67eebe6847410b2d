"""Chat formatting from an event log.

A conversation is a log of events: messages, streamed deltas, edits and
regenerations. The log is dealt by conversation, sorted by sequence inside the
partition (an external sort that spills) and folded one conversation at a time
into final messages, which are rendered into one training text with its loss
mask. ``read_back`` is the exact inverse of the rendering.

Template: ``<|im_start|>role``, a line break, the text, ``<|im_end|>``, a line
break. Inside roles and texts every ``<``, n backslashes, ``|`` gets one more
backslash, so a control string cannot appear there and the step can be undone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """Line breaks end the role in the template, so they are written as backslash n."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def fold(events: Iterable[tuple]) -> list[tuple[str, str]]:
    """Final (role, text) messages of one conversation's events (kind, turn, role, text), in sequence order.

    ``message`` adds a turn; ``delta`` appends to the newest message of its turn, or
    starts one; ``edit`` replaces that message's text; ``regenerate`` empties it and
    takes back every message after it. An edit or regeneration of a turn that is not
    there is without effect. Null roles and texts are empty.
    """
    messages: list[list] = []  # turn, role, pieces
    newest: dict = {}
    for kind, turn, role, text in events:
        at = newest.get(turn)
        if kind in (None, "message") or (kind == "delta" and at is None):
            newest[turn] = len(messages)
            messages.append([turn, role or "", [text or ""]])
        elif kind == "delta":
            messages[at][2].append(text or "")
        elif kind == "edit" and at is not None:
            messages[at][2] = [text or ""]
        elif kind == "regenerate" and at is not None:
            del messages[at + 1 :]
            messages[at][2] = []
            newest = {m[0]: k for k, m in enumerate(messages)}
        elif kind not in ("edit", "regenerate"):
            raise ValueError(f"unknown kind of event: {kind}")
    return [(role, "".join(pieces)) for _, role, pieces in messages]


def render(messages: Iterable[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """Text of the conversation, and where its loss spans (assistant texts) start and end, in code points."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in messages:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == "assistant":
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += head, body, f"{END}\n"
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), starts, ends


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Messages of a rendered conversation."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


RENDERED = "conv_id long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"


def chat_format(events: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_starts, loss_ends.

    ``events`` has conv_id, seq, kind, turn, role, text (see ``fold``); other columns
    are not read. Events with the same sequence number are taken by turn (nulls
    first), kind, role and text, so repeated rows all count and the result does not
    depend on the input's order. Events with a null conv_id form one conversation of
    that id. An empty log gives no rows. A task holds one conversation at a time.
    """
    order = ["conv_id", "seq", "turn", "kind", "role", "text"]
    dealt = (
        events.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("seq").cast("long").alias("seq"),
                      F.col("turn").cast("long").alias("turn"), "kind", "role", "text")
        .repartition("conv_id").sortWithinPartitions(*order)
    )
    return dealt.mapInArrow(_render_sorted, RENDERED)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _render_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_starts", longs), ("loss_ends", longs)])

    def rendered():
        for conv, events in groupby(_rows(batches, "conv_id", "kind", "turn", "role", "text"), key=lambda r: r[0]):
            messages = fold(e[1:] for e in events)
            yield (conv, len(messages), *render(messages))

    yield from _batches(rendered(), schema)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(rendered: DataFrame) -> DataFrame:
    """Counts and hashes of what ``read_back`` finds in the rendered texts and under their loss masks."""
    schema = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for conv, formatted, starts, ends in _rows(batches, "conv_id", "formatted", "loss_starts", "loss_ends"):
                turns = read_back(formatted)
                loss = "".join(unescape(formatted[a:b]) for a, b in zip(starts, ends))
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                yield conv, len(turns), _sha(said), len(loss), _sha(loss), len(formatted)

        yield from _batches(rows(), schema)

    return rendered.mapInArrow(digest, DIGESTS)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
