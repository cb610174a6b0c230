"""Chat formatting by incremental black-box rendering.

A template is any function from a list of messages to a string. ``locate_turns`` renders the successive prefixes of a
conversation and compares consecutive outputs: what an output adds to the one before is the turn's span. Rendering the turn
with a probe text instead shows where in the span its text lies. A template that changes what it wrote for earlier
turns is detected where an output does not begin with the one before.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, read_table, small_table, text_or_empty

Message = dict[str, str]
Template = Callable[[list[Message]], str]

#: A text that templates have no reason to change; it marks where a turn's text goes.
PROBE = "probe"


@dataclass(frozen=True)
class Turn:
    """Span of a turn in the output, and of its text; the text span is None where the template does not show it as a piece."""

    role: str
    start: int
    stop: int
    text_start: int | None
    text_stop: int | None


@dataclass(frozen=True)
class Located:
    output: str
    turns: list[Turn]
    #: Turns at which the output did not begin with the one before, by number.
    rewrites: list[int]


def locate_turns(messages: list[Message], template: Template) -> Located:
    """Spans of all turns in ``template(messages)``.

    Where a prefix's output does not begin with the one before, the turn's number is noted in ``rewrites``, its span
    begins at the first difference, and spans of earlier turns that reach beyond that point are cut there.
    """
    before, turns, rewrites = template([]), [], []
    for k, message in enumerate(messages):
        head = messages[:k]
        now = template([*head, message])
        if now.startswith(before):
            start = len(before)
        else:
            start = len(os.path.commonprefix([before, now]))
            rewrites.append(k)
            turns = [t if t.stop <= start else Turn(t.role, min(t.start, start), start, None, None) if t.text_stop is None or t.text_stop > start else Turn(t.role, t.start, start, t.text_start, t.text_stop) for t in turns]
        probed = template([*head, {**message, "content": PROBE}])
        at = probed.rfind(PROBE)
        text = (None, None)
        if at >= 0:
            tail = len(probed) - at - len(PROBE)
            stop = len(now) - tail
            if stop >= at and now[:at] == probed[:at] and now[stop:] == probed[at + len(PROBE) :]:
                text = (at, stop)
        turns.append(Turn(message["role"], start, len(now), *text))
        before = now
    return Located(before, turns, rewrites)


# --- the template of this module: marks in plain text, control strings in texts escaped

_ESCAPED = re.compile(r"[\\<#\n:]")
_TEXT_ESCAPED = re.compile(r"[\\<#]")
_TURN = re.compile(r"### ((?:[^\\:#\n<]|\\.)*): ((?:[^\\<#]|\\.)*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before each backslash, < and #: neither a turn's beginning nor its end can then occur in a text."""
    return _TEXT_ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(messages: list[Message]) -> str:
    return "".join(f"### {_ESCAPED.sub(r'\\\g<0>', m['role'])}: {escape(m['content'])}</turn>\n" for m in messages)


def parse(output: str) -> list[Message]:
    """The messages that ``render`` was given."""
    out, at = [], 0
    while at < len(output):
        m = _TURN.match(output, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append({"role": unescape(m[1]), "content": unescape(m[2])})
        at = m.end()
    return out


def loss_texts(located: Located, roles: tuple[str, ...] = ("assistant",)) -> list[str]:
    """The texts under the loss mask: those of ``roles``, as the output has them."""
    return [located.output[t.text_start : t.text_stop] for t in located.turns if t.role in roles and t.text_start is not None]


# --- DataFrames


def _formatted(template: Template, roles: tuple[str, ...]):
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("roles", pa.list_(pa.string())), ("spans", pa.list_(pa.int32())), ("loss", pa.list_(pa.int32())), ("rewrites", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(conv: int | None, messages: list[Message]) -> tuple:
            x = locate_turns(messages, template)
            loss = [(t.text_start, t.text_stop) for t in x.turns if t.role in roles and t.text_start is not None]
            return conv, x.output, [t.role for t in x.turns], [p for t in x.turns for p in (t.start, t.stop)], [p for s in loss for p in s], x.rewrites

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)

        now: object = run
        messages: list[Message] = []
        rows: list[tuple] = []
        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if conv != now and messages:
                    rows.append(done(now, messages))
                    messages = []
                    if len(rows) >= 64:
                        yield made(rows)
                        rows = []
                now = conv
                messages.append({"role": role, "content": text})
        if messages:
            rows.append(done(now, messages))
        if rows:
            yield made(rows)

    return run


def format_conversations(turns: DataFrame, template: Template = render, roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, roles, spans, loss (starts and stops in turn), rewrites.

    Rows are put in order by turn, then role and text, so ties do not depend on how the table is read; null turns come
    first, null roles and texts count as empty, and rows without conv_id are one conversation. Other columns are not read.
    A conversation is the unit of a template: one is in memory at a time, whatever a partition holds.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(lean(_formatted(template, roles)), "conv_id long, formatted string, roles array<string>, spans array<int>, loss array<int>, rewrites array<int>")


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_rewrites", pa.int64())])
    for batch in batches:
        rows = []
        for conv, out, loss, rewrites in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            read = parse(out)
            text = "".join(unescape(out[a:b]) for a, b in zip(loss[::2], loss[1::2], strict=True))
            turns = hashlib.sha256("".join(f"{m['role']}\n{m['content']}\n" for m in read).encode("utf-8", "replace"))
            rows.append((conv, len(read), turns.hexdigest(), len(text), hashlib.sha256(text.encode("utf-8", "replace")).hexdigest(), len(out), len(rewrites)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)


def op1_chat_formatting(spark, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = small_table(spark, [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    made = format_conversations(turns).select("conv_id", "formatted", "loss", "rewrites")
    return made.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_rewrites long")


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(4 + length(regexp_replace(role, '[\\<#\n:]', 'xx', 'g')) + 2 + length(regexp_replace(text, '[\\<#]', 'xx', 'g')) + 8) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_rewrites
FROM t GROUP BY conv_id
"""
