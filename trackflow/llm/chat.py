"""Chat formatting by a template that is only asked to render, never to explain itself.

Successive turn prefixes are rendered and consecutive outputs compared: what the longer one adds is the span of its last
turn, and an output that does not begin with the one before belongs to a template that rewrites history. Every prefix of
every conversation is rendered, whatever its length, so a rewrite that comes with some number of turns and is gone at the end
is found as well. A conversation of n turns costs n renderings; only two outputs are held at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from trackflow.llm.work import ready

Turns = list[tuple[str, str]]
#: (turns, open_role) -> text; with a role, the text ends with the opening of that role's next turn.
Render = Callable[[Turns, "str | None"], str]
END = "</turn>"
BATCH_CHARS = 8 << 20


def escape(text: str) -> str:
    """A text without turn marks: every backslash, ``#`` and ``</`` gets a backslash."""
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def opening(role: str) -> str:
    return f"### {escape(role).replace(':', chr(92) + ':')}: "


def marked_turns(turns: Turns, open_role: str | None = None) -> str:
    """The template of the query: ``### role: text </turn>`` and a newline for each turn."""
    out = "".join(f"{opening(role)}{escape(text)} {END}\n" for role, text in turns)
    return out + (opening(open_role) if open_role is not None else "")


def turn_spans(turns: Turns, render: Render) -> tuple[str, list[tuple[int, int]], int | None]:
    """The whole output, the span of each turn, and the first turn that changes what was rendered before it."""
    before, spans = render([], None), []
    for k in range(1, len(turns) + 1):
        now = render(turns[:k], None)
        if not now.startswith(before):
            return render(turns, None), [], k - 1
        spans.append((len(before), len(now)))
        before = now
    return before, spans, None


def text_spans(turns: Turns, spans: list[tuple[int, int]], render: Render) -> list[tuple[int, int]]:
    """Where the text of each turn lies inside its span, found from renderings of its role with and without a text."""
    frames: dict[str, tuple[int, int]] = {}
    out = []
    for (role, _), (a, b) in zip(turns, spans, strict=True):
        if role not in frames:
            base = render([], None)
            head = len(render([], role)) - len(base)
            frames[role] = head, len(render([(role, "")], None)) - len(base) - head
        head, tail = frames[role]
        out.append((a + head, b - tail))
    return out


def formatted(turns: Turns, render: Render, loss_role: str) -> dict:
    """Output, turn spans, text spans and loss spans of one conversation; no spans for a template that rewrites history."""
    whole, spans, rewrites = turn_spans(turns, render)
    texts = text_spans(turns, spans, render) if rewrites is None else []
    pair = lambda xs: [{"start": a, "end": b} for a, b in xs]
    return {"formatted": whole, "turn_spans": pair(spans), "text_spans": pair(texts), "loss_spans": pair(s for s, (role, _) in zip(texts, turns, strict=False) if role == loss_role), "rewrites_at": rewrites}


SPANS = "array<struct<start: int, end: int>>"


def format_conversations(rows: DataFrame, render: Render = marked_turns, loss_role: str = "assistant") -> DataFrame:
    """Format conversations given as rows (conv_id, turn, role, text); one output row for each conversation.

    Turns go by ``turn``; nulls come first and ties go by role and text, so repeated rows become repeated turns. A null role or
    text is empty; a null conv_id is a conversation of its own. Returns conv_id, ``formatted``, ``turn_spans``, ``text_spans``,
    ``loss_spans``, and ``rewrites_at``: the first turn, from 0, at which the template rewrites history (then no
    spans), else null. Rows are sorted, not grouped: a task holds one conversation at a time, which rendering needs whole.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    fields = StructType.fromDDL(f"conv_id {id_type}, formatted string, turn_spans {SPANS}, text_spans {SPANS}, loss_spans {SPANS}, rewrites_at int")
    target = to_arrow_schema(fields)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        turns: Turns = []
        out: list[dict] = []
        size = 0
        for batch in batches:
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0] != key:
                    out.append({"conv_id": held[0], **formatted(turns, render, loss_role)})
                    size += len(out[-1]["formatted"])
                    turns = []
                    if size > BATCH_CHARS:
                        yield pa.RecordBatch.from_pylist(out, schema=target)
                        out, size = [], 0
                held = [key]
                turns.append((role or "", text or ""))
        if held:
            out.append({"conv_id": held[0], **formatted(turns, render, loss_role)})
        yield pa.RecordBatch.from_pylist(out, schema=target)

    ready(rows.sparkSession)
    dealt = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(over, fields)


def unescaped(column):
    return F.regexp_replace(column, r"(?s)\\(.)", "$1")


def texts(output: str, spans: str):
    """The texts that an array of spans cuts from the output, unescaped."""
    return F.transform(spans, lambda s: unescaped(F.substring(F.col(output), s["start"] + 1, s["end"] - s["start"])))


def roles(output: str, turn_spans: str, text_spans: str):
    """The roles between the marks of ``marked_turns``, unescaped."""
    mark, colon = len("### "), len(": ")
    cut = lambda turn, text: F.substring(F.col(output), turn["start"] + mark + 1, text["start"] - colon - turn["start"] - mark)
    return F.zip_with(turn_spans, text_spans, lambda turn, text: unescaped(cut(turn, text)))
