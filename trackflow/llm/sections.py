"""Token counts of the sections of a document, from one encoding of the whole document.

Tokens carry the span of characters whose bytes they hold. Spans of tokens and of sections are joined as intervals: both
are sorted, so every token finds its sections by binary search. A token over a border goes by the rule: ``start``, to the
section with its first character, or ``most``, to the section with most of its characters, the earlier one on a tie.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.bpe import ByteBpe, tokenizer
from trackflow.llm.work import map_rows

RULES = ("start", "most")


def token_spans(bpe: ByteBpe, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of every token; tokens that share a character both cover it."""
    ends = np.cumsum(bpe.widths[np.frombuffer(ids, dtype=np.uint32)])
    starts = np.concatenate(([0], ends[:-1]))
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    if len(raw) == len(text):
        return starts, ends
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def counts(first: np.ndarray, past: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens of each section, tokens of each that cross its border, and tokens in no section.

    Sections are disjoint and in order; between them may lie text that belongs to none.
    """
    low = np.searchsorted(end, first, side="right")  # the first section that ends behind the token's start
    high = np.searchsorted(begin, past, side="left") - 1  # the last that begins before its end
    inside = low <= high
    chosen = low.copy()
    if rule == "start":
        inside &= begin[np.minimum(low, len(begin) - 1)] <= first
    else:
        several = np.flatnonzero(inside & (low < high))
        for t in several:  # only tokens over a border
            s = np.arange(low[t], high[t] + 1)
            chosen[t] = s[np.argmax(np.minimum(end[s], past[t]) - np.maximum(begin[s], first[t]))]
    own = chosen[inside]
    crossing = (first[inside] < begin[own]) | (past[inside] > end[own])
    n = len(begin)
    return np.bincount(own, minlength=n), np.bincount(own[crossing], minlength=n), int((~inside).sum())


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their closing newline; an empty text has none."""
    parts = text.split("\n")
    ends = np.cumsum([len(p) + 1 for p in parts])
    ends[-1] -= 1
    if not parts[-1]:
        ends = ends[:-1]
    return np.concatenate(([0], ends[:-1])).astype(np.int64), ends.astype(np.int64)


def line_counts(docs: DataFrame, path: str, rule: str = "start", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every line of every whole text: the id, ``section`` from 0, ``start``, ``end``, ``n_tokens``, ``n_crossing``.

    The counts of a document sum to the tokens of its whole text. Null and empty texts have no lines and give no rows;
    repeated rows are counted each; a token over several borders counts once; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    id_type = docs.schema[id_col].dataType.simpleString()

    def fn(keys: list, texts: list) -> list:
        bpe = tokenizer(path, library=True)
        out: list[list] = []
        for text in texts:
            if not text:
                out.append([])
                continue
            begin, end = line_sections(text)
            n, crossing, _ = counts(*token_spans(bpe, text, bpe.encode(text)), begin, end, rule)
            out.append([{"section": i, "start": a, "end": b, "n_tokens": c, "n_crossing": d} for i, (a, b, c, d) in enumerate(zip(begin.tolist(), end.tolist(), n.tolist(), crossing.tolist(), strict=True))])
        return [keys, out]

    section = "struct<section: int, start: bigint, end: bigint, n_tokens: bigint, n_crossing: bigint>"
    return map_rows(docs.select(id_col, text_col), fn, f"`{id_col}` {id_type}, found array<{section}>").select(id_col, F.inline("found"))


def field_counts(rows: DataFrame, fields: list[str], path: str, separator: str = "\n", rule: str = "start", id_col: str = "doc_id") -> DataFrame:
    """Tokens of each field when the fields are joined by the separator and encoded once, as one document.

    Returns the id, ``n_<field>`` for every field, ``n_between`` for tokens that lie in no field, and ``n_tokens``, their sum.
    A null field counts as empty. Repeated rows are counted each; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    id_type = rows.schema[id_col].dataType.simpleString()

    def fn(keys: list, *columns: list) -> list:
        bpe = tokenizer(path, library=True)
        out = []
        for values in zip(*columns, strict=True):
            parts = [v or "" for v in values]
            text = separator.join(parts)
            end = np.cumsum([len(p) + len(separator) for p in parts]) - len(separator)
            begin = end - np.array([len(p) for p in parts])
            n, between = np.zeros(len(parts), dtype=np.int64), 0
            kept = np.flatnonzero(end > begin)  # empty fields hold no token
            if text:
                spans = token_spans(bpe, text, bpe.encode(text))
                if len(kept):
                    n[kept], _, between = counts(*spans, begin[kept], end[kept], rule)
                else:
                    between = len(spans[0])
            out.append([*n.tolist(), between, int(n.sum()) + between])
        return [keys, *(list(c) for c in zip(*out, strict=True))] if out else [keys, *([] for _ in range(len(fields) + 2))]

    names = [*(f"n_{f}" for f in fields), "n_between", "n_tokens"]
    schema = ", ".join([f"`{id_col}` {id_type}", *(f"`{n}` bigint" for n in names)])
    return map_rows(rows.select(id_col, *fields), fn, schema)
