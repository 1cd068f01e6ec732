"""Line-first quality rules: lines that fail are removed, then documents that lose too much text are rejected."""

from __future__ import annotations

import re
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame

from trackflow.llm.work import map_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; a line is judged only by those that its number of words allows."""

    min_words: int = 10
    max_repeat_share: float = 0.2
    max_symbol_share: float = 0.25  # symbols for each word of a line
    max_bars: int = 2  # separators of a navigation line
    max_shout_share: float = 0.5  # words in capitals, from `shout_words` words on
    shout_words: int = 3
    unpunctuated_words: int = 40  # a line with so many words has punctuation
    max_stutter_share: float = 0.4  # of words equal to the one before, from `stutter_words` words on
    stutter_words: int = 8
    notice_words: int = 25  # a boilerplate phrase condemns lines up to this length
    max_lost_share: float = 0.5  # of the characters in words


# Phrases of notices and menus.
NOTICES = re.compile(
    r"all rights reserved|cookie(s)? (policy|settings|notice)|accept (all )?cookies|privacy policy|terms of (use|service)|click here|read more|sign up|log in|"
    r"subscribe (now|to)|enable javascript|follow us on|share on|lorem ipsum",
    re.IGNORECASE,
)
PUNCTUATION = re.compile(r"[.,;:!?…。、！？]")


def line_fails(line: str, words: list[str], rules: LineRules) -> bool:
    """Punctuation, navigation and boilerplate rules on one line that has a word."""
    n = len(words)
    if sum(map(line.count, SYMBOLS)) > rules.max_symbol_share * n or line.count(" | ") > rules.max_bars:
        return True
    if n >= rules.shout_words and sum(w.isupper() and len(w) > 1 for w in words) > rules.max_shout_share * n:
        return True
    if n >= rules.unpunctuated_words and not PUNCTUATION.search(line):
        return True
    if n >= rules.stutter_words and sum(map(eq, words, words[1:])) > rules.max_stutter_share * n:
        return True
    return n <= rules.notice_words and NOTICES.search(line) is not None


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both parts are equal."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeat_words(words: list) -> int:
    """Words inside windows of five words that the text has twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=n)
    bits = len(index).bit_length()
    if bits * WINDOW <= 62:
        keys = ids[: n - WINDOW + 1].copy()
        for k in range(1, WINDOW):
            keys = (keys << bits) | ids[k : n - WINDOW + 1 + k]
    else:
        two = paired(ids[:-1], ids[1:])
        keys = paired(paired(two[:-2], two[2:])[:-1], ids[4:])
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[: n - WINDOW + 1] += twice
    edge[WINDOW:] -= twice
    return int((np.cumsum(edge)[:n] > 0).sum())


def judged(text: str | None, rules: LineRules) -> tuple[int, int, int, int, int, bool, bool, int, int, str]:
    text = text or ""
    words = text.encode().split()  # ASCII white space only
    word_chars = sum(map(len, words))
    if not text.isascii():
        word_chars = len(b"".join(words).decode())
    seen: set[str] = set()
    dup = failed = lost = 0
    kept = []
    for line in text.split("\n"):
        own = WORD.findall(line)
        if not own:
            kept.append(line)
            continue
        dup += line in seen
        seen.add(line)
        if line_fails(line, own, rules):
            failed += 1
            lost += sum(map(len, own))
        else:
            kept.append(line)
    n, repeats = len(words), repeat_words(words)
    base_failed = n < rules.min_words or repeats > rules.max_repeat_share * n
    keep = not base_failed and lost <= rules.max_lost_share * word_chars
    clean = text if not failed else "\n".join(kept)
    return n, word_chars, sum(map(text.count, SYMBOLS)), dup, repeats, base_failed, keep, failed, lost, clean


def quality(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Judge every whole text; one output row for each input row, repeated rows included.

    Returns the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``,
    ``n_failed_lines``, ``lost_chars`` and ``clean_text``, the text without failing lines. A null text counts as empty: no
    words, base failed, not kept, clean text empty. Other columns are not read. A loss of exactly the allowed share is kept.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def fn(keys: list, texts: list) -> list:
        rows = [judged(t, rules) for t in texts]
        return [keys, *(list(c) for c in zip(*rows, strict=True))] if rows else [keys, *([] for _ in range(10))]

    schema = (
        f"`{id_col}` {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, n_failed_lines long, lost_chars long, clean_text string"
    )
    return map_rows(docs.select(id_col, text_col), fn, schema)
