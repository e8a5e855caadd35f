"""License scan by ordered signature rules.

Text becomes lower-case words (letters, digits and all non-ASCII) parted by one
space. A rule runs only if one of its keywords is among the words. Detections
are taken by priority, then length; one whose words lie inside a detection
already kept is suppressed.

Three base phrases are always counted, at every place where their words stand
consecutively. Null text counts as empty: no words, no labels, score 0. The
functions work on one column, so repeated rows and extra columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.llm.common import strings, structs
from basketry.llm.license_rules import Rule, rules
from basketry.llm.tokens import PUNCTUATION, byte_table

WORDS = byte_table(PUNCTUATION)
#: The base phrases and their labels.
BASE = {b"under the mit license": "mit", b"apache license version 2": "apache-2", b"cc by nc": "cc-by-nc"}
BASE_PATTERNS = [(label, re.compile(rb"(?<![^ ])(?=" + phrase + rb"(?![^ ]))")) for phrase, label in BASE.items()]
#: A base phrase alone is as sure as a bare title.
BASE_SCORE = 0.6


class Detection(NamedTuple):
    """A rule's match: words [start, end)."""

    label: str
    priority: int
    start: int
    end: int


@lru_cache(maxsize=1)
def rule_index() -> dict[bytes, list[Rule]]:
    """Rules by keyword."""
    index: dict[bytes, list[Rule]] = {}
    for rule in rules():
        for word in rule.keywords:
            index.setdefault(word, []).append(rule)
    return index


def suppressed(found: list[Detection]) -> list[Detection]:
    """Detections by priority, then length, without those inside one already kept."""
    kept: list[Detection] = []
    reach: dict[int, int] = {}  # word: furthest end of a kept detection that covers it
    for d in sorted(set(found), key=lambda d: (-d.priority, d.start - d.end, d.start, d.label)):
        if reach.get(d.start, 0) < d.end:
            kept.append(d)
            for word in range(d.start, d.end):
                reach[word] = max(reach.get(word, 0), d.end)
    return kept


def starts(pattern: re.Pattern, line: bytes) -> Iterator[tuple[int, bytes]]:
    """Word number and text of each match."""
    word = at = 0
    for m in pattern.finditer(line):
        word += line.count(b" ", at, m.start())
        at = m.start()
        yield word, m[0]


def normal(text: str) -> tuple[bytes, list[bytes]]:
    words = text.encode().translate(WORDS).split()
    return b" ".join(words), words


def detect(line: bytes, words: list[bytes]) -> list[Detection]:
    """Kept detections of normalised text."""
    index = rule_index()
    found, tried = [], set()
    for word in index.keys() & set(words):
        for rule in index[word]:
            if rule not in tried:
                tried.add(rule)
                found += [Detection(rule.label, rule.priority, word, word + m.count(b" ") + 1) for word, m in starts(rule.pattern, line)]
    return suppressed(found)


REPORT = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_detections", pa.int64()),
])


def _report(text: str) -> tuple:
    line, words = normal(text)
    places, base = [], set()
    for label, pattern in BASE_PATTERNS:
        if at := [word for word, _ in starts(pattern, line)]:
            base.add(label)
            places += at
    kept = detect(line, words)
    score = max([d.priority / 100 for d in kept] + [BASE_SCORE] * bool(base), default=0.0)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {d.label for d in kept})), score, len(kept))


def report(text: Column) -> Column:
    """Struct of word count, base places, labels, score and the number of kept detections."""

    @F.arrow_udf("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
                 "score double, n_detections long")
    def run(column: pa.Array) -> pa.Array:
        return structs(REPORT, map(_report, strings(column)))

    return run(text)
