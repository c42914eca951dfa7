"""Licences named in texts: identifier tags with their expressions, and notice phrases.

One Aho-Corasick automaton finds all notice phrases in the words of a text, and
identifier tags in the text itself.  The expression after a tag is put in postfix
order by a shunting yard (``with`` binds tightest, then ``and``, then ``or``) and
evaluated to the labels it names and to how much it asks of a user: an ``or`` lets
one choose the mildest, an ``and`` demands the strictest, a ``with`` exception halves
what is left to ask.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import ahocorasick
from pyspark.sql import DataFrame

from pressgrain.llm.common import keyed_texts, map_batches

# Phrases that always count, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Further notices, as words.  Those of one label may overlap; each place counts once.
NOTICES = {
    "lesser general public license": "lgpl", "library general public license": "lgpl",
    "affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "bsd license": "bsd", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "isc license": "isc", "zlib license": "zlib",
    "boost software license": "bsl", "the unlicense": "unlicense", "artistic license": "artistic",
    "permission is hereby granted free of charge": "mit", "licensed under the apache license": "apache",
    "redistribution and use in source and binary forms": "bsd", "creative commons": "cc",
    "licensed under cc by": "cc-by", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd",
    "cc0 1 0": "cc0", "public domain dedication": "cc0", "all rights reserved": "proprietary",
}
# What a licence asks of a user, from 0 (nothing) to 1 (everything kept back).
BURDEN = {
    "cc0": 0.0, "unlicense": 0.0, "0bsd": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "zlib": 0.1, "bsl": 0.1, "apache": 0.15,
    "cc-by": 0.15, "cc": 0.3, "artistic": 0.3, "mpl": 0.4, "epl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.6, "gpl": 0.7,
    "agpl": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.9, "proprietary": 1.0,
}
UNKNOWN_BURDEN = 0.5
TAG = "spdx-license-identifier:"

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_PART = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
_LINE = re.compile(r"[^\r\n*<>\"';,]*")
_RANK = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """The label of a licence identifier: its family, without version and suffixes."""
    name = identifier.lower().removeprefix("licenseref-").rstrip("+").removesuffix("-only").removesuffix("-or-later")
    for family in ("cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by", "cc0"):
        if name.startswith(family):
            return family
    if name == "0bsd":
        return name
    return name.split("-")[0]


@dataclass
class Value:
    labels: frozenset[str] = field(default_factory=frozenset)
    burden: float = 0.0


def postfix(tokens: list[str]) -> list[str]:
    """Shunting yard.  Raises ValueError for an expression that is none."""
    out, stack, operand_next = [], [], True
    for token in tokens:
        op = _RANK.get(token.lower())
        if token == "(":
            if not operand_next:
                raise ValueError("operator expected")
            stack.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("operand expected")
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ValueError("no opening parenthesis")
            stack.pop()
        elif op:
            if operand_next:
                raise ValueError("operand expected")
            while stack and _RANK.get(stack[-1], 0) >= op:
                out.append(stack.pop())
            stack.append(token.lower())
            operand_next = True
        else:
            if not operand_next:
                raise ValueError("operator expected")
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        raise ValueError("incomplete")
    return out + stack[::-1]


def evaluate(expression: str) -> Value:
    """Labels and burden of an expression.  Raises ValueError if it is none."""
    stack: list[Value | str] = []
    for token in postfix(_PART.findall(expression)):
        if token not in _RANK:
            label = label_of(token)
            stack.append(Value(frozenset([label]), BURDEN.get(label, UNKNOWN_BURDEN)))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":  # what stands on the right is an exception, no licence
            stack.append(Value(left.labels, left.burden / 2))
        else:
            pick = min if token == "or" else max
            stack.append(Value(left.labels | right.labels, pick(left.burden, right.burden)))
    return stack[0]


def tag_expression(line: str) -> Value | None:
    """The value of the longest part of a line, from its beginning, that is an expression.

    The part stops where two operands or words follow each other, so prose after an
    expression does not spoil it.  None if nothing of the line is one.
    """
    tokens = _PART.findall(line)
    depth, operand_next, usable = 0, True, 0
    for i, token in enumerate(tokens):
        op = token.lower() in _RANK
        if token == "(":
            if not operand_next:
                break
            depth += 1
        elif token == ")":
            if operand_next or not depth:
                break
            depth -= 1
        elif op != (not operand_next):
            break
        else:
            operand_next = op
        if not operand_next and not depth:
            usable = i + 1
    return evaluate(" ".join(tokens[:usable])) if usable else None


def _automaton(phrases: dict[str, str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in phrases.items():
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


_AUTOMATON = None


def _phrases() -> ahocorasick.Automaton:
    global _AUTOMATON
    if _AUTOMATON is None:
        _AUTOMATON = _automaton(NOTICES | BASE)
    return _AUTOMATON


def scan_text(text: str) -> dict:
    """Words, places and labels of a text; see ``scan``."""
    words = text.encode("utf-8", "replace").translate(_FOLD).split()
    line = b" " + b" ".join(words) + b" "
    base, labels, places, burdens = set(), set(), [], []
    joined = line.decode("utf-8", "replace")
    spaces, seen = 0, 0  # of the line up to the last end
    for end, (phrase, label) in _phrases().iter(joined):
        labels.add(label)
        burdens.append(BURDEN.get(label, UNKNOWN_BURDEN))
        if phrase in BASE:
            spaces, seen = spaces + joined.count(" ", seen, end), end
            places.append(spaces - 1 - phrase.count(" "))
            base.add(label)
    low = text.translate(_LOWER)
    expressions, at = [], low.find(TAG)
    while at >= 0:
        rest = _LINE.match(text, at + len(TAG))[0]
        value = tag_expression(rest)
        if value:
            expressions.append(value)
            labels |= value.labels
            burdens.append(value.burden)
        at = low.find(TAG, at + len(TAG))
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min(places, default=None),
        "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)),
        "score": max(burdens, default=0.0), "n_tags": len(expressions),
    }


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_tags).

    One for each input row; null texts are empty.  Words are runs of ASCII letters and
    digits or of any other characters beyond ASCII, lower-cased from A to Z.  ``n_base``
    counts the places of the base phrases' words; ``labels`` has those of all phrases
    and tags.  ``score`` is the strictest burden found, 0 without any licence.
    """

    def of(batch):
        found = [scan_text(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0)} | {k: [f[k] for f in found] for k in found[0]}

    return map_batches(
        keyed_texts(docs, id_col, text_col), of,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, n_tags long",
    )
