"""Secrets in texts: fixed patterns, and strings that compression finds new.

Besides the patterns, a long string near a word such as "key" or "auth" is measured:
zstandard compresses it after a dictionary made of common identifiers and the text
around it.  A name, path or number seen before costs a few bytes; a random secret
costs nearly all that its characters cost in an order that repeats nothing.  Names new
to the text cost as much, so strings that are words joined by signs are no secrets.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from pressgrain.llm.common import keyed_texts, map_batches

KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Words that make a context sensitive, and identifiers that are no secrets.
CONTEXT = (
    "password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api key", "access_key",
    "access key", "private_key", "private key", "auth", "bearer", "credential", "signature", "client_id", "cookie",
)
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key public_key client_id client_secret "
    "authorization authentication bearer basic credential credentials signature session cookie username user "
    "admin root localhost example.com http:// https:// www. .com .org .net .json .yaml .html .py .js .txt "
    "config configuration environment variable default undefined null none true false return function "
    "import export const static public private protected string integer boolean float double number array "
    "object class interface abstract extends implements package module require include define process.env "
    "os.environ get set self this value name type key id index count length size path file directory "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 your_api_key_here changeme placeholder "
    "xxxxxxxxxxxxxxxx ----------------"
)
_NEAR = re.compile("|".join(map(re.escape, CONTEXT)), re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_PART = re.compile(r"[A-Za-z0-9+/_=-]+")
_JOIN = re.compile(r"""[^A-Za-z0-9+/_=\s-]{0,3}\r?\n[\x20\t]*["']?|[^A-Za-z0-9+/_=\n-]{1,3}""")
_LINE_END = re.compile(r"""["',;)\x20]*(?:\r?\n|\Z)""")
_PARTS = re.compile(r"[A-Za-z0-9]+")
_RUNS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_VOWEL = re.compile(r"[aeiouy]")
_CLUSTER = re.compile(r"[bcdfghjklmnpqrstvwxz]{5}")


def _added(candidate: bytes, primed: zstandard.ZstdCompressionDict | None = None) -> int:
    """Bytes that the candidate adds to a frame."""
    packer = zstandard.ZstdCompressor(
        level=19, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    return len(packer.compress(candidate)) - len(packer.compress(b""))


def _marginal(candidate: bytes, around: bytes) -> int:
    """Bytes that the candidate adds to a frame whose dictionary is what surrounds it."""
    return _added(candidate, zstandard.ZstdCompressionDict(
        IDENTIFIERS.encode() + b" " + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT
    ))


def _unmatched(candidate: bytes) -> int:
    """Bytes that the candidate's characters cost, shuffled and without a dictionary: entropy coding alone."""
    mixed = list(candidate)
    random.Random(0).shuffle(mixed)
    return _added(bytes(mixed))


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _word_like(run: str) -> bool:
    """Whether a run of letters could be a word: some vowels, and no five other letters in a row."""
    vowels = len(_VOWEL.findall(run))
    return 0.15 * len(run) <= vowels <= 0.8 * len(run) and not _CLUSTER.search(run)


def joined_words(value: str, share: float = 0.7) -> bool:
    """Whether a string is made of words, as names, paths and addresses are.

    It is cut at signs, between letters and digits and where case changes as in names.
    ``share`` of its letters and digits must lie in runs of three or more letters that
    could be words, or shorter ones that stand alone; numbers of up to four digits
    beside words do not count, and a part with two or more numbers between its letters
    is no word.
    """
    total = wordy = 0
    for part in _PARTS.findall(value):
        runs = _RUNS.findall(part)
        if sum(run.isdigit() for run in runs[1:-1]) > 1:
            total += len(part)  # digits scattered between letters
            continue
        numbers = 0
        plain = True
        for run in runs:
            if run.isdigit():
                numbers += len(run) if len(run) <= 4 else 0
                total += len(run)
                continue
            total += len(run)
            if (len(run) >= 3 or len(runs) == 1) and _word_like(run.lower()):
                wordy += len(run)
            elif len(run) > 1:
                plain = False
        if plain:
            total -= numbers
    return total > 0 and wordy >= share * total


def _is_secret_like(value: str, entropy: float) -> bool:
    return _entropy(value) >= entropy and not joined_words(value)


def _carried(text: str, lo: int, hi: int, entropy: float) -> list[tuple[int, int]]:
    """What goes on behind a secret: parts after a dot, lines after a line end.

    Between two parts stand a dot, a line end with indentation or up to three other
    signs.  A part has 16 or more characters and is no joined words; a shorter last line
    counts behind two or more lines that are equally long.
    """
    found, lines = [], [hi - lo]
    while gap := _JOIN.match(text, hi):
        m = _PART.match(text, gap.end())
        if not m:
            break
        value, is_line = m[0], "\n" in gap[0]
        short = is_line and len(lines) > 1 and len(set(lines)) == 1 and len(value) < lines[0] and _LINE_END.match(text, m.end())
        if not (short and "-" not in value) and not (len(value) >= 16 and _is_secret_like(value, entropy)):
            break
        lo, hi = m.span()
        found.append((lo, hi))
        lines = [*lines, hi - lo] if is_line else [hi - lo]
    return found


def novel_spans(
    text: str, taken: list[tuple[int, int]], reach: int = 40, around: int = 1024, novelty: float = 0.9,
    entropy: float = 3.0,
) -> list[tuple[int, int]]:
    """Spans of candidates in sensitive context that compression can't shorten.

    A candidate has 16 or more letters, digits or ``+/_=-``, among them a digit and a
    letter, is no joined words, and a word of ``CONTEXT`` stands at most ``reach``
    characters before it.  Its dictionary is the text up to ``around`` characters on
    either side without the candidate itself.  It is reported if it still costs
    ``novelty`` of its length, or of what its characters cost shuffled and without a
    dictionary where that is less (hex digits take half a byte each), and its characters
    are spread (``entropy`` bits each).  A secret carries its context on to what follows
    it directly, so keys of many lines and tokens of several parts are taken whole, also
    behind a span in ``taken``; what overlaps one of these is skipped.
    """
    found: list[tuple[int, int]] = []
    free = lambda a, b: not any(a < y and x < b for x, y in taken)
    end = 0

    def carry(lo: int, hi: int) -> int:
        for a, b in _carried(text, lo, hi, entropy):
            hi = b
            if free(a, b):
                found.append((a, b))
        return hi

    starts = [(m.end(), None) for m in _NEAR.finditer(text)] + [(b, (a, b)) for a, b in taken if b - a >= 16]
    for near, span in sorted(starts, key=lambda s: s[0]):
        if span is not None:
            end = max(end, carry(*span))
            continue
        for m in _CANDIDATE.finditer(text, max(near, end), min(len(text), near + reach + 16)):
            lo = m.start()
            if lo > near + reach:
                break
            if lo < end:
                continue
            hi = _CANDIDATE.match(text, lo).end()  # the search above may have been cut
            end = hi
            value = text[lo:hi]
            if not free(lo, hi):
                continue
            if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
                continue
            if not _is_secret_like(value, entropy):
                continue
            rest = text[max(0, lo - around) : lo] + " " + text[hi : hi + around]
            cost = _marginal(value.encode(), rest.encode("utf-8", "replace"))
            if cost >= novelty * (hi - lo) or cost >= novelty * _unmatched(value.encode()):
                found.append((lo, hi))
                end = carry(lo, hi)
    return sorted(set(found))


def spans(text: str) -> list[tuple[int, int, int]]:
    """All spans (start, end, kind as index of ``KINDS``) by start, then kind; ends are exclusive."""
    low = text.lower()
    found = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    if _NEAR.search(low):
        found += [(a, b, 3) for a, b in novel_spans(text, [(a, b) for a, b, _ in found])]
    return sorted(found, key=lambda s: (s[0], s[2]))


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans), one for each input row.

    ``spans`` are kind:start:end in code points, by start, joined by commas;
    ``base_sha256`` is the digest of the same string over the fixed patterns alone.
    Null texts are empty.
    """

    def of(batch):
        found = [spans(t) for t in batch.column(1).to_pylist()]
        count = lambda kind: [sum(k == kind for _, _, k in f) for f in found]
        return {
            "doc_id": batch.column(0), "n_assign": count(0), "n_access": count(1), "n_hex": count(2), "n_novel": count(3),
            "base_sha256": [hashlib.sha256(joined([s for s in f if s[2] < 3]).encode()).hexdigest() for f in found],
            "spans": [joined(f) for f in found],
        }

    return map_batches(
        keyed_texts(docs, id_col, text_col), of,
        "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string",
    )


def redacted(text: str, mask: str = "[SECRET]") -> str:
    """The text with every span replaced; spans that overlap are replaced together."""
    out, at = [], 0
    for a, b, _ in spans(text):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def redact(text: Column, mask: str = "[SECRET]") -> Column:
    """Each whole text without its secrets; a null text stays null."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redacted(t, mask) for t in texts], dtype=object)

    return F.pandas_udf(of, "string")(text)
