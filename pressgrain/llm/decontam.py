"""Benchmark items that occur in documents, also with other numbers, names and units.

Both sides are brought to templates: numbers, units after numbers and names become
typed placeholders (slots), all other words are case-folded.  Windows of template
tokens are joined by hash.  Along each alignment of an item and a document the slots
must be consistent: one value of the item stands for one value of the document
throughout, and different ones for different ones.  Windows that touch a slot
breaking this do not count.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from pressgrain.llm.common import fresh, keyed_texts, map_batches, presence_bits, present, stored

# Number words, units, and words that begin sentences without being names.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms "
    "ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds "
    "minute minutes hour hours day days week weeks month months year years cent cents dollar dollars "
    "euro euros percent degree degrees mph kmh joule joules watt watts volt volts meter meters metre metres"
).split()
OPENERS = (
    "the a an if in on at of to for by with from and or but so as it its he she they we you i this that "
    "these those there here what which who whose whom when where why how is are was were do does did can "
    "could will would should may might must has have had not no yes then than after before while during "
    "each every some all any both one find given let suppose consider calculate compute determine solve"
).split()

_MARKS = ".!?\n:;\"“”()"
_TOKEN = re.compile(rf"\d+(?:[.,]\d+)*|[^\W\d_]+|[{_MARKS}]")
_MARK, _WORD, _NAME, _NUMBER, _UNIT = range(5)


def _digest(value: str) -> int:
    return xxhash.xxh64_intdigest(value)


_SLOT = {kind: _digest(f"<{name}>") for kind, name in ((_NAME, "name"), (_NUMBER, "number"), (_UNIT, "unit"))}


class _Vocabulary(dict):
    """Index of each token seen, with its kinds and hash; forgets everything when it is full."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit
        self.clear()

    def clear(self):
        super().clear()
        self.kinds, self.hashes = np.empty((2, 1024), dtype=np.int8), np.empty(1024, dtype=np.uint64)

    def __missing__(self, token: str) -> int:
        low, at = token.casefold(), len(self)
        if token in _MARKS:
            kind = folded = _MARK
        elif token[0].isdigit() or low in _NUMBERS:
            kind = folded = _NUMBER
        else:
            kind = folded = _UNIT if low in _UNIT_SET else _WORD
            if token[0].isupper() and not (len(token) > 1 and token.isupper()):
                kind = _NAME if low not in _OPENERS else _WORD
        if at == len(self.hashes):
            self.kinds, self.hashes = np.tile(self.kinds, 2), np.tile(self.hashes, 2)
        self.kinds[:, at] = kind, folded
        self.hashes[at] = _digest(low)
        self[token] = at
        return at


_NUMBERS, _UNIT_SET, _OPENERS = frozenset(NUMBER_WORDS), frozenset(UNITS), frozenset(OPENERS)
_SEEN = _Vocabulary()

# As written, where capitals make names, and with all case folded, where names are words.
WRITTEN, FOLDED = VIEWS = range(2)


class _Tokens:
    """The tokens of texts, one after the other; marks are left out."""

    def __init__(self, texts: list[str]):
        if len(_SEEN) > _SEEN.limit:
            _SEEN.clear()
        parts = []
        for text in texts:
            tokens = _TOKEN.findall(text)
            parts.append(np.fromiter(map(_SEEN.__getitem__, tokens), dtype=np.int64, count=len(tokens)))
        at = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
        text = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        plain = _SEEN.kinds[WRITTEN, at] != _MARK
        # whether a token begins or ends a sentence: a mark or the text's border is beside it
        other = np.ones(len(at) + 1, dtype=bool)
        other[1:-1] = text[1:] != text[:-1]
        mark = np.concatenate([[True], ~plain, [True]])
        self.opens, self.closes = (mark[:-2] | other[:-1])[plain], (mark[2:] | other[1:])[plain]
        at, self.text = at[plain], text[plain]
        self.values, self._kinds = _SEEN.hashes[at], _SEEN.kinds[:, at]
        self.lengths = np.bincount(self.text, minlength=len(parts))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def template(self, view: int) -> tuple[np.ndarray, np.ndarray]:
        """Template hashes and whether each token is a slot."""
        kinds = self._kinds[view]
        after_number = np.zeros(len(kinds), dtype=bool)
        after_number[1:] = (kinds[:-1] == _NUMBER) & (self.text[1:] == self.text[:-1])
        kinds = np.where((kinds == _UNIT) & ~after_number, _WORD, kinds)
        hashes = self.values.copy()
        for kind, digest in _SLOT.items():
            hashes[kinds == kind] = digest
        return hashes, kinds != _WORD


def template(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template hashes, value hashes and whether each token is a slot; marks are left out.

    A capitalised word is a name unless it is a usual opener of sentences.  A unit is
    a slot only right after a number.
    """
    tokens = _Tokens([text])
    hashes, slots = tokens.template(WRITTEN)
    return hashes, tokens.values, slots


_BASE = np.uint64(0x9E3779B97F4A7C15)
_STIR = np.uint64(0xD6E8FEB86659FD93)
_FOLD = np.uint64(0xA0761D6478BD642F)  # windows of the two views, and of values alone, never meet
_EXACT = np.uint64(0xE7037ED1A0B428DB)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every window of ``size`` tokens."""
    n = len(hashes) - size + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(size if n > 0 else 0):
        total = (total ^ hashes[i : i + n]) * _BASE
        total ^= total >> np.uint64(29)
    total *= _STIR
    return total ^ (total >> np.uint64(32))


def _windows(tokens: _Tokens, view: int, sizes: list[int], literal: int, size: int, least: int):
    """(size, hashes, whether it counts, slots) of all windows within a text.

    As written, those with ``literal`` plain words count.  With case folded all count,
    but fewer plain words make a window of values without slots.  Windows shorter than
    ``size`` are whole items: those of under ``least`` tokens or, with case folded,
    without a plain word count only as a whole text, others (if there is a ``least``)
    only as whole sentences, with a mark or the text's border on either side.
    """
    hashes, slots = tokens.template(view)
    words = np.concatenate([[0], np.cumsum(~slots)])
    for w in sizes:
        found = window_hashes(hashes, w)
        n = len(found)
        if not n:
            continue
        plain = words[w:] - words[:n]
        enough = plain >= min(literal, w)
        counts = tokens.text[w - 1 :] == tokens.text[:n]
        if view == FOLDED:
            found = np.where(enough, found ^ _FOLD, window_hashes(tokens.values, w) ^ _EXACT)
        else:
            counts &= enough
        if w < size:
            whole = tokens.lengths[tokens.text[:n]] == w
            sentence = (tokens.opens[:n] & tokens.closes[w - 1 :]) | (least == 0)
            counts &= whole | (sentence & (w >= least) & ((plain > 0) | (view == WRITTEN)))
        yield w, found, counts, slots, enough


_SCHEMA = "id long, n int, view int, place int, size int, hash long, slots array<struct<at int, value long>>"


def _rows(out: dict, keys: list, tokens: _Tokens, view: int, size: int, found, places, slots, templated) -> None:
    slot_at = np.flatnonzero(slots)
    for p in places.tolist():
        lo, hi = np.searchsorted(slot_at, [p, p + size])
        text = tokens.text[p]
        out["id"].append(keys[text])
        out["n"].append(int(tokens.lengths[text]))
        out["view"].append(view)
        out["place"].append(p - int(tokens.starts[text]))
        out["size"].append(size)
        out["hash"].append(int(found[p].view(np.int64)))
        out["slots"].append([{"at": int(q) - p, "value": int(tokens.values[q].view(np.int64))} for q in (slot_at[lo:hi] if templated[p] else ())])


def _empty() -> dict:
    return {k: [] for k in ("id", "n", "view", "place", "size", "hash", "slots")}


def item_windows(
    items: DataFrame, size: int = 8, literal: int = 4, views: tuple[int, ...] = (WRITTEN,), least: int = 0
) -> DataFrame:
    """Template windows of the benchmark; an item of fewer tokens than ``size`` is one window."""

    def of(batch):
        out = _empty()
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens = _Tokens([text])
            n = len(tokens.values)
            for view in views if n else ():
                for s, found, counts, slots, templated in _windows(tokens, view, [min(size, n)], literal, size, least):
                    _rows(out, [key], tokens, view, s, found, np.flatnonzero(counts), slots, templated)
        return out

    return map_batches(items, of, _SCHEMA)


def _portions(keys: list, texts: list[str], most: int = 1 << 20):
    """The rows in turn, so many at once that their texts have about ``most`` characters."""
    lo, total = 0, 0
    for hi, text in enumerate(texts, 1):
        total += len(text)
        if total >= most or hi == len(texts):
            yield keys[lo:hi], texts[lo:hi]
            lo, total = hi, 0


def document_windows(
    docs: DataFrame, bits: np.ndarray, sizes: list[int], size: int = 8, literal: int = 4,
    views: tuple[int, ...] = (WRITTEN,), least: int = 0,
) -> DataFrame:
    """Template windows of whole documents that may be in the benchmark."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def of(batch):
        known = shared.value
        out = _empty()
        for keys, texts in _portions(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens = _Tokens(texts)
            for view in views:
                for s, found, counts, slots, templated in _windows(tokens, view, sizes, literal, size, least):
                    _rows(out, keys, tokens, view, s, found, np.flatnonzero(counts & present(found, known)), slots, templated)
        return out

    return map_batches(docs, of, _SCHEMA)


def _met(
    bench: DataFrame, docs: DataFrame, size: int, literal: int, views: tuple[int, ...], least: int, id_col: str, text_col: str
) -> DataFrame:
    """Rows (doc_id, item_id, view, shift, i_place, exact): the item's windows that occur with consistent slots."""
    bits = presence_bits(bench, "hash", 23, per_key=1024)
    sizes = sorted(r[0] for r in bench.select("size").distinct().collect())  # at most `size` of them
    texts = keyed_texts(docs, id_col, text_col).where("doc_id is not null")
    hits = stored(document_windows(texts, bits, sizes, size, literal, views, least))
    d = hits.select(F.col("id").alias("doc_id"), F.col("place").alias("d_place"), "view", "size", "hash", F.col("slots").alias("d_slots"))
    b = bench.select(F.col("id").alias("item_id"), F.col("place").alias("i_place"), "view", "size", "hash", F.col("slots").alias("i_slots"))
    met = stored(
        d.join(b, ["hash", "size", "view"])
        .where(F.transform("d_slots", lambda s: s["at"]) == F.transform("i_slots", lambda s: s["at"]))
        .select(
            "doc_id", "item_id", "view", "i_place", (F.col("d_place") - F.col("i_place")).alias("shift"),
            F.zip_with("i_slots", "d_slots", lambda i, o: F.struct(i["value"].alias("i"), o["value"].alias("d"))).alias("slots"),
        )
    )
    along = ["doc_id", "item_id", "view", "shift"]
    values = met.select(*along, F.inline("slots")).distinct()
    torn = (
        values.groupBy(*along, "i").agg(F.count("*").alias("n")).where("n > 1").select(*along, F.col("i").alias("bad_i"), F.lit(None).cast("long").alias("bad_d"))
        .unionByName(
            values.groupBy(*along, "d").agg(F.count("*").alias("n")).where("n > 1").select(*along, F.lit(None).cast("long").alias("bad_i"), F.col("d").alias("bad_d"))
        )
        .groupBy(*along).agg(F.collect_set("bad_i").alias("bad_i"), F.collect_set("bad_d").alias("bad_d"))
    )
    kept = met.join(torn, along, "left").where(
        F.col("bad_i").isNull()
        | ~F.exists("slots", lambda s: F.array_contains("bad_i", s["i"]) | F.array_contains("bad_d", s["d"]))
    )
    return kept.select(*along, "i_place", F.forall("slots", lambda s: s["i"] == s["d"]).cast("int").alias("exact"))


def _shares(bench: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, view, n, size, n_windows, n_found, n_exact, coverage); runs no job."""
    found = (
        kept.groupBy("doc_id", "item_id", "view", "i_place").agg(F.max("exact").alias("exact"))
        .groupBy("doc_id", "item_id", "view").agg(F.count("*").alias("n_found"), F.sum("exact").alias("n_exact"))
    )
    total = (
        bench.select(F.col("id").alias("item_id"), "view", "n", "size", "place").distinct()
        .groupBy("item_id", "view").agg(F.max("n").alias("n"), F.max("size").alias("size"), F.count_distinct("place").alias("n_windows"))
    )
    return found.join(total, ["item_id", "view"]).withColumn("coverage", F.col("n_found") / F.col("n_windows"))


def contaminated(
    docs: DataFrame, items: DataFrame, size: int = 8, literal: int = 4, coverage: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, item_id, n_windows, n_found, n_exact, coverage): items that documents contain.

    ``n_found`` counts the item's windows that occur in the document with consistent
    slots, ``n_exact`` those whose slots have the item's own values; ``coverage`` is
    their share and at least the given one.  Windows of fewer than ``literal`` plain
    words do not count; an item without any counting window is never found.

    Null texts are empty and null ids take no part; rows repeating an id are taken
    together.  Runs jobs: the benchmark's windows and the documents' candidate
    windows are written once; a bit map of fixed size and the few window lengths in
    use come to the driver.
    """
    bench = stored(item_windows(keyed_texts(items, item_col, item_text_col).where("doc_id is not null"), size, literal))
    kept = _met(bench, docs, size, literal, (WRITTEN,), 0, id_col, text_col)
    return _shares(bench, kept).where(F.col("coverage") >= coverage).select(*_RESULT)


_RESULT = ("doc_id", "item_id", "n_windows", "n_found", "n_exact", "coverage")


def leaked(
    docs: DataFrame, items: DataFrame, size: int = 8, literal: int = 4, coverage: float = 0.5, run: int = 20, least: int = 3,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Rows as of ``contaminated``: items that documents contain as written or in other case, whole or in part.

    Windows are compared twice: as written, where capitalised words are slots, and with
    all case folded, where names are words like others.  An item is found if in either
    view the share of its windows is at least ``coverage``, or if consecutive windows
    along one alignment span ``coverage`` of its tokens, or ``run`` tokens whatever
    the share; the figures are those of the view that finds more.  One window alone,
    where the item has others, must have the item's own slot values.

    With case folded, windows of fewer than ``literal`` plain words count too, where
    all their tokens are equal.  So every item has windows: one of fewer tokens than
    ``size`` is found where it stands as whole sentences, with a mark or the text's
    border on either side.  One of fewer than ``least`` tokens, or a short one without
    any plain word, must be the whole document.  Runs jobs, as ``contaminated`` does.
    """
    texts = keyed_texts(items, item_col, item_text_col).where("doc_id is not null")
    bench = stored(item_windows(texts, size, literal, VIEWS, least))
    kept = stored(_met(bench, docs, size, literal, VIEWS, least, id_col, text_col))
    key = ["doc_id", "item_id", "view"]
    order = F.row_number().over(Window.partitionBy(*key, "shift").orderBy("i_place"))
    longest = (
        kept.select(*key, "shift", "exact", (F.col("i_place") - order).alias("island"))
        .groupBy(*key, "shift", "island").agg(F.count("*").alias("run"), F.sum("exact").alias("same"))
        .where((F.col("run") > 1) | (F.col("same") > 0))
        .groupBy(*key).agg(F.max("run").alias("run"))
    )
    spanned = F.col("run") + F.col("size") - 1
    enough = (F.col("n_found") > 1) | (F.col("n_exact") > 0) | (F.col("n_found") == F.col("n_windows"))
    found = _shares(bench, kept).join(longest, key, "left").where(
        ((F.col("coverage") >= coverage) & enough) | (spanned >= F.least(F.lit(float(run)), coverage * F.col("n")))
    )
    best = F.max(F.struct("coverage", (-F.col("view")).alias("view"), "n_windows", "n_found", "n_exact")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*").select(*_RESULT)


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows whose document contains no benchmark item; all columns stay.  Runs jobs."""
    gone_id = fresh(docs, "gone_id")
    gone = stored(leaked(docs, items, **options).select(F.col("doc_id").alias(gone_id)).distinct())
    return docs.join(gone, docs["doc_id"] == F.col(gone_id), "left_anti")
