"""Text functions: Column in, Column out, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from pressgrain.functions.columns import bind

# Unicode white space as Python's str.split sees it: Java's (?U)\s lacks 1c-1f.
_SPACE = r"\s\x1c-\x1f"


def split_words(text: Column) -> Column:
    """Whitespace-separated words; the first and last may be empty."""
    return F.split(text, f"(?U)[{_SPACE}]+")


def words(text: Column) -> Column:
    """Whitespace-separated words, empty strings removed."""
    return F.filter(split_words(text), lambda w: w != "")


def clean_words(text: Column) -> Column:
    """Keep purely alphabetic words of 3 to 13 ASCII letters, one space between.

    Characters other than ASCII letters, digits and white space are removed
    first, so ``cross-border`` becomes one word.  Null stays null.
    """
    kept = F.filter(
        F.split(F.regexp_replace(text, f"(?U)[^a-zA-Z0-9{_SPACE}]", ""), f"(?U)[{_SPACE}]+"),
        lambda w: F.length(w).between(3, 13) & ~w.rlike("[0-9]"),
    )
    return F.array_join(kept, " ")


def has_content(text: Column) -> Column:
    """True when any character is not white space; null counts as no content."""
    return F.coalesce(text.rlike(f"(?U)[^{_SPACE}]"), F.lit(False))


def capitalised(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))


def publisher_from_url(url: Column) -> Column:
    """``https://www.new-york.example/x`` -> ``New York``; no authority -> ``''``."""
    authority = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    host = F.split_part(F.regexp_replace(authority, r"^www\.", ""), F.lit("."), F.lit(1))
    return F.array_join(F.transform(F.split(host, "-"), capitalised), " ")


def publisher_from_title(title: Column) -> Column:
    """Text after the last `` - ``, else after the last `` | ``, else ``Unknown``."""
    def last(mark: str) -> Column:
        # split from the left: in "a | | b" the second bar belongs to the last part
        return F.element_at(F.split(title, mark), -1)

    return (
        F.when(title.contains(" - "), last(" - "))
        .when(title.contains(" | "), last(r" \| "))
        .when(title.isNotNull(), F.lit("Unknown"))
    )


def topic_slug(query: Column) -> Column:
    """Folder-safe topic name.  ``AND`` is removed wherever it occurs."""
    spaced = F.regexp_replace(F.replace(query, F.lit("AND"), F.lit(" ")), " +", " ")
    return F.regexp_replace(F.trim(spaced), " ", "_")


def sentiment_category(score: Column) -> Column:
    """Above zero is positive, everything else negative."""
    return F.when(score > 0, F.lit("positive")).otherwise(F.lit("negative"))


def row_digest(columns: Iterable[str]) -> Column:
    """Content hash of a row: the same on every retry and partitioning.

    Each value stands behind its length in code points, a null behind none, so no
    two different rows give the same text.
    """
    parts = []
    for c in columns:
        value = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("~")))
    return F.sha2(F.concat(*parts), 256)


def word_tokens(text: Column) -> Column:
    """Lower-case runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def alpha_tokens(text: Column) -> Column:
    """Lower-case words of 3 to 13 ASCII letters between Unicode word borders."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b[a-z]{3,13}\b"), F.lit(0))


def without(tokens: Column, stop_words: Iterable[str]) -> Column:
    """Drop stop words.  Literal lists become one hash set, probed per token."""
    stop = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(stop)) if stop else tokens


# Endings that a word tokenizer splits off, and marks it splits at.
_CONTRACTION = r"(?:n't|'(?:s|m|d|ll|re|ve))$"
_MARKS = r"?!,;:()\[\]{}<>\"“”…"


def _bare_word(word: Column) -> Column:
    """A word without the punctuation around it and without a contracted ending."""
    trimmed = F.regexp_replace(word, r"(?U)^[^\w]+|[^\w]+$", "")
    return F.when(word.rlike("^[a-z]+$"), word).otherwise(
        F.regexp_replace(trimmed, _CONTRACTION, "")
    )


def keyword_tokens(text: Column, stop_words: Iterable[str] = ()) -> Column:
    """Lower-case alphabetic words longer than two letters that are no stop words."""
    parts = F.transform(F.split(F.lower(text), f"(?U)[{_SPACE}{_MARKS}]+"), _bare_word)
    found = F.filter(parts, lambda w: (F.length(w) > 2) & w.rlike(r"^\p{L}+$"))
    return without(found, stop_words)


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs joined by one space."""
    def pairs(t: Column) -> Column:
        return F.transform(
            F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))),
            lambda w, i: F.concat_ws(" ", w, F.get(t, i + 1)),
        )

    return bind(tokens, pairs)


def first_words(text: Column, limit: int) -> Column:
    """The first ``limit`` words, one space between."""
    return F.array_join(F.slice(words(text), 1, limit), " ")


def sentences(text: Column) -> Column:
    """Split after ``. ! ?`` followed by white space; empty parts removed."""
    parts = F.split(text, rf"(?U)(?<=[.!?])[{_SPACE}]+")
    return F.filter(F.transform(parts, F.trim), lambda s: s != "")
