"""Rule-based sentiment of a text, as one column expression.

The rules are those published by Hutto and Gilbert (2014): word valences from a
lexicon, boosters and negations in the three words before, emphasis by capitals
and punctuation, a contrast word, a few idioms.  Everything is evaluated inside
the row in the JVM; no tokens are exploded or shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from pressgrain.functions.columns import bind
from pressgrain.functions.text import split_words

# Fixed values of the published rules.
BOOST = 0.293
CAPITALS = 0.733
NEGATED = -0.74
NORMALISER = 15
EXCLAMATION = 0.292
QUESTION = 0.18
QUESTIONS_MANY = 0.96
DISTANCE_2 = 0.95
DISTANCE_3 = 0.9
BEFORE_CONTRAST = 0.5
AFTER_CONTRAST = 1.5
NEVER_SO_2 = 1.5
NEVER_SO_3 = 1.25

# Words that strengthen the sentiment after them.
STRENGTHEN = [
    "absolutely", "amazingly", "awfully", "completely", "considerably",
    "decidedly", "deeply", "effing", "enormously", "entirely", "especially",
    "exceptionally", "extremely", "fabulously", "flipping", "flippin",
    "fricking", "frickin", "frigging", "friggin", "fully", "fucking",
    "greatly", "hella", "highly", "hugely", "incredibly", "intensely",
    "majorly", "more", "most", "particularly", "purely", "quite", "really",
    "remarkably", "so", "substantially", "thoroughly", "totally",
    "tremendously", "uber", "unbelievably", "unusually", "utterly", "very",
]

# Words that weaken the sentiment after them.
WEAKEN = [
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof",
    "kind-of", "less", "little", "marginally", "occasionally", "partly",
    "scarcely", "slightly", "somewhat", "sort of", "sorta", "sortof",
    "sort-of",
]

# Negations.
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
    "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't",
    "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing",
    "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't",
    "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom",
    "despite",
]

# Idioms and their valence.
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}


@dataclass(frozen=True)
class Rules:
    """Word lists of the rules; the defaults are the published English ones."""

    boosters: Mapping[str, float] = field(
        default_factory=lambda: {w: BOOST for w in STRENGTHEN} | {w: -BOOST for w in WEAKEN}
    )
    negations: frozenset[str] = frozenset(NEGATIONS)
    idioms: Mapping[str, float] = field(default_factory=lambda: dict(IDIOMS))
    contrast: str = "but"
    # first part of a two-word dampener that must not count as a sentiment word
    kind: str = "kind"
    least: str = "least"


def _pick(token: Column, values: Mapping[str, float], miss: Column) -> Column:
    """Value of a token in a literal table, by hash-set probes.

    Most tokens are not listed and cost one probe.
    """
    if not values:
        return miss
    by_value = defaultdict(list)
    for word, value in values.items():
        by_value[float(value)].append(word)
    found = None
    for value, members in by_value.items():
        hit = token.isin(members)
        found = F.when(hit, F.lit(value)) if found is None else found.when(hit, F.lit(value))
    return F.when(token.isin(list(values)), found).otherwise(miss)


def literal_valence(lexicon: Mapping[str, float]) -> Callable[[Column], Column]:
    """Valence of a lower-case token from a lexicon held in the plan; null if unlisted."""
    return lambda token: _pick(token, lexicon, F.lit(None).cast("double"))


# Fixed value: punctuation runs split off a word, at its start or its end.
_PUNCTUATION = r"(?:\.|,|;|:|-|'|\"|!\?!\?|\?!\?!|\?!\?|!\?!|!!!|!!|!|\?\?\?|\?\?|\?)"
_PLAIN_WORD = r"([^!-/:-@\[-`{-~]{2,})"


def sentiment_words(text: Column) -> Column:
    """Words longer than one character, without one run of punctuation at one end."""
    kept = F.filter(split_words(text), lambda w: F.length(w) > 1)
    return F.transform(
        kept,
        lambda w: F.when(w.rlike("^[a-zA-Z]+$"), w).otherwise(
            F.regexp_replace(
                F.regexp_replace(w, f"^{_PUNCTUATION}{_PLAIN_WORD}$", "$1"),
                f"^{_PLAIN_WORD}{_PUNCTUATION}$",
                "$1",
            )
        ),
    )


def _shouted(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _word_score(
    w: Column, low: Column, valences: Column, at: Column, mixed: Column, rules: Rules
) -> Column:
    """Valence of the word at a position, changed by the words around it."""
    def word(offset: int) -> Column:
        return F.get(w, at + offset)

    def lower(offset: int) -> Column:
        return F.get(low, at + offset)

    def phrase(*offsets: int) -> Column:
        return F.concat_ws(" ", *[word(o) for o in offsets])

    def negates(offset: int) -> Column:
        return lower(offset).isin(list(rules.negations)) | F.contains(lower(offset), F.lit("n't"))

    def unlisted(offset: int) -> Column:
        return F.isnull(F.get(valences, at + offset))

    def boosted(valence: Column, offset: int, fade: float) -> Column:
        def apply(scalar: Column) -> Column:
            signed = F.when(valence < 0, -scalar).otherwise(scalar)
            shout = F.when(
                _shouted(word(offset)) & mixed,
                F.when(valence > 0, F.lit(CAPITALS)).otherwise(F.lit(-CAPITALS)),
            ).otherwise(F.lit(0.0))
            total = signed + shout
            return valence + total * fade

        return F.when(lower(offset).isin(list(rules.boosters)),
                      bind(_pick(lower(offset), rules.boosters, F.lit(0.0)), apply)
                      ).otherwise(valence)

    so_or_this = ["so", "this"]

    def first_before(v: Column) -> Column:
        return bind(
            boosted(v, -1, 1.0),
            lambda b: F.when(negates(-1), b * NEGATED).otherwise(b),
        )

    def second_before(v: Column) -> Column:
        return bind(
            boosted(v, -2, DISTANCE_2),
            lambda b: F.when((word(-2) == "never") & word(-1).isin(so_or_this), b * NEVER_SO_2)
            .when(negates(-2), b * NEGATED)
            .otherwise(b),
        )

    def third_before(v: Column) -> Column:
        negated = bind(
            boosted(v, -3, DISTANCE_3),
            lambda b: F.when(
                ((word(-3) == "never") & word(-2).isin(so_or_this)) | word(-1).isin(so_or_this),
                b * NEVER_SO_3,
            )
            .when(negates(-3), b * NEGATED)
            .otherwise(b),
        )
        return bind(negated, idiomatic)

    def idiomatic(v: Column) -> Column:
        idioms = dict(rules.idioms)
        if idioms:
            before = F.coalesce(
                *[
                    _pick(phrase(*o), idioms, F.lit(None).cast("double"))
                    for o in [(-1, 0), (-2, -1, 0), (-2, -1), (-3, -2, -1), (-3, -2)]
                ]
            )
            v = F.coalesce(before, v)
            last = F.size(w) - 1
            v = F.when(last > at, _pick(phrase(0, 1), idioms, v)).otherwise(v)
            v = F.when(last > at + 1, _pick(phrase(0, 1, 2), idioms, v)).otherwise(v)
        pair = list(rules.boosters)
        dampened = phrase(-3, -2).isin(pair) | phrase(-2, -1).isin(pair)
        return v - F.when(dampened, F.lit(BOOST)).otherwise(F.lit(0.0))

    def least(v: Column) -> Column:
        hit = (lower(-1) == rules.least) & unlisted(-1)
        spared = (at > 1) & lower(-2).isin(["at", "very"])
        return F.when(hit & ~spared, v * NEGATED).otherwise(v)

    def capitalised(v: Column) -> Column:
        loud = F.when(v > 0, v + CAPITALS).otherwise(v - CAPITALS)
        return F.when(_shouted(word(0)) & mixed, loud).otherwise(v)

    def step(effect, offset: int):
        reach = -offset
        return lambda v: F.when((at >= reach) & unlisted(offset), effect(v)).otherwise(v)

    def chain(value: Column, effects) -> Column:
        if not effects:
            return value
        return bind(value, lambda v: chain(effects[0](v), effects[1:]))

    return chain(
        F.get(valences, at),
        [
            capitalised,
            step(first_before, -1),
            step(second_before, -2),
            step(third_before, -3),
            lambda v: F.when(at > 0, least(v)).otherwise(v),
        ],
    )


def _scores_of(text: Column, w: Column, low: Column, valences: Column, rules: Rules) -> Column:
    # two adjacent characters that are no small letters: most texts lack them
    mixed = (
        text.rlike(r"[^\p{Ll}\s]{2}")
        & F.exists(w, _shouted)
        & F.exists(w, lambda t: ~_shouted(t))
    )

    def scored(mixed: Column, turn: Column) -> Column:
        def of_word(word: Column) -> Column:
            # the context looked at is that of the word's first occurrence
            return bind(
                (F.array_position(w, word) - 1).cast("int"),
                lambda at: F.when(neutral(at), F.lit(0.0)).otherwise(
                    _word_score(w, low, valences, at, mixed, rules)
                ),
            )

        def weight(i: Column) -> Column:
            return (
                F.when((turn == 0) | (i + 1 == turn), F.lit(1.0))
                .when(i + 1 < turn, F.lit(BEFORE_CONTRAST))
                .otherwise(F.lit(AFTER_CONTRAST))
            )

        def placed(at: Column, names: Column, values: Column) -> Column:
            value = lambda i: F.get(values, (F.array_position(names, F.get(w, i)) - 1).cast("int"))
            return F.filter(F.transform(at, lambda i: value(i) * weight(i)), lambda s: s != 0)

        def neutral(at: Column) -> Column:
            here = F.get(low, at)
            dampener = (here == rules.kind) & F.coalesce(F.get(low, at + 1) == "of", F.lit(False))
            return dampener | here.isin(list(rules.boosters))

        listed = F.filter(
            F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(valences, i).isNotNull()
        )
        # each distinct word is scored once, then looked up at its places
        return bind(
            listed,
            lambda at: bind(
                F.array_distinct(F.transform(at, lambda i: F.get(w, i))),
                lambda names: bind(F.transform(names, of_word), lambda values: placed(at, names, values)),
            ),
        )

    zero = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("pos"), F.lit(0.0).alias("neg"))

    def summed(sentiments: Column) -> Column:
        return F.aggregate(
            sentiments,
            zero,
            lambda a, s: F.struct(
                (a["total"] + s).alias("total"),
                (a["pos"] + F.when(s > 0, s + 1).otherwise(F.lit(0.0))).alias("pos"),
                (a["neg"] + F.when(s < 0, s - 1).otherwise(F.lit(0.0))).alias("neg"),
            ),
            lambda a: F.struct(
                a["total"], a["pos"], a["neg"], (F.size(w) - F.size(sentiments)).alias("neu")
            ),
        )

    sums = bind(
        mixed,
        lambda m: bind(
            F.array_position(low, rules.contrast),
            lambda turn: bind(scored(m, turn), summed),
        ),
    )
    marks = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    asks = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    emphasis = F.least(marks, F.lit(4)) * EXCLAMATION + F.when(asks <= 1, F.lit(0.0)).when(
        asks <= 3, asks * QUESTION
    ).otherwise(F.lit(QUESTIONS_MANY))

    def result(a: Column, e: Column) -> Column:
        total = a["total"] + F.signum(a["total"]) * e
        pos = a["pos"] + F.when(a["pos"] > -a["neg"], e).otherwise(F.lit(0.0))
        neg = -a["neg"] + F.when(a["pos"] < -a["neg"], e).otherwise(F.lit(0.0))
        everything = pos + neg + a["neu"]
        share = lambda part: F.round(F.coalesce(F.try_divide(part, everything), F.lit(0.0)), 3)
        return F.struct(
            share(neg).alias("neg"),
            share(a["neu"].cast("double")).alias("neu"),
            share(pos).alias("pos"),
            F.round(total / F.sqrt(total * total + NORMALISER), 4).alias("compound"),
        )

    return bind(sums, lambda a: bind(emphasis, lambda e: result(a, e)))


def polarity(text: Column, valence_of, rules: Rules | None = None) -> Column:
    """struct<neg, neu, pos, compound> of a text; null text gives null.

    ``valence_of`` maps a lower-case token to its valence, or null.
    """
    rules = rules or Rules()
    scored = bind(
        sentiment_words(text),
        lambda w: bind(
            F.transform(w, lambda t: F.lower(t)),
            lambda low: bind(
                F.transform(low, valence_of),
                lambda valences: _scores_of(text, w, low, valences, rules),
            ),
        ),
    )
    return F.when(text.isNotNull(), scored)
