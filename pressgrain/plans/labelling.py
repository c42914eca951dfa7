"""Two sentiment scorers, their agreement, the editorial stance."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame

from pressgrain.functions.lexicon import Rules
from pressgrain.functions.wordlists import EDITORIAL_STANCES
from pressgrain.operators.columns import consolidate_columns
from pressgrain.operators.inference import Predictor, score_model
from pressgrain.operators.matching import map_stance, stance_table
from pressgrain.operators.rows import drop_repeated_rows, keep_agreeing, with_row_id
from pressgrain.operators.sentiment import score_lexicon
from pressgrain.sources.stored import stored

LEXICON_LABEL = "overall_emotion_vader"
MODEL_LABEL = "sentiment_category_bert"


def score_articles(
    corpus: DataFrame,
    lexicon: DataFrame | Mapping[str, float],
    predictor: Callable[[], Predictor],
    *,
    text_column: str = "content",
    rules: Rules | None = None,
) -> DataFrame:
    """Row id and the columns of both scorers.

    Cleaning can make rows equal that were not, so repeated rows are dropped again:
    then each id is one row's.
    """
    identified = with_row_id(drop_repeated_rows(corpus))
    by_lexicon = score_lexicon(identified, text_column, lexicon, rules)
    return score_model(by_lexicon, text_column, predictor)


def label_articles(
    corpus: DataFrame,
    lexicon: DataFrame | Mapping[str, float],
    predictor: Callable[[], Predictor],
    *,
    stances: Mapping[str, str] = EDITORIAL_STANCES,
    stop_words: Iterable[str] | None = None,
    rules: Rules | None = None,
) -> DataFrame:
    """Articles on which both scorers agree, with the publisher's stance.

    Runs jobs: the scored articles are stored, so that the steps after them do
    not run the model again.
    """
    scored = stored(score_articles(corpus, lexicon, predictor, rules=rules))
    agreeing = keep_agreeing(consolidate_columns(scored), LEXICON_LABEL, MODEL_LABEL)
    return map_stance(
        agreeing, stance_table(corpus.sparkSession, stances), stop_words=stop_words
    )
