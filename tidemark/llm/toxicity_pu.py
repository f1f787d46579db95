"""Toxicity: non-negative positive-unlabelled learning from confirmed toxic texts and unlabelled ones.

Features are the words of a text and the beginnings of its longer words. Labels of 0
are not used; the class prior is estimated from the two samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pu_text import below, fit, fold, score
from tidemark.llm.text_features import remembered, vocabulary, word_features

THRESHOLD = 0.7
DECAY = 3e-5


def held_out(id_col: str) -> Column:
    return fold(id_col, 3) == 1


def features():
    of_word = remembered(word_features)
    return lambda text: vocabulary(text, of_word)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    **settings,
) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``.

    A null or empty text has the score of a text without words; a null id is not held out
    and its label is not learned. Repeated rows each get the same score. Ids only say which
    labels may be learned; other columns are not looked at. An empty table gives no rows,
    and without any toxic label every score is 0.5.
    """
    model = fit(docs, labels, "toxic", features, held_out, id_col, text_col, **{"decay": DECAY, **settings})
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return score(rows, model, features).select(
        F.col("doc.id").alias(id_col),
        held_out("doc.id").alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    **settings,
) -> DataFrame:
    """The rows of ``docs`` scored below the threshold, each judged by its own text, whatever its id.

    Rows are dropped where they are scored: nothing is shuffled or joined. Columns may bear any name.
    """
    model = fit(docs, labels, "toxic", features, held_out, id_col, text_col, **{"decay": DECAY, **settings})
    return below(docs, model, features, threshold, text_col)
