"""Quality: positive-unlabelled learning from trusted texts, unlabelled web text and a class prior.

The non-negative unbiased risk is minimised over features of a text's appearance: shapes
of its tokens and their shares, repetition, line and word lengths, signs. Labels of 0 are
not used; the class prior is estimated from the two samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pu_text import fit, fold, score
from tidemark.llm.text_features import appearance, remembered, shape

THRESHOLD = 0.3
STEPS = 800


def held_out(id_col: str) -> Column:
    return fold(id_col, 5) == 0


def features():
    of_token = remembered(shape)
    return lambda text: appearance(text, of_token)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    **settings,
) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``.

    A null or empty text has the score of a text without tokens; a null id is not held out
    and its label is not learned. Repeated rows each get the same score. Ids only say which
    labels may be learned; other columns are not looked at. An empty table gives no rows,
    and without any trusted text every score is 0.5.
    """
    model = fit(docs, labels, "quality", features, held_out, id_col, text_col, **{"steps": STEPS, **settings})
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return score(rows, model, features).select(
        F.col("doc.id").alias(id_col),
        held_out("doc.id").alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
