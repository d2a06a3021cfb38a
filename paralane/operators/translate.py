"""Predictions of a user's translator for a whole table."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from paralane.functions import text as X

Translate = Callable[[list[str], str, str], list[str]]


def translate_table(
    df: DataFrame,
    make_translator: Callable[[], Translate],
    batch_size: int = 32,
    text: str = "src",
    output: str = "prediction",
    repair_question_marks: bool = True,
    preprocess: Translate | None = None,
    postprocess: Translate | None = None,
) -> DataFrame:
    """Add ``output``. Each task makes its translator once and feeds it batches of one direction.

    The parallelism is that of the table's partitions; there is no shuffle. Only the text and
    its languages go to Python. ``preprocess`` and ``postprocess`` are a user's steps around the
    translator and have its signature.
    """

    def answers_to(texts: list[str], src_lang, tgt_lang, translate: Translate) -> list[str]:
        if preprocess:
            texts = preprocess(texts, src_lang, tgt_lang)
        done: list[str] = []
        for begin in range(0, len(texts), batch_size):
            out = translate(texts[begin:begin + batch_size], src_lang, tgt_lang)
            if repair_question_marks:
                out = [answer.replace("\u061f", "?") for answer in out]
            done.extend(postprocess(out, src_lang, tgt_lang) if postprocess else out)
        return done

    @F.pandas_udf("string")
    def predict(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        translate = make_translator()
        for texts, src_langs, tgt_langs in batches:
            answers = pd.Series([None] * len(texts), dtype=object)
            for rows in texts.groupby([src_langs, tgt_langs], dropna=False).indices.values():
                direction = src_langs.iloc[rows[0]], tgt_langs.iloc[rows[0]]
                answers.iloc[rows] = answers_to(texts.iloc[rows].tolist(), *direction, translate)
            yield answers

    # Marked as not deterministic, so that a filter on the output does not run the model again.
    predicted = predict.asNondeterministic()(X.text_or_empty(text), "src_lang", "tgt_lang")
    return df.withColumn(output, predicted)


def repair_predictions(df: DataFrame, column: str = "prediction") -> DataFrame:
    return df.withColumn(column, X.repair_question_mark(column))
