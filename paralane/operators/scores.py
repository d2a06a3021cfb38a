"""Corpus BLEU and chrF++ of predictions, per direction, per domain or over a whole table."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paralane.functions import overlap as O, text as X
from paralane.registry import DISPLAY_NAMES

LABEL_PADDING = -100


def _added_up(struct: str, fields: Sequence[str]) -> Column:
    return F.struct(*[F.sum(f"{struct}.{name}").alias(name) for name in fields]).alias(struct)


def with_row_sums(
    df: DataFrame,
    prediction: str = "prediction",
    reference: str = "tgt",
    word_order: int = 2,
    bleu: bool = True,
    chrf: bool = True,
) -> DataFrame:
    """Add the additive parts of the two scores to each row."""
    fields = {}
    if bleu:
        fields["bleu_sums"] = O.bleu_fields()
    if chrf:
        fields["chrf_sums"] = O.chrf_fields(word_order)
    if not fields:
        return df
    summed = df.withColumn("_row_sums", O.row_sums(prediction, reference, word_order, bleu, chrf))
    structs = {name: F.struct(*[f"_row_sums.{field}" for field in some]) for name, some in fields.items()}
    return summed.withColumns(structs).drop("_row_sums")


def _sums(df: DataFrame, word_order: int) -> list[Column]:
    fields = {"bleu_sums": O.bleu_fields(), "chrf_sums": O.chrf_fields(word_order)}
    return [_added_up(name, some) for name, some in fields.items() if name in df.columns]


def sum_groups(rows: DataFrame, by: Sequence[str] = (), word_order: int = 2) -> DataFrame:
    """The additive parts of each group of rows that carry row sums.

    Row sums are added up before the shuffle, so a direction with most of the rows is no hot
    group: each map task sends one row per group.
    """
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_samples"), *_sums(rows, word_order))


def merge_groups(summed: DataFrame, by: Sequence[str] = (), word_order: int = 2, totals: str | None = None) -> DataFrame:
    """The parts of coarser groups, from those of finer ones: a few rows, not the table.

    ``totals`` names a column of ``by`` over which totals are added. They have null there, and
    ``is_total`` tells them from the rows of a null value.
    """
    parts = [F.sum("n_samples").alias("n_samples"), *_sums(summed, word_order)]
    if totals is None:
        return summed.groupBy(*by).agg(*parts)
    rest = [F.col(name) for name in by if name != totals]
    sets = [[*rest, F.col(totals)], rest]
    return summed.groupingSets(sets, *by).agg((F.grouping(totals) == 1).alias("is_total"), *parts)


def scores_of(summed: DataFrame, by: Sequence[str] = (), word_order: int = 2) -> DataFrame:
    """The scores of groups from their additive parts; unrounded."""
    wanted = {
        "bleu_sums": ("bleu", O.bleu_score),
        "chrf_sums": ("chrf_pp", lambda sums: O.chrf_score(sums, word_order)),
    }
    scores = [score(name).alias(out) for name, (out, score) in wanted.items() if name in summed.columns]
    return summed.select(*by, "n_samples", *scores)


def score_groups(rows: DataFrame, by: Sequence[str] = (), word_order: int = 2) -> DataFrame:
    """Scores of each group of rows that carry row sums; unrounded."""
    return scores_of(sum_groups(rows, by, word_order), by, word_order)


def corpus_bleu(
    df: DataFrame, by: Sequence[str] = (), prediction: str = "prediction", reference: str = "tgt"
) -> DataFrame:
    scored = score_groups(with_row_sums(df, prediction, reference, chrf=False), by)
    return scored.withColumn("bleu", F.round("bleu", 2))


def corpus_chrf(
    df: DataFrame,
    by: Sequence[str] = (),
    prediction: str = "prediction",
    reference: str = "tgt",
    word_order: int = 2,
) -> DataFrame:
    rows = with_row_sums(df, prediction, reference, word_order, bleu=False)
    return score_groups(rows, by, word_order).withColumn("chrf_pp", F.round("chrf_pp", 2))


def with_directions(df: DataFrame) -> DataFrame:
    """Only rows whose direction is known; groups of null keys do not exist."""
    return df.where(F.col("src_lang").isNotNull() & F.col("tgt_lang").isNotNull())


def evaluate_directions(
    df: DataFrame,
    names: Mapping[str, str] = DISPLAY_NAMES,
    prediction: str = "prediction",
    by_domain: bool = False,
) -> DataFrame:
    """One row per direction: its label, rows, BLEU and chrF++.

    ``by_domain`` adds a row per domain, and ``is_total``: a direction's total has a null domain,
    as have its rows without a domain.
    """
    by = ["src_lang", "tgt_lang", *(["domain"] if by_domain else [])]
    return evaluate_sums(sum_groups(with_row_sums(with_directions(df), prediction), by), names, by_domain)


def evaluate_sums(summed: DataFrame, names: Mapping[str, str] = DISPLAY_NAMES, by_domain: bool = False) -> DataFrame:
    """``evaluate_directions`` from the additive parts of any finer groups."""
    known, by = with_directions(summed), ["src_lang", "tgt_lang"]
    if by_domain:
        by = [*by, "domain", "is_total"]
        scored = scores_of(merge_groups(known, by[:3], totals="domain"), by)
    else:
        scored = scores_of(merge_groups(known, by), by).withColumn("domain", F.lit(None).cast("string"))
    return scored.select(
        X.display_direction(names).alias("direction"),
        "n_samples",
        F.round("bleu", 2).alias("bleu"),
        F.round("chrf_pp", 2).alias("chrf_pp"),
        "domain",
        *by[3:],
    )


def unmask_labels(labels: Column | str, pad_id: int, label_padding: int = LABEL_PADDING) -> Column:
    """Put the pad id back where labels are masked."""
    return F.transform(
        labels, lambda token: F.when(token == label_padding, F.lit(pad_id)).otherwise(token)
    )


def compute_metrics(
    df: DataFrame,
    decode: Callable[[Column], Column],
    pad_id: int,
    predictions: str = "predictions",
    labels: str = "labels",
) -> DataFrame:
    """BLEU and chrF++ of token ids over a whole table.

    ``decode`` makes a text Column of an ids Column: an expression, or an Arrow function
    around a tokenizer.
    """
    texts = df.select(
        X.strip(decode(unmask_labels(predictions, pad_id))).alias("prediction"),
        X.strip(decode(unmask_labels(labels, pad_id))).alias("tgt"),
    )
    scored = score_groups(with_row_sums(texts))
    return scored.select(F.round("bleu", 2).alias("bleu"), F.round("chrf_pp", 2).alias("chrf++"))


def make_compute_metrics(decode: Callable[[Column], Column], pad_id: int):
    return lambda df, **columns: compute_metrics(df, decode, pad_id, **columns)
