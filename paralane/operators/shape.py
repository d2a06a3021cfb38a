"""Bring tables into the shape of the pair table, and summarize it."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paralane.registry import DEFAULT_DOMAIN, DIRECTIONS, PAIR_COLUMNS


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the configured columns that are present; all others pass through."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def require_columns(df: DataFrame, required: Sequence[str] = PAIR_COLUMNS) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; available: {sorted(df.columns)}")
    return df


def with_default_domain(df: DataFrame, domain: str = DEFAULT_DOMAIN) -> DataFrame:
    return df if "domain" in df.columns else df.withColumn("domain", F.lit(domain))


def to_pairs(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    return with_default_domain(require_columns(map_columns(df, mapping or {})))


def fan_out(
    lines: DataFrame, directions: Sequence[tuple[str, str]] = DIRECTIONS, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per direction of each line; ``lines`` has a text column per language code.

    ``direction_no`` keeps the order of the directions within a line.
    """
    made = F.array(
        *[
            F.struct(
                F.col(src).alias("src"), F.col(tgt).alias("tgt"),
                F.lit(src).alias("src_lang"), F.lit(tgt).alias("tgt_lang"),
                F.lit(number).alias("direction_no"),
            )
            for number, (src, tgt) in enumerate(directions)
        ]
    )
    return lines.select(*keep, F.inline(made))


def ingestion_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, source languages and domains; at least one domain."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    domains = distinct("domain") if "domain" in df.columns else F.lit(1).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct("src_lang").alias("src_langs"),
        F.greatest(domains, F.lit(1)).alias("domains"),
    )


def split_statistics(df: DataFrame, split: str = "split") -> DataFrame:
    """One row: the size of each split, and the directions and domains, in order.

    Both are lists in one row, so they must be few: a domain is a subject or a source, of which
    there are thousands at most. For a column such as a web host, group by it instead.
    """
    direction: Column = F.concat(F.col("src_lang"), F.lit(" -> "), F.col("tgt_lang"))
    domains = (
        F.array_sort(F.collect_set("domain")) if "domain" in df.columns
        else F.array().cast("array<string>")
    )
    return df.agg(
        *[F.count_if(F.col(split) == name).alias(name) for name in ("train", "val", "test")],
        F.array_sort(F.collect_set(direction)).alias("directions"),
        domains.alias("domains"),
    )
