"""Exact sampling, splitting and ranking in a seeded random order, without a global sort.

Every row has a place in the order: the SHA-256 of the seed and its row key. Row keys must be
unique; nulls and any characters may be in them. Rows of equal keys that a cut would part are an
error, so a sample or split never has another size than asked. The hex digits that a hash begins with are its bucket, so buckets
are of even size whatever the keys are.

To cut the order at rank k, a histogram of the buckets finds the one bucket that holds the
rank, and only that bucket's hashes are numbered. Rows are then labelled by comparing their
hash with the cut: the table itself is neither sorted nor shuffled.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paralane.session import materialize

HASH = "__hash"
BUCKET = "__bucket"


def encoded(values: Sequence[Column | str]) -> list[Column]:
    """Values as text that reads the same only for equal values: lengths go first, null is a mark."""
    parts = []
    for value in values:
        value = (F.col(value) if isinstance(value, str) else value).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return parts


def shuffle_hash(keys: Sequence[Column | str], seed: int = 42) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *encoded(keys)), 256)


def histogram(hashed: DataFrame, strata: Sequence[str], digits: int) -> DataFrame:
    """Rows per bucket, with the number of rows before it and in all.

    At most 16 ** digits rows per stratum reach the window, whatever the table's size.
    """
    sizes = (
        hashed.groupBy(*strata, F.substring(HASH, 1, digits).alias(BUCKET))
        .agg(F.count(F.lit(1)).alias("__size"))
    )
    whole = Window.partitionBy(*strata)
    before = whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumns(
        {
            "__before": F.coalesce(F.sum("__size").over(before), F.lit(0)),
            "__rows": F.sum("__size").over(whole),
        }
    )


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, where a null equals a null."""
    names = {name: f"__right_{name}" for name in on}
    condition = F.lit(True)
    for name, other in names.items():
        condition = condition & F.col(name).eqNullSafe(F.col(other))
    return left.join(right.withColumnsRenamed(names), condition, how).drop(*names.values())


def _cuts(
    hashed: DataFrame, bounds: Mapping[str, Column], strata: Sequence[str], digits: int, ends: DataFrame | None = None
) -> DataFrame:
    """The hash at each bound's rank: one row per stratum, one column per bound.

    A bound is a Column over ``__rows``, or over the columns of ``ends``, which has a row per stratum. Its
    cut is null where the rank is past the last row.
    """
    strata = list(strata)
    wanted = F.array(
        *[F.struct(F.lit(name).alias("__name"), rank.cast("bigint").alias("__rank"))
          for name, rank in bounds.items()]
    )
    inside = (F.col("__rank") >= F.col("__before")) & (
        F.col("__rank") < F.col("__before") + F.col("__size")
    )
    buckets = histogram(hashed, strata, digits)
    targets = (
        (buckets if ends is None else _join(buckets, ends, strata))
        .select("*", F.inline(wanted))
        .where(inside)
        .groupBy(*strata, BUCKET)
        .agg(F.collect_list(F.struct("__name", (F.col("__rank") - F.col("__before")).alias("__nth")))
             .alias("__targets"))
    )
    keyed = hashed.select(*strata, HASH, F.substring(HASH, 1, digits).alias(BUCKET))
    # Without strata there is at most one row per bound. With them, the table's size on disk tells
    # Spark whether to broadcast it.
    targets = materialize(targets) if strata else F.broadcast(targets)
    near = _join(keyed, targets, [*strata, BUCKET])
    order = Window.partitionBy(*strata, BUCKET).orderBy(HASH)
    numbered = near.withColumns(
        {"__nth": F.row_number().over(order) - 1, "__same": F.lag(HASH).over(order) == F.col(HASH)}
    )
    hits = numbered.select(
        *strata, HASH, "__same", F.col("__nth").alias("__found"), F.inline("__targets")
    ).where(F.col("__found") == F.col("__nth"))
    unique = F.when(F.col("__same"), F.raise_error(F.lit("rows on both sides of a cut have the same key")))
    place = F.coalesce(unique.cast("string"), F.col(HASH))
    return hits.groupBy(*strata).agg(
        *[F.max(F.when(F.col("__name") == name, place)).alias(name) for name in bounds]
    )


def exact_sample(
    df: DataFrame,
    size: int | None,
    keys: Sequence[Column | str],
    seed: int = 42,
    order_column: str | None = None,
    digits: int = 4,
) -> DataFrame:
    """Exactly ``size`` rows without replacement, or all rows if there are no more.

    ``order_column`` adds the place of a row in the sample's random order.
    """
    place = shuffle_hash(keys, seed)
    if not size:
        return df.withColumn(order_column, place) if order_column else df
    cut = _cuts(df.select(place.alias(HASH)), {"cut": F.lit(size)}, [], digits)
    limit = cut.select("cut").scalar()
    sample = df.withColumn(HASH, place).where(F.col("__hash") < F.coalesce(limit, F.lit("g")))
    return sample.withColumnRenamed(HASH, order_column) if order_column else sample.drop(HASH)


def _split_bounds(train: float, val: float) -> dict[str, Column]:
    rows = F.col("__rows")
    return {"train_end": F.floor(F.lit(train) * rows), "val_end": F.floor(F.lit(train + val) * rows)}


def _split_label(train_end: Column, val_end: Column) -> Column:
    # A missing cut lies past every hash; "g" sorts after all hex digits.
    return (
        F.when(F.col(HASH) < F.coalesce(train_end, F.lit("g")), "train")
        .when(F.col(HASH) < F.coalesce(val_end, F.lit("g")), "val")
        .otherwise("test")
    )


def exact_split(
    df: DataFrame,
    keys: Sequence[Column | str],
    train: float = 0.90,
    val: float = 0.05,
    seed: int = 42,
    digits: int = 4,
) -> DataFrame:
    """Add ``split``: floor(train * n) rows, up to floor((train + val) * n), and the rest.

    ``df`` is read three times, so materialize it first if it is costly to compute.
    """
    hashed = df.withColumn(HASH, shuffle_hash(keys, seed))
    cuts = _cuts(hashed.select(HASH), _split_bounds(train, val), [], digits)
    label = _split_label(cuts.select("train_end").scalar(), cuts.select("val_end").scalar())
    return hashed.withColumn("split", label).drop(HASH)


def stratified_split(
    df: DataFrame,
    keys: Sequence[Column | str],
    strata: Sequence[str] = ("src_lang", "tgt_lang", "domain"),
    train: float = 0.90,
    val: float = 0.05,
    seed: int = 42,
    digits: int = 4,
) -> DataFrame:
    """``exact_split`` within each stratum.

    The cuts, a row per stratum, are computed and written when this is called. Spark broadcasts them
    if their files are small. Otherwise rows are shuffled by stratum, and adaptive execution splits
    the partitions of hot strata, which a left join with one row per stratum allows.
    """
    strata = list(strata)
    hashed = df.withColumn(HASH, shuffle_hash(keys, seed))
    # Every stratum has a cut unless all its rows are before all bounds, which needs train = 1.
    cuts = materialize(_cuts(hashed.select(*strata, HASH), _split_bounds(train, val), strata, digits))
    label = _split_label(F.col("train_end"), F.col("val_end"))
    return _join(hashed, cuts, strata, "left").select(*df.columns, label.alias("split"))


def grouped_split(
    df: DataFrame,
    group: Sequence[Column | str],
    train: float = 0.90,
    val: float = 0.05,
    seed: int = 42,
    digits: int = 4,
) -> DataFrame:
    """Add ``split`` so that all rows of a group, such as the directions of one sentence, have the same.

    Groups are ordered by the hash of their key; null keys are keys like others. A group belongs to the
    split in which its first row would fall, so the first split has at least floor(train * n) rows, and
    fewer than that and the rows of one group more, if it is not empty; so have the first two together.

    A histogram of the rows by bucket of the hash finds the bucket that holds a bound; only there are
    groups told apart and counted. Counts are made before a shuffle, so a group may have any share of the
    rows; rows are labelled by their hash, without a shuffle. ``df`` is read three times.
    """
    hashed = df.withColumn(HASH, shuffle_hash(group, seed))
    last = _last_groups(hashed.select(HASH), _split_bounds(train, val), digits)
    place = F.col(HASH)
    label = (
        F.when(place <= F.coalesce(last.select("train_end").scalar(), F.lit("")), "train")
        .when(place <= F.coalesce(last.select("val_end").scalar(), F.lit("")), "val")
        .otherwise("test")
    )
    return hashed.withColumn("split", label).drop(HASH)


def _last_groups(hashed: DataFrame, bounds: Mapping[str, Column], digits: int) -> DataFrame:
    """One row: for each bound, the hash of the last group with fewer rows before it than the bound."""
    wanted = F.array(
        *[F.struct(F.lit(name).alias("__name"), rank.cast("bigint").alias("__rank")) for name, rank in bounds.items()]
    )
    holds = (F.col("__before") < F.col("__rank")) & (F.col("__rank") <= F.col("__before") + F.col("__size"))
    targets = histogram(hashed, [], digits).select("*", F.inline(wanted)).where(holds)
    targets = targets.select(BUCKET, "__name", (F.col("__rank") - F.col("__before")).alias("__inside"))
    near = hashed.withColumn(BUCKET, F.substring(HASH, 1, digits)).join(F.broadcast(targets), BUCKET)
    sizes = near.groupBy("__name", "__inside", HASH).agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.partitionBy("__name").orderBy(HASH).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
    reached = sizes.where(F.col("__before") < F.col("__inside"))
    return reached.agg(*[F.max(F.when(F.col("__name") == name, F.col(HASH))).alias(name) for name in bounds])


def proportional_split(
    df: DataFrame,
    keys: Sequence[Column | str],
    strata: Sequence[str] = ("src_lang", "tgt_lang", "domain"),
    train: float = 0.90,
    val: float = 0.05,
    seed: int = 42,
    digits: int = 4,
) -> DataFrame:
    """``exact_split`` whose splits are also in proportion within strata, however small these are.

    The whole has the sizes of ``exact_split``. Strata stand one after the other, in the order of their
    keys' hash, and each gets what the running totals owe it: its part of train differs from its share by
    less than one row, its part of val by less than two. So strata too small for a validation row of
    their own take turns. Rows of a stratum follow their hash.

    Strata are never collected: their running totals are made by bucket of the hash. They and the cuts, a row
    per stratum each, are computed and written when this is called, as in ``stratified_split``.
    """
    strata = list(strata)
    hashed = df.withColumn(HASH, shuffle_hash(keys, seed))
    ends = materialize(_apportioned(df, strata, train, val, seed, digits))
    bounds = {"train_end": F.col("__train"), "val_end": F.col("__train") + F.col("__val")}
    cuts = materialize(_cuts(hashed.select(*strata, HASH), bounds, strata, digits, ends))
    label = _split_label(F.col("train_end"), F.col("val_end"))
    return _join(hashed, cuts, strata, "left").select(*df.columns, label.alias("split"))


def _apportioned(df: DataFrame, strata: Sequence[str], train: float, val: float, seed: int, digits: int) -> DataFrame:
    """Rows of train and val for each stratum: what is due up to its end, less what was due before it."""
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n")).withColumn(HASH, shuffle_hash(strata, seed))
    sizes = materialize(sizes.withColumn(BUCKET, F.substring(HASH, 1, digits)))
    whole = Window.partitionBy()
    totals = sizes.groupBy(BUCKET).agg(F.sum("__n").alias("__size"))  # at most 16 ** digits rows
    totals = totals.withColumns({
        "__before": F.coalesce(F.sum("__size").over(whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "__rows": F.sum("__size").over(whole),
    }).withColumns(_split_bounds(train, val))
    upto = Window.partitionBy(BUCKET).orderBy(HASH)
    placed = sizes.join(F.broadcast(totals), BUCKET).withColumn("__end", F.col("__before") + F.sum("__n").over(upto))
    placed = placed.withColumns({"__begin": F.col("__end") - F.col("__n"), "__rest": F.col("__rows") - F.col("train_end")})

    def due(count: str, share: Column, of: str) -> Column:
        """floor(count * share / of), in decimals that hold the product."""
        exact = F.col(count).cast("decimal(19,0)") * share.cast("decimal(19,0)")
        return F.when(F.col(of) == 0, F.lit(0)).otherwise(F.floor((exact - exact % F.col(of)) / F.col(of))).cast("bigint")

    for edge in ("begin", "end"):
        placed = placed.withColumn(f"__train_{edge}", due(f"__{edge}", F.col("train_end"), "__rows"))
        placed = placed.withColumn(f"__other_{edge}", F.col(f"__{edge}") - F.col(f"__train_{edge}"))
        placed = placed.withColumn(f"__val_{edge}", due(f"__other_{edge}", F.col("val_end") - F.col("train_end"), "__rest"))
    return placed.select(
        *strata, (F.col("__train_end") - F.col("__train_begin")).alias("__train"), (F.col("__val_end") - F.col("__val_begin")).alias("__val")
    )


def global_rank(
    df: DataFrame, place: Column, rank_column: str = "rank", digits: int = 4
) -> DataFrame:
    """Add each row's position, from 0, in the order of a hex hash that is unique per row.

    One shuffle of the rows by bucket. The offsets that are broadcast have at most
    16 ** digits rows: 65,536 by default, some 2 MB.
    """
    hashed = df.withColumns({HASH: place, BUCKET: F.substring(place, 1, digits)})
    offsets = histogram(hashed.select(HASH), [], digits).select(BUCKET, "__before")
    order = Window.partitionBy(BUCKET).orderBy(HASH)
    position = F.col("__before") + F.row_number().over(order) - 1
    return (
        hashed.join(F.broadcast(offsets), BUCKET)
        .withColumn(rank_column, position)
        .select(*df.columns, rank_column)
    )
