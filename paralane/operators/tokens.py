"""Token ids: a built-in vocabulary, user tokenizers, truncation and padding in batches."""

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from paralane.functions import text as X
from paralane.operators.ranks import global_rank
from paralane.operators.scores import LABEL_PADDING
from paralane.operators.word_index import indexed_ids, write_word_index
from paralane.session import materialize

# The special ids of the built-in vocabulary.
PAD_ID, UNKNOWN_ID, EOS_ID = 0, 1, 2
FIRST_ID = 3
# Words with at least this share of all occurrences are looked up by broadcast. There can be
# no more than 10,000 of them.
HOT_SHARE = 1e-4

TOKEN_COLUMNS = ("input_ids", "attention_mask", "labels")


def tokenize_with(
    df: DataFrame,
    make_tokenizer: Callable[[], Callable[[list[str], list[str], str, str], dict]],
    keys: Sequence[str],
    max_length: int | None = None,
) -> DataFrame:
    """Token ids of both sides by a user's tokenizer, which each task makes once.

    The tokenizer gets the tagged sources and the targets of one direction and returns lists or
    arrays ``input_ids``, ``labels`` and, if it has one, ``attention_mask``. Directions are told
    apart inside the batches of a task; they do not become groups of a shuffle. Nothing is cut
    unless ``max_length`` says so.
    """
    ids = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField(name, ids) for name in TOKEN_COLUMNS])

    def cut(rows) -> list[list[int]]:
        return [list(row)[:max_length] for row in rows]

    @F.pandas_udf(schema)
    def encode(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]
    ) -> Iterator[pd.DataFrame]:
        tokenizer = make_tokenizer()
        for sources, targets, src_langs, tgt_langs in batches:
            encoded = {name: [None] * len(sources) for name in TOKEN_COLUMNS}
            for rows in sources.groupby([src_langs, tgt_langs]).indices.values():
                direction = src_langs.iloc[rows[0]], tgt_langs.iloc[rows[0]]
                out = tokenizer(sources.iloc[rows].tolist(), targets.iloc[rows].tolist(), *direction)
                inputs = cut(out["input_ids"])
                masks = out.get("attention_mask")
                if masks is None:
                    masks = [[1] * len(row) for row in inputs]
                for row, *values in zip(rows, inputs, cut(masks), cut(out["labels"])):
                    for name, value in zip(TOKEN_COLUMNS, values):
                        encoded[name][row] = value
            yield pd.DataFrame(encoded)

    tokens = encode.asNondeterministic()(
        X.tagged_input(), X.text_or_empty("tgt"), X.text_or_empty("src_lang"), X.text_or_empty("tgt_lang")
    )
    return df.select(*keys, tokens.alias("__tokens")).select(*keys, "__tokens.*")


def vocabulary(df: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    """The distinct words of some texts with their counts and dense ids.

    Ids follow the hash of a token, so they do not depend on partitions. Words are counted, before
    and after a shuffle, and written once, when this is called; the ranks are made from the counts.
    """
    texts = F.array(*[X.text_or_empty(c) for c in columns])
    tokens = df.select(F.explode(texts).alias("text")).select(F.explode(X.words("text")).alias("token"))
    counted = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    ranked = global_rank(counted, F.sha2("token", 256), "__rank")
    return ranked.select("token", "n", (F.col("__rank") + FIRST_ID).cast("int").alias("token_id"))


def _ids_by_word(table: Broadcast) -> dict[str, int]:
    """A task's dictionary of a broadcast vocabulary."""
    known = table.value
    return dict(zip(known.column("token").to_pylist(), known.column("token_id").to_pylist()))


def _bytes_of(vocab: DataFrame) -> int:
    """What a vocabulary takes when it is sent to the workers."""
    return vocab.agg(F.sum(F.octet_length("token") + 12).alias("bytes")).first()["bytes"] or 0


def _row_local(df: DataFrame, vocab: DataFrame, texts: Mapping[str, Column], room: int | None, end: list[int]) -> Column:
    """A struct of id arrays by a vocabulary that is broadcast."""
    table = df.sparkSession.sparkContext.broadcast(vocab.toArrow())
    schema = T.StructType([T.StructField(name, T.ArrayType(T.IntegerType())) for name in texts])

    @F.pandas_udf(schema)
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _ids_by_word(table)
        for batch in batches:
            yield pd.DataFrame({
                name: [[ids.get(word, UNKNOWN_ID) for word in text.split()[:room]] + end for text in batch[name]]
                for name in batch.columns
            })

    return encode.asNondeterministic()(F.struct(*[text.alias(name) for name, text in texts.items()]))


def _joined(df: DataFrame, vocab: DataFrame, texts: Mapping[str, Column], keys: Sequence[str], room: int | None, end: list[int]) -> DataFrame:
    """Id arrays by a join on words, for a vocabulary that no worker can hold.

    Rows get an id of their own and are written once, when this is called. Words with at least
    ``HOT_SHARE`` of all occurrences, which are at most its inverse, are looked up by broadcast; the
    others are shuffled by word, and all are put together again by row.
    """
    words = {name: X.words(text) if room is None else F.slice(X.words(text), 1, room) for name, text in texts.items()}
    sides = F.array(*[F.struct(F.lit(name).alias("__side"), some.alias("__words")) for name, some in words.items()])
    rows = materialize(df.select(*keys, F.uuid().alias("__row"), sides.alias("__sides")))
    placed = rows.select("__row", F.inline("__sides")).select(
        "__row", "__side", F.posexplode_outer("__words").alias("__pos", "__token")
    )
    ids = vocab.select(F.col("token").alias("__known"), "token_id")
    counted = placed.groupBy(F.col("__token").alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
    total = counted.select(F.sum("__n").alias("__n")).scalar()
    hot = counted.where(F.col("__hot").isNotNull() & (F.col("__n") >= HOT_SHARE * total))
    hot = hot.join(ids, F.col("__hot") == F.col("__known"), "left").select(
        "__hot", F.coalesce("token_id", F.lit(UNKNOWN_ID)).alias("__hot_id")
    )
    found = placed.join(F.broadcast(hot), F.col("__token") == F.col("__hot"), "left")
    # What has no cold word, because it is hot or of an empty text, is spread evenly under keys
    # that begin with a space, as no word does.
    cold = F.when(F.col("__hot").isNull(), F.col("__token"))
    spread = F.concat(F.lit(" "), F.hash("__row", "__side", "__pos").cast("string"))
    found = found.withColumn("__key", F.coalesce(cold, spread))
    found = found.join(ids, F.col("__key") == F.col("__known"), "left")
    place = F.struct(F.col("__pos").alias("pos"), F.coalesce("__hot_id", "token_id", F.lit(UNKNOWN_ID)).alias("id"))
    place = F.when(F.col("__token").isNotNull(), place)
    tail = F.lit(end).cast("array<int>")
    arrays = []
    for name in texts:
        places = F.array_sort(F.collect_list(F.when(F.col("__side") == name, place)))
        arrays.append(F.concat(F.transform(places, lambda one: one["id"]), tail).alias(name))
    return rows.drop("__sides").join(found.groupBy("__row").agg(*arrays), "__row").drop("__row")


def encode_words(
    df: DataFrame,
    vocab: DataFrame,
    columns: dict[str, Column | str],
    keys: Sequence[str],
    max_length: int | None = None,
    eos: bool = True,
    lookup: str = "broadcast",
    broadcast_bytes: int = 256 << 20,
) -> DataFrame:
    """The columns ``keys`` of each row and arrays of the ids of the words of some texts.

    ``columns`` maps the name of a new array to its text. Words missing in the vocabulary get
    the unknown id. Nothing is cut unless ``max_length`` says so; it counts the end id. Rows stay
    rows, whether or not their keys are unique.

    The vocabulary is computed and its size in bytes taken when this is called. With ``lookup='auto'`` one of at
    most ``broadcast_bytes`` is broadcast, and words are looked up inside their row, without a shuffle; a
    larger one is joined, and words are shuffled. ``lookup='broadcast'`` makes a larger one an error
    instead, and ``lookup='join'`` always joins. ``lookup='index'`` writes the vocabulary, of whatever size, as
    sorted files into the shared folder; words are looked up there inside their row, so none is shuffled and
    nothing broadcast. The rows are the same.
    """
    room = max_length if max_length is None else max_length - 1 if eos else max_length
    end = [EOS_ID] if eos else []
    texts = {name: X.text_or_empty(text) for name, text in columns.items()}
    if lookup not in ("auto", "broadcast", "join", "index"):
        raise ValueError(f"unknown lookup {lookup!r}; use 'auto', 'broadcast', 'join' or 'index'")
    if lookup == "index":
        words = {name: X.words(text) if room is None else F.slice(X.words(text), 1, room) for name, text in texts.items()}
        found = indexed_ids(write_word_index(vocab), words, UNKNOWN_ID)
        tail = F.lit(end).cast("array<int>")
        rows = df.select(*keys, found.alias("__ids"))
        return rows.select(*keys, *[F.concat(F.col("__ids")[name], tail).alias(name) for name in texts])
    if lookup != "join":
        vocab = materialize(vocab.select("token", "token_id"))
        size = _bytes_of(vocab)
        if size > broadcast_bytes and lookup == "broadcast":
            raise ValueError(
                f"the vocabulary has {size} bytes, more than the {broadcast_bytes} to be broadcast; use lookup='join'"
            )
        lookup = "join" if size > broadcast_bytes else "broadcast"
    if lookup == "join":
        return _joined(df, vocab, texts, keys, room, end)
    found = _row_local(df, vocab, texts, room, end)
    return df.select(*keys, found.alias("__ids")).select(*keys, "__ids.*")


def tokenize_words(
    df: DataFrame,
    vocab: DataFrame,
    keys: Sequence[str],
    max_length: int | None = None,
    tagged: bool = True,
    **options,
) -> DataFrame:
    """The token table of a pair table by the built-in vocabulary."""
    source = X.tagged_input() if tagged else F.col("src")
    encoded = encode_words(df, vocab, {"input_ids": source, "labels": F.col("tgt")}, keys, max_length, **options)
    mask = F.array_repeat(F.lit(1), F.size("input_ids"))
    return encoded.select(*keys, "input_ids", mask.alias("attention_mask"), "labels")


def truncate_ids(ids: Column | str, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def shift_right(labels: Column | str, start_id: int, pad_id: int, label_padding: int = LABEL_PADDING) -> Column:
    """Decoder inputs: the start id, then the labels but the last, unmasked."""
    unmasked = F.transform(
        labels, lambda token: F.when(token == label_padding, F.lit(pad_id)).otherwise(token)
    )
    shown = F.when(F.array_contains(labels, F.lit(label_padding)), unmasked).otherwise(
        F.col(labels) if isinstance(labels, str) else labels
    )
    start = F.array(F.lit(start_id).cast("int"))
    return F.when(F.size(shown) > 0, F.concat(start, F.slice(shown, 1, F.size(shown) - 1))).otherwise(shown)


def padded_batches(
    tokens: DataFrame,
    rank: Column | str = "rank",
    batch_size: int = 32,
    pad_id: int = PAD_ID,
    start_id: int = EOS_ID,
    multiple: int = 8,
    label_padding: int = LABEL_PADDING,
) -> DataFrame:
    """Pad consecutive rows to the length of the longest in their batch, rounded up.

    Inputs and labels are padded separately. ``rank`` numbers the rows from 0; a batch is the
    largest group that is formed, so the shuffle by batch has no hot group.
    """
    position = F.col(rank) if isinstance(rank, str) else rank
    batch = Window.partitionBy("batch_id")

    def goal(name: str) -> Column:
        longest = F.max(F.size(name)).over(batch)
        return (F.ceil(longest / multiple) * multiple).cast("int")

    def pad(name: str, length: str, value: int) -> Column:
        return F.concat(F.col(name), F.array_repeat(F.lit(value).cast("int"), F.col(length) - F.size(name)))

    numbered = tokens.withColumn("batch_id", F.floor(position / batch_size).cast("bigint"))
    sized = numbered.withColumns({"__inputs": goal("input_ids"), "__labels": goal("labels")})
    columns = {
        "input_ids": pad("input_ids", "__inputs", pad_id),
        "attention_mask": pad("attention_mask", "__inputs", 0),
        "labels": pad("labels", "__labels", label_padding),
    }
    if "decoder_input_ids" not in tokens.columns:
        # Padded with what the mask would be replaced by, so nothing is to be unmasked one by one.
        sized = sized.withColumn("__shown", pad("labels", "__labels", pad_id))
        columns["decoder_input_ids"] = shift_right("__shown", start_id, pad_id, label_padding)
    return sized.withColumns(columns).drop("__inputs", "__labels", "__shown")
