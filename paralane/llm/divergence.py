"""Source divergence audit: term prefixes refined level by level, then exact scores of sources."""

from collections.abc import Iterator
from functools import partial
from itertools import compress
from operator import ne

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructType

from paralane.llm.bloom import Bloom
from paralane.llm.common import strings_as_bytes, text_or_empty
from paralane.session import materialize, new_folder, remove_folder

#: Bytes that belong to terms: ASCII letters, lower-cased, and all of other characters; others become spaces.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

#: Numbers and terms are kept as plain bytes, which cost Spark nothing per element.
_NUMBERS = {"doc_groups": np.int32, "doc_starts": np.int64, "term_ends": np.int32, "term_ids": np.int32, "term_counts": np.int32}
BLOCK_SCHEMA = StructType().add("langs", ArrayType(StringType())).add("sources", ArrayType(StringType())).add("terms", BinaryType())
for _name in _NUMBERS:
    BLOCK_SCHEMA = BLOCK_SCHEMA.add(_name, BinaryType())
LEVEL_SCHEMA = StructType().add("lang", StringType()).add("prefix", BinaryType()).add("whole", BooleanType()).add("docs", LongType())
COUNT_SCHEMA = StructType().add("lang", StringType()).add("source", StringType()).add("term", BinaryType()).add("n", LongType())

#: Sources of one side of a block of pairs, and terms of a block on average.
TILE = 64
TERMS = 4096
#: Bytes of text in a block of documents.
BLOCK_BYTES = 12 << 20
#: Documents whose texts are held as Python values at a time.
SLICE = 256


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


class Block:
    """Documents as ids of the block's sorted distinct terms, each document's ascending."""

    CHUNK = 1 << 18

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.doc_groups: list[int] = []
        self.sizes: list[int] = []
        self.words: list[bytes] = []
        self.chunks: list[pa.Array] = []
        self.bytes = 0

    def add(self, text: bytes, lang: str, source: str) -> None:
        self.doc_groups.append(self.groups.setdefault((lang, source), len(self.groups)))
        words = terms_of(text)
        self.sizes.append(len(words))
        self.words += words
        self.bytes += len(text) + 64
        if len(self.words) >= self.CHUNK:
            self.close()

    def close(self) -> None:
        self.chunks.append(pa.array(self.words, type=pa.binary()))
        self.words = []

    def row(self) -> dict:
        self.close()
        coded = pa.concat_arrays(self.chunks).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        docs, terms = len(self.sizes), max(1, len(order))
        key = np.repeat(np.arange(docs), self.sizes) * terms + rank[coded.indices.to_numpy()]
        pairs, counts = np.unique(key, return_counts=True)
        words = coded.dictionary.take(pa.array(order)).to_pylist()
        numbers = {
            "doc_groups": self.doc_groups, "doc_starts": np.searchsorted(pairs, np.arange(docs + 1) * terms),
            "term_ends": np.cumsum([0, *map(len, words)]), "term_ids": pairs % terms, "term_counts": counts,
        }
        return {
            "langs": [lang for lang, _ in self.groups], "sources": [source for _, source in self.groups], "terms": b"".join(words),
            **{name: np.asarray(values, dtype=_NUMBERS[name]).tobytes() for name, values in numbers.items()},
        }


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, block_bytes: int) -> Iterator[pa.RecordBatch]:
    def batch_of(block: Block) -> pa.RecordBatch:
        row = block.row()
        return pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in schema], schema=schema)

    block = Block()
    slices = (batch.slice(at, SLICE) for batch in batches for at in range(0, batch.num_rows, SLICE))
    for batch in slices:
        langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for text, lang, source in zip(strings_as_bytes(batch.column(0)), langs, sources):
            block.add(text, lang, source)
            if block.bytes >= block_bytes:
                yield batch_of(block)
                block = Block()
                pa.default_memory_pool().release_unused()
    if block.doc_groups:
        yield batch_of(block)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks as lists of strings, an array of terms and numpy arrays of numbers."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            ends = block.pop("term_ends")
            terms = pa.Array.from_buffers(pa.binary(), len(ends) // 4 - 1, [None, pa.py_buffer(ends), pa.py_buffer(block["terms"])])
            yield {name: np.frombuffer(value, dtype=_NUMBERS[name]) if name in _NUMBERS else value for name, value in block.items()} | {"terms": terms}


def hashes_of(lang: str, terms: list[bytes]) -> np.ndarray:
    """Spark's xxhash64 of the two columns: the hash of the first is the seed of the second."""
    seed, digest = xxhash.xxh64_intdigest(lang.encode(), 42), xxhash.xxh64_intdigest
    return np.fromiter((digest(term, seed) for term in terms), dtype=np.uint64, count=len(terms))


def _alive(terms: list[bytes], lang: str, parent: int, survivors: Broadcast | None) -> np.ndarray:
    """Which of some sorted terms are longer than ``parent`` bytes and may have a surviving prefix of that length."""
    longer = np.fromiter(map(len, terms), dtype=np.int64, count=len(terms)) > parent
    if survivors is None or not longer.any():
        return longer
    at = np.flatnonzero(longer)
    parents = [terms[i][:parent] for i in at.tolist()]
    first = np.fromiter(map(ne, parents, [None, *parents[:-1]]), dtype=bool, count=len(parents))
    held = survivors.value.holds(hashes_of(lang, list(compress(parents, first))))
    longer[at] = held[np.cumsum(first) - 1]
    return longer


def _used(ids: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and each id's place among them."""
    mark = np.zeros(terms, dtype=bool)
    mark[ids] = True
    return np.flatnonzero(mark), (np.cumsum(mark, dtype=np.int32) - 1)[ids]


def _level(batches: Iterator[pa.RecordBatch], schema: pa.Schema, parent: int, width: int, survivors: Broadcast | None) -> Iterator[pa.RecordBatch]:
    """Distinct documents of each language per prefix of ``width`` bytes, or term if it is no longer.

    Only what has a surviving prefix of ``parent`` bytes is counted.
    """
    for block in _read(batches):
        ids, starts = block["term_ids"], block["doc_starts"]
        docs = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        if parent:
            longer = (pc.binary_length(block["terms"]).to_numpy() > parent)[ids]
            ids, docs = ids[longer], docs[longer]
        langs = list(dict.fromkeys(block["langs"]))
        lang_of_doc = np.array([langs.index(lang) for lang in block["langs"]])[block["doc_groups"]]
        for number, lang in enumerate(langs):
            own = np.flatnonzero((lang_of_doc == number)[docs])
            used, local = _used(ids[own], len(block["terms"]))
            terms = block["terms"].take(pa.array(used)).to_pylist()
            alive = _alive(terms, lang, parent, survivors)
            if not alive.any():
                continue
            terms = list(compress(terms, alive))
            keys = [(term[:width], len(term) <= width) for term in terms]
            first = np.fromiter(map(ne, keys, [None, *keys[:-1]]), dtype=bool, count=len(keys))
            key_of_term = np.full(len(used), -1)
            key_of_term[alive] = np.cumsum(first) - 1
            key, doc = key_of_term[local], docs[own]
            key, doc = key[key >= 0], doc[key >= 0]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
            prefixes, whole = zip(*compress(keys, first))
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang), len(prefixes)), pa.array(prefixes, type=pa.binary()), pa.array(whole),
                pa.array(np.bincount(key[new], minlength=len(prefixes)), type=pa.int64()),
            ], schema=schema)


def _counts(batches: Iterator[pa.RecordBatch], schema: pa.Schema, kept: Broadcast) -> Iterator[pa.RecordBatch]:
    """Occurrences of what may be a kept term, per language and source."""
    for block in _read(batches):
        ids, counts, starts, terms = block["term_ids"], block["term_counts"], block["doc_starts"], block["terms"]
        group_of = np.repeat(block["doc_groups"], np.diff(starts))
        group_lang = np.array(block["langs"], dtype=object)
        for lang in dict.fromkeys(block["langs"]):
            own = np.flatnonzero((group_lang == lang)[group_of])
            used, local = _used(ids[own], len(terms))
            alive = kept.value.holds(hashes_of(lang, terms.take(pa.array(used)).to_pylist()))
            own, local = own[alive[local]], local[alive[local]]
            pairs = pa.table({"pair": group_of[own].astype(np.int64) * len(used) + local, "n": counts[own].astype(np.int64)})
            pairs = pairs.group_by("pair", use_threads=False).aggregate([("n", "sum")])
            pair, n = pairs["pair"].to_numpy(), pairs["n_sum"].to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang), len(pair)), pa.array(block["sources"]).take(pa.array(pair // len(used))) if len(pair) else pa.array([], type=pa.string()),
                terms.take(pa.array(used[pair % len(used)])) if len(pair) else pa.array([], type=pa.binary()), pa.array(n, type=pa.int64()),
            ], schema=schema)


def _documents(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(text_or_empty(text).alias("text"), text_or_empty(lang).alias("lang"), text_or_empty(source).alias("source"))


def term_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, path: str | None = None) -> DataFrame:
    """Documents as blocks of term ids, written once; a document is never parted."""
    make = partial(_blocks, schema=to_arrow_schema(BLOCK_SCHEMA), block_bytes=block_bytes)
    return materialize(docs.mapInArrow(make, BLOCK_SCHEMA), path)


def kept_terms(blocks: DataFrame, least: int = 10, first: int = 6) -> DataFrame:
    """The (lang, term, docs) with at least ``least`` distinct documents of the language.

    Levels have prefixes of ``first`` bytes, then twice as many each time. A level counts, in each block
    and then over all, the distinct documents of every prefix whose parent survived, and discards
    those below ``least``; a prefix has no fewer documents than any term it begins. Terms that are
    no longer than the level's width are whole and settled. It ends when no open prefix is left.
    Parents are looked up in a Bloom filter of at most 8 MB: where it errs, a prefix is counted in vain.
    """
    spark = blocks.sparkSession
    inputs = blocks.drop("sources", "term_counts")
    parent, width, survivors, kept = 0, first, None, None
    while True:
        count = partial(_level, schema=to_arrow_schema(LEVEL_SCHEMA), parent=parent, width=width, survivors=survivors)
        level = inputs.mapInArrow(count, LEVEL_SCHEMA).groupBy("lang", "prefix", "whole").agg(F.sum("docs").alias("docs"))
        level = materialize(level.filter(F.col("docs") >= least))
        whole = level.filter("whole").select("lang", F.col("prefix").alias("term"), "docs")
        kept = whole if kept is None else kept.unionByName(whole)
        open_ = level.filter(~F.col("whole"))
        left = open_.count()
        if not left:
            return kept
        survivors = spark.sparkContext.broadcast(Bloom.of(open_.select(F.xxhash64("lang", "prefix").alias("hash")), left))
        parent, width = width, 2 * width


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(10**9 * (n + 2) / (total + 2 * terms)), digit by digit in base 1,000.

    Exact while total + 2 * terms is below 9 * 10**15; n is at most the total.
    """
    over, rest, whole = f"({total} + 2 * {terms})", f"({n} + 2)", "0"
    rest, whole = f"({rest} % {over})", f"({rest} div {over})"
    for _ in range(3):
        rest, whole = f"(({rest} * 1000) % {over})", f"({whole} * 1000 + ({rest} * 1000) div {over})"
    return F.expr(f"1 + {whole}")


def gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def shares(n: np.ndarray, over: np.ndarray) -> np.ndarray:
    """``share`` for arrays of counts, with total + 2 * terms given."""
    whole, rest = (n + 2) // over, (n + 2) % over
    for _ in range(3):
        whole, rest = whole * 1000 + rest * 1000 // over, rest * 1000 % over
    return 1 + whole


def _tile_sums(key: tuple, counted: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums of the gaps of all pairs of sources of two tiles, over the block's terms that occur in them."""
    lang, _, left, right = key
    names = ["lang", "a", "b", "gaps", "seen"]
    if counted.empty or groups.empty:
        return pd.DataFrame({name: [] for name in names})
    groups = groups.sort_values("place")
    row = {place: i for i, place in enumerate(groups["place"].tolist())}
    term, terms = pd.factorize(counted["term"])
    n = np.zeros((len(groups), len(terms)), dtype=np.int64)
    n[[row[place] for place in counted["place"].tolist()], term] = counted["n"].to_numpy()
    p = shares(n, groups["over"].to_numpy()[:, None])
    places = groups["place"].to_numpy()
    tiles = places // TILE
    out = []
    for i in np.flatnonzero(tiles == left).tolist():
        others = np.flatnonzero((tiles == right) & (places > places[i]))
        gaps = ((p[others] - p[i]) ** 2 // (p[others] + p[i])).sum(axis=1)
        out += [(lang, int(places[i]), int(places[j]), int(g), len(terms)) for j, g in zip(others.tolist(), gaps.tolist())]
    return pd.DataFrame(out, columns=names)


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item and value of every ordered pair of sources of a language.

    Sources and terms of a language are dealt into tiles and blocks. A task gets the counts of two
    tiles in a block, so none gets a whole language; its sums are added up. Terms that occur in
    neither of two sources have the same gap each, which is added for all of them at once.
    """
    tiles = groups.groupBy("lang").agg(F.max("place").alias("last"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / TERMS))
    dealt = counts.join(groups.select("lang", "source", "place", "terms"), ["lang", "source"]).join(tiles, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), F.shiftright("place", 6).alias("tile"),
        F.explode(F.sequence(F.lit(0), F.shiftright("last", 6))).alias("other"), "place", "term", "n",
    )
    left, right = F.least("tile", "other"), F.greatest("tile", "other")
    dealt = dealt.select("lang", "block", left.alias("left"), right.alias("right"), "place", "term", "n")
    asked = dealt.select("lang", "block", "left", "right").distinct()
    asked = asked.withColumn("tile", F.explode(F.array_distinct(F.array("left", "right"))))
    placed = asked.join(groups.select("lang", F.shiftright("place", 6).alias("tile"), "place", (F.col("total") + 2 * F.col("terms")).alias("over")), ["lang", "tile"])
    keys = ["lang", "block", "left", "right"]
    placed = placed.select(*[F.col(key).alias(f"of_{key}") for key in keys], "place", "over")
    sums = dealt.groupBy(*keys).cogroup(placed.groupBy(*[f"of_{key}" for key in keys])).applyInPandas(
        _tile_sums, "lang string, a int, b int, gaps long, seen long"
    )
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("gaps").alias("gaps"), F.sum("seen").alias("seen"))
    none = share("0L", "total", "terms")
    one = groups.withColumn("none", F.when(F.col("terms") > 0, none).otherwise(1))
    a, b = one.alias("a"), one.alias("b")
    both = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.place") != F.col("b.place"))).select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item"),
        F.least("a.place", "b.place").alias("a"), F.greatest("a.place", "b.place").alias("b"),
        F.col("a.terms").alias("terms"), F.col("a.none").alias("p"), F.col("b.none").alias("q"),
    )
    rest = (F.col("terms") - F.coalesce("seen", F.lit(0))) * gap("p", "q")
    return both.join(sums, ["lang", "a", "b"], "left").select("lang", "source", "item", (F.coalesce("gaps", F.lit(0)) + rest).alias("value"))


def _terms(counts: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """lang, source, item and value of the terms that a source has more of than its language, best first."""
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    totals = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    scored = (
        counts.join(of_lang, ["lang", "term"]).join(groups, ["lang", "source"]).join(totals, "lang")
        .withColumns({"p": share("n", "total", "terms"), "q": share("lang_n", "lang_total", "terms")})
        .filter("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), gap("p", "q").alias("value"))
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)


def audit_sources(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
    least: int = 10, most: int = 10, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """How sources of a language differ in their terms: lang, source, part, item, value, rank.

    Null texts, languages and sources count as empty ones. Terms are runs of ASCII letters, lower-cased,
    and other non-ASCII characters; those in at least ``least`` documents of the language are kept. A
    row is a document, also if it repeats another. Part ``pair`` has a row for each other source of
    the language, part ``term`` the ``most`` terms that the source has more of than the language. Ties go
    to the smaller item by its UTF-8 bytes. A language without kept terms has pairs of value 0, one
    without a second source no pairs; an empty table gives an empty result. Other columns are not read.

    Documents are read once and written as blocks of term ids; each level reads those. Counts are
    added up per block before a shuffle, so a hot source or term sends one row per block and key.
    """
    spark: SparkSession = docs.sparkSession
    rows = _documents(docs, text_column, lang_column, source_column)
    path = new_folder(spark, "blocks")
    blocks = term_blocks(rows, block_bytes, path)
    kept = materialize(kept_terms(blocks, least))
    seen = spark.sparkContext.broadcast(Bloom.of(kept.select(F.xxhash64("lang", "term").alias("hash")), kept.count()))
    count = partial(_counts, schema=to_arrow_schema(COUNT_SCHEMA), kept=seen)
    counts = blocks.mapInArrow(count, COUNT_SCHEMA).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    counts = materialize(counts.join(kept.select("lang", "term"), ["lang", "term"], "left_semi"))
    remove_folder(spark, path)
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = (
        rows.select("lang", "source").distinct().withColumn("place", place).join(terms, "lang", "left").join(totals, ["lang", "source"], "left")
        .select("lang", "source", "place", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("terms", "total")])
    )
    groups = materialize(groups)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(counts, groups).withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))
    found = _terms(counts, groups, most).withColumn("part", F.lit("term"))
    return pairs.unionByName(found).select("lang", "source", "part", "item", "value", "rank")
