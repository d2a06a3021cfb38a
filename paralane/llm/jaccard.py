"""N-gram Jaccard join: equal parts of sets bring candidates together, signature trees join them."""

from collections.abc import Iterator
from functools import lru_cache, partial
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from paralane.llm.bloom import Bloom
from paralane.llm.common import mixed, strings_as_bytes
from paralane.llm.components import components
from paralane.llm.signature_tree import SignatureTree
from paralane.llm.simhash import shingle_hashes
from paralane.session import materialize, new_folder, remove_folder

#: Sets and tokens that a tree may have; larger groups are parted.
TREE_SETS = 4096
TREE_TOKENS = 4 << 20

LINKS = StructType().add("a", BinaryType()).add("b", BinaryType())


def tokens_of(text: bytes, words: int) -> np.ndarray:
    """The distinct hashes of the shingles, ascending as signed numbers."""
    return np.unique(shingle_hashes(text, words).view(np.int64))


def digest_of(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


class Bands:
    """Bands of set sizes, and the number of parts into which the sets of a band are cut.

    Linked sets differ in at most (|x| + |y|) * (d - n) / (d + n) tokens. With one part more than that,
    two linked sets have a part that is equal in both. A set takes part in its own band and, where a linked
    set can be in the next one, in that too; bands are so wide that it cannot be farther away.
    """

    def __init__(self, share: tuple[int, int]) -> None:
        self.above, self.below = share

    @lru_cache(maxsize=None)
    def start(self, band: int) -> int:
        if band == 0:
            return 1
        before = self.start(band - 1)
        return max(before + 1, -(-before * max(3 * self.above, 2 * self.below + self.above) // (2 * self.above)))

    def of(self, size: int) -> list[int]:
        """The bands that a set of a size takes part in."""
        band = 0
        while self.start(band + 1) <= size:
            band += 1
        return [band, band + 1] if size * self.below // self.above >= self.start(band + 1) else [band]

    @lru_cache(maxsize=None)
    def parts(self, band: int) -> tuple[int, int, int]:
        """The number of parts, how many of them a set may leave empty, and how often it is cut anew beyond that.

        So many parts are added that of two linked sets' equal parts more are left than either has empty
        ones, in all but very few sets. Where hardly any part is empty, none is added. Where parts would have
        hardly a token, nothing is cut anew, and empty parts count like others.
        """
        least = 2 * (self.start(band + 1) - 1) * (self.below - self.above) // (self.below + self.above) + 1
        first = -(-self.start(band) * self.above // self.below)
        if least == 1:
            return 1, 0, 0
        if least * exp(-first / least) < 0.5:
            return least, 0, 8
        spare = 0
        while spare < least:
            empty = (least + spare) * exp(-first / (least + spare))
            enough = ceil(empty + 6 * sqrt(empty))
            if enough <= spare:
                return least + spare, spare, 1
            spare = enough
        return least, 0, 0


def routes(tokens: np.ndarray, bands: Bands) -> np.ndarray:
    """One hash for each part of a set in each of its bands; equal parts have equal hashes.

    Parts without tokens would bring together whatever has none there, so they are left out, unless
    there are more than the band allows for. Then sets with such a part are cut anew, among those with
    the same empty part: a pair that agrees in it agrees in a part of that cut.
    """
    spread = mixed(tokens.view(np.uint64))
    out = []

    def cut(seed: np.uint64, parts: int, spare: int, again: int) -> None:
        values = mixed(spread + seed)
        sums = np.zeros(parts, dtype=np.uint64)
        part = ((values >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        np.add.at(sums, part, values)
        keys = mixed(mixed(seed + np.arange(1, parts + 1, dtype=np.uint64)) + sums)
        empty = np.bincount(part, minlength=parts) == 0
        if empty.sum() <= spare:
            out.append(keys[~empty])
        elif again == 0:
            out.append(keys)
        else:
            out.append(keys[~empty])
            for key in keys[empty]:
                cut(key, parts, spare, again - 1)

    for band in bands.of(len(tokens)):
        cut(mixed(np.array([band], dtype=np.uint64) + np.uint64(1 << 40))[0], *bands.parts(band))
    return np.concatenate(out)


def _sets(batches: Iterator[pa.RecordBatch], schema: pa.Schema, words: int, share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Size and digest of each document's set; its routes where a task meets the set first."""
    bands, seen = Bands(share), set()
    for batch in batches:
        sizes, digests, routed = [], [], []
        for text in strings_as_bytes(batch.column(2)):
            tokens = tokens_of(text, words)
            digest = digest_of(tokens)
            sizes.append(len(tokens))
            digests.append(digest)
            routed.append(routes(tokens, bands).view(np.int64) if len(tokens) and digest not in seen else None)
            seen.add(digest)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, type=pa.int32()), pa.array(digests, type=pa.binary()), pa.array(routed, type=pa.list_(pa.int64()))],
            schema=schema,
        )


def _tokens(batches: Iterator[pa.RecordBatch], schema: pa.Schema, words: int, asked: Broadcast) -> Iterator[pa.RecordBatch]:
    """Digest and tokens of the texts of rows that may be asked for, once per task."""
    seen = set()
    for batch in batches:
        rows = np.flatnonzero(asked.value.holds(batch.column(0).to_numpy()))
        digests, found = [], []
        for text in strings_as_bytes(batch.column(1).take(pa.array(rows))):
            tokens = tokens_of(text, words)
            digest = digest_of(tokens)
            if digest not in seen:
                seen.add(digest)
                digests.append(digest)
                found.append(tokens.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(digests, type=pa.binary()), pa.array(found, type=pa.binary())], schema=schema)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[dict[str, list]]:
    """Rows whose first ``keys`` columns are equal, of batches sorted by them."""
    last, run = None, {}
    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for row in zip(*columns):
            if row[:keys] != last:
                if last is not None:
                    yield run
                last, run = row[:keys], {name: [] for name in batch.schema.names}
            for name, value in zip(batch.schema.names, row):
                run[name].append(value)
    if last is not None:
        yield run


def _join_run(run: dict[str, list], share: tuple[int, int], across: bool) -> list[tuple[bytes, bytes]]:
    """Links (set, first set of its component) of one run, new ones only."""
    at = list({node: i for i, node in enumerate(run["node"])}.values())  # a set may come from several tasks
    if len(at) < 2:
        return []
    nodes = [run["node"][i] for i in at]
    tree = SignatureTree([np.frombuffer(run["tokens"][i], dtype=np.int64) for i in at])
    before = side = None
    if across:
        number: dict = {}
        before = np.array([number.setdefault(run["label"][i], len(number)) for i in at])
        side = np.array([run["side"][i] for i in at])
    label = tree.components(share, before, side)
    first: dict[int, int] = {}
    links = []
    for i, own in enumerate(label.tolist()):
        head = first.setdefault(own, i)
        if head != i and (before is None or before[head] != before[i]):
            links.append((nodes[head], nodes[i]))
    return links


def _tree_links(batches: Iterator[pa.RecordBatch], schema: pa.Schema, keys: int, share: tuple[int, int], across: bool) -> Iterator[pa.RecordBatch]:
    for run in _runs(batches, keys):
        links = _join_run(run, share, across)
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(side, type=pa.binary()) for side in zip(*links)], schema=schema)


def _linked(rows: DataFrame, keys: list[str], share: tuple[int, int], across: bool) -> DataFrame:
    """Links of each run of rows with equal ``keys``, by a signature tree over the run."""
    find = partial(_tree_links, schema=to_arrow_schema(LINKS), keys=len(keys), share=share, across=across)
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(find, LINKS)


def _open_links(tokens: DataFrame, members: DataFrame, known: DataFrame, share: tuple[int, int]) -> DataFrame | None:
    """Links between sets that have a part in common but were in different trees.

    Two trees are joined if some part has sets of both and these are not all known to be linked.
    Each such pair of trees is worked on in one task, so the work is bounded by two trees' sizes.
    """
    places = tokens.select("node", F.struct("home", "part").alias("place"))
    labelled = places.join(known, "node", "left").select("node", "place", F.coalesce("root", "node").alias("label"))
    labelled = materialize(labelled)
    met = members.join(labelled, "node").groupBy("route", "place").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    met = materialize(met)
    mixed_ = met.groupBy("route").agg(
        F.min("place").alias("p"), F.max("place").alias("q"), F.min("least").alias("a"), F.max("most").alias("b")
    ).filter("p <> q AND a <> b").select("route")
    met = met.join(mixed_, "route", "left_semi")
    other = met.select("route", F.col("place").alias("other"), F.col("least").alias("other_least"), F.col("most").alias("other_most"))
    pairs = met.join(other, "route").filter(
        "place < other AND NOT (least = most AND other_least = other_most AND least = other_least)"
    ).select("place", "other").distinct()
    pairs = materialize(pairs.select(F.col("place").alias("p"), F.col("other").alias("q")))
    if pairs.isEmpty():
        return None
    rows = tokens.withColumn("place", F.struct("home", "part")).join(labelled.select("node", "label"), "node")
    sides = [
        pairs.withColumn("place", F.col(name)).join(rows, "place").select("p", "q", F.lit(n).alias("side"), "node", "label", "tokens")
        for n, name in enumerate(("p", "q"))
    ]
    both = sides[0].unionByName(sides[1]).select(
        *[F.col(f"{p}.{name}").alias(f"{p}_{name}") for p in ("p", "q") for name in ("home", "part")], "side", "node", "label", "tokens"
    )
    return _linked(both, ["p_home", "p_part", "q_home", "q_part"], share, True)


def jaccard_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, share: tuple[int, int] = (90, 100),
    tree_sets: int = TREE_SETS, tree_tokens: int = TREE_TOKENS,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Texts are lower-cased (A-Z only) and cut into words at spaces and U+0009 to U+000D. A document's
    set are its distinct shingles of ``words`` words, or the whole sequence where there are fewer; 64-bit hashes
    stand for shingles, and 128-bit digests of all of them for sets. Two documents link when
    d * intersection >= n * union, for ``share`` (n, d); component_id is the smallest doc_id that links lead
    to. Null texts and texts without words have empty sets and link with nothing: component_id is their
    own doc_id. Null ids link too, but name a component only if it has no other. Repeated rows stay,
    an empty table gives an empty result, other columns are not read.

    Equal sets become one node. Nodes are sent, by 16 bytes a part, to each of their parts' hashes (see
    ``Bands``); nodes that share none cannot link. Every node that shares one gets one home, the smallest node
    met over its parts, and its tokens are sent there once; homes with more than ``tree_sets`` sets or
    ``tree_tokens`` tokens are parted. A home's sets are joined by a signature tree. Sets that share a part,
    but neither a tree nor a component, are joined tree by tree afterwards, so that no link is lost.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    schema = StructType([
        rows.schema["doc_id"], StructField("row", LongType()), StructField("n_shingles", IntegerType()),
        StructField("node", BinaryType()), StructField("routes", ArrayType(LongType())),
    ])
    make = partial(_sets, schema=to_arrow_schema(schema), words=words, share=share)
    sets_path, token_path = new_folder(spark, "sets"), new_folder(spark, "tokens")
    sets = materialize(rows.mapInArrow(make, schema), sets_path)
    # A set is placed by 64 bits of its digest; nodes are told apart by all 128.
    place = F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long")
    members = sets.filter("routes IS NOT NULL").select("node", place.alias("place"), F.explode("routes").alias("route"))
    shared = members.groupBy("route").agg(F.min("place").alias("leader"), F.max("place").alias("last")).filter("leader <> last")
    members = materialize(members.join(shared.drop("last"), "route").select("route", "node", "leader").distinct())
    homes = members.groupBy("node").agg(F.min("leader").alias("home"))
    nodes = sets.groupBy("node").agg(F.min("row").alias("row"), F.max("n_shingles").alias("n"))
    homes = materialize(homes.join(nodes, "node"))
    sizes = homes.groupBy("home").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / tree_sets, F.sum("n") / tree_tokens)).cast("int").alias("parts")
    ).filter("parts > 1")
    asked = homes.join(sizes, "home", "left").select(
        "home", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"), "node"
    )
    filter_ = spark.sparkContext.broadcast(Bloom.of(homes.select(F.col("row").alias("hash")), homes.count()))
    token_schema = StructType().add("node", BinaryType()).add("tokens", BinaryType())
    read = partial(_tokens, schema=to_arrow_schema(token_schema), words=words, asked=filter_)
    found = rows.select("row", "text").mapInArrow(read, token_schema)
    tokens = materialize(found.join(asked, "node").select("home", "part", "node", "tokens"), token_path)
    links = materialize(_linked(tokens, ["home", "part"], share, False))
    roots = components(links)
    more = _open_links(tokens, members.select("route", "node"), roots, share)
    if more is not None:
        roots = components(links.unionByName(materialize(more)))
    remove_folder(spark, token_path)
    named = sets.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = named.join(least, "root").select("node", "component_id")
    return sets.join(of_node, "node", "left").select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
