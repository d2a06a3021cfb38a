"""SimHash near-dedup: balls of half the radius that meet in the middle."""

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from paralane.llm.common import strings_as_bytes
from paralane.llm.components import components, forest
from paralane.session import materialize

BITS = 64
SEED = 42
#: Variants that a bucket should have on average, and that a task holds at once.
BUCKET_VARIANTS = 1 << 21


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words, repeats included; of all words if there are fewer."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(parts) - size + 1].tolist(), ends[size - 1 :].tolist())]
    return np.array(hashes, dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hashes: zero."""
    ones = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, len(hashes), 1 << 16):
        part = hashes[begin : begin + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch], at: int, words: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(shingle_hashes(text, words)) for text in strings_as_bytes(batch.column(at))]
        columns = [c for i, c in enumerate(batch.columns) if i != at]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(prints, type=pa.int64())], schema=schema)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4) -> DataFrame:
    """doc_id, the 64-bit hash of the text and the 64-bit fingerprint of the whole text, as signed longs."""
    text = F.col(text_column).cast("string")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    schema = StructType([rows.schema["doc_id"], rows.schema["text_hash"], StructField("fingerprint", LongType())])
    return rows.mapInArrow(partial(_fingerprints, at=2, words=words, schema=to_arrow_schema(schema)), schema)


@lru_cache(maxsize=256)
def flips(bits: int, most: int) -> np.ndarray:
    """All masks of at most ``most`` of the lowest ``bits`` bits, as unsigned 64-bit numbers."""
    one = [1 << i for i in range(bits)]
    return np.array([sum(some) for n in range(most + 1) for some in combinations(one, n)], dtype=np.uint64)


def ball_links(prints: np.ndarray, prefix: int, prefix_bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints that have a variant in common, of those that begin with ``prefix``.

    A fingerprint that already spends some of its flips on the prefix has fewer left for the rest.
    Variants are sorted, and neighbours in a run of equal ones are linked: a run of n gives n - 1
    links, not all pairs. Two fingerprints with a variant in common differ in at most ``radius``
    bits; this is verified for each link all the same.
    """
    half, low = radius // 2, BITS - prefix_bits
    spent = np.bitwise_count((prints >> np.uint64(low)) ^ np.uint64(prefix)) if prefix_bits else np.zeros(len(prints), dtype=np.uint8)
    rest = prints & np.uint64((1 << low) - 1)
    variants, owners = [], []
    for n in range(half + 1):
        own = np.flatnonzero(spent == n)
        if len(own):
            masks = flips(low, half - n)
            variants.append((rest[own][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(own, len(masks)))
    if not variants:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    all_variants, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(all_variants)
    same = np.flatnonzero(all_variants[order[1:]] == all_variants[order[:-1]])
    left, right = owner[order[same]], owner[order[same + 1]]
    pairs = np.unique(np.minimum(left, right) * len(prints) + np.maximum(left, right))
    left, right = pairs // max(1, len(prints)), pairs % max(1, len(prints))
    near = np.bitwise_count(prints[left] ^ prints[right]) <= radius
    return left[near], right[near]


def bucket_links(prints: np.ndarray, prefix: int, prefix_bits: int, radius: int, room: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The links of a bucket, in parts if it has more variants than ``room``: by one more bit each."""
    half = radius // 2
    low = BITS - prefix_bits
    size = sum(comb(low, n) for n in range(half + 1)) * len(prints)
    if size <= room or low <= 8:
        yield ball_links(prints, prefix, prefix_bits, radius)
        return
    for bit in (0, 1):
        finer = prefix << 1 | bit
        spent = np.bitwise_count((prints >> np.uint64(low - 1)) ^ np.uint64(finer))
        inside = np.flatnonzero(spent <= half)
        for left, right in bucket_links(prints[inside], finer, prefix_bits + 1, radius, room):
            yield inside[left], inside[right]


def _links(batches: Iterator[pa.RecordBatch], prefix_bits: int, radius: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    buckets, prints = [], []
    for batch in batches:
        buckets.append(batch.column(0).to_numpy(zero_copy_only=False))
        prints.append(batch.column(1).to_numpy(zero_copy_only=False))
    if not buckets:
        return
    bucket, signed = np.concatenate(buckets), np.concatenate(prints)
    order = np.lexsort((signed, bucket))
    bucket, signed = bucket[order], signed[order]
    begins = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1))
    for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(bucket)]):
        own = signed[begin:end]
        if len(own) < 2:
            continue
        label = np.arange(len(own))
        for left, right in bucket_links(own.view(np.uint64), int(bucket[begin]), prefix_bits, radius, 2 * BUCKET_VARIANTS):
            if len(left):
                label = forest(np.concatenate([left, np.arange(len(own))]), np.concatenate([right, label]), len(own))
        linked = np.flatnonzero(label != np.arange(len(own)))
        if len(linked):
            yield pa.RecordBatch.from_arrays([pa.array(own[linked]), pa.array(own[label[linked]])], schema=schema)


def near_links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) that join all fingerprints at ``radius`` or fewer differing bits, as forests.

    ``distinct`` has one column, ``fingerprint``, without repeats. If two fingerprints differ in at
    most ``radius`` bits, a variant lies within half of that of both. Every fingerprint is
    therefore sent to each bucket (the first bits of a variant) that one of its variants is in;
    the bucket's task makes the variants themselves, finds the equal ones and verifies the pairs.
    So variants are shuffled on their first bits, and a row stands for all variants in a bucket.
    The number of bits follows the number of fingerprints: a bucket has some 2 million variants
    on average, and a fuller one is worked on in parts. Each bucket gives at most one link per
    fingerprint, not all pairs.
    """
    if radius % 2:
        raise ValueError("the radius must be even to be halved")
    half = radius // 2
    n = distinct.count()
    wanted = n * sum(comb(BITS, k) for k in range(half + 1)) / BUCKET_VARIANTS
    bits = min(24, max(6, int(np.ceil(np.log2(max(1.0, wanted))))))
    masks = [int(m) for m in flips(bits, half)]
    head = F.shiftrightunsigned("fingerprint", BITS - bits)
    routed = distinct.select(F.explode(F.transform(F.lit(masks).cast("array<bigint>"), lambda m: m.bitwiseXOR(head))).alias("bucket"), "fingerprint")
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    links = partial(_links, prefix_bits=bits, radius=radius, schema=to_arrow_schema(schema))
    return routed.repartition("bucket").mapInArrow(links, schema)


def _grouped(docs: DataFrame, id_column: str, text_column: str, words: int, radius: int) -> DataFrame:
    """doc_id, text_hash, fingerprint, root (a fingerprint that names the component) and component_id."""
    prints = materialize(fingerprints(docs, id_column, text_column, words))
    nodes = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(nodes.select("fingerprint"), radius))
    linked = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(linked.join(named, "root").select("fingerprint", "root", "component_id"), "fingerprint")


def simhash_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4, radius: int = 4
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document.

    Texts are lower-cased (A-Z only) and cut into words at spaces and U+0009 to U+000D; the
    fingerprint is that of all runs of ``words`` words. Documents whose fingerprints differ in
    ``radius`` bits or fewer are linked, and component_id is the smallest doc_id that links lead to.
    Null texts count as empty; texts without words have fingerprint zero and are linked like others.
    Null ids are linked too, but name a component only if it has no other id. Repeated rows stay.
    Copies of a fingerprint count once in the search, so a hot group costs one fingerprint.
    """
    return _grouped(docs, id_column, text_column, words, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The document with the smallest id of each group of near-duplicates, with all its columns.

    Null ids come last. Where several texts of a group have that id, or all ids are null, the one with the
    smallest text hash stays; rows equal in id and text stay together. An id that is the smallest of one
    group and not of another stays in the first only. Null texts count as empty; no rows: no result.
    """
    groups = _grouped(docs, id_column, text_column, 4, 4).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = groups.groupBy("root").agg(F.min("doc_id").alias("__kept"), F.min("text_hash").alias("__text_hash"))
    same = docs[id_column].eqNullSafe(kept["__kept"]) & (F.xxhash64(docs[text_column].cast("string")) == kept["__text_hash"])
    return docs.join(kept, same, "left_semi")
