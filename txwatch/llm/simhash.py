"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh, 2016).

A fingerprint's bit i is given a non-zero vector m(i) of radius + 1 bits. For each of the 2^(radius+1) - 1
non-zero vectors v there is one table, whose mask keeps the bits with an odd number of ones in m(i) & v. At most
`radius` differing bits give as many linear equations in radius + 1 unknowns, so some v is orthogonal to all of
them: the mask of that table leaves out every differing bit, and the pair collides there. No pair is missed.

Each table fixes about half of the bits. A bucket of many fingerprints is not compared pair by pair: its members
are posted again, under the covering masks of the bits that the bucket does not fix. The guarantee holds again
for these. With radius 3 a bucket leaves at most 32, then 16, then 8 bits open, and as fingerprints are distinct,
a bucket of the last level has at most 2^8 members: a bound that does not grow with the corpus. Inside a bucket
only a spanning forest of the links is kept, so a dense group yields one edge per member and bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from txwatch.llm.graph import components
from txwatch.llm.text import U64, raw
from txwatch.session import materialise

BITS = 64
#: Buckets up to this size are compared at once; larger ones are dealt out by further masks.
LIGHT = 32
#: Open bits with which a bucket is compared whatever its size: at most 2**LEAF fingerprints.
LEAF = 8
_CHUNK = 1 << 14


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    """A bit is set if it is set in over half of the hashes of the text's shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    n = len(words) - size + 1
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    joined = b" ".join(words)
    del words
    seen = np.zeros(BITS, dtype=np.int64)
    for k in range(0, n, _CHUNK):
        pairs = zip(starts[k : min(k + _CHUNK, n)].tolist(), ends[k + size - 1 : k + size - 1 + _CHUNK].tolist())
        codes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in pairs], dtype="<u8")
        seen += np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * seen > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), size, seed) for text in batch.column("raw")]
            codes = np.array(found, dtype=U64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes)], ["doc_id", "fp"])

    return run


def covering(open_bits: list[int], radius: int) -> list[int]:
    """The masks over `open_bits` of which every set of at most `radius` bits is left out by one."""
    tables = (1 << radius + 1) - 1
    return [
        sum(1 << bit for place, bit in enumerate(open_bits) if (1 + place % tables & v).bit_count() % 2)
        for v in range(1, tables + 1)
    ]


def _next_masks(masks: list[int], radius: int) -> list[int]:
    """For each mask its own bits with each covering mask of the bits it leaves open, in order."""
    return [
        fixed | more
        for fixed in masks
        for more in covering([bit for bit in range(BITS) if not fixed >> bit & 1], radius)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> BITS - 1 else mask


def _forests(radius: int):
    """Of each bucket, edges (a, b) that connect just the members connected by links within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            sizes = lists.value_lengths().to_numpy()
            values = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            for m in np.unique(sizes):
                first = starts[sizes == m]
                step = max(1, (1 << 20) // int(m * m))
                for k in range(0, len(first), step):
                    codes = values[first[k : k + step, None] + np.arange(m)]
                    near = np.bitwise_count((codes[:, :, None] ^ codes[:, None, :]).view(U64)) <= radius
                    label = np.broadcast_to(np.arange(m), codes.shape)
                    while True:
                        lower = np.where(near, label[:, None, :], m).min(axis=2)
                        if (lower == label).all():
                            break
                        label = lower
                    root = np.take_along_axis(codes, label, axis=1)
                    linked = label != np.arange(m)
                    yield pa.RecordBatch.from_arrays([pa.array(codes[linked]), pa.array(root[linked])], ["a", "b"])

    return run


def _post(rows: DataFrame, masks: list[int], tables: int) -> DataFrame:
    """(path, code, fp): every fingerprint under each table below its own path."""
    paths = F.sequence(F.col("path") * tables, F.col("path") * tables + F.lit(tables - 1))
    kept: Column = F.array(*[F.lit(_signed(m)) for m in masks])
    return rows.select("fp", F.explode(paths).alias("path")).select(
        "path", F.col("fp").bitwiseAND(F.element_at(kept, F.col("path") + F.lit(1))).alias("code"), "fp"
    )


def links(codes: DataFrame, radius: int = 3, light: int = LIGHT) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints `codes` (fp) connected by links."""
    tables = (1 << radius + 1) - 1
    rows, masks, found = codes.select("fp", F.lit(0).alias("path")), [0], None
    while True:
        masks = _next_masks(masks, radius)
        last = all(BITS - m.bit_count() <= LEAF for m in masks)
        posts = _post(rows, masks, tables)
        sizes = posts.groupBy("path", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = materialise(posts.join(sizes, ["path", "code"]), "simhash-buckets")
        near = (met if last else met.where(F.col("n") <= light)).groupBy("path", "code")
        edges = near.agg(F.collect_list("fp").alias("members")).select("members").mapInArrow(_forests(radius), "a long, b long")
        edges = materialise(edges, "simhash-edges")
        found = edges if found is None else found.union(edges)
        rows = met.where(F.col("n") > light).select("fp", "path")
        if last or rows.isEmpty():
            return found


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42, light: int = LIGHT) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    Words are runs of bytes other than white space, A-Z in lower case; a shingle is `shingle` words with single
    spaces between (with fewer words all of them), hashed by XXH64. A text without words has fingerprint zero and
    is linked like any other. Fingerprints that differ in at most `radius` bits are linked; component_id is the
    smallest doc_id reachable. Null ids count only where a component has nothing else. Rows may repeat. `light`
    moves work between levels and never changes the result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    members = materialise(
        docs.select("doc_id", raw().alias("raw")).mapInArrow(_fingerprints(shingle, seed), f"doc_id {kind}, fp long"),
        "simhash-fingerprints",
    )
    classes = materialise(members.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    labels = components(links(classes, radius, light)).withColumnRenamed("node", "fp")
    placed = classes.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    about = materialise(placed.join(lowest, "component").select("fp", "component_id"), "simhash-components")
    return members.join(about, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
