"""Benchmark decontamination by a prefix-filtered set join.

Every window of a benchmark item (ten consecutive words; a shorter item is one window) is a set of word
shingles. A document contains a window only if it contains all its shingles, so the necessary prefix under an
order by rarity is the single rarest one. Documents are joined with windows on that shingle alone; bounds on
its place and on the document's length drop impossible pairs; what is left is compared word by word.

Two passes over the documents: one counts the benchmark's shingles (their rarity), one emits the places of
the chosen shingles together with the words around them. Both look shingles up in a filter of fixed size.
A passage shared by many documents is a hot key of the join only on the documents' side, where adaptive
execution splits it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwatch.llm.text import U64, FixedFilter, mix, raw
from txwatch.session import materialise

WINDOW = 10
SHINGLE = 3

#: Letters in lower case, digits and all bytes beyond ASCII stay; every other byte parts words.
_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: One odd factor for each place in a shingle.
_FACTORS = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def words_of(text: bytes) -> list[bytes]:
    """Words of a text: letters A-Z in lower case, parted by ASCII bytes that are no letters or digits."""
    return text.translate(_KEEP).split()


def shingles(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words, given the words' 32-bit codes."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    total = np.full(n, size, dtype=U64)
    for k in range(size):
        total += codes[k : k + n] * _FACTORS[k]
    return mix(total)


def codes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), dtype=U64, count=len(words))


def _item_windows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            items, texts, lengths, tokens, offsets = [], [], [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                size = min(window, len(words))
                if not size:
                    continue
                width = min(SHINGLE, size)
                hashes = shingles(codes_of(words), width).view(np.int64)
                for start in range(len(words) - size + 1):
                    own = hashes[start : start + size - width + 1].tolist()
                    items += [item] * len(own)
                    texts += [b" ".join(words[start : start + size]).decode("utf-8", "replace")] * len(own)
                    lengths += [size] * len(own)
                    tokens += own
                    offsets += range(len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, batch.column(0).type), pa.array(texts, pa.string()), pa.array(lengths, pa.int32()),
                 pa.array(tokens, pa.int64()), pa.array(offsets, pa.int32())],
                ["item_id", "window", "n", "token", "offset"],
            )

    return run


def _count_tokens(known: FixedFilter, widths: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                codes = codes_of(words_of(text))
                for width in widths:
                    hashes = shingles(codes, width)
                    found.append(hashes[known.has(hashes)])
            tokens, counts = np.unique(np.concatenate(found), return_counts=True) if found else ([], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(tokens, U64).view(np.int64)), pa.array(np.asarray(counts, np.int64))], ["token", "n"]
            )

    return run


def _places(known: FixedFilter, widths: list[int], window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    place = pa.struct([("token", pa.int64()), ("pos", pa.int64()), ("lead", pa.int32()), ("around", pa.string())])

    def run(batches):
        for batch in batches:
            counts, places = [], []
            for text in batch.column("raw").to_pylist():
                words = words_of(text)
                codes, own = codes_of(words), []
                for width in widths:
                    hashes = shingles(codes, width)
                    for pos in np.flatnonzero(known.has(hashes)).tolist():
                        first = max(0, pos - window + width)
                        around = b" ".join(words[first : pos + window]).decode("utf-8", "replace")
                        own.append((int(hashes[pos : pos + 1].view(np.int64)[0]), pos, pos - first, around))
                counts.append(len(words))
                places.append([dict(zip(("token", "pos", "lead", "around"), p)) for p in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(counts, pa.int64()), pa.array(places, pa.list_(place))],
                ["key", "n_words", "places"],
            )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, hits (sorted spans of words) and items.

    `benchmark` has item_id and text. Repeated items and windows count once per item_id; an item without
    words is never found; a null item_id hits words but is not listed in `items`.
    """
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    windows = materialise(
        benchmark.select("item_id", raw().alias("raw"))
        .mapInArrow(_item_windows(window), f"item_id {item_type}, window string, n int, token long, offset int")
        .distinct(),
        "benchmark-windows",
    )
    widths = sorted(r[0] for r in windows.select(F.least("n", F.lit(SHINGLE))).distinct().collect())  # at most 3
    texts = docs.select(raw().alias("raw"))
    counted = texts.mapInArrow(_count_tokens(FixedFilter.of(windows, "token"), widths), "token long, n long")
    rarity = counted.groupBy("token").agg(F.sum("n").alias("seen"))
    rarest = Window.partitionBy("window").orderBy("seen", "token", "offset")
    anchors = materialise(
        windows.select("window", "n", "token", "offset").distinct()
        .join(rarity.hint("merge"), "token")  # a shingle that no document has cannot be contained
        .withColumn("nth", F.row_number().over(rarest))
        .where("nth = 1")
        .drop("nth", "seen"),
        "benchmark-anchors",
    )
    keyed = docs.select("doc_id", F.col("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = materialise(
        keyed.select(F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("key"), raw().alias("raw"))
        .mapInArrow(
            _places(FixedFilter.of(anchors, "token"), widths, window),
            f"key struct<doc_id:{id_type},row:long>, n_words long, "
            "places array<struct<token:long,pos:long,lead:int,around:string>>",
        ),
        "benchmark-places",
    )
    places = found.where(F.size("places") > 0).select("key.row", F.explode("places").alias("p")).select("row", "p.*")
    # Places: the window starts inside the document, and enough words follow.
    bounded = places.join(anchors, "token").where(
        (F.col("lead") >= F.col("offset"))
        & (F.size(F.split("around", " ")) >= F.col("lead") - F.col("offset") + F.col("n"))
    )
    exact = bounded.where(
        F.concat_ws(" ", F.expr("slice(split(around, ' '), lead - offset + 1, n)")) == F.col("window")
    ).select("row", (F.col("pos") - F.col("offset")).alias("start"), "n", "window")
    # Stored, so that the join can split the places of a window found everywhere.
    holders = materialise(windows.select("window", "item_id").distinct(), "benchmark-holders")
    per_row = (
        exact.join(holders.hint("merge"), "window")
        .groupBy("row")
        .agg(
            F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("hits"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return found.select("key.*", "n_words").join(per_row.hint("merge"), "row", "left").select(
        "doc_id", "n_words", F.coalesce("hits", none).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def n_hit() -> Column:
    """Words inside any of the sorted spans `hits`."""
    return F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, h: F.struct(
            (a["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(a["upto"], h["start"]))).alias("n"),
            F.greatest(a["upto"], h["end"]).alias("upto"),
        ),
        lambda a: a["n"],
    )
