"""Exact substring dedup by external induced sorting of sampled suffixes.

A byte goes if it lies in a `size`-byte string that starts at least twice in the corpus. Sorting every suffix
of the corpus would move 200 bytes per byte of text, so only suffixes at sampled places are sorted, and the
order of the others is induced from them:

1. Sampling. In every window of `size` bytes the smallest hash of a 32-byte string marks an anchor. Equal
   windows have their anchor at the same offset, so equal windows meet at equal anchors, and there is about
   one anchor per 85 bytes. An anchor serves a range of window starts; its context is what they cover.
2. Naming. Contexts that occur twice or more are repeated as a whole, whatever their copies: a combinable
   count of digests, with no bytes moved. This settles the inside of every shared passage.
3. External sorting. What is left are anchors at the borders of shared passages. Windows are split into those
   with the anchor in their first or second half; both halves give a key that all equal windows share. Spark's
   sort, which spills to disk, deals the contexts by key and orders them by suffix.
4. Induction. Neighbours in that order get common-prefix lengths. Going left one byte at a time, the order of
   the suffixes starting one byte earlier follows from (byte, order so far), and their common prefixes from
   range minima over the lengths. A window is repeated if a neighbour agrees in `size` bytes.
5. Groups of more contexts than a task should hold are counted by window digests instead, a combinable
   aggregate with the same answer.

Hashes only select; equality is that of bytes or of 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.llm.text import U64, FixedFilter, mix, raw
from txwatch.session import materialise

SIZE = 200
SEED = 32
#: Contexts of one key that a task sorts at most; larger groups are counted by windows.
GROUP = 2_000
#: Window starts looked at in one go.
SEGMENT = 1 << 20
_BASE = 0x5851F42D4C957F2D


@cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.full(length, _BASE, dtype=U64)
    inverse = np.full(length, pow(_BASE, -1, 1 << 64), dtype=U64)
    base[0] = inverse[0] = 1
    return np.multiply.accumulate(base), np.multiply.accumulate(inverse)


class _Hashes:
    """Hashes of all substrings of some bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(12, int(len(data)).bit_length())
        up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + U64(salt))

    def seeds(self) -> np.ndarray:
        n = len(self.sums) - SEED
        return mix((self.sums[SEED:] - self.sums[:n]) * self.down[:n])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values, from running minima of blocks in both directions."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=U64)
    padded[:n] = x
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Anchors:
    """Anchors of one segment: place, first and last window start served, and the two keys."""

    def __init__(self, data: np.ndarray, size: int):
        hashes = _Hashes(data)
        seeds = hashes.seeds()
        packed = (seeds & ~U64(0xFFFFFF)) | np.arange(len(seeds), dtype=U64)
        chosen = (_sliding_min(packed, size - SEED + 1) & U64(0xFFFFFF)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(chosen)) + 1
        self.first = np.concatenate(([0], cuts))
        self.last = np.concatenate((cuts, [len(chosen)])) - 1
        self.at = chosen[self.first]
        half = (size - SEED) // 2
        # First half: windows that start at most `half` before the anchor; all hold at .. at + size - half.
        self.near = self.last >= self.at - half
        self.far = self.first < self.at - half
        end = np.minimum(self.at + size - half, len(data))
        self.near_key = np.where(self.near, hashes.of(self.at, end, 1), U64(0))
        begin = np.maximum(self.at - half, 0)
        self.far_key = np.where(self.far, hashes.of(begin, self.at + SEED, 2), U64(0))


def segments(data: bytes, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping pieces of a long text in which every window lies whole."""
    whole = np.frombuffer(data, dtype=np.uint8)
    for start in range(0, len(whole) - size + 1, SEGMENT):
        yield start, whole[start : start + SEGMENT + size - 1]


def _keys(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text in batch.column("raw"):
                for _, piece in segments(text.as_py(), size):
                    a = Anchors(piece, size)
                    keys += [a.near_key[a.near], a.far_key[a.far]]
            found = np.concatenate(keys) if keys else np.empty(0, U64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["key"])

    return run


_CONTEXT = (
    "doc struct<doc_id:{id},t:binary>, at long, lo int, hi int, context binary, near_key long, far_key long"
)


def _contexts(size: int, known: FixedFilter):
    """Anchors with a key that occurs twice, as window offsets lo..hi before the anchor and a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, lo, hi, near, far, digests = [], [], [], [], [], [], []
            for row, text in enumerate(batch.column("raw")):
                text = text.as_py()
                for start, piece in segments(text, size):
                    a = Anchors(piece, size)
                    hit = np.flatnonzero((a.near & known.has(a.near_key)) | (a.far & known.has(a.far_key)))
                    if not len(hit):
                        continue
                    rows.append(np.full(len(hit), row))
                    at.append(a.at[hit] + start)
                    hi.append(a.at[hit] - a.first[hit])
                    lo.append(a.at[hit] - a.last[hit])
                    near.append(np.where(a.near[hit], a.near_key[hit], U64(0)))
                    far.append(np.where(a.far[hit], a.far_key[hit], U64(0)))
                    for first, last, place in zip(a.first[hit] + start, a.last[hit] + start + size, hi[-1]):
                        mark = hashlib.blake2b(text[first:last], digest_size=16, salt=int(place).to_bytes(4, "little"))
                        digests.append(mark.digest())
            joined = lambda x, kind: np.concatenate(x).astype(kind) if x else np.empty(0, kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(joined(rows, np.int64))), pa.array(joined(at, np.int64)),
                 pa.array(joined(lo, np.int32)), pa.array(joined(hi, np.int32)), pa.array(digests, pa.binary()),
                 pa.array(joined(near, U64).view(np.int64)), pa.array(joined(far, U64).view(np.int64))],
                ["doc", "at", "lo", "hi", "context", "near_key", "far_key"],
            )

    return run


def _fetch(size: int):
    """Bytes on both sides of a key's place for the contexts listed with a document.

    Window offsets count from that place: the anchor for the first half, `half` bytes earlier for the second.
    """
    half = (size - SEED) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("context", "n", "far", "key", "big", "lo", "hi", "right", "left")}
            for text, items in zip(batch.column("raw"), batch.column("items").to_pylist()):
                text = text.as_py()
                for item in items:
                    shift = half if item["far"] else 0
                    place, lo, hi = item["at"] - shift, item["lo"] - shift, item["hi"] - shift
                    for name in ("context", "n", "far", "key", "big"):
                        out[name].append(item[name])
                    out["lo"].append(lo)
                    out["hi"].append(hi)
                    out["right"].append(text[place : place - lo + size])
                    out["left"].append(text[place - hi : place][::-1])
            kinds = (pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    return run


_FETCHED = "context binary, n long, far boolean, key long, big boolean, lo int, hi int, right binary, left binary"


def _matrix(values: list[bytes], width: int) -> np.ndarray:
    """One row per value, padded with zeros; lengths are kept apart."""
    return np.frombuffer(b"".join(v.ljust(width, b"\0")[:width] for v in values), dtype=np.uint8).reshape(len(values), width)


class _Minima:
    """Range minima by doubling."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
        self.table = np.zeros((len(self.levels), len(values)), dtype=values.dtype)
        for k, level in enumerate(self.levels):
            self.table[k, : len(level)] = level

    def over(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        k = np.log2(last - first + 1).astype(np.int64)
        return np.minimum(self.table[k, first], self.table[k, last - (1 << k) + 1])


def induce(group: np.ndarray, right: list[bytes], left: list[bytes], lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    """Which window offsets of each context are repeated in its group: a (rows, offsets) table.

    Rows come sorted by (group, right). `left` is read from the place leftwards.
    """
    n, reach = len(group), int(hi.max()) + 1
    table = np.zeros((n, reach), dtype=bool)
    r, r_len = _matrix(right, size), np.array([len(x) for x in right])
    l, l_len = _matrix(left, reach), np.array([len(x) for x in left])
    common = np.zeros(n, dtype=np.int16)  # with the row before
    if n > 1:
        differ = r[1:] != r[:-1]
        where = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
        common[1:] = np.where(group[1:] == group[:-1], np.minimum(where, np.minimum(r_len[1:], r_len[:-1])), 0)
    minima = _Minima(common)
    order, cls = np.arange(n), group.astype(np.int64)
    for offset in range(reach):
        if offset:  # induce: the suffixes starting one byte earlier, by (byte, order so far)
            longer = l_len[order] >= offset
            order, cls = order[longer], cls[longer]
            key = cls * 256 + l[order, offset - 1]
            move = np.argsort(key, kind="stable")
            order, key = order[move], key[move]
            cls = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))) if len(key) else key
        if len(order) < 2:
            break
        same = cls[1:] == cls[:-1]
        agree = np.zeros(len(order) - 1, dtype=bool)
        pairs = np.flatnonzero(same)
        agree[pairs] = minima.over(order[pairs] + 1, order[pairs + 1]) >= size - offset
        hit = np.zeros(len(order), dtype=bool)
        hit[1:] |= agree
        hit[:-1] |= agree
        found = order[hit]
        table[found, offset] = (lo[found] <= offset) & (offset <= hi[found])
        # A row without a companion of the same left side never gets one again.
        company = np.zeros(len(order), dtype=bool)
        company[1:] |= same
        company[:-1] |= same
        order, cls = order[company], cls[company]
    return table


_RUNS = "context binary, lo int, hi int"


def _runs_of(contexts: list[bytes], far: list[bool], table: np.ndarray, half: int) -> pa.RecordBatch:
    """Runs of repeated offsets, counted from the anchor again."""
    padded = np.zeros((len(table), table.shape[1] + 2), dtype=np.int8)
    padded[:, 1:-1] = table
    edge = np.diff(padded, axis=1)
    rows, lo = np.nonzero(edge == 1)
    _, hi = np.nonzero(edge == -1)
    shift = np.where(np.asarray(far, dtype=bool)[rows], half, 0) if len(rows) else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([contexts[k] for k in rows], pa.binary()), pa.array((lo + shift).astype(np.int32)),
         pa.array((hi - 1 + shift).astype(np.int32))],
        ["context", "lo", "hi"],
    )


def _induced(size: int, chunk: int = 20_000):
    """Sorted contexts to runs of repeated windows, whole groups at a time; contexts seen twice are partners only."""
    half = (size - SEED) // 2

    def settle(rows: pa.Table) -> pa.RecordBatch:
        col = lambda name: rows.column(name).to_pylist()
        pair = np.stack((np.asarray(col("key")), np.asarray(col("far")).astype(np.int64)), axis=1)
        group = np.cumsum(np.concatenate(([0], (pair[1:] != pair[:-1]).any(axis=1))))
        lo, hi = np.maximum(0, np.asarray(col("lo"))), np.asarray(col("hi"))
        table = induce(group, col("right"), col("left"), lo, hi, size)
        table &= (np.asarray(col("n")) == 1)[:, None]
        return _runs_of(col("context"), col("far"), table, half)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held else pa.Table.from_batches([batch])
            if held.num_rows >= chunk:
                keys = held.column("key").to_numpy()
                cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
                if cut:
                    yield settle(held.slice(0, cut))
                    held = held.slice(cut).combine_chunks()
        if held and held.num_rows:
            yield settle(held)

    return run


def _windows(size: int):
    """Digests of all windows of a context's range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contexts, fars, offsets, digests = [], [], [], []
            for row in batch.to_pylist():
                text = row["left"][::-1] + row["right"]
                for offset in range(max(0, row["lo"]), row["hi"] + 1):
                    start = row["hi"] - offset
                    contexts.append(row["context"])
                    fars.append(row["far"])
                    offsets.append(offset)
                    digests.append(hashlib.blake2b(text[start : start + size], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(contexts, pa.binary()), pa.array(fars, pa.bool_()), pa.array(offsets, pa.int32()), pa.array(digests, pa.binary())],
                ["context", "far", "at", "digest"],
            )

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the sorted, merged spans of each text."""
    for batch in batches:
        n, removed, spans, digests = [], [], [], []
        for text, own in zip(batch.column("raw"), batch.column("spans").to_pylist()):
            text = text.as_py()
            kept, upto = hashlib.sha256(), 0
            gone = 0
            for span in own or ():
                kept.update(text[upto : span["start"]])
                gone += span["end"] - span["start"]
                upto = span["end"]
            kept.update(text[upto:])
            n.append(len(text))
            removed.append(gone)
            spans.append(len(own or ()))
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(docs: DataFrame, size: int = SIZE, group: int = GROUP, log2_bits: int = 26) -> DataFrame:
    """(doc_id, t, spans): merged byte spans to remove, for texts that have any; t is the text's MD5."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select(F.struct("doc_id", F.unhex(F.md5(raw())).alias("t")).alias("doc"), raw().alias("raw"))
    long_enough = keyed.where(F.octet_length("raw") >= size)
    keys = long_enough.select("raw").mapInArrow(_keys(size), "key long")
    twice = materialise(
        keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "suffix-keys"
    )
    known = FixedFilter.of(twice, "key", log2_bits)
    shipped = docs.sparkSession.sparkContext.broadcast(known)  # 2**log2_bits bits at every size of the corpus

    def contexts(batches):
        yield from _contexts(size, shipped.value)(batches)

    found = materialise(long_enough.mapInArrow(contexts, _CONTEXT.format(id=id_type)), "suffix-anchors")
    # Distinct contexts with a place to read each from.
    distinct = materialise(
        found.groupBy("context").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("doc.doc_id", "doc.t", "at")).alias("place"),
            F.min("lo").alias("lo"), F.min("hi").alias("hi"), F.min("near_key").alias("near_key"), F.min("far_key").alias("far_key"),
        ),
        "suffix-contexts",
    )
    half = (size - SEED) // 2
    side = lambda far, key, lo, hi: F.struct(F.lit(far).alias("far"), F.col(key).alias("key"), lo.alias("lo"), hi.alias("hi"))
    sides = distinct.select(
        "context", "n", "place",
        F.explode(F.array(
            side(False, "near_key", F.col("lo"), F.least("hi", F.lit(half))),
            side(True, "far_key", F.greatest("lo", F.lit(half + 1)), F.col("hi")),
        )).alias("s"),
    ).select("context", "n", "place", "s.*").where("lo <= hi")
    # Keys with something left to settle: a context seen once, and company.
    groups = sides.groupBy("key", "far").agg(F.count(F.lit(1)).alias("m"), F.max((F.col("n") == 1).cast("int")).alias("open"))
    groups = groups.where("m > 1 and open = 1").select("key", "far", (F.col("m") > group).alias("big"))
    listed = (
        sides.join(groups, ["key", "far"])
        .groupBy("place.doc_id", "place.t")
        .agg(F.collect_list(F.struct("place.at", "context", "n", "far", "key", "big", "lo", "hi")).alias("items"))  # one text's
    )
    texts = keyed.select(F.col("doc.doc_id").alias("own_id"), F.col("doc.t").alias("own_t"), "raw")
    fetched = materialise(
        listed.join(texts, (F.col("t") == F.col("own_t")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
        .select("raw", "items")
        .mapInArrow(_fetch(size), _FETCHED),
        "suffix-fetched",
    )
    # A row repeated in the input is fetched twice; its contexts occur twice and are partners only.
    small = fetched.where("not big").repartition("key", "far").sortWithinPartitions("key", "far", "right")
    induced = small.mapInArrow(_induced(size), _RUNS)
    windows = fetched.where("big").select("context", "far", "lo", "hi", "right", "left").mapInArrow(
        _windows(size), "context binary, far boolean, at int, digest binary"
    )
    repeated = windows.groupBy("digest").agg(F.countDistinct("context").alias("m")).where("m > 1").select("digest")
    shift = F.when(F.col("far"), F.col("at") + half).otherwise(F.col("at"))
    counted = windows.join(repeated, "digest").select("context", shift.alias("lo"), shift.alias("hi"))
    whole = distinct.where("n > 1").select("context", "lo", "hi")
    flagged = materialise(whole.union(induced).union(counted), "suffix-flagged")
    spans = (
        found.select("doc", "at", "context").join(flagged, "context")
        .groupBy("doc")
        .agg(F.sort_array(F.collect_set(F.struct(
            (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + size).alias("end")
        ))).alias("spans"))
    )
    return spans.select("doc.doc_id", "doc.t", "spans")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for own in batch.column("spans").to_pylist():
            merged: list[list[int]] = []
            for span in own:
                if merged and span["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span["end"])
                else:
                    merged.append([span["start"], span["end"]])
            out.append([{"start": a, "end": b} for a, b in merged])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, kind)], ["key", "spans"])


def remove_repeats(docs: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    Texts are UTF-8 bytes, null is empty; windows never cross texts. Repeated rows are repeats of each other.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(docs, size, group)
    merged = spans.select(F.struct("doc_id", "t").alias("key"), "spans").mapInArrow(
        _merged, f"key struct<doc_id:{id_type},t:binary>, spans array<struct<start:long,end:long>>"
    )
    merged = materialise(merged.select(F.col("key.doc_id").alias("own_id"), F.col("key.t").alias("own_t"), "spans"), "suffix-spans")
    texts = docs.select("doc_id", F.unhex(F.md5(raw())).alias("t"), raw().alias("raw"))
    joined = texts.join(merged, (F.col("t") == F.col("own_t")) & F.col("doc_id").eqNullSafe(F.col("own_id")), "left")
    return joined.select(F.struct("doc_id").alias("key"), "raw", "spans").mapInArrow(
        _cut, f"key struct<doc_id:{id_type}>, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    ).select("key.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
