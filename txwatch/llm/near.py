"""MinHash near-duplicates by an inverted join over signature coordinates.

1. Texts with equal shingle sets are one class; only classes take part, so exact copies cost nothing more.
2. Every class is posted under each of its K (coordinate, value) pairs. Posts that no other class has are
   dropped: they cannot collide.
3. Two classes with Jaccard similarity of at least 0.8 agree in at least MATCHES of the K coordinates but for
   a chance below 1e-5 (binomial tail). So they share one of their K - MATCHES + 1 rarest posts: only these
   prefixes are merged, and the long lists behind them are skipped.
4. Inside a posting list, members are first compared with one pivot per size band, the one whose posts are most
   often shared, and what is confirmed becomes one component. Lists of one component are done. In those of at most
   LIGHT members the members of different components are compared with each other.
5. The members of longer lists are posted again, under the rarest of their shingles: two sets similar enough share
   one so early in both that the rest can still hold the overlap they need. Each post names its own size step and
   every step that a partner may have from that place on, and only posts that name each other meet. A copy whose
   changes are too many for any partner has no post left that meets one. Pivots come first here too, those with the
   fewest rare shingles; then what is not in a key's largest component is compared with the rest of the key. No pair
   similar enough is lost by this.
6. Candidates are probed by comparing the two signatures and confirmed on the full shingle sets of texts fetched
   once per class.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from txwatch.llm.graph import components
from txwatch.llm.text import U64, mix, raw
from txwatch.session import materialise

COORDINATES = 32
MATCHES = 15
#: Members of a posting list up to which they are compared with each other; moves work between steps only.
LIGHT = 16
#: Ratio of the set sizes of two neighbouring size steps.
STEP = 1.03
#: Odd multipliers, one per coordinate, from a fixed seed.
_MULTIPLIERS = np.random.default_rng(20240229).integers(0, 2**63, COORDINATES, dtype=np.uint64) * U64(2) + U64(1)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of `size` words; with fewer words, of the whole sequence."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=U64)
    codes = np.fromiter(map(xxh3_64_intdigest, words), dtype=U64, count=len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, dtype=U64)
    for k in range(size):
        total = mix(total * U64(0x9E3779B97F4A7C15) + codes[k : k + n])
    return np.unique(total)


def signature(found: np.ndarray) -> np.ndarray:
    """Per coordinate the smallest 31 bits of the multiplied hashes, with the coordinate in the high bits."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=U64)
    for start in range(0, len(found), 4096):
        low = np.minimum(low, (found[start : start + 4096, None] * _MULTIPLIERS).min(axis=0))
    return ((low >> U64(33)) | (np.arange(COORDINATES, dtype=U64) << U64(32))).view(np.int64)


def _digest(found: np.ndarray) -> bytes:
    return blake2b(found.tobytes(), digest_size=16).digest()


def _summaries(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, signatures = [], [], []
            for text in batch.column("raw"):
                found = shingle_set(text.as_py(), size)
                counts.append(len(found))
                digests.append(_digest(found))
                signatures.append(signature(found) if len(found) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.list_(pa.int64()))],
                ["key", "n", "digest", "posts"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text.as_py(), size).view(np.int64) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(found, pa.list_(pa.int64()))], ["cls", "set"])

    return run


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = b"", np.empty(0, dtype=U64)
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if ta != last:
                    last, left = ta, shingle_set(ta, size)
                right = shingle_set(tb, size)
                same = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * same >= percent * (len(left) + len(right) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _close(percent: int) -> Column:
    """Whether two set sizes allow the similarity."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _enough(percent: int) -> Column:
    """Whether two sets of which `left` shingles remain from a common one on can still overlap enough."""
    return F.least("left_a", "left_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent


def _step(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(STEP)))


class _Search:
    def __init__(self, docs: DataFrame, size: int, percent: int, matches: int, light: int):
        self.size, self.percent, self.matches, self.light = size, percent, matches, light
        self.texts = docs.select("doc_id", raw().alias("text"))
        id_type = docs.schema["doc_id"].dataType.simpleString()
        key = F.struct("doc_id", F.monotonically_increasing_id().alias("row"), F.unhex(F.md5(raw())).alias("t"))
        summaries = materialise(
            docs.select(key.alias("key"), raw().alias("raw"))
            .mapInArrow(_summaries(size), f"key struct<doc_id:{id_type},row:long,t:binary>, n long, digest binary, posts array<long>")
            .select("key.*", "n", "digest", "posts"),
            "near-summaries",
        )
        classes = summaries.where("n > 0").groupBy("digest").agg(F.min("row").alias("cls"))
        self.members = materialise(
            summaries.join(classes.hint("merge"), "digest", "left").withColumn("cls", F.coalesce("cls", "row")), "near-members"
        )
        self.classes = self.members.where("row = cls and n > 0")

    def prefixes(self) -> DataFrame:
        """(token, cls, n, weight): the rarest posts of each class that has enough shared posts to match at all."""
        posts = self.classes.select("cls", "n", F.explode("posts").alias("token"))
        shared = posts.groupBy("token").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
        ranked = (
            posts.join(shared.hint("merge"), "token")
            .groupBy("cls", "n")
            .agg(F.sort_array(F.collect_list(F.struct("seen", "token"))).alias("found"))  # at most COORDINATES
            .where(F.size("found") >= self.matches)
        )
        # The unshared posts come first in the order by rarity and use up places of the prefix.
        take = F.size("found") - F.lit(self.matches - 1)
        weight = F.aggregate("found", F.lit(0.0), lambda total, f: total + F.log(f["seen"]))
        kept = ranked.select("cls", "n", weight.alias("weight"), F.explode(F.slice("found", F.lit(1), take)).alias("f"))
        return materialise(kept.select(F.col("f.token").alias("token"), "cls", "n", "weight"), "near-prefixes")

    def own_texts(self, wanted: DataFrame) -> DataFrame:
        """(cls, text) of the wanted classes: the text of each is fetched once, by id and checksum."""
        about = materialise(self.classes.join(wanted.distinct().hint("merge"), "cls", "left_semi").select("cls", "doc_id", "t"), "near-wanted")
        own = self.texts.select(F.col("doc_id").alias("own"), F.unhex(F.md5("text")).alias("own_t"), "text")
        fetched = own.join(about.hint("merge"), F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("t") == F.col("own_t")))
        return materialise(fetched.select("cls", "text").dropDuplicates(["cls"]), "near-texts")

    def confirmed(self, pairs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
        """Of (a, b) class pairs those whose signatures agree often enough and whose sets are similar enough."""
        about = self.classes.select("cls", "posts")
        for side in ("a", "b"):
            own = about.select(F.col("cls").alias(side), F.col("posts").alias(f"posts_{side}"))
            pairs = pairs.join(own.hint("merge"), side)
        agree = pairs.where(F.size(F.array_intersect("posts_a", "posts_b")) >= self.matches)
        rows = materialise(agree.select("a", "b"), "near-candidates")
        if texts is None:
            texts = self.own_texts(rows.select(F.col("a").alias("cls")).union(rows.select("b")))
        for side in ("b", "a"):
            own = texts.select(F.col("cls").alias(side), F.col("text").alias(f"text_{side}"))
            rows = rows.join(own.hint("merge"), side)
        return materialise(rows.mapInArrow(_confirm(self.size, self.percent), "a long, b long"), "near-links")

    def star(self, lists: DataFrame) -> DataFrame:
        """Pairs (a, b) of the pivot of each list and size band with the other members."""
        band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / self.percent))).alias("band")
        banded = lists.select("token", "cls", "n", "weight", band)
        pivots = banded.groupBy("token", "band").agg(F.max(F.struct("weight", "cls", "n")).alias("p"))
        return (
            banded.join(pivots.hint("merge"), ["token", "band"])
            .select(F.col("p.cls").alias("a"), F.col("p.n").alias("n_a"), F.col("cls").alias("b"), F.col("n").alias("n_b"))
            .where((F.col("a") != F.col("b")) & _close(self.percent))
            .select("a", "b")
            .distinct()
        )

    def shingle_posts(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """(token, own, other, left, cls, n, weight, component): the members (cls, n, component) under each of
        their rarest shared shingles and each size step of a partner that they can have from there on, where `left`
        shared shingles remain. Only posts whose key holds both sides of a pair of components are returned."""
        sets = materialise(texts.mapInArrow(_sets(self.size), "cls long, set array<long>"), "near-sets")
        rows = members.join(sets.hint("merge"), "cls").select("cls", "n", "component", F.explode("set").alias("token"))
        seen = rows.groupBy("token").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
        # What nobody shares comes first in the order by rarity and uses up places.
        found = rows.join(seen.hint("merge"), "token").groupBy("cls", "n", "component").agg(
            F.sort_array(F.collect_list(F.struct("seen", "token"))).alias("found")  # one document's shingles
        )
        least = F.ceil(F.col("n") * self.percent / 100)  # shingles of the smallest partner, all of them shared
        take = F.greatest(F.size("found") - least + 1, F.lit(0)).cast("int")
        # The fewer of its shingles are rare, the nearer a set is to the middle of its group.
        weight = F.aggregate("found", F.lit(0.0), lambda total, f: total + F.log(f["seen"])) / F.col("n")
        rarest = materialise(
            found.select("cls", "n", "component", weight.alias("weight"), F.size("found").alias("shared"),
                         F.slice("found", F.lit(1), take).alias("rarest")),
            "near-rarest",
        )
        placed = rarest.select("*", F.posexplode("rarest").alias("place", "f"))
        left = (F.col("shared") - F.col("place")).alias("left")
        posted = placed.select(F.col("f.token").alias("token"), left, "cls", "n", "weight", "component")
        most = F.floor(F.col("left") * (100 + self.percent) / self.percent) - F.col("n")  # of the largest partner
        dealt = posted.select(
            "*", _step(F.col("n")).alias("own"), F.explode(F.sequence(_step(least), _step(most))).alias("other")
        ).select("*", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        key = ["token", "low", "high"]
        alive = dealt.groupBy(key).agg(
            F.min("own").alias("first"), F.max("own").alias("last"), F.min("component").alias("one"), F.max("component").alias("two")
        ).where("first = low and last = high and one < two")
        return materialise(dealt.join(alive.select(key).hint("merge"), key), "near-alive")

    def _meeting(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs (a, b) of posts that name each other's size step, of different components and with enough left."""
        about = ("cls", "n", "left", "component")
        a = left.select("token", "own", "other", *[F.col(c).alias(f"{c}_a") for c in about])
        b = right.select("token", F.col("own").alias("other"), F.col("other").alias("own"), *[F.col(c).alias(f"{c}_b") for c in about])
        pairs = a.join(b.hint("merge"), ["token", "own", "other"]).where(
            (F.col("component_a") != F.col("component_b")) & _close(self.percent) & _enough(self.percent)
        )
        return pairs.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct()

    def shingle_star(self, posts: DataFrame) -> DataFrame:
        """Pairs (a, b) of every post with the pivot of those that it names."""
        pivots = posts.groupBy("token", "own", "other").agg(F.max(F.struct("weight", "cls", "n", "left", "component")).alias("p"))
        return self._meeting(posts, pivots.select("token", "own", "other", "p.*"))

    def shingle_pairs(self, posts: DataFrame) -> DataFrame:
        """Pairs (a, b) of different components: what is outside a key's largest component with all that it names."""
        key = ["token", "low", "high"]
        counts = posts.groupBy(*key, "component").agg(F.count(F.lit(1)).alias("rows"))
        main = counts.groupBy(key).agg(F.max(F.struct("rows", "component")).alias("m")).select(*key, F.col("m.component").alias("main"))
        return self._meeting(posts.join(main.hint("merge"), key).where("component <> main"), posts)

    def links(self) -> DataFrame:
        """(node, component) over classes that have a partner."""

        def placed(rows: DataFrame) -> DataFrame:
            labels = components(edges).withColumnRenamed("node", "cls")
            return rows.drop("component").join(labels.hint("merge"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))

        lists = self.prefixes()
        edges = self.confirmed(self.star(lists))
        grouped = materialise(placed(lists), "near-grouped")
        # Lists whose members are one component have nothing left to compare.
        mixed = grouped.groupBy("token").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")
        ).where("low < high")
        open_lists = materialise(grouped.join(mixed.select("token", "members").hint("merge"), "token"), "near-open")
        short = open_lists.where(F.col("members") <= self.light)
        sides = [short.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("cls", "n", "component")]) for s in "ab"]
        across = (
            sides[0].join(sides[1].hint("merge"), "token")
            .where("cls_a < cls_b and component_a <> component_b")
            .where(_close(self.percent))
            .select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"))
        )
        long = open_lists.where(F.col("members") > self.light).select("cls", "n", "component").distinct()
        if not long.isEmpty():
            texts = self.own_texts(long.select("cls"))
            posts = self.shingle_posts(long, texts)
            edges = edges.union(self.confirmed(self.shingle_star(posts), texts))
            across = across.union(self.shingle_pairs(materialise(placed(posts), "near-placed-again")))
        return components(edges.union(self.confirmed(across.distinct())))


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, matches: int = MATCHES, light: int = LIGHT
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than white space, A-Z in lower case. Sets whose intersection is at least
    `percent` % of their union are linked; component_id is the smallest doc_id reachable. A text without words
    has no shingles and no links. Repeated rows are exact copies; with several doc_ids null, nulls are ignored
    for component_id unless a component has nothing else. `light` moves work between steps and never changes the
    result.
    """
    search = _Search(docs, shingle, percent, matches, light)
    labels = search.links()
    placed = search.members.join(labels.withColumnRenamed("node", "cls").hint("merge"), "cls", "left").select(
        "row", "doc_id", "n", F.coalesce("component", "cls").alias("component")
    )
    placed = materialise(placed, "near-placed")
    # Stored, so that the join can split the rows of a large component.
    lowest = materialise(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")), "near-lowest")
    return placed.join(lowest.hint("merge"), "component").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
