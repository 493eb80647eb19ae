"""Secret scans with corpus-wide ownership frequency (DataFrame functions only).

Candidates come from regular expressions. Their values are hashed, and for every hash the distinct
repositories and owners that hold it are counted over the whole corpus. A value that many owners hold is a
copied example; a value that stays with few owners is a live credential. Matches of the added kind must look
random too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwatch.session import materialise

#: kind: (pattern, the group that holds the value, characters the value needs, cheap test that any match passes).
KINDS: dict[str, tuple[str, int, int, str]] = {
    "assign": (
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1, 6,
        r"""(?i:passwo?r?d|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""",
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    "hex": (r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
    # Added by the method, only where ownership says live: long tokens of mixed characters.
    "mixed": (r"[A-Za-z0-9_-]{20,}", 0, 20, r"[A-Za-z0-9_-]{20}"),
}
BASE = ("assign", "access", "hex")
MAX_OWNERS = 2
#: A live value has at most so many holders: owners, and repositories of theirs.
MAX_REPOSITORIES = 4
#: Values made of nothing but fragments of copied examples.
ALL_STOCK = r"(?i)^(?:example|sample|dummy|changeme|placeholder|your|x{4,}|0{4,}|123456?7?8?9?0?|abcdef|[_.-])+$"


def _matches(text: Column, kind: str) -> Column:
    """Matches of one kind in order: the code points before it since the last one, its length, its value."""
    pattern, group, _, test = KINDS[kind]
    pattern_lit = F.lit(pattern)
    zipped = F.zip_with(
        F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern_lit, 0), lambda g, w: F.struct(g.alias("g"), w.alias("w"))),
        F.regexp_extract_all(text, pattern_lit, group),
        lambda m, value: F.struct(
            F.lit(kind).alias("kind"), F.char_length(m["g"]).alias("gap"), F.char_length(m["w"]).alias("len"), value.alias("value")
        ),
    )
    # The piece after the last match has no match of its own.
    found = F.filter(zipped, lambda m: m["value"].isNotNull())
    none = F.array().cast("array<struct<kind:string,gap:int,len:int,value:string>>")
    return F.when(text.rlike(test), found).otherwise(none)


def _passes() -> Column:
    """Whether a match counts, by kind."""
    size, value = F.char_length("value"), F.col("value")
    varied = value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]")
    return F.when(F.col("kind") == "mixed", varied).otherwise(
        size >= F.when(F.col("kind") == "assign", 6).when(F.col("kind") == "access", 20).otherwise(24)
    )


def looks_random(value: Column) -> Column:
    """16 characters or more, letters and digits, eight different characters."""
    chars = F.size(F.array_distinct(F.split(value, "")))
    return (F.char_length(value) >= 16) & value.rlike("[A-Za-z]") & value.rlike("[0-9]") & (chars >= 8)


def find_secrets(
    docs: DataFrame, owner: str = "source", repository: str = "lang", max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES, keep_text: bool = True,
) -> DataFrame:
    """All rows of `docs` with all their columns and `spans`: sorted (start, rank, kind, end, value_start, live, owners,
    repositories).

    Offsets are code points, the end exclusive. A value that at most `max_owners` owners hold, in at most
    `max_repositories` repositories together, is `live` unless it is made of stock phrases alone; of the added kind
    `mixed` it must look random. Base kinds stay, live or not; a match of `mixed` stays if it is live. Both
    frequencies are counted over the whole corpus. `owner` names the column of the owner; a repository is an owner's
    value of `repository`. Null owners count as one owner, null repositories as one of their owner's. A null text has
    no spans. A column named spans is replaced. Without `keep_text` the text is neither stored on the way nor returned.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*[_matches(text, kind) for kind in KINDS])
    scanned = docs.withColumn("_secret_row", F.monotonically_increasing_id()).withColumn("_secret_found", found)
    base = materialise(scanned if keep_text else scanned.drop("text"), "secret-candidates")
    matches = base.where(F.size("_secret_found") > 0).select(
        "_secret_row", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"), F.posexplode("_secret_found").alias("k", "m"),
    ).select("_secret_row", "owner", "repository", "k", "m.*")
    # Every match, failing ones too, moves the next one's start.
    before = Window.partitionBy("_secret_row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        matches.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before))
        .where(_passes())
        .select(
            "_secret_row", "owner", "repository", "kind", "end", (F.col("end") - F.col("len")).alias("start"),
            (F.col("end") - F.char_length("value")).alias("value_start"),
            F.sha2(F.col("value").cast("binary"), 256).alias("hash"),
            (~F.col("value").rlike(ALL_STOCK) & (F.col("kind").isin(*BASE) | looks_random(F.col("value")))).alias("candidate"),
        )
    )
    placed = materialise(placed, "secret-places")
    # Distinct owners first, each step combined before its shuffle: a value held a million times is a few rows.
    holders = placed.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = holders.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    frequency = by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
    # Stored, so that the join can split the places of a value held everywhere.
    frequency = materialise(frequency, "secret-frequency")
    rank = F.lit(len(KINDS))
    for k, kind in enumerate(KINDS):
        rank = F.when(F.col("kind") == kind, k).otherwise(rank)
    judged = placed.join(frequency.hint("merge"), "hash").withColumn(
        "live", F.col("candidate") & (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    ).where(F.col("kind").isin(*BASE) | F.col("live"))
    per_row = judged.groupBy("_secret_row").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end", "value_start", "live", "owners", "repositories"))).alias("spans")
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,value_start:bigint,live:boolean,owners:bigint,repositories:bigint>>")
    return (
        base.drop("_secret_found", "spans").join(per_row.hint("merge"), "_secret_row", "left").withColumn("spans", F.coalesce("spans", none)).drop("_secret_row")
    )


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE))


def frequencies(spans: Column) -> Column:
    """owners/repositories that hold each span's value, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("/", s["owners"], s["repositories"])), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with the values of live spans replaced; overlapping values get one mark."""
    live = F.filter(spans, lambda s: s["live"])
    ordered = F.sort_array(F.transform(live, lambda s: F.struct(s["value_start"].alias("a"), s["end"].alias("b"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("upto"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["upto"] + 1).cast("int"), (s["a"] - acc["upto"]).cast("int"))
        fresh = s["a"] >= acc["upto"]
        return F.struct(
            F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["upto"], s["b"]).alias("upto"),
        )

    whole = F.aggregate(
        ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["upto"] + 1).cast("int"), F.char_length(text)))
    )
    return F.when(F.size(live) > 0, whole).otherwise(text)
