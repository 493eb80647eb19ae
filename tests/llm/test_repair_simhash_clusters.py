"""Conversation repair, covering SimHash and the bisector tournament against plain Python."""

from __future__ import annotations

import random
from itertools import combinations

import brute
import duckdb
import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F

from txwatch.llm import centroids, conversations, registry, simhash

SAMPLE = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
REPORT = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
#: Columns that clash with names the operators use themselves.
CLASHES = "place segment at fault initial same symbols audit entry edit n nth fp code path cluster x h distance raw component".split()


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def expected(answer):
    return sorted(map(tuple, answer), key=repr)


def odd_turns(seed=1):
    rnd = random.Random(seed)
    texts = ["Yes.", "yes", " \t", "", None, "Why?", "no end", "Tail. \n", "é!", "a", "b."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "sage", "uncle"]
    table = [(c, t, rnd.choice(roles), rnd.choice(texts)) for c in range(60) for t in range(rnd.randint(0, 12))]
    table += [(c, t, ("user", "assistant")[t % 2], f"turn {t}.") for c in range(60, 80) for t in range(rnd.randint(1, 9))]
    table += [(100, None, "user", "x."), (100, None, "assistant", "y."), (100, 5, "user", "x."), (100, 5, "user", "x.")]
    table += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, None, None), (None, 2, "user", "b.")]
    table += [(101, 7, "user", "same.")] * 40 + [(102, t, "user", "long run.") for t in range(300)]
    table += [(103, t, ("user", "assistant")[t % 2], f"{t}") for t in range(400)]
    return table


@pytest.fixture(scope="module")
def turns(spark):
    return clashing(spark.createDataFrame(odd_turns(), TURNS).repartition(5))


@pytest.mark.parametrize("bits", [16, 3, 1])
def test_conversations(turns, monkeypatch, bits):
    monkeypatch.setattr(conversations, "SEGMENT_BITS", bits)
    found = conversations.damaged_and_repaired(turns)
    assert rows(found, *REPORT) == expected(brute.repaired_conversations(odd_turns()))


def test_conversations_of_the_sample(spark):
    found = registry.queries()["op11_path_ranking"](spark, SAMPLE)
    given = duckdb.sql(f"select conv_id, turn, role, text from '{SAMPLE}/conversations.parquet'").fetchall()
    assert rows(found, *REPORT) == expected(brute.repaired_conversations(given))


def test_repaired_rows_follow_the_pattern(turns):
    report, fixed = conversations.repair(turns)
    costs = {r["conv_id"]: r for r in report.collect()}
    by_conv = {}
    for r in sorted(fixed.collect(), key=lambda r: (r["place"], r["nth"])):
        by_conv.setdefault(r["conv_id"], []).append(r)
    for conv, lines in by_conv.items():
        initials = "".join(r["role"][0] for r in lines)
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2) and len(initials) > 1
        assert [r["edit"] for r in lines] == [x for x in costs[conv]["audit"] if x != "D"]
        assert all((r["text"] == "") == (r["edit"] == "I") for r in lines)
    assert all(set(r["audit"]) <= {"D"} for c, r in costs.items() if c not in by_conv)


def test_ranks_order_nodes_as_their_audits():
    rnd = np.random.default_rng(3)
    sizes = np.array([5, 0, 9, 1, 9])
    pieces = conversations._Pieces(rnd.integers(0, 16, sizes.sum()), sizes)
    ranking = conversations.Ranking(pieces, np.tile(conversations._RIGHT_END, (5, 1)), np.ones(5, dtype=bool))
    nodes = np.arange(len(ranking.rank))
    found, _ = ranking.audits(nodes)
    assert all((found[a] < found[b]) == (ranking.rank[a] < ranking.rank[b]) for a, b in combinations(nodes, 2))


def test_no_conversations(spark):
    nothing = spark.createDataFrame([], TURNS)
    assert conversations.damaged_and_repaired(nothing).count() == 0
    dropped = next(t for t in range(10**4) if brute.zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    found = conversations.damaged_and_repaired(spark.createDataFrame([(1, dropped, "user", "a.")], TURNS))
    assert rows(found, *REPORT) == [(1, 0, 0, 0, 0, 0, 0, "", brute.sha(""))]


def test_masks_cover_every_small_set():
    masks = simhash._next_masks([0], 3)
    assert len(masks) == 15 and all(30 <= m.bit_count() <= 36 for m in masks)
    rnd = random.Random(2)
    for _ in range(3000):
        apart = sum(1 << b for b in rnd.sample(range(64), 3))
        assert any(not m & apart for m in masks)
    third = simhash._next_masks(simhash._next_masks(masks, 3), 3)
    assert all(64 - m.bit_count() <= simhash.LEAF for m in third)
    for fixed in masks[:3]:
        left = [b for b in range(64) if not fixed >> b & 1]
        more = simhash.covering(left, 3)
        assert all(any(not m & sum(1 << b for b in some) for m in more) for some in combinations(left, 3))


def cloud():
    """Chains and dense groups of fingerprints, with some far from all."""
    rnd = random.Random(9)
    found = {0, 1, 7, (1 << 64) - 1}
    for _ in range(3):
        centre = rnd.getrandbits(64)
        some = rnd.sample(range(64), 12)
        found |= {centre ^ sum(1 << b for b in rnd.sample(some, rnd.randint(0, 6))) for _ in range(250)}
        at = centre
        for _ in range(30):
            at ^= sum(1 << b for b in rnd.sample(range(64), rnd.choice([3, 3, 4])))
            found.add(at)
    return sorted(found | {rnd.getrandbits(64) for _ in range(100)})


@pytest.mark.parametrize("light", [32, 2])
def test_links_connect_what_is_close(spark, light):
    codes = cloud()
    df = spark.createDataFrame([(simhash._signed(c),) for c in codes], "fp long")
    edges = [(r["a"], r["b"]) for r in simhash.links(df, light=light).collect()]
    parent = {simhash._signed(c): simhash._signed(c) for c in codes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    want = brute.closest_groups(codes)
    names = {}
    for code, group in zip(codes, want):
        names.setdefault(find(simhash._signed(code)), set()).add(group)
    assert all(len(g) == 1 for g in names.values()) and len(names) == len(set(want))


@pytest.mark.parametrize("which", ["fixture", "sample"])
def test_simhash_groups(spark, which):
    corpus = fixtures.documents() if which == "fixture" else duckdb.sql(
        f"select doc_id, text from '{SAMPLE}/documents.parquet'").fetchall()
    if which == "fixture":
        corpus += [(2, "To " * 91), (2, "\x0b \r"), (1, "Mixed  CASE\twords here"), (50, "mixed case words HERE")]
    found = simhash.near_duplicates(clashing(spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)))
    codes = [brute.fingerprint64(t) for _, t in corpus]
    groups, lowest = brute.closest_groups(codes), {}
    for (d, _), g in zip(corpus, groups):
        lowest[g] = min(d, lowest.get(g, d))
    want = [(d, f"{c:016x}", lowest[g]) for (d, _), c, g in zip(corpus, codes, groups)]
    assert rows(found, "doc_id", "fingerprint", "component_id") == expected(want)


def test_simhash_of_odd_tables(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = [(None, None), (None, ""), (9, "one two three four"), (None, "one two three four"), (9, "one two three four"), (None, "lone text")]
    found = simhash.near_duplicates(spark.createDataFrame(odd, "doc_id long, text string"))
    want = [(d, f"{brute.fingerprint64(t):016x}", 9 if t and "four" in t else None) for d, t in odd]
    assert rows(found, *found.columns) == expected(want)
    long = " ".join(f"w{k % 977}" for k in range(200_000))
    assert simhash.fingerprint(long.encode()) == brute.fingerprint64(long)


def vectors():
    rnd = np.random.default_rng(4)
    made = np.concatenate([rnd.normal(m, 0.2, (60, 64)) for m in (-0.4, 0.0, 0.3)]).astype("float32").tolist()
    table = list(enumerate(made))
    table += [(500, made[0]), (500, made[0]), (501, [0.5] * 64), (None, made[7])] + [(600 + k, made[3]) for k in range(90)]
    bad = [(700, None), (701, []), (702, made[1][:63]), (703, made[1] + [0.0]), (704, [None] + made[1][:63]),
           (705, [float("nan")] + made[1][:63]), (706, [float("inf")] + made[1][:63]), (707, made[1][:63] + [float("-inf")])]
    return table + bad


COLUMNS = "vec_id cluster distance cluster_inertia inertia centroid_sha256".split()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_clusters(spark, kind):
    df = clashing(spark.createDataFrame(vectors(), f"vec_id long, embedding array<{kind}>").repartition(4))
    found = centroids.report(*centroids.cluster(df))
    assert rows(found, *COLUMNS) == expected(brute.clusters(vectors()))


def test_sign_tests_agree_with_distances_and_ties_go_to_the_smaller_number():
    rnd = np.random.default_rng(8)
    c = rnd.integers(-3, 4, (9, 5))
    c[4] = c[1]
    x = rnd.integers(-4, 5, (5000, 5))
    test = centroids.Tournament(c)
    apart = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    best = test.winners(x)
    assert (best == apart.argmin(axis=1)).all() and (test.distances(x, best) == apart.min(axis=1)).all()
    assert ((apart == apart.min(axis=1)[:, None]).sum(axis=1) > 1).any() and not (best == 4).any()


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    three = [(k, [k / 7] * 64) for k in range(3)]
    found = centroids.report(*centroids.cluster(spark.createDataFrame(three, schema)))
    assert rows(found, *COLUMNS) == expected(brute.clusters(three))
    for nothing in ([], [(1, None), (2, [1.0])]):
        found = centroids.report(*centroids.cluster(spark.createDataFrame(nothing, schema)))
        assert found.count() == 0 and sorted(found.columns) == sorted(COLUMNS)
    with pytest.raises(Exception, match="exceeds"):
        centroids.cluster(spark.createDataFrame([(1, [1e9] * 64)], schema))
