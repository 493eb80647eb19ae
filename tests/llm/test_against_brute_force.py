"""Operators against plain-Python answers, on the fixture and on the smallest sample."""

from __future__ import annotations

import brute
import duckdb
import fixtures
import pytest
from pyspark.sql import functions as F

from txwatch.llm import archive, decontaminate, near, registry, secrets, suffixes, weak_rules

SAMPLE = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
#: Columns that clash with names the operators use themselves.
CLASHES = "key raw row n cls digest posts s m hits spans row_ found_ context at t value lang source".split()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def expected(answer):
    return sorted(answer, key=repr)


def sample(name, *columns):
    return duckdb.sql(f"select {', '.join(columns)} from '{SAMPLE}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module", params=["fixture", "sample"])
def corpus(request):
    return fixtures.documents() if request.param == "fixture" else sample("documents", "doc_id", "text")


@pytest.fixture(scope="module")
def docs(spark, corpus):
    df = spark.createDataFrame(corpus, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, corpus, size):
    found = near.near_duplicates(docs, shingle=size)
    assert rows(found, "doc_id", "n_shingles", "component_id", "kept") == expected(brute.near(corpus, size))


@pytest.mark.parametrize("group", [2000, 1])
def test_repeats_by_both_routes(docs, corpus, group):
    found = suffixes.remove_repeats(docs, group=group)
    assert rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected(brute.repeats(corpus))


def test_repeats_across_segments(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 64)
    corpus = [(1, "abc" * 10 + "".join(map(chr, range(200, 400))) + "x"), (2, "".join(map(chr, range(200, 400))) * 2), (3, None)]
    data = [t.encode() for _, t in corpus if t]
    for text in data:
        pieces = list(suffixes.segments(text, 200))
        assert sum(len(p) - 199 for _, p in pieces) == len(text) - 199
    at = [{a.at[k] + s for s, p in suffixes.segments(text, 200) for a in [suffixes.Anchors(p, 200)] for k in range(len(a.at))} for text in data]
    monkeypatch.setattr(suffixes, "SEGMENT", 1 << 20)
    assert at == [{int(x) for _, p in suffixes.segments(text, 200) for x in suffixes.Anchors(p, 200).at} for text in data]


def test_base_rules(docs, corpus):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = weak_rules.judge(docs)
    assert rows(judged, *names) == expected(brute.base_rules(corpus))
    assert judged.where("base_failed and kept").isEmpty()
    kept = sorted(r[0] for r in judged.where("kept").select("doc_id").collect())
    passed = weak_rules.keep_good(docs)
    assert sorted(r[0] for r in passed.select("doc_id").collect()) == kept
    assert passed.columns == docs.columns


def test_contamination(spark, docs, corpus):
    items = spark.createDataFrame(fixtures.ITEMS, "item_id long, text string")
    found = decontaminate.contamination(docs, items).select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("sha"), (F.size("hits") > 0).alias("hit"),
    )
    want = [
        (d, n, h, len(ids := [i for i in items_ if i != "None"]), brute.sha(",".join(ids)), hit)
        for d, n, h, items_, hit in _contamination_items(corpus)
    ]
    assert rows(found, *found.columns) == expected(want)


def _contamination_items(corpus):
    """The brute-force rows with the items themselves, so that null ids can be left out."""
    for row in corpus:
        (d, n, h, _, _, hit), = brute.contamination([row], fixtures.ITEMS)
        found = [str(i) for i in {x[0] for x in fixtures.ITEMS} if brute.contamination([row], [x for x in fixtures.ITEMS if x[0] == i])[0][5]]
        yield d, n, h, sorted(found), hit


def test_base_secrets(docs, corpus):
    found = secrets.find_secrets(docs)
    got = found.select(
        "doc_id", *[secrets.n_of(F.col("spans"), k).alias(k) for k in secrets.BASE],
        F.sha2(secrets.listed(secrets.base_only(F.col("spans"))), 256).alias("sha"),
    )
    assert rows(got, *got.columns) == expected(brute.base_secrets(corpus))


def test_archive(spark, tmp_path):
    pages = spark.createDataFrame(fixtures.pages(), "page_id long, url string, html string")
    archive.write_archive(pages, str(tmp_path / "a"))
    records = archive.read_archive(spark, str(tmp_path / "a")).cache()
    refers = F.when(F.col("record_type") == "revisit", F.col("refers_to").cast("long"))
    got = records.select("page_id", "n_bytes", "payload_digest", "record_type", refers.alias("r"))
    assert rows(got, *got.columns) == expected(brute.warc([(p, h) for p, _, h in fixtures.pages()]))
    stored = spark.read.parquet(str(tmp_path / "a" / "payloads"))
    assert stored.count() == len({h or "" for _, _, h in fixtures.pages()})
    for r in records.collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and head.count(b"WARC-Type") == 1
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert rest[length:] == b"\r\n\r\n" and rest[:length] == (bytes(r["payload"]) if r["record_type"] == "response" else b"")
    archive.export_warc(records, str(tmp_path / "w"))
    assert spark.read.format("binaryFile").load(str(tmp_path / "w")).count() >= 1


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_archive_with_null_ids(spark, tmp_path, kind):
    pages = [(None, None, ""), (4, "u", ""), (3, "u", None), (None, "n", "alone"), (None, "m", "alone"), (5, "u", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("page_id", F.col("page_id").cast(kind))
    df = df.union(df.where("page_id = 5").select(F.lit("null" if kind == "string" else "6").cast(kind), "url", "html"))
    df.write.parquet(str(tmp_path / "pages.parquet"))
    found = {(str(r[0]), r[1], r[3], r[4] and str(r[4])) for r in registry.queries()["op6_content_archive"](spark, str(tmp_path)).collect()}
    other = "null" if kind == "string" else "6"
    assert found == {
        ("None", 0, "revisit", "3"), ("3", 0, "response", None), ("4", 0, "revisit", "3"), ("None", 5, "response", None),
        ("5", 1, "response", None), (other, 1, "revisit", "5"),
    }
    archive.write_archive(df, str(tmp_path / "a"))
    records = archive.read_archive(spark, str(tmp_path / "a"), kind)
    assert {r[0] for r in records.where("page_id is null and n_bytes = 0").select("refers_to").collect()} == {"3"}
    assert records.where("page_id is null and header not like '%<urn:no-page>%'").isEmpty()


def test_archive_query_rebuilds_records(spark, tmp_path):
    """What the query selects cannot be had without the bytes of the rebuilt records."""
    spark.createDataFrame(fixtures.pages(), "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = registry.queries()["op6_content_archive"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "concat(header" in plan and found.count() == len(fixtures.pages())


def test_damaged_archive_is_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "good")], "page_id long, url string, html string")
    archive.write_archive(pages, str(tmp_path / "a"))
    bad = spark.read.parquet(str(tmp_path / "a" / "payloads")).withColumn("payload", F.lit(b"evil"))
    bad.write.parquet(str(tmp_path / "b" / "payloads"))
    spark.read.parquet(str(tmp_path / "a" / "headers")).write.parquet(str(tmp_path / "b" / "headers"))
    with pytest.raises(Exception, match="digest"):
        archive.read_archive(spark, str(tmp_path / "b")).collect()


def test_sql_counterparts(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings"):
        connection.execute(f"create view {name} as select * from '{SAMPLE}/{name}.parquet'")
    for name, sql in registry.oracle_sql().items():
        got = registry.queries()[name](spark, SAMPLE)
        answer = connection.execute(sql)
        names = [d[0] for d in answer.description]
        assert sorted(names) == sorted(got.columns), name
        assert rows(got, *names) == expected(answer.fetchall()), name


EMPTY = {
    "near": lambda d, _: near.near_duplicates(d),
    "suffixes": lambda d, _: suffixes.remove_repeats(d),
    "rules": lambda d, _: weak_rules.judge(d),
    "keep": lambda d, _: weak_rules.keep_good(d),
    "contamination": lambda d, b: decontaminate.contamination(d, b),
    "secrets": lambda d, _: secrets.find_secrets(d.withColumns({"source": F.lit("a"), "lang": F.lit("b")})),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_tables_and_null_ids(spark, name):
    items = spark.createDataFrame([], "item_id long, text string")
    nothing = spark.createDataFrame([], SCHEMA)
    assert EMPTY[name](nothing, items).count() == 0
    long = "some words that make a text of more than two hundred bytes " * 6
    odd = spark.createDataFrame([(None, None), (None, long), (None, long), (7, long), (7, "other words in a text"), (7, None)], SCHEMA)
    if name != "keep":
        assert EMPTY[name](odd, items).count() == 6


def test_null_page_ids_equal_sql(spark, tmp_path):
    pages = [(None, None, ""), (4, "u", ""), (3, "u", None), (None, "n", "alone"), (None, "m", "alone"), (5, "u", "x")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    sql = duckdb.connect()
    sql.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    answer = sql.execute(registry.oracle_sql()["op6_content_archive"])
    names = [d[0] for d in answer.description]
    assert rows(registry.queries()["op6_content_archive"](spark, str(tmp_path)), *names) == expected(answer.fetchall())


@pytest.mark.parametrize("n", [40, 2999, 3000, 30_000])
def test_small_vocabularies_are_bad_at_every_length(spark, n):
    import random

    rnd = random.Random(n)
    poor = " ".join(rnd.choice([f"w{k}" for k in range(5)]) for _ in range(n))
    rich = " ".join(f"w{rnd.randrange(n)}" for _ in range(n))
    df = spark.createDataFrame([(1, poor), (2, rich)], SCHEMA)
    stats = df.select("doc_id", weak_rules.statistics(F.coalesce("text", F.lit(""))).alias("s"))
    cast = {r[0]: r[1] for r in stats.select("doc_id", weak_rules.votes(F.col("s"))["vocabulary"]).collect()}
    assert cast == {1: -1, 2: 0}


def test_texts_that_are_not_utf8(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    raw = [(1, b"x \xff\xfe one two three four five six seven eight nine ten \xc3"), (2, b"\xff")]
    docs = spark.createDataFrame(raw, "doc_id long, b binary").selectExpr("doc_id", "cast(b as string) as text")
    found = decontaminate.contamination(docs, items)
    assert {r["doc_id"]: len(r["hits"]) > 0 for r in found.collect()} == {1: True, 2: False}


def test_near_duplicates_of_a_wide_group_with_null_ids(spark):
    """A big group whose members are far from each other, a passage that many share, a third of the ids null."""
    import random

    rnd = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    base = [rnd.choice(words) for _ in range(60)]
    corpus = []
    for k in range(70):
        text = list(base)
        for _ in range(rnd.randint(0, 9)):
            text[rnd.randrange(60)] = rnd.choice(words)
        corpus.append((k, " ".join(text)))
    corpus += [(100 + k, " ".join(base[:25] + [rnd.choice(words) for _ in range(20)])) for k in range(40)]
    corpus += [(None, t) for _, t in corpus[::2]]
    found = near.near_duplicates(spark.createDataFrame(corpus, SCHEMA), shingle=2)
    want = brute.near([(10**6 + k if d is None else d, t) for k, (d, t) in enumerate(corpus)], 2)
    shown = lambda d: None if d is None or d >= 10**6 else d
    plain = [(shown(d), n, shown(c)) for d, n, c, _ in want]
    assert rows(found, "doc_id", "n_shingles", "component_id") == expected(plain)


def _wide(seed, members, spread):
    """Copies of one text with up to `spread` of its 80 words changed, and texts that share its first third."""
    import random

    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    base = [rnd.choice(words) for _ in range(80)]
    corpus = []
    for k in range(members):
        text = list(base)
        for _ in range(rnd.randint(0, spread)):
            text[rnd.randrange(80)] = rnd.choice(words)
        corpus.append((k, " ".join(text[: rnd.randint(70, 80)])))
    return corpus + [(1000 + k, " ".join(base[:30] + [rnd.choice(words) for _ in range(40)])) for k in range(members // 4)]


@pytest.mark.parametrize("size", [2, 5])
@pytest.mark.parametrize("light", [1, 6, 10**6])
def test_near_duplicates_by_short_and_long_lists(spark, size, light):
    corpus = _wide(11, 80, 14) + _wide(12, 30, 3)
    corpus = [(k, t) for k, (_, t) in enumerate(corpus)]
    found = near.near_duplicates(spark.createDataFrame(corpus, SCHEMA), shingle=size, light=light)
    assert rows(found, "doc_id", "n_shingles", "component_id", "kept") == expected(brute.near(corpus, size))


def test_far_members_of_a_large_group_make_no_pairs(spark, monkeypatch):
    """Texts that are similar to their group, but not similar enough, are not compared with each of its members."""
    probed = []
    confirmed = near._Search.confirmed

    def counted(self, pairs, *more):
        probed.append(pairs.count())
        return confirmed(self, pairs, *more)

    monkeypatch.setattr(near._Search, "confirmed", counted)
    corpus = _wide(13, 240, 14)
    found = near.near_duplicates(spark.createDataFrame(corpus, SCHEMA), shingle=2)
    assert rows(found, "doc_id", "n_shingles", "component_id", "kept") == expected(brute.near(corpus, 2))
    assert sum(probed) < 4000, probed
