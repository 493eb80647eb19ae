"""The whole pipeline against a brute-force version in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import brute
import corpus_pipeline
import duckdb
import fixtures
import pytest
from tokenizers import Tokenizer

from txwatch.llm import decontaminate, graph, near, registry, secrets, weak_rules
from txwatch.session import materialise

SAMPLE = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TABLE = "doc_id long, text string, lang string, source string, n_chars long"
STOCK = re.compile(r"(?i)^(?:example|sample|dummy|changeme|placeholder|your|x{4,}|0{4,}|123456?7?8?9?0?|abcdef|[_.-])+$")


def votes(text):
    words = brute.WORD.findall(text)
    (_, n, chars, symbols, dup, repeats, _), = brute.base_rules([(0, text)])
    count = lambda pattern: len(re.findall(pattern, text))
    upper, shouts, stops = count("[A-Z]"), count("[!?]"), count("[.,;:]")
    words_, chars_ = max(n, 1), max(chars, 1)
    length = chars / words_
    bad = lambda test: -1 if test else 0
    return (
        bad(symbols / words_ > 0.15), bad(symbols / chars_ > 0.03), bad(upper / chars_ > 0.3), bad(shouts / words_ > 0.2),
        bad(repeats / words_ > 0.15), bad(len(set(words)) / words_ < 0.25 and words_ < 3000), bad(dup / words_ > 0.02),
        bad(length > 9.5 or length < 2.5),
        int(symbols / chars_ < 0.01 and shouts / words_ < 0.05 and upper / chars_ < 0.15 and repeats / words_ < 0.05),
        int(0.03 < stops / words_ < 0.4 and 3 < length < 9),
    )


def good(docs):
    cast = [votes(d["text"] or "") for d in docs]
    rules = list(map(str, range(10)))
    model = weak_rules.fit([(v, cast.count(v)) for v in set(cast)], rules)
    for d, v in zip(docs, cast):
        odds = model.prior + sum(model.odds[r][x] for r, x in zip(rules, v))
        failed = brute.base_rules([(0, d["text"])])[0][-1]
        if not failed and 1 / (1 + math.exp(-max(-500, min(500, odds)))) >= 0.5:
            yield d


def values(text):
    """(start of value, end, value, whether it can be live) of candidates of every kind."""
    key = "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    for m in re.finditer(rf"""{key}["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            yield m.start(1), m.end(), m[1], not STOCK.search(m[1])
    for pattern in ("AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"):
        for m in re.finditer(pattern, text):
            yield m.start(), m.end(), m[0], not STOCK.search(m[0])
    for m in re.finditer("[A-Za-z0-9_-]{20,}", text):
        if all(re.search(p, m[0]) for p in ("[A-Z]", "[a-z]", "[0-9]")):
            yield m.start(), m.end(), m[0], len(set(m[0])) >= 8 and not STOCK.search(m[0])


def without_secrets(docs):
    owners, repositories = defaultdict(set), defaultdict(set)
    for d in docs:
        for _, _, value, _ in values(d["text"] or ""):
            owners[value].add(d["source"] or "")
            repositories[value].add((d["source"] or "", d["lang"] or ""))
    for d in docs:
        text, out, upto = d["text"] or "", "", 0
        for a, b, value, can in sorted(values(text)):
            if can and len(owners[value]) <= 2 and len(repositories[value]) <= 4:
                if a >= upto:
                    out += text[upto:a] + "[SECRET]"
                upto = max(upto, b)
        yield d | {"text": out + text[upto:]} if upto else d


def expected(docs, items):
    docs = list(good(docs))
    kept = {d for d, _, _, keep in brute.near([(k, d["text"]) for k, d in enumerate(docs)], 5) if keep}
    docs = [d for k, d in enumerate(docs) if k in kept]
    hit = {k for k, *_, bad in brute.contamination([(k, d["text"]) for k, d in enumerate(docs)], items) if bad}
    docs = list(without_secrets([d for k, d in enumerate(docs) if k not in hit]))
    library = Tokenizer.from_file(registry.vocabulary())
    return sorted((d["doc_id"], library.encode(d["text"] or "", add_special_tokens=False).ids) for d in docs)


def write(spark, folder, docs, items):
    spark.createDataFrame(docs, TABLE).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


@pytest.mark.parametrize("kind", ["fixture", "sample"])
def test_pipeline_equals_brute_force(spark, tmp_path, kind):
    if kind == "sample":
        docs = duckdb.sql(f"select {', '.join(COLUMNS)} from '{SAMPLE}/documents.parquet' order by doc_id").fetchall()
        items = duckdb.sql(f"select item_id, text from '{SAMPLE}/benchmark.parquet'").fetchall()
    else:
        docs = [(d, t, "en", f"s{d % 5}", len(t or "")) for d, t in fixtures.documents()]
        items = fixtures.ITEMS
    write(spark, str(tmp_path), docs, items)
    found = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "ids").collect()
    assert sorted((r["doc_id"], r["ids"]) for r in found) == expected([dict(zip(COLUMNS, d)) for d in docs], items)


def test_ownership_decides_for_all_base_values(spark, tmp_path):
    alone = ["hunter2hunter2", "abcdefgh", "horsestaple", "918273645546372819", "kR7000012345tQzLmN8", "s3cr3t"]
    texts = [(f"password={v} end", "s1") for v in alone] + [("é key zR7kP0000wQ9sLmN4tVx end", "s1"), ("deadbeef" * 3 + " end", None)]
    copied = [(f"token: {v} end", f"s{k}") for v in ("hunter3hunter3", "zzzzzzzz") for k in range(3)]
    stock = [("secret=changeme end", "s1"), ("secret=xxxxxxxx end", "s1"), ("api_key=your-example end", "s1"), ("token=12345678 end", "s1")]
    docs = [(k, t, "en", s, len(t)) for k, (t, s) in enumerate(texts + copied + stock)]
    # A stock phrase inside a random value does not make it an example; many repositories of one owner do.
    inside = "see aB3dE5gH7jK9your1pQ3rS5tU7 end"
    spread = [(100 + k, "password=spreadspread end", f"l{k}", "s1", 25) for k in range(5)]
    docs += [(99, inside, "en", "s1", len(inside)), *spread]
    found = corpus_pipeline.secret_scan(spark, spark.createDataFrame(docs, TABLE), "").orderBy("doc_id").collect()
    want = ["password=[SECRET] end"] * len(alone) + ["é key [SECRET] end", "[SECRET] end"] + [t for t, _ in copied + stock]
    want += ["see [SECRET] end"] + [t for _, t, *_ in spread]
    assert [r["text"] for r in found] == want
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    write(spark, str(tmp_path), docs, [])
    listed = {r["doc_id"]: (r["spans"], r["held_by"]) for r in registry.queries()["op9_ownership_scan"](spark, str(tmp_path)).collect()}
    sql = duckdb.connect()
    sql.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    answer = sql.execute(registry.oracle_sql()["op9_ownership_scan"])
    names = [d[0] for d in answer.description]
    assert listed == {r[0]: (r[names.index("spans")], r[names.index("held_by")]) for r in answer.fetchall()}
    assert listed[99] == ("mixed:4:30", "1/1") and listed[100] == ("assign:0:21", "1/5")


def test_stages_keep_columns_and_stand_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    docs = spark.createDataFrame([], TABLE)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == COLUMNS, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "secret_scan", "tokenise"
    ]


def test_no_table_that_grows_with_the_documents_is_broadcast(spark, tmp_path, monkeypatch):
    docs = [(d, t, "en", f"s{d % 5}", len(t or "")) for d, t in fixtures.documents()]
    write(spark, str(tmp_path), docs, fixtures.ITEMS)
    plans = []

    def note(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return materialise(df, name)

    for module in (corpus_pipeline, decontaminate, graph, near, secrets):
        monkeypatch.setattr(module, "materialise", note)
    light = near.near_duplicates
    monkeypatch.setattr(near, "near_duplicates", lambda rows: light(rows, light=2))  # lists beyond it are dealt out too
    corpus_pipeline.run(spark, str(tmp_path))
    assert {"near-prefixes", "near-alive", "near-links", "pipeline-near_dedup", "pipeline-secret_scan", "pointers"} <= {name for name, _ in plans}
    sent = {(name, keys) for name, plan in plans for keys in re.findall(r"BroadcastHashJoin \[([^]]*\]?)\]", plan)}
    # The benchmark's chosen windows may be.
    assert all(name == "pipeline-decontamination" and re.fullmatch(r"token#\d+L", keys) for name, keys in sent)


def test_a_table_of_exploded_signatures_is_not_broadcast(spark):
    rnd = random.Random(3)
    n = 15_000
    rows = [(k, " ".join(str(rnd.randrange(10**6)) for _ in range(8))) for k in range(n)]
    spark.conf.set("spark.sql.maxBroadcastTableSize", "40m")  # its 32 x n posts take more, its file less than 10 MB
    try:
        found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.where("kept").count() == n
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
