"""Classifier, vote model, slots, layout and byte-pair encoding."""

from __future__ import annotations

import hashlib
import itertools
import random
import struct
import time
import tracemalloc
import zlib

import fixtures
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txwatch.llm import bpe, layout, registry, rule_ensemble, slots, weak_rules

SAMPLE = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def test_classifier_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    scored = registry.op1_rule_ensemble(spark, SAMPLE).join(labels, "doc_id").where("held_out")
    right, total = scored.select(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert total > 50 and right / total > 0.95


def test_classifier_ignores_held_out_labels(spark):
    docs = spark.createDataFrame([(k, "some words " * (k + 1)) for k in range(20)], SCHEMA)
    held = docs.where(rule_ensemble.held_out())
    assert {r[0] for r in held.collect()} == {k for k in range(20) if zlib.crc32(str(k).encode()) % 5 == 0}
    labels = held.select("doc_id", F.lit(1).alias("quality"))
    assert rule_ensemble.learn(docs, labels) == rule_ensemble.RuleModel(0.0, ())


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 1), (2, 1), (2, 1), (99, 0)]])
def test_classifier_without_two_classes(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, ""), (None, "x")], SCHEMA).withColumn("label", F.lit(3))
    found = rule_ensemble.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(found) == 4 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in found)


def test_vote_model_learns_accuracies():
    rnd = random.Random(1)
    counts: dict[tuple[int, ...], int] = {}
    good = 0
    for _ in range(20_000):
        y = rnd.random() < 0.7
        good += y
        votes = []
        for right, cover in ((0.9, 0.9), (0.8, 0.8), (0.7, 0.9), (0.5, 0.5)):
            truth = 1 if y else -1
            votes.append((truth if rnd.random() < right else -truth) if rnd.random() < cover else 0)
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + 1
    model = weak_rules.fit(list(counts.items()), list("abcd"))
    assert model.odds["a"][1] - model.odds["a"][-1] > model.odds["b"][1] - model.odds["b"][-1] > model.odds["c"][1] - model.odds["c"][-1]
    assert abs(model.odds["d"][1] - model.odds["d"][-1]) < 0.5
    assert weak_rules.fit([], ["a"]).prior == 0.0


def test_shards(spark):
    docs = [(k, t) for k, (_, t) in enumerate(fixtures.documents() * 8)] + [(None, None), (0, "again")]
    found = slots.shard_documents(spark.createDataFrame(docs, SCHEMA), slots=256).collect()
    assert len(found) == len(docs)
    assert sorted((r["size"], r["text_crc32"]) for r in found) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in docs
    )
    total: dict[int, int] = {}
    for shard in range(8):
        own = [r for r in found if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        total[shard] = sum(r["size"] for r in own)
    assert max(total.values()) < 1.05 * sum(total.values()) / 8
    assert slots.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("hot", [None, 7])
@pytest.mark.parametrize("text", ["text {}", "same text"])
def test_one_id_of_a_third_of_the_rows_spreads(spark, hot, text):
    docs = [(hot, text.format(k).ljust(50)) for k in range(3000)] + [(k + 10, "other text".ljust(50)) for k in range(6000)]
    df = spark.createDataFrame(docs, SCHEMA)
    found = [tuple(r) for r in slots.shard_documents(df).collect()]
    total, most = [0] * 8, {}
    for doc_id, size, _, _, shard, _, _, slot, _ in found:
        total[shard] += size
        most[slot] = most.get(slot, 0) + 1
    assert len(found) == 9000 and sum(r[0] == hot for r in found) == 3000
    assert max(total) < 1.05 * sum(total) / 8 and max(most.values()) < 30
    again = slots.shard_documents(df.repartition(5)).collect()
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in again)


def test_rebalancing_moves_few_slots(spark, tmp_path):
    loads = spark.createDataFrame([(s, 10, 1000 + s % 7) for s in range(64)], "vslot int, n_rows long, n_bytes long")
    path = str(tmp_path / "map")
    slots.save_map(slots.first_map(spark, loads, 4, 64), path)
    grown = slots.rebalanced(spark, slots.load_map(spark, path), loads, 5)
    slots.save_map(grown, path)
    old = {r["slot"]: r["shard"] for r in slots.load_map(spark, path, 1).collect()}
    new = {r["slot"]: r["shard"] for r in slots.load_map(spark, path).collect()}
    moved = [s for s in old if old[s] != new[s]]
    assert 0 < len(moved) <= 64 // 5 + 1 and all(new[s] == 4 for s in moved)
    shrunk = slots.rebalanced(spark, slots.load_map(spark, path), loads, 3).collect()
    assert {r["shard"] for r in shrunk} == {0, 1, 2} and {r["version"] for r in shrunk} == {3}


PAGES = {
    "<p>One<p>Two <b>bold</b>,  spaced\n text<br>next": "One\n\nTwo bold, spaced text\nnext",
    "<head><title>no</title></head><script>x<p></script><style>y</style><div hidden>h</div><div style='display: none'>h</div>yes": "yes",
    "<ul><li>a<li>b<ol start=3><li>c</li><li>d</ol></ul>after": "- a\n- b\n  3. c\n  4. d\n\nafter",
    "<table><tr><th>Name<th>N<tr><td>x<td>10<tr><td colspan=2>wide cell</table>": "Name  N\nx     10\nwide cell",
    "<pre>a  b\n  c</pre>d": "a  b\n  c\n\nd",
    "a<div>b<div>c</div></div>d": "a\nb\nc\nd",
    "<h1>T</h1>&amp;&lt; <p></p><p> x </p>": "T\n\n&<\n\nx",
    "": "", "<![foo bar]>x": "x", "<b>un<i>closed": "unclosed", "</p></div>x": "x",
    "<table><tr><td><p>in<p>side</td></tr></table>": "in\n\nside",
    "<td>stray</td>": "stray",
}


@pytest.mark.parametrize("html", PAGES)
def test_layout(html):
    assert layout.layout_text(html) == PAGES[html]


SHOWN = {
    "<head><title>T</title><p>Hello": "Hello", "<head><meta charset=utf-8>\n <title>T</title>\nHello": "Hello",
    "<html><head><link rel=x><script>s</script><style>y</style><noscript>n</noscript><template>t</template><div>a</div>b": "a\nb",
    "<head><head><b>a</b>": "a", "<head><title>T</title></head> <body>a": "a", "<body>a<head><title>T</title>b": "ab",
    "a <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></semantics></math> b": "a x=2 b",
    "a<svg><title>t</title><desc>d</desc><style>s</style><script>j</script><text>one</text><text>two</text></svg>b": "a one two b",
    "<p>a<textarea>x  y\n <b></textarea>c": "a\nx  y\n <b>\nc",
    "<textarea>\na &amp; <i>b": "a & <i>b",
    "<p>pick <select><option>one<option>two<optgroup><option>three</select> now": "pick\none\ntwo\nthree\nnow",
    "<datalist><option>no</datalist><svg hidden><text>no</text></svg>a": "a",
}


@pytest.mark.parametrize("html", SHOWN)
def test_layout_shows_what_browsers_show(html):
    assert layout.layout_text(html) == SHOWN[html]


def test_layout_of_deep_and_long_pages():
    assert layout.layout_text("<div>" * 5000 + "x") == "x"
    assert layout.layout_text("<b>" * 5000 + "x" + "</b>" * 5000) == "x"
    assert len(layout.layout_text("<p>word " * 20_000).split()) == 20_000


class WalkedLayout(layout.Layout):
    """The same tree builder in plain words: walks over the open elements, lists indented as they close."""

    def _inside(self, tag, barrier):
        return next((e.tag == tag for e in reversed(self.stack) if e.tag in (tag, barrier)), False)

    def handle_endtag(self, tag):
        if tag == "br":
            return super().handle_endtag(tag)
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                return self._close_to(k)
            if self.stack[k].tag in layout.SCOPES and tag not in layout.REACHING:
                return None

    def _close_open(self, closing, barrier):
        lowest = None
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in barrier:
                break
            lowest = k if self.stack[k].tag in closing else lowest
        if lowest:
            self._close_to(lowest)


class IndentedFlow(layout._Flow):
    def box(self, lines, size, mark=""):
        plain = []
        for line in lines:
            plain.append((mark + line).rstrip() if not plain else " " * len(mark) + line if line else "")
        self.break_(size)
        if plain:
            self._leave_gap()
            self.lines += plain
        self.gap = max(self.gap, size)


def test_layout_equals_walks_over_the_open_elements(monkeypatch):
    rnd = random.Random(8)
    tags = (
        "p div ul ol li table tr td th caption span b body html head title textarea pre svg desc select option br hr "
        "dl dt dd thead tbody math text"
    ).split()
    pieces = [f"<{t}>" for t in tags] * 2 + [f"</{t}>" for t in tags] + ["x", "a b ", " ", "\n", "y  y"] * 8
    pages = ["".join(rnd.choices(pieces, k=rnd.randint(1, 60))) for _ in range(3000)]
    got = [layout.layout_text(page) for page in pages]
    monkeypatch.setattr(layout, "Layout", WalkedLayout)
    monkeypatch.setattr(layout, "_Flow", IndentedFlow)
    monkeypatch.setattr(layout._Table, "lines", lambda self: self._aligned(self.rows))
    assert got == [layout.layout_text(page) for page in pages]


DEEP = [
    "<b><p>y", "<ul><li>x", "<ol><li>", "<table><tr><td>x<td>y", "<table><caption>x", "<div></p>", "<svg><desc>x",
    "<dl><dd>x", "<!--", "<!-- >", "<a ", '<a b="', "</x ", "<li>x", "<td>x",
]


@pytest.mark.parametrize("unit", DEEP)
def test_time_grows_with_the_page_however_deep(unit):
    started = time.process_time()
    text = layout.layout_text(unit * 50_000)
    assert time.process_time() - started < 60  # walks over the open elements take ten minutes and more
    assert text.count("x") == (unit.count("x") * 50_000 if "desc" not in unit else 0)


def test_bounds_of_indents_columns_and_tables():
    lines = layout.layout_text("<ul><li>x" * 100).split("\n")
    assert lines[3] == "      - x" and lines[-1] == " " * layout.MOST_INDENT + "- x" and len(lines) == 100
    wide = "w" * 500
    assert layout.layout_text(f"<table><tr><td>{wide}<td>b<tr><td>c<td>d</table>") == f"{wide}  b\nc{' ' * 201}d"
    assert layout.layout_text("<table><tr><td>x<td>y" * 12).split() == ["x", "y"] * 12


def test_layout_query(spark):
    pages = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, "<p>x", 3)], "page_id long, html string, key int")
    assert sorted((r[1] for r in layout.extract_text(pages).collect())) == ["", "", "x"]
    assert layout.extract_text(pages.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(open(registry.vocabulary(), encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(registry.vocabulary())


def odd_texts():
    rnd = random.Random(3)
    chars = "aàéß ΣσςİI'sthK\x1c\x85　\x00一二½٣😀éſ\n\t!?ꟋᲉ"
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    letters = "".join(rnd.choice("aeinrst") for _ in range(30_000))
    return texts + ["", "<|endoftext|>hi<|startoftext|>", "a" * 20_000, "ab" * 9_999, "!" * 10_001, letters, "é" * 9_000]


def test_encoding_equals_the_library(vocabulary, library):
    texts = [t or "" for _, t in fixtures.documents()] + odd_texts()
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = vocabulary.encode(text)
        assert ids == want.ids
        decoder = bpe.LibraryDecoder(vocabulary)
        assert "".join(decoder.feed([i]) for i in ids) == library.decode(ids, skip_special_tokens=False)


def test_encoding_by_small_pieces_equals_the_library(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 3)
    texts = [t or "" for _, t in fixtures.documents()] + odd_texts()
    texts += ["e \u0301a \u0301 <|endoftext|> <|endoftext|>\n\r\n x  y", "ΑΣ ΑΣ\nΑΣ", " ", "\n\n"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert "".join(vocabulary.pieces(text)) == text
        assert vocabulary.encode(text) == want.ids


def test_encoding_query_by_small_blocks_equals_the_library(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 4)
    texts = [t or "" for _, t in fixtures.documents()] + ["", "one", "one two three four", "one two three four five"]
    spec = open(registry.vocabulary(), encoding="utf-8").read()
    batch = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "raw": [t.encode() for t in texts]})
    (found,) = bpe._encode(spec, True)(iter([batch]))
    for row, text in zip(found.to_pylist(), texts):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (row["ids"], row["n_tokens"]) == (ids, len(ids))
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_memory_of_encoding_does_not_grow_with_the_text(vocabulary):
    peaks = []
    for words in (50_000, 400_000):
        text = "some words of a text that goes on " * (words // 8)
        tracemalloc.start()
        decoder, ids = bpe.LibraryDecoder(vocabulary), vocabulary.stream_text(text)
        while block := list(itertools.islice(ids, bpe.BLOCK)):
            decoder.feed(block)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0]


def test_incremental_decoder_restores_words(vocabulary):
    for text in ("Hello, wörld 😀 naïve!", "一二 x", "<|endoftext|>"):
        decoder = bpe.TextDecoder(vocabulary)
        out = "".join(map(decoder.feed, vocabulary.encode(text))) + decoder.close()
        words = vocabulary.words.findall(vocabulary.normalise(text)) if "|" not in text else [text]
        assert out.split() == words


def test_lookahead_suffices_on_small_merge_lists():
    """Streaming with the computed lookahead equals merging whole words, for all short words."""
    rnd = random.Random(11)
    for _ in range(40):
        symbols, merges = ["a", "b"], []
        for _ in range(rnd.randint(1, 6)):
            pair = (rnd.choice(symbols), rnd.choice(symbols))
            if pair not in merges and pair[0] + pair[1] not in symbols:
                merges.append(pair)
                symbols.append(pair[0] + pair[1])
        small = object.__new__(bpe.Bpe)
        small.ids = {s: s for s in symbols}
        small.ranks = {m: k for k, m in enumerate(merges)}
        small.longest = max(map(len, symbols))
        small.lookahead = bpe.sufficient_lookahead(merges)
        for word in map("".join, itertools.product("ab", repeat=9)):
            word = word * 4
            assert list(small.stream(iter(word))) == small._merge(list(word))


def test_encoding_query(spark, library):
    rows = [(1, "Some text"), (None, None), (1, "Some text"), (2, "")]
    found = bpe.encode_documents(spark.createDataFrame(rows, SCHEMA).withColumn("raw", F.lit(1)), registry.vocabulary())
    assert sorted(r["ids"] for r in found.collect()) == [[], [], *[library.encode("Some text", add_special_tokens=False).ids] * 2]
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA), registry.vocabulary()).count() == 0


def test_sample_bound_holds_for_repeated_ids(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"some text number {k}") for k in range(300)] + [(2, "other text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, quality int")
    seen, keep = [], rule_ensemble.materialise
    monkeypatch.setattr(rule_ensemble, "materialise", lambda df, name: seen.append(keep(df, name)) or seen[-1])
    rule_ensemble.learn(docs, labels, sample_rows=10)
    assert [t.count() for t in seen] == [10]
    scored = rule_ensemble.classify(docs.limit(0), labels)
    assert scored.count() == 0 and rule_ensemble.classify(docs, labels.limit(0)).count() == 301
