"""Byte-pair encoding as a streaming transducer with bounded lookahead, and incremental decoding.

Merges apply in rank order, so a token may depend on symbols to its right: a merge is taken or not because a
better-ranked one took part of it, and so on. Along such a chain ranks fall strictly, and neighbours overlap
as strings. `sufficient_lookahead` follows all chains that the merge list allows and returns how many symbols
to the right can matter. A word is encoded from a window: tokens that end at least that many symbols before
the window's end are final and are emitted; the rest stays and is refilled. Beyond the text itself, memory is
bounded by the lookahead, the longest token and a piece of PIECE characters up to the next space, not by the text;
a run without spaces is held once. A word that fits into the window is merged in one go. Ids are decoded and
hashed block by block as they come.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.llm.text import raw

#: Characters normalised at a time, and ids packed, decoded and hashed at a time.
PIECE, BLOCK = 1 << 16, 1 << 13
#: Code points of symbols that end a word lie this much higher.
_END = 0x10000
#: Runs without spaces kept with their tokens by each worker.
CACHE_CHUNKS = 400_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


# Lower-case forms of Unicode 16 and 17, which the library knows and the interpreter does not.
LATER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
LATER_LOWER |= {0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LATER_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
# Letters and digits of Unicode 17, which are symbols to the library.
LATER_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
]


def _newer_letters() -> str:
    """A character class of LATER_LETTERS."""
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in LATER_LETTERS) + "]"


def _symbols(token: str, end: str) -> str:
    """A vocabulary entry as one character per symbol."""
    if end and token.endswith(end) and len(token) > len(end):
        body = token[: -len(end)]
        return body[:-1] + chr(ord(body[-1]) + _END)
    return token


def sufficient_lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """How many symbols to the right of a boundary can decide about it, for merges in rank order.

    reach(w) bounds how far left of the first difference a merge making w can carry it: either w itself
    touches the unknown text, or a proper suffix of w overlaps the start of an earlier-ranked merge's result.
    """
    by_prefix: dict[str, int] = {}
    whole: dict[str, int] = {}
    most = 0
    for left, right in merges:
        w = left + right
        reach = len(w) - 1
        for cut in range(1, len(w)):
            suffix = w[cut:]
            beyond = max(
                by_prefix.get(suffix, 0), max((whole.get(suffix[:k], 0) for k in range(1, len(suffix) + 1)), default=0)
            )
            reach = max(reach, cut + beyond if beyond else 0)
        for k in range(1, len(w) + 1):
            by_prefix[w[:k]] = max(by_prefix.get(w[:k], 0), reach)
        whole[w] = max(whole.get(w, 0), reach)
        most = max(most, reach)
    return most


class Bpe:
    """A vocabulary read from a `tokenizers` JSON file of the word-end BPE kind."""

    def __init__(self, spec: dict):
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        self.ids = {_symbols(t, end): i for t, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(_symbols(a, end), _symbols(b, end)) for a, b in merges]
        self.ranks = {m: k for k, m in enumerate(self.merges)}
        self.longest = max(map(len, self.ids))
        self.lookahead = sufficient_lookahead(self.merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # White space is the Unicode property.
        pattern = pattern.replace(r"\s", r"\p{White_Space}")
        self.words = regex.compile(pattern, regex.V1)
        newer = _newer_letters()
        self.newer = regex.compile(newer, regex.V1)
        for name in ("L", "N"):
            pattern = pattern.replace(rf"[\p{{{name}}}]", rf"[\p{{{name}}}--{newer}]")
        others = r"[^\p{White_Space}\p{L}\p{N}]"
        self.words_exact = regex.compile(pattern.replace(others, f"[{newer}{others}]"), regex.V1)
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        self.alphabet = byte_alphabet()
        self.table = {b: c for b, c in enumerate(self.alphabet)}
        self.cache: dict[str, list[int]] = {}
        self.gap = regex.compile("[ \n]")
        #: A special token with white space in it may stand across a cut, so such texts stay whole.
        self.whole = any(c.isspace() for name in self.special for c in name)

    def normalise(self, text: str) -> str:
        """NFC and lower case, character by character (no final-sigma rule)."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _merge(self, symbols: list[str]) -> list[str]:
        """Merge by rank, leftmost first, with a queue of candidate pairs over a linked list."""
        n = len(symbols)
        if n < 2:
            return symbols
        ranks = self.ranks
        if n <= 64:
            get, none = ranks.get, len(ranks)
            pairs = [get(pair, none) for pair in zip(symbols, symbols[1:])]
            while pairs and (best := min(pairs)) < none:
                k = pairs.index(best)
                symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
                del pairs[k]
                if k:
                    pairs[k - 1] = get((symbols[k - 1], symbols[k]), none)
                if k < len(pairs):
                    pairs[k] = get((symbols[k], symbols[k + 1]), none)
            return symbols
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, k) for k in range(n - 1) if (r := ranks.get((symbols[k], symbols[k + 1]), -1)) >= 0]
        heapq.heapify(queue)
        while queue:
            rank, k = heapq.heappop(queue)
            j = after[k]
            if not symbols[k] or j >= n or ranks.get((symbols[k], symbols[j]), -1) != rank:
                continue
            symbols[k] += symbols[j]
            symbols[j] = ""
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (r := ranks.get((symbols[k], symbols[after[k]]), -1)) >= 0:
                    heapq.heappush(queue, (r, k))
            if before[k] >= 0 and (r := ranks.get((symbols[before[k]], symbols[k]), -1)) >= 0:
                heapq.heappush(queue, (r, before[k]))
        return [s for s in symbols if s]

    def stream(self, symbols: Iterator[str]) -> Iterator[int]:
        """Token ids of one word, given its symbols one by one; ids come out once they are final."""
        room = 2 * (self.lookahead + self.longest)
        window: list[str] = []
        for symbol in symbols:
            window.append(symbol)
            if len(window) >= room:
                sure, done = len(window) - self.lookahead, 0
                for token in self._merge(list(window)):
                    if done + len(token) > sure:
                        break
                    done += len(token)
                    yield self.ids[token]
                del window[:done]
        for token in self._merge(window):
            yield self.ids[token]

    def word(self, word: str) -> list[int]:
        """Tokens of one word of the pattern."""
        last = len(data := word.encode()) - 1
        closing = chr(ord(self.alphabet[data[last]]) + _END)
        if last < 64:  # the whole word fits into the window
            return [self.ids[t] for t in self._merge([self.alphabet[b] for b in data[:last]] + [closing])]
        return list(self.stream(closing if k == last else self.alphabet[b] for k, b in enumerate(data)))

    def chunk(self, chunk: str) -> Iterator[int]:
        """Tokens of a run without spaces; no word of the pattern reaches beyond one."""
        text, words = chunk, self.words
        if not chunk.isascii():
            text = chunk.translate(LATER_LOWER)
            words = self.words_exact if self.newer.search(text) else words
        if len(chunk) > 64:
            for found in words.finditer(text):
                yield from self.word(found.group())
            return
        if len(self.cache) >= CACHE_CHUNKS:
            self.cache.clear()
        known = self.cache[chunk] = [i for word in words.findall(text) for i in self.word(word)]
        yield from known

    def pieces(self, text: str) -> Iterator[str]:
        """A text in pieces of PIECE characters and up to the next space or line break. Neither composes with a
        neighbour nor stands inside a word, so pieces are normalised and encoded on their own."""
        at = 0
        while at < len(text):
            found = None if self.whole else self.gap.search(text, at + PIECE)
            cut = found.start() if found else len(text)
            yield text[at:cut]
            at = cut

    def stream_text(self, text: str) -> Iterator[int]:
        """Ids of a text, as they become final; the strings of special tokens become those tokens."""
        get, chunk = self.cache.get, self.chunk
        for piece in self.pieces(text):
            for part in self.split.split(piece) if self.split else [piece]:
                if part in self.special:
                    yield self.special[part]
                    continue
                for run in self.normalise(part).replace("\n", " ").split(" "):
                    if run:
                        known = get(run)
                        yield from chunk(run) if known is None else known

    def encode(self, text: str) -> list[int]:
        """All ids of a text."""
        return list(self.stream_text(text))


class LibraryDecoder:
    """Token ids to the library's text, id by id: without a decoder in its file it sets the vocabulary's strings
    side by side with a space between. The state is whether an id has come before."""

    def __init__(self, bpe: Bpe):
        self.names, self.lead = bpe.names, ""

    def feed(self, tokens: Iterable[int]) -> str:
        """The text that some further ids add."""
        body = " ".join(map(self.names.__getitem__, tokens))
        if not body:
            return ""
        lead, self.lead = self.lead, " "
        return lead + body


class TextDecoder:
    """Token ids to readable text, id by id: bytes whose character is not complete yet are held back.

    Each word is followed by one space. At most three bytes and nothing else are kept between calls.
    """

    def __init__(self, bpe: Bpe, end: str = "</w>"):
        self.bpe, self.end = bpe, end
        self.bytes = {c: b for b, c in enumerate(bpe.alphabet)}
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: int) -> str:
        name = self.bpe.names[token]
        if name in self.bpe.special:
            return self.state.decode(b"", final=True) + name + " "
        closes = name.endswith(self.end) and name != self.end
        body = name[: -len(self.end)] if closes else name
        data = bytes(self.bytes[c] for c in body)
        return self.state.decode(data, final=closes) + " " * closes

    def close(self) -> str:
        return self.state.decode(b"", final=True)


@lru_cache(maxsize=2)
def load(spec: str) -> Bpe:
    """The vocabulary of a JSON text; each worker builds it once."""
    return Bpe(json.loads(spec))


def _encode(spec: str, keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        bpe = load(spec)
        for batch in batches:
            n, ids_hash, text_hash, kept = [], [], [], []
            for data in batch.column("raw"):
                count, id_sha, text_sha, blocks = 0, hashlib.sha256(), hashlib.sha256(), []
                decoder, ids = LibraryDecoder(bpe), bpe.stream_text(data.as_py().decode("utf-8", "replace"))
                while block := list(islice(ids, BLOCK)):
                    packed = np.asarray(block, dtype="<u4")
                    count += len(block)
                    id_sha.update(packed.tobytes())
                    text_sha.update(decoder.feed(block).encode())
                    if keep:
                        blocks.append(packed.astype(np.int32))
                n.append(count)
                ids_hash.append(id_sha.hexdigest())
                text_hash.append(text_sha.hexdigest())
                if keep:
                    kept.append(np.concatenate(blocks) if blocks else np.empty(0, np.int32))
            columns = [batch.column("key"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode_documents(docs: DataFrame, vocabulary: str, keep_ids: bool = True) -> DataFrame:
    """Encode and decode every row of `docs` (doc_id, text): doc_id, n_tokens, digests and, if asked, `ids`.

    `vocabulary` is the path of a tokenizer file, or of a copy in any store Spark can read. It is read as one
    small text (its size is that of a vocabulary, not of the corpus) and shipped with the tasks. A null or
    empty text has no tokens. Row order and repeated rows do not matter; there is no shuffle.
    """
    spec = "\n".join(r[0] for r in docs.sparkSession.read.text(vocabulary, wholetext=True).collect())
    shipped = docs.sparkSession.sparkContext.broadcast(spec)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"key struct<doc_id:{id_type}>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""

    def run(batches):
        yield from _encode(shipped.value, keep_ids)(batches)

    keyed = docs.select(F.struct("doc_id").alias("key"), raw().alias("raw"))
    rest = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids
    return keyed.mapInArrow(run, schema).select("key.doc_id", *rest)
