"""Plain-Python answers for small tables, written from the contracts alone."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def near(docs, size=2, percent=80):
    sets = []
    for _, text in docs:
        words = WORD.findall(ascii_lower(text or ""))
        if len(words) < size:
            sets.append({tuple(words)} if words else set())
        else:
            sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)})
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            by_shingle[g].append(k)
    for k, s in enumerate(sets):
        shared = Counter(j for g in s for j in by_shingle[g] if j < k)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(k)] = find(j)
    lowest = {}
    for k, (doc_id, _) in enumerate(docs):
        lowest[find(k)] = min(lowest.get(find(k), doc_id), doc_id)
    return sorted((d, len(sets[k]), lowest[find(k)], d == lowest[find(k)]) for k, (d, _) in enumerate(docs))


def repeats(docs, size=200):
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i : i + size] for _, b in data for i in range(len(b) - size + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return sorted(out)


def base_rules(docs):
    out = []
    for d, t in docs:
        t = t or ""
        words = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        count = Counter(runs)
        covered = {i + k for i, r in enumerate(runs) if count[r] > 1 for k in range(5)}
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        out.append(
            (d, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed)
        )
    return sorted(out)


def warc(pages):
    first = {}
    for p, html in pages:
        data = (html or "").encode()
        first[data] = min(first.get(data, p), p)
    out = []
    for p, html in pages:
        data = (html or "").encode()
        response = first[data] == p
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((p, len(data), digest, "response" if response else "revisit", None if response else first[data]))
    return sorted(out)


def contamination(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = BENCH_WORD.findall(ascii_lower(text or ""))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for d, text in docs:
        words = BENCH_WORD.findall(ascii_lower(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[w]
        out.append((d, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out)


def base_secrets(docs):
    letters = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    key = "|".join(map(letters, ["password", "passwd", "secret", "token", "api_?key"]))
    kinds = [
        ("assign", re.compile(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    out = []
    for d, text in docs:
        spans = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(kinds) for m in p.finditer(text or "") if ok(m)]
        count = Counter(s[2] for s in spans)
        out.append((d, count["assign"], count["access"], count["hex"], sha(",".join(f"{n}:{a}:{b}" for a, _, n, b in sorted(spans)))))
    return sorted(out)


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


def repaired_conversations(table):
    """Damage and cheapest repair of (conv_id, turn, role, text) rows by a search over whole audits."""
    white = " \t\n\x0b\x0c\r"
    known = lambda v: " " if v is None else str(v)
    rows = defaultdict(list)
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{known(conv)}:{known(turn)}".encode()) % 20
        role, text = known(role), known(text)
        own = rows[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in rows.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in own:
            last = text.rstrip(white)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[1][:1] for r in own]
        best = {"": (0, "", ())}  # by the initials' state: cost, audit, lines; least audit of all cheapest ones

        def after(state, letter):
            allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            return letter if letter and letter in allowed else None

        def put(table, state, entry):
            if state is not None and (state not in table or entry[:2] < table[state][:2]):
                table[state] = entry

        def inserted(table):
            for _ in range(3):
                for state, (cost, audit, lines) in list(table.items()):
                    for role in ("user", "assistant"):
                        put(table, after(state, role[0]), (cost + 2, audit + "I", (*lines, f"{role}:")))
            return table

        for (_, role, text), fault in zip(own, faults):
            fresh = {}
            for state, (cost, audit, lines) in inserted(best).items():
                put(fresh, state, (cost + 3, audit + "D", lines))
                if fault in ("blank", "duplicate"):
                    continue
                more = fault == "truncated"
                put(fresh, after(state, role[:1]), (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    put(fresh, after(state, other[0]), (cost + 2 + more, audit + "R", (*lines, f"{other}:{text}")))
            best = fresh
        best = inserted(best)
        cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, sha("\n".join(lines)),
        ))
    return out


def fingerprint64(text, size=3):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    codes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), seed=42) for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(c >> bit & 1 for c in codes) > len(codes))


def closest_groups(codes, radius=3):
    """The smallest index reachable over pairs of codes that differ in at most `radius` bits."""
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(codes))]


def clusters(vectors, k=8, rounds=10, width=64):
    """Lloyd rounds over (vec_id, embedding) in Python integers."""
    import math

    kept = [(i, [math.floor(1024 * float(v)) for v in e]) for i, e in vectors
            if e is not None and len(e) == width and all(v is not None and math.isfinite(v) for v in e)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"3:{r[0]}"), r[1]))[:k]
    centroids = [x for _, x in first]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in kept:
            members[nearest(x)[1]].append(x)
        centroids = [[sum(v) // len(members[n]) for v in zip(*members[n])] if members[n] else c for n, c in enumerate(centroids)]
    placed = [(i, *nearest(x)) for i, x in kept]
    return [(i, n, d, sum(e for _, e, m in placed if m == n), sum(e for _, e, _ in placed), sha(",".join(map(str, centroids[n]))))
            for i, d, n in placed]
