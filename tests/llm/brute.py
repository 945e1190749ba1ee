"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^ \t-\r]+")
LAST = (1 << 63) - 1  # the place of a null doc_id


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def base_counts(text: str | None) -> tuple[int, ...]:
    own = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    times, hit = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            hit.update(range(i, i + 8))
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(own), sum(map(len, own)), symbols, dup, len(hit)


def without_windows(docs: list[tuple], size: int = 13) -> list[tuple]:
    """(doc_id, words, removed, kept words) after removal of windows that start in a smaller id."""
    place = [LAST if i is None else i for i, _ in docs]
    first: dict[tuple, int] = {}
    for at, (_, text) in zip(place, docs):
        own = words(text)
        for i in range(len(own) - size + 1):
            window = tuple(own[i : i + size])
            first[window] = min(at, first.get(window, at))
    out = []
    for at, (doc_id, text) in zip(place, docs):
        own, gone = words(text), set()
        for i in range(len(own) - size + 1):
            if first[tuple(own[i : i + size])] < at:
                gone.update(range(i, i + size))
        out.append((doc_id, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return out


def without_strings(docs: list[tuple], size: int = 400, keep: str = "none") -> list[tuple]:
    """(doc_id, bytes, removed, runs, kept bytes); ``first`` keeps the earliest of each string."""
    data = [(i, (t or "").encode()) for i, t in docs]
    order = sorted(range(len(data)), key=lambda k: LAST if data[k][0] is None else data[k][0])
    times, first = Counter(), {}
    for k in order:
        for a in range(len(data[k][1]) - size + 1):
            string = data[k][1][a : a + size]
            times[string] += 1
            first.setdefault(string, (k, a))
    out = []
    for k, (doc_id, own) in enumerate(data):
        gone = bytearray(len(own))
        for a in range(len(own) - size + 1):
            string = own[a : a + size]
            if times[string] > 1 and (keep == "none" or first[string] != (k, a)):
                gone[a : a + size] = b"\1" * size
        kept = bytes(c for c, g in zip(own, gone) if not g)
        out.append((doc_id, len(own), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return out


def shingles(text: str | None, size: int = 5) -> frozenset:
    own = words(text)
    if 0 < len(own) < size:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def groups(n: int, links: list[tuple[int, int]]) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def jaccard_classes(docs: list[tuple], similar: float = 0.8) -> list[tuple]:
    """(doc_id, class_id, n_links, component_id) of each row."""
    sets = [shingles(t) for _, t in docs]
    ids = [LAST if i is None else i for i, _ in docs]
    links = [
        (a, b)
        for a in range(len(docs)) for b in range(a)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b])
    ]
    same, least = defaultdict(lambda: LAST), defaultdict(lambda: LAST)
    for i, s in zip(ids, sets):
        same[s] = min(same[s], i)
    roots = groups(len(docs), links)
    for i, root in zip(ids, roots):
        least[root] = min(least[root], i)
    degree = Counter(x for link in links for x in link)
    real = lambda x: None if x == LAST else x
    return [
        (doc[0], real(same[s] if s else i), degree[k], real(least[root] if s else i))
        for k, (doc, s, i, root) in enumerate(zip(docs, sets, ids, roots))
    ]


# --- resampling, lines, spelling ------------------------------------------------------------

_GRAM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def gram_buckets(text: str | None, buckets: int = 10_000) -> tuple[int, list[int]]:
    own = _GRAM_WORD.findall(ascii_lower(text or ""))
    features = own + [f"{a} {b}" for a, b in zip(own, own[1:])]
    return len(own), [zlib.crc32(f.encode()) % buckets for f in features]


def resampled(docs: list[tuple], target: list[str | None], per_cent: int = 25, least: int = 20) -> list[tuple]:
    """(doc_id, n_features, weight, score, rank) of each row; equal rows in any order."""
    grams = [gram_buckets(t) for _, t in docs]
    source, wanted = [0] * 10_000, [0] * 10_000
    for _, buckets in grams:
        for b in buckets:
            source[b] += 1
    for text in target:
        for b in gram_buckets(text)[1]:
            wanted[b] += 1
    S, T = sum(source), sum(wanted)
    gain = [math.floor(1000 * math.log(((t + 1) * (S + 10_000)) / ((s + 1) * (T + 10_000)))) for s, t in zip(source, wanted)]
    rows = []
    for (doc_id, _), (n, buckets) in zip(docs, grams):
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(buckets), weight, score, n >= least])
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], LAST if r[0] is None else r[0]))
    for row in rows:
        row[4] = None
    for rank, row in enumerate(drawn[: per_cent * len(drawn) // 100], 1):
        row[4] = rank
    return [tuple(r) for r in rows]


def without_lines(docs: list[tuple], least: int = 10) -> list[tuple]:
    """(doc_id, lines, dropped, kept text)."""
    key = lambda line: ascii_lower(line.strip(" \t\n\v\f\r"))
    place = [LAST if i is None else i for i, _ in docs]
    first: dict[str, int] = {}
    for at, (_, text) in zip(place, docs):
        for line in (text or "").split("\n"):
            first[key(line)] = min(at, first.get(key(line), at))
    out = []
    for at, (doc_id, text) in zip(place, docs):
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] == at]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def spelling_words(docs: list[tuple], least: int = 6, count: int = 5, one_in: int = 199) -> dict[str, int]:
    times: Counter = Counter()
    for doc_id, text in docs:
        for run in map(ascii_lower, _RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            times[run if h % one_in else run[:at] + run[at + 1 :]] += 1
    return {w: n for w, n in times.items() if len(w) >= least and n >= count}


def spelling_variants(words: dict[str, int], ratio: int = 5) -> list[tuple]:
    """(word, form, root, n, n_near, form_n), sorted."""
    near: dict[str, list[str]] = {w: [] for w in words}
    by_size: dict[int, list[str]] = defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    for w in words:
        near[w] = [x for k in (-1, 0, 1) for x in by_size[len(w) + k] if one_edit(w, x)]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    rows = []
    for w in sorted(words):
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return rows
