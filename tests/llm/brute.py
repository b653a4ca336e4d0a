"""Plain Python versions of the operators' definitions, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def low_words(text):
    return words((text or "").translate(LOWER))


def base_measures(text):
    text = text or ""
    w = words(text)
    n = len(w)
    seen = Counter(tuple(w[k : k + 8]) for k in range(n - 7))
    repeated = set()
    for k in range(n - 7):
        if seen[tuple(w[k : k + 8])] > 1:
            repeated.update(range(k, k + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        n,
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 20 or 100 * len(repeated) > 30 * n,
    )


def shingles(text, size):
    w = low_words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def near_duplicates(docs, size, percent):
    """{doc_id: (n_shingles, component)} of (doc_id, text) with unique ids."""
    sets = {i: shingles(t, size) for i, t in docs}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            lists[g].append(i)
    both = Counter()
    for members in lists.values():
        for x, a in enumerate(members):
            for b in members[:x]:
                both[b, a] += 1
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def lines_that_go(docs, percent=80):
    """Places (doc_id, line_no) with an earlier line of the required similarity."""
    found = []
    for i, t in docs:
        for k, line in enumerate((t or "").split("\n")):
            w = frozenset(words(line.lower()))
            if w:
                found.append(((i, k), w))
    found.sort(key=lambda x: x[0])
    return {
        a for x, (a, w) in enumerate(found) if any(100 * len(w & v) >= percent * len(w | v) for _, v in found[:x])
    }


def base_scores(docs):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    texts = {i: low_words(t) + ["\n"] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    counts = Counter(w for i, t in texts.items() if not held[i] for w in t)
    total = sum(counts.values())
    norm = total + 0.1 * (len(counts) + 1)
    return {
        i: (held[i], len(t), sum(counts[w] > 0 for w in t), total, sum(math.log10((counts[w] + 0.1) / norm) for w in t))
        for i, t in texts.items()
    }


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_identifiers(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]
