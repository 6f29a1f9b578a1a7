"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = "[^\x20\x09-\x0d]+"
LICENCE_WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
PHRASES = {
    "mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def shingles(text, width):
    words = re.findall(WORD, (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def groups(texts, width, percent=80):
    """{doc_id: (set size, smallest reachable id)} by comparing all sets that share a shingle."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    held = defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in held[s]:
                shared[j] += 1
            held[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: (len(sets[i]), top(i)) for i in sets}


def secret_spans(text):
    found = []
    for m in re.finditer(ASSIGN, text):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def secret_row(text):
    spans = secret_spans(text or "")
    written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    counts = [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
    return (*counts, hashlib.sha256(written.encode()).hexdigest()), written


def licence_row(text):
    words = re.findall(LICENCE_WORD, (text or "").translate(LOWER))
    places = []
    for phrase, label in PHRASES.items():
        wanted = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def sizes(texts):
    return [len(re.findall(WORD, t or "")) for t in texts]


def targets(by_source, weights=(5.0, 2.0, 1.0), most=3):
    """{source: target} by sharing out the excess again until no target is above its limit."""
    names = sorted((s for s in by_source if s is not None)) + ([None] if None in by_source else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = float(sum(by_source.values()))
    stopped, found = set(), {}
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(most * by_source[s] for s in stopped)
        share = sum(weight[s] for s in free)
        found = {s: most * by_source[s] for s in stopped} | {s: left * weight[s] / share for s in free}
        over = {s for s in free if found[s] > most * by_source[s]}
        if not over:
            return found
        stopped |= over


def ids_of(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def crc(ids):
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
