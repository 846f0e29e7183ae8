"""Plain versions of the operators on lists, written apart from them."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer


def groups(pairs, members):
    """Smallest member of each member's component."""
    up = {m: m for m in members}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {m: top(m) for m in members}


def fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows):
    prints = [fingerprint(t) for _, t in rows]
    at = range(len(rows))
    pairs = [(i, j) for i in at for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = groups(pairs, at)
    least = defaultdict(list)
    for i in at:
        if rows[i][0] is not None:
            least[root[i]].append(rows[i][0])
    return sorted(((rows[i][0], f"{prints[i]:016x}", min(least[root[i]], default=None)) for i in at), key=str)


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def ids(t, text):
    return t.encode(text or "", add_special_tokens=False).ids


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def spans(text, patterns):
    """patterns: (kind, regular expression, test of the match)."""
    found = []
    for rank, (kind, pattern, test) in enumerate(patterns):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if test(m)]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


SECRETS = [
    ("assign", r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
]


def _luhn(text):
    total = 0
    for n, d in enumerate(int(c) for c in reversed(text) if c.isdigit()):
        total += d if n % 2 == 0 else sum(map(int, str(2 * d)))
    return total % 10 == 0


def _digits(m):
    return sum(c.isdigit() for c in m.group())


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= _digits(m) <= 19 and _luhn(m.group())),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= _digits(m) <= 15),
]


def vector_links(rows, threshold=0.9):
    units = {}
    for at, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.asarray(v, float)
            u = u / np.abs(u).max()
            units[at] = u / np.sqrt((u * u).sum())
    pairs = [(i, j) for i in units for j in units if i < j and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]
    n = defaultdict(int)
    for i, j in pairs:
        n[i] += 1
        n[j] += 1
    root = groups(pairs, range(len(rows)))
    least = {}
    for at, (key, _) in enumerate(rows):
        if key is not None:
            least[root[at]] = min(key, least.get(root[at], key))
    return sorted(((key, n[at], least.get(root[at]), key is not None and least.get(root[at]) == key) for at, (key, _) in enumerate(rows)), key=str)
