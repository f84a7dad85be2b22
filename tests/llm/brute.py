"""Plain references of the operators, row by row."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_rules(text):
    text = text or ""
    w = words(text)
    chars = sum(map(len, w))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), chars, symbols, dup, len(inside), failed


def ngram_chars(text, n):
    w = words(text)
    windows = {}
    for i in range(len(w) - n + 1):
        windows.setdefault(tuple(w[i : i + n]), []).append(i)
    inside = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + n)}
    return sum(len(w[p]) for p in inside)


def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in h) * 2 > len(h))


def components(ids, prints, distance=3):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    f = np.array(prints, np.uint64)
    for i in range(len(f)):
        for j in (np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= distance) + i + 1).tolist():
            p, q = find(i), find(j)
            if p != q:
                parent[max(p, q)] = min(p, q)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return [low[find(i)] for i in range(len(ids))]


def exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    out = {}
    for key, members in groups.items():
        for _, i in members:
            out[i] = (min(members)[1], len(members), i == min(members)[1], hashlib.sha256(key.encode()).hexdigest())
    return out


def substring(rows, window=50):
    split = [(i, words(t)) for i, t in rows]
    owner = {}
    for i, w in sorted(split, key=lambda x: x[0]):
        for k in range(len(w) - window + 1):
            owner.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, w in split:
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if owner[tuple(w[k : k + window])] < i:
                keep[k : k + window] = [False] * window
        kept = [x for x, y in zip(w, keep, strict=True) if y]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def shards(rows, k=16):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    order = sorted(groups.items(), key=lambda x: min(x[1]))
    sizes = [len(v) * (len(t.encode()) + 1) for t, v in order]

    def greedy(capacity):
        used, n, out = 0, 0, []
        for s in sizes:
            if s > capacity:
                return None
            if used + s > capacity:
                n, used = n + 1, 0
            used += s
            out.append(n)
        return out if n < k else None

    low, high = 0, sum(sizes)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(mid) else (mid, high)
    out, slots = {}, {}
    for (t, members), s in zip(order, greedy(high), strict=True):
        for i in sorted(members):
            out[i] = (len(t.encode()) + 1, zlib.crc32(t.encode()), s, slots.get(s, 0))
            slots[s] = slots.get(s, 0) + 1
    return out


def warc(rows, least=1000):
    lead = {}
    for i, h in rows:
        b = (h or "").encode()
        if len(b) >= least:
            lead[b] = max(lead.get(b, -1), i)
    out = {}
    for i, h in rows:
        b = (h or "").encode()
        to = lead.get(b, i)
        out[i] = (len(b), hashlib.sha1(b).hexdigest(), "response" if to == i else "revisit", None if to == i else to)
    return out


def tiktoken_encoding():
    """The library's own encoding of whole texts."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f.read().splitlines() if line)}
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
