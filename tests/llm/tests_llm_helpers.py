"""Plain versions that several tests share."""

import re

import xxhash

from loam.llm import simhash

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


def reach(nodes, edges):
    """The least node that each reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles_of(text, n=4):
    w = [x.encode() for x in words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    return [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))] if w else []


def brute_simhash(text, n=4):
    h = shingles_of(text, n)
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_sketch(text, rule):
    """The last bit of the least of all shingles, in each of 64 orders."""
    h, out = shingles_of(text, rule.shingle), []
    for m in simhash.MIX.tolist():
        mixed = [(x * m) % (1 << 32) for x in h]
        mixed = [((x ^ x >> 15) * 0x85EBCA6B) % (1 << 32) for x in mixed]
        out.append(min(x ^ x >> 13 for x in mixed) % 2 if h else 0)
    return out


def brute_components(texts, rule):
    """The least id that each reaches by pairs of texts that the rule links. texts: by id."""
    fp = {d: brute_simhash(t, rule.shingle) for d, t in texts.items()}
    sketch = {d: brute_sketch(t, rule) for d, t in texts.items()} if rule.sketched else {d: [] for d in texts}
    close = lambda a, b: (fp[a] ^ fp[b]).bit_count() <= rule.radius and sum(x != y for x, y in zip(sketch[a], sketch[b], strict=True)) <= rule.apart
    return reach(fp, [(a, b) for a in fp for b in fp if a < b and close(a, b)])
