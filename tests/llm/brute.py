"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

BLANK = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs, min_chars=10, min_docs=2):
    """{(id, text): (n_lines, n_dropped, kept)} for [(id, text)]."""
    key = lambda line: lower(line.strip(BLANK))
    holders = defaultdict(set)
    for own, text in docs:
        if own is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders[key(line)].add(own)
    out = {}
    for own, text in docs:
        lines = (text or "").split("\n")
        gone = [own is not None and len(h := holders.get(key(x), ())) >= min_docs and own != min(h) for x in lines]
        out[own, text] = len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
    return out


def substring_dedup(docs, size=13):
    first = {}
    cut = [(own, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for own, text in docs]
    for own, w in cut:
        for p in range(len(w) - size + 1):
            if own is not None:
                key = tuple(w[p : p + size])
                first[key] = min(own, first.get(key, own))
    out = []
    for own, w in cut:
        gone = set()
        for p in range(len(w) - size + 1):
            if own is not None and first[tuple(w[p : p + size])] < own:
                gone.update(range(p, p + size))
        out.append((own, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def decontaminate(docs, items, size=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for item, text in items:
        w = cut(text)
        k = min(size, len(w))
        for p in range(len(w) - k + 1) if k else ():
            windows[tuple(w[p : p + k])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for own, text in docs:
        w, hit, found = cut(text), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in windows:
                    hit.update(range(p, p + k))
                    found |= windows[tuple(w[p : p + k])]
        out.append((own, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def fingerprint(text, size=3, seed=42):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(w[p : p + size]) for p in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    votes = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed)
        votes.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(shingles))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def simhash_components(docs, bits=2):
    prints = [(own, fingerprint(text)) for own, text in docs]
    near = [
        (a, b)
        for i, (a, x) in enumerate(prints)
        for b, y in prints[:i]
        if a is not None and b is not None and (x ^ y).bit_count() <= bits
    ]
    return prints, components([a for a, _ in prints if a is not None], near)
