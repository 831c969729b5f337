"""The operators' contracts, one document at a time."""

import hashlib
from collections import Counter, defaultdict

import xxhash

BLANKS = b" \t\n\x0b\x0c\r"


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rows):
    """Smallest id reachable through fingerprints at most four bits apart, for rows of unique ids."""
    prints = {d: fingerprint(t) for d, t in rows}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (f"{prints[d]:016x}", find(d)) for d in ids}


def similar(rows, shingle=5, similarity=0.8):
    """Smallest id reachable through texts of at least this Jaccard similarity, for rows of unique ids."""
    sets = {}
    for d, t in rows:
        words = (t or "").encode().lower().split()
        sets[d] = {b" ".join(words[i : i + shingle]) for i in range(max(len(words) - shingle + 1, 1))}
    ids, root = sorted(sets), {d: d for d in sets}
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return root


def repeated_bytes(rows, length):
    seen = defaultdict(set)
    texts = {(d, t or ""): (t or "").encode() for d, t in rows}
    for key, data in texts.items():
        for i in range(len(data) - length + 1):
            seen[data[i : i + length]].add((key, i))
    gone = defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for key, i in places:
                gone[key].update(range(i, i + length))
    out = []
    for d, t in rows:
        key = (d, t or "")
        data, lost = texts[key], gone[key]
        left = bytes(b for i, b in enumerate(data) if i not in lost)
        spans = sum(1 for i in lost if i - 1 not in lost)
        out.append((d, len(data), len(lost), spans, hashlib.sha256(left).hexdigest()))
    return out


def repeated_words(rows, length):
    """Rows of unique ids; the first occurrence stays."""
    seen, out = set(), []
    for d, t in sorted(rows):
        words = (t or "").encode().split()
        lost = set()
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                lost.update(range(i, i + length))
            seen.add(window)
        left = b" ".join(w for i, w in enumerate(words) if i not in lost)
        out.append((d, len(words), len(lost), hashlib.sha256(left).hexdigest()))
    return out


def exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").encode().translate(None, BLANKS)].append((-len(t or ""), d))
    out = []
    for data, members in groups.items():
        keep = min(members)[1]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(data).hexdigest()) for _, d in members]
    return out


def repeated_window_words(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    return len({i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)})
