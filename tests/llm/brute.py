"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def fold(doc_id, k):
    return zlib.crc32(str(doc_id).encode()) % k


def shingles(text, size=2):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def near_groups(rows, size=2, percent=80):
    """doc_id -> (set size, smallest id reachable) for rows of (doc_id, text)."""
    sets = {i: shingles(t, size) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    ra, rb = root(a), root(b)
                    up[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def without_repeats(texts, span=200):
    """(bytes, removed, spans, digest of the rest) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for k, r in enumerate(raws):
        for p in range(len(r) - span + 1):
            w = r[p:p + span]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for p in range(len(r) - span + 1):
            if seen[r[p:p + span]] > 1:
                gone[p:p + span] = b"\1" * span
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rest = bytes(c for c, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def edited(rows):
    """doc_id -> (n_chars, digest of the edited text) for rows of (doc_id, text) with distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        third = len(t) // 3
        out[i] = (len(t), hashlib.sha256((t[:len(t) - third] + u[:third]).encode()).hexdigest())
    return out


def distance_to_part(pattern, text):
    """Smallest edit distance of pattern to any part of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)
