"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def fingerprint(text):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def near(rows, least=min):
    """[(id, fingerprint, component)] of [(id, text)]."""
    prints = [fingerprint(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    first = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(d, f"{prints[i]:016x}", first[root(i)]) for i, (d, _) in enumerate(rows)]


def passages(rows, n=20):
    """[(id, n_words, n_removed, kept_sha256)] of [(id, text)] with different ids."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        found = words(text)
        gone = [False] * len(found)
        for i in range(len(found) - n + 1):
            window = tuple(found[i : i + n])
            if window in seen:
                gone[i : i + n] = [True] * n
            seen.add(window)
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out.append((doc_id, len(found), sum(gone), sha(kept.encode())))
    return out


def strings(rows, n=200):
    """[(id, n_bytes, n_removed, n_spans, kept_sha256)] of [(id, text)] with different ids."""
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    times = Counter(t[i : i + n] for _, t in texts for i in range(len(t) - n + 1))
    out = []
    for doc_id, t in texts:
        gone, upto = bytearray(len(t)), 0
        for i in range(len(t) - n + 1):
            if times[t[i : i + n]] > 1:
                gone[max(i, upto) : i + n] = b"\1" * (i + n - max(i, upto))
                upto = i + n
        spans = len([r for r in bytes(gone).split(b"\0") if r])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), spans, sha(kept)))
    return out


def exact(rows):
    """[(id, keep_id, size, sha256)] of [(id, text)]."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(SPACE.sub("", text or ""), []).append((doc_id, len(text or "")))
    out = []
    for doc_id, text in rows:
        body = SPACE.sub("", text or "")
        best = min(groups[body], key=lambda r: (-r[1], r[0] is None, r[0]))
        out.append((doc_id, best[0], len(groups[body]), sha(body.encode())))
    return out
