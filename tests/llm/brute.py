"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

UPPER = {c: c + 32 for c in range(65, 91)}


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def exact(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault((t or "").translate(UPPER), []).append(i)
    least = lambda x: (x is not None, x or 0)
    out = []
    for i, t in docs:
        own = groups[(t or "").translate(UPPER)]
        keep = max(own, key=least)
        out.append((i, keep, len(own), i == keep, sha((t or "").translate(UPPER))))
    return out


def secrets(docs):
    word = re.compile(
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        re.IGNORECASE | re.ASCII,
    )
    out = []
    for i, t in docs:
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in word.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        out.append((i, *counts, sha(line)))
    return out


def order(i):
    return (1 << 63) - 1 if i is None else i


def repeated_bytes(docs, size=100):
    seen, by_row = {}, {}
    for at, (i, t) in sorted(enumerate(docs), key=lambda x: order(x[1][0])):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - size + 1):
            first = seen.setdefault(data[k : k + size], (order(i), t, k))
            # Rows of one id and text are one document.
            if first != (order(i), t, k):
                gone[k : k + size] = b"\1" * size
        runs = sum(x and (k == 0 or not gone[k - 1]) for k, x in enumerate(gone))
        kept = bytes(x for x, y in zip(data, gone, strict=True) if not y)
        by_row[at] = (i, len(data), sum(gone), runs, sha(kept))
    return list(by_row.values())


def repeated_passages(docs, size=50):
    first = {}
    words = [(t or "").encode().split() for _, t in docs]
    for (i, _), w in zip(docs, words, strict=True):
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for (i, _), w in zip(docs, words, strict=True):
        gone = bytearray(len(w))
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < order(i):
                gone[k : k + size] = b"\1" * size
        kept = b" ".join(x for x, y in zip(w, gone, strict=True) if not y)
        out.append((i, len(w), sum(gone), sha(kept)))
    return out


def near(docs, percent=85):
    sets = []
    for _, t in docs:
        w = (t or "").translate(UPPER).encode().split()
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else frozenset())
    part = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
                old, new = part[a], part[b]
                part = [new if p == old else p for p in part]
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if part[j] == part[k] and docs[j][0] is not None]
        low = (min(ids) if ids else None) if sets[k] else i
        out.append((i, len(sets[k]), low, i == low))
    return out


def contaminated(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
    windows = {}
    for item, t in items:
        w = words(t)
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k in range(len(w)):
            for n in sizes:
                own = windows.get(tuple(w[k : k + n])) if k + n <= len(w) else None
                if own:
                    found |= own
                    hit |= set(range(k, k + n))
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out
