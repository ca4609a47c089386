"""Brute-force versions of the operators, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def substring(rows, n):
    first, seen = {}, {i: words(t) for i, t in rows if i is not None}
    for i, w in seen.items():
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in seen.items():
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < i:
                gone.update(range(k, k + n))
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def suffix(rows, n):
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    count = collections.Counter(t[k:k + n] for t in texts.values() for k in range(len(t) - n + 1))
    out = []
    for i, t in texts.items():
        spans = []
        for k in range(len(t) - n + 1):
            if count[t[k:k + n]] > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + n
                else:
                    spans.append([k, k + n])
        left = bytes(c for k, c in enumerate(t) if not any(a <= k < z for a, z in spans))
        out.append((i, len(t), sum(z - a for a, z in spans), len(spans), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def jaccard(rows, shingle=5, percent=80):
    sets = {}
    for i, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m.group(0).lower(), t or ""))
        sets[i] = {tuple(w[k:k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else (
            {tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(digits[::-1])) % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in text.split(".")),
            "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def personal(text):
    found = [(m.start(), rank, kind, m.end()) for rank, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if holds(kind, m.group(0))]
    listed = ",".join(f"{k}:{a}:{z}" for a, _, k, z in sorted(found))
    counts = collections.Counter(k for _, _, k, _ in found)
    return (*(counts[k] for k in PATTERNS), hashlib.sha256(listed.encode()).hexdigest())


def quality(text):
    w = [x.decode() for x in words(text)]
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    count = collections.Counter(windows)
    repeat = {k + j for k, x in enumerate(windows) if count[x] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeat))
