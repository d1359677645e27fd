"""Plain single-machine versions of the operators, for comparison."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np

SPACED = re.compile("[^\x20\x09-\x0D]+")
LETTERED = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, kind=SPACED):
    return kind.findall((text or "").translate(LOWER))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def spans_of(kinds, found):
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found))


def secrets(text):
    text, out = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [sum(k == n for _, k, _ in out) for n in range(3)], digest(spans_of(("assign", "access", "hex"), out))


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def personal(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for k, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (12 <= len(digits) <= 19 and luhn(digits)) if k == 2 else 9 <= len(digits) <= 15:
                out.append((m.start(), k, m.end()))
    return [sum(k == n for _, k, _ in out) for n in range(4)], digest(spans_of(("email", "ip", "card", "phone"), out))


def near_duplicates(texts):
    """id -> (set size, smallest id of the group)."""
    sets = {}
    for i, text in texts.items():
        w = words(text)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, own in sets.items():
        shared = collections.Counter()
        for g in own:
            shared.update(holders[g])
            holders[g].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def contamination(texts, items):
    windows = collections.defaultdict(set)
    for name, text in items:
        w = words(text, LETTERED)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(name)
    lengths, out = {len(w) for w in windows}, {}
    for i, text in texts.items():
        w = words(text, LETTERED)
        hit, found = [0] * len(w), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit[k : k + n] = [1] * n
        found = sorted(str(x) for x in found if x is not None)
        out[i] = (len(w), sum(hit), len(found), digest(",".join(found)), sum(hit) > 0 and 20 * sum(hit) >= len(w))
    return out


def repeated_strings(texts, length=200):
    data = {i: (t or "").encode() for i, t in texts.items()}
    seen = collections.Counter(b[p : p + length] for b in data.values() for p in range(len(b) - length + 1))
    out = {}
    for i, b in data.items():
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def token_scores(texts, folds=10, held=0):
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    counts = collections.Counter()
    for i, own in tokens.items():
        if zlib.crc32(str(i).encode()) % folds != held:
            counts.update(own)
    total = sum(counts.values())
    size = total + 0.1 * (len(counts) + 1)
    return {
        i: (len(own), sum(counts[w] > 0 for w in own), total, sum(math.log10((counts[w] + 0.1) / size) for w in own))
        for i, own in tokens.items()
    }
