"""Brute-force versions of the operators, over lists of rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter


def closure(nodes, links):
    """The smallest node reachable from every node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_set(text, size):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def near_duplicates(rows, size, percent):
    """``{id: (n_shingles, component, kept)}`` of ``(id, text)``."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    component = closure(ids, links)
    return {i: (len(sets[i]), component[i], component[i] == i) for i in ids}


def remove_repeats(rows, length):
    """``(id, n_bytes, n_removed, n_spans, hash)`` of every ``(id, text)``."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if counts[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def personal_data(text):
    text = text or ""
    only = lambda m: re.sub("[^0-9]", "", m.group())
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(only(m)) <= 19 and luhn(only(m))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(only(m)) <= 15]
    return [f"{kind}:{m.start()}:{m.end()}" for kind, m in found]


def secrets(text):
    text = text or ""
    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return [name for _, _, name in sorted(found)]


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def hard_negatives(rows):
    """Anchors, their positives and negatives over ``(id, vector, label)`` rows."""
    import math

    usable = set()
    for i, v, label in rows:
        if i is None or label is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        usable.add((i, label, tuple(math.floor(256 * float(c)) for c in v)))
    usable = sorted(usable)
    out = []
    for a, la, va in usable:
        if a % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(va, v)), i, label) for i, label, v in usable if i != a and len(v) == len(va)]
        scored.sort()
        positives = [(i, -s) for s, i, label in scored if label == la][:5]
        for p, ps in positives:
            window = [(i, -s) for s, i, label in scored if label != la and 30 * ps <= -100 * s <= 90 * ps][:10]
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(window)]
    return out


def contamination(docs, items):
    """``doc_id -> (n_words, n_hit, n_items, items_sha256, contaminated)`` by trying every window everywhere."""
    word = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: word.findall((t or "").translate(lower))
    windows = {}
    for item, text in items:
        ws = split(text)
        if item is None or not ws:
            continue
        for i in range(max(1, len(ws) - 9)):
            windows.setdefault(tuple(ws[i : i + 10]), set()).add(item)
    out = []
    for doc_id, text in docs:
        ws = split(text)
        hit, named = set(), set()
        for w, owners in windows.items():
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    named |= owners
        joined = ",".join(sorted(str(i) for i in named))
        out.append((doc_id, len(ws), len(hit), len(named), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return out


def lexical_search(docs, items, top=50):
    """``(item_id, rank, doc_id, score)`` by scoring every document for every item."""
    import math

    term = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: term.findall((t or "").translate(lower))
    counted = [(d, Counter(split(t)), len(split(t))) for d, t in docs]
    big_n = sum(1 for _, _, n in counted if n)
    big_l = sum(n for _, _, n in counted)
    out = []
    for item, text in items:
        if item is None:
            continue
        terms = set(split(text))
        df = {t: sum(1 for _, c, _ in counted if c[t]) for t in terms}
        scored = []
        for d, c, n in counted:
            if not n or d is None:
                continue
            m = 100 - 50 + (50 * n * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scored.append((-s, d))
        scored.sort()
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(scored[:top])]
    return out
