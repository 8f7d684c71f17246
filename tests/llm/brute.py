"""Plain Python versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re


def sets_of(texts, size=5):
    out = {}
    for key, text in texts.items():
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        out[key] = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()
    return out


def linked(a, b, percent=80):
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def smallest_reachable(keys, links):
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def join_documents(texts):
    sets = sets_of(texts)
    keys = sorted(sets)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:] if linked(sets[a], sets[b])]
    found = smallest_reachable(keys, links)
    return {k: (len(sets[k]), found[k]) for k in keys}


def removed_lines(texts):
    lines = []
    for key in sorted(k for k in texts if texts[k] is not None):
        for number, line in enumerate(texts[key].split("\n")):
            words = re.findall(r"[^ \t\x0B\f\r]+", line)
            if words:
                n = min(5, len(words))
                lines.append((key, number, {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}))
    return {(k, n) for i, (k, n, s) in enumerate(lines) if any(linked(s, t) for _, _, t in lines[:i])}


def contamination(texts, items, window=10):
    def words(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)

    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item or "")
    out = {}
    for key, text in texts.items():
        w = words(text)
        hit, named = set(), set()
        for n in {len(win) for win in windows}:
            for i in range(len(w) - n + 1):
                if (owners := windows.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    named |= owners
        out[key] = (len(w), len(hit), sorted(named))
    return out


def digest(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()
