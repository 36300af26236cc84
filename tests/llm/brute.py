"""Plain versions of the operators, straight from their definitions."""

from __future__ import annotations

import re
from collections import Counter

SF_DIR = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, width=5):
    w = words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    windows = list(zip(w, w[1:], w[2:]))
    often = {g for g, n in Counter(windows).items() if n > 1}
    inside = {i + k for i, g in enumerate(windows) if g in often for k in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(inside),
    )


def near_classes(texts: dict, threshold=0.8):
    """(class id, number of links) by id, comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent, links = {i: i for i in sets}, Counter()

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= threshold - 1e-12:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (root(i), links[i]) for i in ids}


def spread_cleaned(rows, min_sites=10, max_share=0.5):
    """Texts after line dedup; ``rows`` are (id, text, site)."""
    blanks = " \t\n\x0b\f\r"
    sites = {}
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if words(line):
                sites.setdefault(line.strip(blanks), set()).add(site or "")
    out = []
    for id_, text, _ in rows:
        kept = text
        if text is not None:
            lines = [x for x in text.split("\n") if len(sites.get(x.strip(blanks), ())) < min_sites]
            cleaned = "\n".join(lines)
            if len(cleaned) >= len(text) * (1 - max_share):
                kept = cleaned
        out.append((id_, kept))
    return out
