"""Plain versions of the operators, for small fixtures."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def shingles(text, width=3):
    words = [w.translate(LOWER) for w in WORD.findall(text or "")]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(rows, width=3, percent=85):
    sets = {doc: shingles(text, width) for doc, text in rows}
    docs = sorted(sets)
    parent = {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = {}
    for d in docs:
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    for d in docs:
        near = {e for s in sets[d] for e in holders[s] if e < d}
        for e in near:
            common = len(sets[d] & sets[e])
            if 100 * common >= percent * (len(sets[d]) + len(sets[e]) - common):
                x, y = sorted((root(d), root(e)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in docs}


def removed_bytes(rows, length=100):
    seen, result = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            else:
                seen[data[i : i + length]] = True
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        result[doc] = (data, gone, spans)
    return result
