"""Brute-force versions of operators, for tests of their own and of the pipeline."""

import re

from tableflow.llm.line_dedup import line_key
from tableflow.llm.words import ASCII_LOWER


def shingles(text):
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def similar(a, b):
    common = len(a & b)
    return bool(a) and 100 * common >= 80 * len(a | b)


def near_duplicates(rows):
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    root = {doc_id: doc_id for doc_id, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, one) in enumerate(sets):
        for b, two in sets[:k]:
            if similar(one, two):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((doc_id, len(one), find(doc_id)) for doc_id, one in sets)

def common_lines(rows, least):
    found = {}
    for at, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            found.setdefault(line_key(line.encode()), set()).add(at)
    common = {key for key, where in found.items() if key and len(where) >= least}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if line_key(line.encode()) not in common]
        out.append((doc_id, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return out

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def contamination(docs, items, window):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, other in items:
            other = words(other)
            span = min(window, len(other))
            for k in range(len(other) - span + 1) if span else ():
                for at in range(len(own) - span + 1):
                    if own[at : at + span] == other[k : k + span]:
                        hit.update(range(at, at + span))
                        if item_id is not None:
                            found.add(str(item_id))
        bad = bool(hit) and 20 * len(hit) >= len(own)
        out.append((doc_id, len(own), len(hit), sorted(found), bad))
    return sorted(out, key=str)
