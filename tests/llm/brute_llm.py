"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def grams(text: str | None, n: int) -> frozenset:
    words = SPACE_WORD.findall(lower_ascii(text or ""))
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def connected(ids, linked) -> dict:
    """Smallest reachable id, by trying all pairs."""
    smallest = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if smallest[b] < smallest[a] and a != b and linked(a, b):
                    smallest[a], changed = smallest[b], True
    return smallest


def jaccard_components(rows: dict, n: int, p: int, q: int) -> dict:
    sets = {i: grams(t, n) for i, t in rows.items()}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x) and bool(y) and q * len(x & y) >= p * len(x | y)

    parts = connected(list(rows), linked)
    return {i: (len(sets[i]), parts[i]) for i in rows}


def kept_words(rows: list[tuple], window: int) -> list[tuple]:
    """(id, number of words, number removed, kept text); windows are judged on the input."""
    starts = defaultdict(list)
    words = [(i, SPACE_WORD.findall(t or "")) for i, t in rows]
    for i, own in words:
        for k in range(len(own) - window + 1):
            if i is not None:
                starts[tuple(own[k : k + window])].append((i, k))
    first = {w: min(s) for w, s in starts.items()}
    out = []
    for i, own in words:
        gone = set()
        for k in range(len(own) - window + 1):
            if i is not None and first[tuple(own[k : k + window])] < (i, k):
                gone.update(range(k, k + window))
        kept = [w for k, w in enumerate(own) if k not in gone]
        out.append((i, len(own), len(gone), " ".join(kept)))
    return out


def kept_lines(rows: list[tuple], min_docs: int, min_chars: int) -> list[tuple]:
    def key(line: str) -> str:
        return lower_ascii(line.strip(" \t\n\r\x0b\x0c"))

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < min_docs or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def benchmark_hits(text: str | None, items: dict, window: int) -> tuple:
    """(number of words, number hit, items)"""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own, hit, names = word.findall(lower_ascii(text or "")), set(), set()
    for item, item_text in items.items():
        theirs = word.findall(lower_ascii(item_text or ""))
        size = min(window, len(theirs))
        for k in range(len(theirs) - size + 1) if size else ():
            run = theirs[k : k + size]
            for j in range(len(own) - size + 1):
                if own[j : j + size] == run:
                    hit.update(range(j, j + size))
                    names.add(str(item))
    return len(own), len(hit), sorted(names)


def prefix_trie(rows: list[tuple]) -> set[tuple]:
    """Nodes of (conversation, turn, role, text) rows, from all prefixes of all conversations."""
    import zlib

    def turn_order(row):
        own = (row[2] or "").encode()
        digest = hashlib.md5(f"{len(own)}:".encode() + own + (row[3] or "").encode()).hexdigest()
        return row[1] is not None, row[1] or 0, row[2] or "", int(digest[:15], 16), int(digest[15:30], 16)

    talks = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=turn_order):
        talks[row[0]].append((row[2] or "", row[3] or ""))
    members = defaultdict(list)
    for c, own in sorted(talks.items()):
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        whole = tuple(talks.get(donor, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append((c, d == len(whole)))
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
    return {
        (own[0][0], len(node), members[node[:-1]][0][0] if node else None, len(own), children[node], leaves[node],
         saved[node], sha(",".join(str(c) for c, ends in own if ends)))
        for node, own in members.items()
    }


def hard_negatives(rows: list[tuple], anchors: set, n_pos: int, n_neg: int, low: tuple[int, int], scale: float) -> set[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) from all pairs of (id, label, vector) rows."""
    import math

    usable = {
        (i, label, tuple(math.floor(scale * x) for x in v))
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    asking = {}
    for a, label, own in usable:
        order = label, np.array(own, np.int32).tobytes()
        if a in anchors and (a not in asking or order < asking[a][0]):
            asking[a] = order, label, own
    out = set()
    for a, (_, label, own) in asking.items():
        scored = sorted(
            (-sum(x * y for x, y in zip(own, v)), i, other) for i, other, v in usable if i != a and len(v) == len(own)
        )
        for p, positive, _ in [s for s in scored if s[2] == label][:n_pos]:
            fits = [s for s in scored if s[2] != label and low[0] * -p <= low[1] * -s[0] <= low[1] * -p]
            out |= {(a, positive, k + 1, i, -p, -n) for k, (n, i, _) in enumerate(fits[:n_neg])}
    return out
