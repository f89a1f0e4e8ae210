"""Plain versions of the operators, for small tables."""

import re
from collections import defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {x: x + 32 for x in range(65, 91)}


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def shingles(text, k):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def similar_groups(rows, k, num, den=100):
    """{id: (set size, least id reachable)}"""
    sets = defaultdict(list)
    union = Union()
    for i, text in rows:
        union.find(i)
        sets[i].append(shingles(text, k))
    flat = [(i, s) for i, all_ in sets.items() for s in all_ if s]
    for (i, a), (j, b) in combinations(flat, 2):
        if i != j and den * len(a & b) >= num * len(a | b):
            union.join(i, j)
    return {i: union.find(i) for i in sets}


def sentence_starts(text, rank, long=16, near=3, most=20):
    """Numbers of the first words of a text's sentences; ``rank``: the hash by which long ones are cut."""
    found = list(WORD.finditer(text))
    plain, current = [], []
    for k, m in enumerate(found):
        current.append(k)
        after = text[m.end() : found[k + 1].start()] if k + 1 < len(found) else "\n"
        if m.group()[-1] in ".!?" or "\n" in after:
            plain.append(current)
            current = []
    starts = []
    for sentence in plain:
        h = [rank(found[k].group().translate(FOLD)) for k in sentence]
        pieces = [[]]
        for j, k in enumerate(sentence):
            pieces[-1].append(k)
            beside = h[max(0, j - near) : j] + h[j + 1 : j + 1 + near]
            if len(sentence) > long and all(h[j] < x for x in beside):
                pieces.append([])
        starts += [k for piece in pieces for k in piece[::most]]
    return starts


def without_repeats(rows, rank, sentences=3, least=20, pair_words=10, length=50):
    """{id: (text, sentences gone)} for distinct ids: of equal spans all but the first go, of exact copies all spans but the first copy's."""
    rows = sorted((i, t or "") for i, t in rows)
    words = {i: [m.group().translate(FOLD) for m in WORD.finditer(t)] for i, t in rows}
    starts = {i: [*sentence_starts(t, rank), len(words[i])] for i, t in rows}
    first_of = {}
    for i, t in rows:
        first_of.setdefault(t, i)
    pairs, owners = defaultdict(list), defaultdict(list)
    for i, t in rows:
        for a, b in zip(starts[i], starts[i][2:]):
            if b - a >= pair_words:
                pairs[i].append((a, b))
                owners[tuple(words[i][a:b])].append(t)
    shared = {k for k, own in owners.items() if len(set(own)) > 1 or any(often > 1 for often in _within(own, first_of, rows))}

    def spans(i, some):
        found = {(s, s + length) for a, b in some for s in range(max(0, b - length), min(a, len(words[i]) - length) + 1)}
        return found | {(a, b) for a, b in zip(starts[i], starts[i][sentences:]) if b - a >= least}

    seen, cut = defaultdict(list), {}
    for i, t in rows:
        if first_of[t] == i:
            for a, b in spans(i, [r for r in pairs[i] if tuple(words[i][slice(*r)]) in shared]):
                seen[tuple(words[i][a:b])].append((i, a, b))
            cut[i] = set()
        else:
            cut[i] = spans(i, pairs[i])
    for places in seen.values():
        for i, a, b in sorted(places)[1:]:
            cut[i].add((a, b))
    out = {}
    for i, t in rows:
        covered = {w for span in cut[i] for w in range(*span)}
        gone = [set(range(a, b)) <= covered for a, b in zip(starts[i], starts[i][1:])] if words[i] else []
        at = [m.start() for m in WORD.finditer(t)]
        edges = [0, *(at[a] for a in starts[i][1:-1]), len(t)]
        out[i] = ("".join(t[edges[k] : edges[k + 1]] for k in range(len(gone)) if not gone[k]) if words[i] else t, sum(gone))
    return out


def _within(own, first_of, rows):
    """How often each text has a run, copies counted once."""
    copies = defaultdict(int)
    for _, t in rows:
        copies[t] += 1
    return [own.count(t) // copies[t] for t in set(own)]


def repeated_words(rows, length=50):
    """{id: numbers of its words that lie in a stretch of words that an earlier row, or an earlier place of this one, has}"""
    seen, out = set(), defaultdict(set)
    for i, t in sorted(rows):
        words = [m.group().translate(FOLD) for m in WORD.finditer(t or "")]
        for s in range(len(words) - length + 1):
            k = tuple(words[s : s + length])
            if k in seen:
                out[i].update(range(s, s + length))
            seen.add(k)
    return out
