"""Brute-force versions shared by the tests of the operators and the pipeline."""

import itertools

from tillroll.llm.decontaminate import item_words


def reach(nodes, links):
    label = {v: v for v in nodes}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return label


def shingle_set(text):
    words = item_words(text)
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_docs(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    label, n = reach(range(len(rows)), links), [0] * len(rows)
    for a, b in links:
        n[a], n[b] = n[a] + 1, n[b] + 1
    members = {}
    for i, c in label.items():
        members.setdefault(c, []).append(i)
    least = {c: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for c, m in members.items()}
    return [(r[0], least[label[i]], n[i], len(sets[i])) for i, r in enumerate(rows)]


def brute_windows(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = item_words(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    sizes = {len(w) for w in windows}
    for doc, text in docs:
        w, hit, found = item_words(text), set(), set()
        for i in range(len(w)):
            for size in sizes:
                if i + size <= len(w) and tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)
