"""Plain Python versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def groups(rows, threshold=0.8):
    """(id, smallest id of the group, links) of (id, text) rows, over all pairs."""
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    for a in range(len(rows)):
        meets = {b for x in sets[a] for b in where[x] if b < a}
        for b in range(a) if not sets[a] else sorted(meets):
            if sets[a] or sets[b]:
                both = len(sets[a] & sets[b])
                like = both >= threshold * (len(sets[a]) + len(sets[b]) - both) and both
            else:
                like = rows[a][1] and rows[a][1] == rows[b][1]
            if like:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return sorted(((i, low.get(find(k)), links[k]) for k, (i, _) in enumerate(rows)), key=str)
