"""Plain versions of the operators' definitions, for small inputs."""

from collections import defaultdict

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def key(row):
    return tuple((v is None, v) for v in row)


def same(got, expected):
    assert sorted(got, key=key) == sorted(expected, key=key)


def shingles(text, width):
    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([("whole", *w)])


def linked(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                parent[root(a)] = root(b)
    members = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        members[root(k)].append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [x for x in members[root(k)] if x is not None]
        smallest = min(ids) if ids and sets[k] else i
        out.append((i, len(sets[k]), smallest, i == smallest))
    return out


def covered_lines(rows, width=3):
    """Rows that repeat an id and a text count as one document."""
    every = sorted(set(rows), key=lambda r: key(r))
    windows = defaultdict(list)
    lines = {r: [] if r[1] is None else r[1].split("\n") for r in every}
    for r in every:
        for i in range(max(len(lines[r]) - width + 1, 1) if lines[r] else 0):
            part = tuple(lines[r][i : i + width])
            if "\n".join(part).strip(" \t\r\n"):
                windows[part].append((key((r[0],)), i, r))
    gone = defaultdict(set)
    for places in windows.values():
        first = min(p[:2] for p in places)
        for place, i, r in places:
            if (place, i) != first:
                gone[r].update(range(i, min(i + width, len(lines[r]))))
    return lines, gone


def found_in(rows, items, window=10):
    patterns = []
    for item, text in items:
        w = (text or "").encode().translate(TABLE).split()
        k = min(window, len(w))
        patterns += [(item, w[i : i + k]) for i in range(len(w) - k + 1)] if w else []
    out = []
    for i, t in rows:
        w = (t or "").encode().translate(TABLE).split()
        hit, named = set(), set()
        for item, p in patterns:
            for a in range(len(w) - len(p) + 1):
                if w[a] == p[0] and w[a : a + len(p)] == p:
                    hit.update(range(a, a + len(p)))
                    named.add(item)
        out.append((i, len(w), len(hit), str(sorted(named, key=lambda x: (x is None, x)))))
    return out
