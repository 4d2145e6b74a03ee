"""Plain-Python versions of the operators' results."""

import hashlib
import re

OP3_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
OP5_WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def repeats(rows, least):
    """{(id, text): (n_bytes, n_removed, n_spans, sha256 of the rest)}."""
    seen, out = set(), {}
    distinct = sorted({(r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest(), r[1] or "", r[0]) for r in rows})
    for _, _, _, text, i in distinct:
        data = text.encode()
        gone = bytearray(len(data))
        for j in range(len(data) - least + 1):
            s = data[j: j + least]
            if s in seen:
                gone[j: j + least] = b"\1" * least
            seen.add(s)
        left = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i, text] = (len(data), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


def word_sets(rows, k=3):
    out = []
    for _, text in rows:
        w = OP5_WORD.findall((text or "").translate(UPPER))
        out.append({tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def components(rows, percent=90, k=3):
    """Per row: (id, shingles, component, linked rows)."""
    sets = word_sets(rows, k)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[find(a)] = min(least.get(find(a), i), i)
    return [(i, len(sets[a]), least[find(a)], links[a]) for a, (i, _) in enumerate(rows)]


def phrases(docs, items, window=10):
    """{id: (n_words, n_hit, item ids in order)}."""
    split = lambda t: OP3_WORD.findall((t or "").translate(UPPER))
    table = {}
    for i, t in items:
        w = split(t)
        for j in range(max(0, len(w) - window) + 1 if w else 0):
            table.setdefault(tuple(w[j: j + window]), set()).add(str(i))
    sizes = {len(k) for k in table}
    out = {}
    for i, t in docs:
        w = split(t)
        hit, found = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (own := table.get(tuple(w[j: j + n]))):
                    hit.update(range(j, j + n))
                    found |= own
        out[i] = (len(w), len(hit), sorted(found))
    return out
