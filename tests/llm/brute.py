"""Plain versions of the operators for small tables."""

import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def counts(text):
    """Words, their characters, symbols, repeated lines, words in repeated windows of three."""
    w = words(text)
    triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def without_repeats(docs, window):
    """Kept words of each (id, text)."""
    seen = Counter(tuple(words(t)[i : i + window]) for _, t in docs for i in range(len(words(t)) - window + 1))
    out = []
    for i, t in docs:
        w = words(t)
        gone = {j for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1 for j in range(k, k + window)}
        out.append((i, [x for j, x in enumerate(w) if j not in gone]))
    return out


def without_lines(docs, min_docs=5, min_chars=40):
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            key = line.strip(SPACE).translate(LOW)
            if len(key) >= min_chars and i is not None:
                holders[key].add(i)
    out = []
    for i, t in docs:
        kept = []
        for line in (t or "").split("\n"):
            own = holders[line.strip(SPACE).translate(LOW)]
            if i is None or len(own) < min_docs or i == max(own):
                kept.append(line)
        out.append((i, "\n".join(kept)))
    return out


def grams(text, n=5):
    w = words((text or "").translate(LOW))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def classes(docs):
    sets = {i: grams(t) for i, t in docs}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: find(i) for i in ids}


def contaminated(docs, items, window=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    wanted = defaultdict(set)
    for item, t in items:
        w = re.findall(pattern, (t or "").translate(LOW))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted[tuple(w[i : i + n])].add(str(item))
    out = []
    for i, t in docs:
        w = re.findall(pattern, (t or "").translate(LOW))
        hit, found = set(), set()
        for n in {len(g) for g in wanted}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wanted:
                    hit |= set(range(k, k + n))
                    found |= wanted[tuple(w[k : k + n])]
        out.append((i, len(w), sorted(hit), sorted(found)))
    return out
