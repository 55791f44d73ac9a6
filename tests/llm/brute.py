"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {i: i + 32 for i in range(65, 91)}


def held_out(doc_id, fold, remainder):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % fold == remainder


def shingles(text, size=5):
    w = WORDS.findall((text or "").translate(LOW))
    if len(w) >= size:
        return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


def components(rows, low=80, high=100):
    """Of (id, text): size of the set and least id in reach, for each row in order."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x]).items():
            if high * n >= low * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(len(s), least.get(root(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def without_repeats(rows, size=20):
    """Of (id, text): words, words removed and SHA-256 of those left. Ids must differ."""
    words = {d: WORDS.findall(t or "") for d, t in rows}
    seen, gone = set(), defaultdict(set)
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            window = tuple(words[d][i:i + size])
            if window in seen:
                gone[d].update(range(i, i + size))
            seen.add(window)
    out = {}
    for d, w in words.items():
        left = " ".join(x for i, x in enumerate(w) if i not in gone[d])
        out[d] = len(w), len(gone[d]), hashlib.sha256(left.encode()).hexdigest()
    return out


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def benchmark_hits(text, items, window=13):
    """Words, hit words and items found of one text; items: (id, text)."""
    words, hit, found = benchmark_words(text), set(), set()
    for name, item in items:
        w = benchmark_words(item)
        n = min(window, len(w))
        parts = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in parts:
                hit.update(range(i, i + n))
                found.add(str(name))
    return len(words), len(hit), sorted(found)


SECRETS = [
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def secrets(text):
    out = []
    for order, (kind, pattern, group, least) in enumerate(SECRETS):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def line_tokens(line):
    # The white space of the engine's expressions is ASCII.
    return ["<*>" if re.search("[0-9]", t) else t for t in re.split(r"[ \t\n\x0b\f\r]+", line) if t]


def line_dedup(rows, depth=3, min_tokens=3, similarity=0.7, min_docs=5, min_copies=2):
    """Of (id, text), ids different: text left and lines dropped. One model a turn in each leaf."""
    def word(t):
        return t != "<*>" and any(c.isalpha() for c in t)

    def words(line):
        return tuple(t for t in re.split(r"[ \t\n\x0b\f\r]+", line) if t)

    def alike(a, b):
        same = [x for x, y in zip(a, b) if x == y]
        return len(same) >= similarity * len(a) and 2 * sum(map(word, same)) >= len(a)

    exact, shapes, leaves = defaultdict(set), defaultdict(set), defaultdict(set)
    lines = {d: (t or "").split("\n") for d, t in rows}
    keys = {}
    for d, ls in lines.items():
        for line in ls:
            w, t = words(line), tuple(line_tokens(line))
            if len(w) < min_tokens:
                continue
            loose = 2 * sum(map(word, t)) >= len(t)
            keys[line] = w, t if loose else ("exact", w)
            exact[w].add(d)
            shapes[keys[line][1]].add(d)
            leaves[(len(t), t[:depth]) if loose else w].add(keys[line][1])
    template = {}
    for leaf in leaves.values():
        left = sorted(leaf, key=lambda s: -len(shapes[s]))
        while left:
            model = left[0]
            for s in [s for s in left if s == model or alike(s, model)]:
                template[s] = model
                left.remove(s)
    held = defaultdict(set)
    for s, m in template.items():
        held[m] |= shapes[s]

    def goes(d, line):
        if line not in keys:
            return False
        w, s = keys[line]
        return (len(exact[w]) >= min_copies and d != min(exact[w])) or (
            len(held[template[s]]) >= min_docs and d != min(held[template[s]]))

    out = {}
    for d, t in rows:
        left = [line for line in lines[d] if not goes(d, line)]
        out[d] = None if t is None else "\n".join(left), len(lines[d]) - len(left)
    return out
