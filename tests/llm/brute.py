"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def near(rows, percent=75):
    """doc_id -> (set size, component) by comparing all that share a shingle."""
    sets, up = {}, {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        up[d] = d

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    with_ = defaultdict(list)
    for d in sorted(sets):
        for s in sets[d]:
            with_[s].append(d)
    for d in sets:
        for e in {e for s in sets[d] for e in with_[s]} - {d}:
            met = len(sets[d] & sets[e])
            if 100 * met >= percent * (len(sets[d]) + len(sets[e]) - met):
                a, b = sorted((top(d), top(e)))
                up[b] = a
    return {d: (len(sets[d]), top(d)) for d in sets}


def substrings(rows, size=100):
    """doc_id -> (bytes, removed, spans, kept)."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - size + 1):
            w = data[i : i + size]
            if w in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(w)
        out[d] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(data, gone, strict=True) if not g))
    return out


def substrings_of_rows(rows, size=100):
    """(removed, spans) of each row; rows of one id are equals."""
    texts = [(t or "").encode() for _, t in rows]
    least = {}
    for (d, _), data in zip(rows, texts, strict=True):
        for i in range(len(data) - size + 1):
            w = data[i : i + size]
            least[w] = min(least.get(w, d), d)
    out = []
    for (d, _), data in zip(rows, texts, strict=True):
        gone, own = bytearray(len(data)), set()
        for i in range(len(data) - size + 1):
            w = data[i : i + size]
            if least[w] < d or w in own:
                gone[i : i + size] = b"\1" * size
            own.add(w)
        out.append((sum(gone), len(re.findall(b"\1+", bytes(gone)))))
    return out


def passages(rows, size=13):
    """doc_id -> (words, removed, kept)."""
    words = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i : i + size]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def base_secrets(text):
    """(start, kind, end) by the contract's patterns, word for word."""
    text = text or ""
    out = []
    for k, (p, flags, least, group) in enumerate(
        [
            (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 6, 2),
            (r"AKIA[A-Z0-9]+", 0, 20, 0),
            (r"[0-9a-f]+", 0, 24, 0),
        ]
    ):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text, flags) if len(m[group]) >= least]
    return sorted(out)


def best_fit(lengths, size):
    """Number of sequences that best fit decreasing needs."""
    free = Counter()
    n = 0
    for length in sorted(lengths, reverse=True):
        gap = next((g for g in range(length, size + 1) if free[g]), None)
        if gap is None:
            n, gap = n + 1, size
        else:
            free[gap] -= 1
        free[gap - length] += 1
    return n


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def occurrences(rows, one_in=97, least=5):
    """Words of all rows, a letter of each one_in-th left out."""
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            w = w[: h % len(w)] + w[h % len(w) + 1 :] if h % one_in == 0 else w
            if len(w) >= least:
                yield w


def one_apart(a, b):
    """Whether one letter inserted, deleted or replaced makes a into b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words, least=3, factor=2):
    """word -> (form, root, n, n_near, form_n) by looking at all pairs."""
    n = {w: m for w, m in Counter(words).items() if m >= least}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def lloyd(rows, parts=4, entries=256, rounds=4, scale=1024):
    """[(id, label, code, error)] of rows (id, label, vector) without faults, and the codebooks, all distances looked at."""
    whole = [(d, l, [math.floor(scale * x) for x in v]) for d, l, v in rows]
    width = len(whole[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in whole]
    first = {}
    for (d, _, _), v in zip(whole, cut, strict=True):
        if d is not None:
            first[d] = min(first.get(d, v), v)
    books = [[first[d][p] for d in sorted(first)[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for v in cut:
                members[nearest(v[p], book)[1]].append(v[p])
            books[p] = [[sum(c) // len(c) for c in zip(*members[j], strict=True)] if j in members else c for j, c in enumerate(book)]
    best = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    return [(d, l, bytes(j for _, j in b), sum(e for e, _ in b)) for (d, l, _), b in zip(whole, best, strict=True)], books
