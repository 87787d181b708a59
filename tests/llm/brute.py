"""Plain versions of the operators' contracts, over lists of (doc_id, text), for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\r\x0b\x0c"


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def jaccard_components(rows, words=3, num=9, den=10):
    """{doc_id: (set size, component)} for rows with distinct ids."""
    sets = {}
    for d, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[d] = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    has, g = defaultdict(list), Groups()
    for d, s in sets.items():
        both = Counter(e for x in s for e in has[x])
        for e, n in both.items():
            if den * n >= num * (len(s) + len(sets[e]) - n):
                g.join(d, e)
        for x in s:
            has[x].append(d)
    return {d: (len(s), g.find(d)) for d, s in sets.items()}


def line_dedup(rows, size=8, least=16):
    """{doc_id: (lines removed, text)} by exact Jaccard of all pairs of lines."""
    lines = [(d, i, s) for d, t in rows if t is not None for i, x in enumerate(t.split("\n")) if len(s := x.strip(BLANK)) >= least]
    kinds = sorted({s for _, _, s in lines})
    sets = [{s[i:i + size] for i in range(len(s) - size + 1)} for s in kinds]
    has, g = defaultdict(list), Groups()
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in has[x]).items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                g.join(k, j)
        for x in s:
            has[x].append(k)
    at, first, gone = {s: k for k, s in enumerate(kinds)}, {}, defaultdict(set)
    for d, i, s in sorted(lines):
        first.setdefault(g.find(at[s]), (d, i))
    for d, i, s in lines:
        if first[g.find(at[s])] != (d, i):
            gone[d].add(i)
    return {d: (len(gone[d]), None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])) for d, t in rows}


def substring_dedup(rows, width=50):
    """{doc_id: (words, removed, sha256 of the kept ones)} for rows with distinct ids."""
    words = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - width + 1):
            first.setdefault(tuple(words[d][i:i + width]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < d:
                gone[i:i + width] = [True] * width
        kept = " ".join(x for x, y in zip(w, gone, strict=True) if not y)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def base_statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    t = text or ""
    w = WORD.findall(t)
    many = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = {j for i in range(len(w) - 2) if many[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n, r = len(w), len(cover)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


def mcd_verdict(v, floor, coverage, consistency, cutoff, steps):
    """Which rows of ``v`` the robust estimate of all of them rejects."""
    q = np.quantile(v, [0.25, 0.5, 0.75], axis=0)
    mean, cov = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2)
    for _ in range(steps):
        d2 = np.einsum("ni,ij,nj->n", v - mean, np.linalg.inv(cov + np.diag(np.square(floor))), v - mean)
        inner = v[np.argsort(d2, kind="stable")[:int(np.ceil(coverage * len(v)))]]
        mean, cov = inner.mean(axis=0), consistency * np.cov(inner.T, bias=True)
    d2 = np.einsum("ni,ij,nj->n", v - mean, np.linalg.inv(cov + np.diag(np.square(floor))), v - mean)
    return d2 > cutoff


def encoded(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def crc(ids):
    return zlib.crc32(ids.tobytes())


def neighbours(rows, k=10, every=100):
    """{query: [(score, id)]} by comparing everything with everything."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in good:
        if q % every == 0:
            out[q] = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in good if i != q)[:k]
    return out
