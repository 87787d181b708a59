"""Collocations against a plain count over the texts."""

import collections
import re

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm.conftest import LONG, frame, rows
from tidepool.llm import collocations, common


def brute(data, least, cover=50, longest=3, limit=2000):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, _ in data:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f.update((lang or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    many = {p: c for p, c in f.items() if c >= least and len(p) > 2}
    out = collections.defaultdict(list)
    for (lang, *w), a in many.items():
        w = tuple(w)
        if any(len(q) - 1 > len(w) and q[0] == lang and 100 * c >= cover * a and any(q[1 + i:1 + i + len(w)] == w for i in range(len(q) - len(w)))
               for q, c in many.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:limit])}


def result(df):
    return {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


EXTRA = [(20 + i, "New  York\tis big, new york IS big. The new york times; the NEW YORK times\x0bnew york " + "x" * 5000 + " " + "x" * 5000, ["en", None][i % 2], "a") for i in range(6)]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_odd_rows(spark, longest):
    data = [r for r in rows() if r[1] != LONG] * 2 + EXTRA
    want = brute(data, 3, longest=longest)
    assert len(want) > 20
    assert result(collocations.top(collocations.mine(frame(spark, data), least=3, longest=longest))) == want


def test_ranks_are_cut_and_ties_go_by_phrase(spark):
    data = [(i, "b a. a b! z y? y z; ç d: d ç", "en", "s") for i in range(3)] + [(9, LONG, "de", "s")]
    assert result(collocations.top(collocations.mine(frame(spark, data), least=3), limit=3)) == brute(data, 3, limit=3)


@pytest.mark.parametrize("bits", [6, 12])
def test_fingerprints_that_collide_are_told_apart(spark, bits):
    data = [r for r in rows() if r[1] != LONG] * 2 + EXTRA
    assert result(collocations.top(collocations.mine(frame(spark, data), least=3, bits=bits))) == brute(data, 3)


def test_full_buffers_and_small_tables(spark, monkeypatch, empty):
    monkeypatch.setattr(collocations, "HELD", 50)
    data = EXTRA + rows()[:3]
    assert result(collocations.top(collocations.mine(frame(spark, data), least=2))) == brute(data, 2)
    assert collocations.mine(empty).count() == 0
    assert collocations.mine(frame(spark, [(1, None, "en", "s"), (2, " .. ", None, "s")])).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    data = [(r["doc_id"], r["text"], r["lang"], None) for r in docs.select("doc_id", "text", "lang").collect()]
    assert result(collocations.top(collocations.mine(docs))) == brute(data, 10)


def test_products_modulo_the_prime():
    rng = np.random.default_rng(3)
    p = int(collocations.PRIME)
    a = np.concatenate([rng.integers(0, p, 2000, dtype=np.uint64), np.array([0, 1, p - 1, p - 1], np.uint64)])
    b = np.concatenate([rng.integers(0, p, 2000, dtype=np.uint64), np.array([p - 1, p - 1, p - 1, 1], np.uint64)])
    assert collocations.times(a, b).tolist() == [int(x) * int(y) % p for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert collocations.powers(collocations.BASE, 100)[:100].tolist() == [pow(collocations.BASE, i, p) for i in range(100)]


def test_regular_words_have_their_own_hashes():
    """Words for which a polynomial modulo 2**64 gives one hash, whatever its base."""
    a, b = "a", "b"
    while len(a) < 4096:
        a, b = a + b, b + a
    block = common.Block([a.encode(), b.encode(), f"x {b}".encode(), a.encode()])
    assert block.words[0] == block.words[4] != block.words[1] == block.words[3]
    grams = collocations.Grams([a.encode(), b.encode()], np.zeros(2, np.uint64))
    at = grams.runs(1)
    assert len(set(grams.fingerprints(at, 1).tolist())) == 2
