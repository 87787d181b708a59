"""Exact comparison of lines: many pairs at once, and no pair twice."""

import itertools

import numpy as np
import pyarrow as pa

from tests.llm import brute
from tests.llm.conftest import frame
from tidepool.llm import common, line_dedup


def variants(n, seed=3):
    """Texts in groups that differ in a few code points, some with repeated shingles, one pair at exactly 4/5."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        base = "".join(rng.choice(list("abcdefgh é日"), size=int(rng.integers(40, 400)))).strip().ljust(30, "x") + "y" * int(rng.integers(0, 30))
        at = int(rng.integers(0, 20))
        out += [base, base[:at] + "Q" * int(rng.integers(0, 25)) + base[at:], base[at:].strip().rjust(20, "z"), base + base[:at]]
    return list(dict.fromkeys([*out, "abcdefghijklmnopqrs", "abcdefghijklmnopqrstuv"]))


def facts(texts):
    size, maps = line_dedup.parities([t.encode() for t in texts])
    return size.astype(np.int32), maps.view(np.int64)


def test_pairs_are_verified_many_at_once(monkeypatch):
    texts = variants(30)
    size, _ = facts(texts)
    sets = [line_dedup.shingles(t) for t in texts]
    pairs = [(i, j) for j in range(len(texts)) for i in range(max(0, j - 5), min(j + 6, len(texts))) if i != j]
    want = [(i, j) for i, j in pairs if len(np.intersect1d(sets[i], sets[j])) * 5 >= 4 * len(np.union1d(sets[i], sets[j]))]
    assert 20 < len(want) < len(pairs) - 20 and (len(texts) - 2, len(texts) - 1) in want
    i, j = (list(x) for x in zip(*pairs, strict=True))
    batch = pa.RecordBatch.from_pydict({
        "line": pa.array(i, pa.int64()), "least": pa.array(j, pa.int64()), "size": pa.array(size[i]), "least_size": pa.array(size[j]),
        "content": [texts[k] for k in i], "least_content": [texts[k] for k in j]})
    made, plain = [], common.Rolling
    monkeypatch.setattr(common, "Rolling", lambda values: made.append(1) or plain(values))
    got = pa.Table.from_batches(line_dedup._verified(iter([batch, batch.slice(0, 0)]))).to_pydict()
    assert list(zip(got["line"], got["least"], strict=True)) == want
    assert len(made) < len(pairs) / 20          # one a pair and one a leader before
    monkeypatch.setattr(common, "CHUNK_BYTES", 700)
    monkeypatch.setattr(line_dedup, "AT_ONCE", 300)
    again = pa.Table.from_batches(line_dedup._verified(iter([batch]))).to_pydict()
    assert again == got


def test_cells_link_what_is_alike():
    texts = variants(12, seed=5)
    size, maps = facts(texts)
    alike = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if line_dedup.alike(line_dedup.shingles(texts[i]), line_dedup.shingles(texts[j]))]

    def components(links, nodes):
        parent = dict(zip(nodes, nodes, strict=True))
        for a, b in links:
            a, b = parent[a], parent[b]
            parent = {k: min(a, b) if v in (a, b) else v for k, v in parent.items()}
        return parent

    for blocks in (1, 2):
        rows = [(7, 0, blocks - 1, i, i % blocks, i, t, int(size[i]), *maps[i].tolist()) for i, t in enumerate(texts)]
        names = ["key", "lo", "hi", "line", "block", "component", "content", "size", *line_dedup.MAPS]
        batch = pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows, strict=True)], names=names)
        got = pa.Table.from_batches(line_dedup._compared(iter([batch]))).to_pydict()
        want = [(i, j) for i, j in alike if blocks == 1 or i % 2 != j % 2]
        links = list(zip(got["least"], got["line"], strict=True))
        assert links and {tuple(sorted(x)) for x in links} <= set(want)
        assert components(links, range(len(texts))) == components(want, range(len(texts)))


def test_pairs_with_a_leader_are_not_compared_again(spark, monkeypatch):
    rng = np.random.default_rng(8)
    data = []
    for k in range(12):
        base = "".join(rng.choice(list("abcdefghijklmnop"), size=120))
        data += [(2 * k, base), (2 * k + 1, base[:60] + "QQQQQQQQ" + base[68:])]
    keys = line_dedup.band_keys([t.encode() for _, t in data])
    assert sum(bool((keys[2 * k] == keys[2 * k + 1]).any()) for k in range(12)) >= 6
    seen, plain = [], common.block_pairs
    monkeypatch.setattr(common, "block_pairs", lambda rows, *a: seen.append(rows.count()) or plain(rows, *a))
    got = {r["doc_id"]: (r["__removed"], r["text"]) for r in line_dedup.rewrite(frame(spark, [(d, t, "en", "s") for d, t in data])).collect()}
    assert got == brute.line_dedup(data) and all(n == 0 for n, _ in got.values())
    assert seen == [0]                          # both lines of every such run before
