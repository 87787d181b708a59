"""The bulk encoder against the tokenizers library, and the size of what it merges at once."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidepool.llm import packing as P
from tidepool.llm import tokens as K


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_are_the_librarys_and_merges_stay_bounded(monkeypatch, name, spaced):
    path = public_tokenizers.path(name)
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(3, 9))) for _ in range(3_000)]
    odd = ["a\x1cb\x1d\x1e\x1f c\x0b\x0c\r\t d", "<|endoftext|> x", "e\x00 y", "  ", "", " \x85 é\x85", "é\t  x", "<", ".,", "a, b. c\n\nd", "1 0 2", "Привет, мир."]
    texts = [" ".join(words[lo:lo + 100]) for lo in range(0, 3_000, 100)] + odd
    enc, rows = K.Encoder(path, spaced, cache_units=2_000), []
    monkeypatch.setattr(K, "BULK", 100)
    step = enc.merges.merge_step
    monkeypatch.setattr(enc.merges, "merge_step", lambda table, size: rows.append(len(table)) or step(table, size))
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(texts)] == want
    assert [x.tolist() for x in enc.encode(odd[::-1])] == want[:-len(odd) - 1:-1]
    assert enc.encode([]) == [] and enc.merges.data is None
    assert rows and max(rows) <= 100


def test_packing_encodes_bounded_chunks(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [f"plain words of row {i}, again and again. " * (1 + i % 5) for i in range(200)] + [None, "", "x " * 5_000]
    enc = K.encoder(path, spaced=False, cache_units=P.CACHE_UNITS)
    seen, encode = [], enc.encode
    monkeypatch.setattr(enc, "encode", lambda part: seen.append([len(t.encode()) for t in part]) or encode(part))
    monkeypatch.setattr(P, "CHUNK", 2_000)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    got = pa.Table.from_batches(list(P._pieces(path)(iter([batch])))).to_pylist()
    assert all(len(s) == 1 or sum(s) <= 2_000 for s in seen) and sum(map(len, seen)) == len(texts)
    length = {}
    for r in got:
        length[r["doc_id"]] = length.get(r["doc_id"], 0) + r["length"]
    library = Tokenizer.from_file(path)
    library.no_truncation()
    assert length == {i: 1 + len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
