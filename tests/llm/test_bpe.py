"""Encoding and decoding against the tokenizers library, unchanged."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.conftest import frame, rows
from tidepool.llm import bpe, queries, transducer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = ["<|endoftext|> end", "a<|endoftext|>", "<|endoftext|><|endoftext|>", "x <|endoftext|>\n\n y <|endoftext", "<|endoftext|>"]
HARD = ["I'll we've 'S it's''s", "  lead\t\ttabs \r\n\x0b\x0c\x85 \xa0　 nbsp", "ünïcödé ﬁ ǅ ½ Ⅷ ٣४ 한국어 ไทย 👩‍👩‍👧", "\x00\x1c\x1d\x1e\x1f a\x1cb 1\x1f2",
        "՘₏ \U000107bb1", "a" * 3000, "é" * 700, "abc" * 5000 + "1" * 400 + "!" * 900, "é" * 31 + " " + "é" * 32 + " " + "é" * 33]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


def want(model, text):
    ids = model.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def result(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in df.collect())


@pytest.mark.parametrize("limit", [0, 40, 1 << 16])
def test_odd_rows(spark, model, limit):
    data = rows() * 2 + [(None, "no id", "en", "a")] + [(100 + i, t, "en", "a") for i, t in enumerate(SPECIAL + HARD)]
    got = result(bpe.digests(frame(spark, data), PATH, limit))
    assert got == sorted((d is None, d or 0, *want(model, t)) for d, t, *_ in data)


def test_round_trip(spark, empty):
    data = rows() + [(100 + i, t, "en", "a") for i, t in enumerate(SPECIAL + HARD)]
    back = bpe.decode(bpe.encode(frame(spark, data), PATH), PATH)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {d: t or "" for d, t, *_ in data}
    assert bpe.digests(empty, PATH).count() == 0


def test_whole_table(spark, model):
    data = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert result(queries.op13_bpe_transducer(spark, SF_SMALL)) == sorted((False, r["doc_id"], *want(model, r["text"])) for r in data)


def test_every_code_point_is_cut_as_the_library_does(model):
    known = bpe.vocabulary(PATH)
    cutter = bpe.Cutter(PATH, known, bpe.classed_apart(PATH))
    spelt = str.maketrans({c: b for b, c in enumerate(bpe.byte_letters())})
    assert len(spelt) == 256
    for lo in range(0, 0x110000, 64):
        text = "".join(f"a{chr(c)}b 1{chr(c)}2!{chr(c)}? {chr(c)}" for c in range(lo, lo + 64) if not 0xD800 <= c < 0xE000)
        assert cutter.words(text) == [text[a:b] for _, (a, b) in model.pre_tokenizer.pre_tokenize_str(text)], hex(lo)


def test_merges_in_step_and_by_heap(model):
    known, draw = bpe.vocabulary(PATH), random.Random(5)
    words = ["".join(draw.choice("aenrst hé") for _ in range(draw.randint(1, 40))).replace(" ", "") or "x" for _ in range(3000)] + ["a" * i for i in range(1, 64)]
    for w in words:
        ids = model.encode(w, add_special_tokens=False).ids
        raw = w.encode()
        assert ids == known.merge_long(raw).tolist()
    raw = [w.encode() for w in words]
    seen = 0
    for rows, table, size in bpe.by_width(raw, 60):
        got, n = known.merge_step(table, size)
        ends = np.cumsum(n)
        for i, a, b in zip(rows.tolist(), (ends - n).tolist(), ends.tolist(), strict=True):
            assert got[a:b].tolist() == model.encode(words[i], add_special_tokens=False).ids
        seen += len(rows)
    assert seen == sum(len(w) <= 60 for w in raw) > 2900


def test_transducer_holds_its_words_only_and_shares_suffixes():
    draw = random.Random(7)
    words = sorted({"".join(draw.choice("abc") for _ in range(draw.randint(1, 7))).encode() for _ in range(900)})
    pairs = {w: tuple(draw.randint(0, 3) for _ in range(draw.randint(1, 4))) for w in words}
    arrays = transducer.compile_words(sorted(pairs.items()))
    machine = transducer.Transducer(np.frombuffer(transducer.to_bytes(arrays, {"apart": ""}), np.uint8))
    for length in range(1, 9):
        every = [bytes(draw.choice(b"abcd") for _ in range(length)) for _ in range(500)] + [w for w in words if len(w) == length]
        table = np.frombuffer(b"".join(w.ljust(9, b"a") for w in every), np.uint8).reshape(-1, 9)
        found, ids, size = machine.lookup(table, np.full(len(every), length))
        assert found.tolist() == [w in pairs for w in every]
        ends = np.cumsum(size)
        assert [tuple(ids[e - n:e].tolist()) for e, n in zip(ends, size, strict=True)] == [pairs[w] for w in every if w in pairs]
    endings = transducer.compile_words((a + b"ation", (1, 2)) for a in (b"cre", b"don", b"not", b"rel"))
    assert len(endings["first"]) - 1 == 1 + 1 + 4 + 4 + 5        # end, start, two states for each stem's inside, then one shared tail
    with pytest.raises(ValueError, match="sorted"):
        transducer.compile_words([(b"b", (1,)), (b"a", (2,))])
    nothing = transducer.Transducer(np.frombuffer(transducer.to_bytes(transducer.compile_words([]), {}), np.uint8))
    assert not nothing.lookup(np.zeros((2, 3), np.uint8), np.array([3, 2]))[0].any()


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
