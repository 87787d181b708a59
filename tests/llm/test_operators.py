"""Each operator against its plain version, on odd rows and on the whole of sf0.001."""

import collections
import os
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import frame, rows
from tidepool.llm import (ann, common, fm_index, language_id, line_dedup, mixing, ngram_join, packing, pii, quality_rules, queries,
                          substring_dedup, token_store, tokens)

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def small(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def pairs(data=None):
    return [(d, t) for d, t, *_ in data or rows()]


def table(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


# ------------------------------------------------------------------ 1 surrogates

def test_surrogates(spark, doubled, empty):
    texts = ["Write to anna.meier@corp.example.org or ANNA.MEIER@CORP.EXAMPLE.ORG today", "card 4539578763621486 and 4539 5787 6362 1486, not 4539578763621487",
             "ip 10.20.30.40 not 300.1.2.3", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end', "call +1 (017) 555-7713 or (212) 555-0199",
             "Mrs. Mary Smith met Mr. John Smith; Mr. Smith left", "Господин Иван Петров", "DE89 3704 0044 0532 0130 00 is an account", "ssn 123-45-6789", "clean text, 12.5 and 2024-01-02"]
    out = table(pii.replace(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])), "n_entities", "text")
    a, b = re.findall(r"\S+@\S+", out[0][1])
    assert a.lower() == b.lower() and b.isupper() and "meier" not in a and a.endswith(".example")
    one, two, three = re.match(r"card (\d{16}) and (\d{4} \d{4} \d{4} \d{4}), not (\d{16})", out[1][1]).groups()
    assert one == two.replace(" ", "") != "4539578763621486" and three == "4539578763621487" and out[1][0] == 2
    digits = [int(c) for c in one[::-1]]
    assert (sum(digits[::2]) + sum(2 * d - 9 if d > 4 else 2 * d for d in digits[1::2])) % 10 == 0
    assert out[2][0] == 1 and "300.1.2.3" in out[2][1] and "10.20.30.40" not in out[2][1]
    assert re.fullmatch(r'token = "[0-9a-f]{40}" end', out[3][1]) and "24be64439e" not in out[3][1]
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4}", out[4][1]) and "7713" not in out[4][1]
    first, last1, _, last2, last3 = re.match(r"Mrs\. (\w+) (\w+) met Mr\. (\w+) (\w+); Mr\. (\w+) left", out[5][1]).groups()
    assert last1 == last2 == last3 != "Smith" and first.endswith(("a", "elle"))
    assert re.fullmatch(r"Господин [А-Яа-я]+ [А-Яа-я]+", out[6][1]) and "Иван" not in out[6][1]
    iban = re.match(r"(DE[\d ]+) is", out[7][1]).group(1).replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and iban != "DE89370400440532013000"
    assert re.fullmatch(r"ssn 9\d\d-\d\d-\d{4}", out[8][1])
    assert out[9] == (0, texts[9])
    other = table(pii.replace(frame(spark, [(0, texts[0], "en", "s")]), key="another"), "text")
    assert other[0] != (out[0][1],)
    same = pii.replace(doubled).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in same) == collections.Counter(pairs(rows() * 2) + [(None, rows()[0][1])])
    assert pii.replace(empty).count() == 0


def test_surrogates_are_drawn_again_on_collisions(spark, monkeypatch):
    monkeypatch.setattr(pii, "_PARTS", {k: v[:1] * 32 for k, v in pii._PARTS.items()})      # four surnames in all
    texts = ["Mr. Abc was seen", "Mr. Def was seen", "Mr. Ghi was seen, and Mr. Abc"]
    out = table(pii.replace(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])), "text")
    a, d, g, again = re.findall(r"Mr\. (\w+)", " ".join(out[i][0] for i in range(3)))
    assert len({a, d, g}) == 3 and again == a


def test_phone_surrogates_are_checked_as_they_are_written(spark):
    texts = ["+44 20 7946 0958 or +442079460958 now", "+49 30 901820 or +4930901820 now", "+1 212 555 0199 or +12125550199 now", "(212) 555-0199 or 212.555.0199 now"]
    out = table(pii.replace(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])), "n_entities", "text")
    for i, (code, t) in enumerate(zip(["+44", "+49", "+1", ""], texts, strict=True)):
        a, b = out[i][1].removesuffix(" now").split(" or ")
        assert out[i][0] == 2 and re.sub(r"\D", "", a) == re.sub(r"\D", "", b) and a.startswith(code) and a != t.split(" or ")[0]
    norms = ["+442079460958", "+4930901820", "2125550199"]
    df = spark.createDataFrame([("phone", n, w) for n, w in zip(norms, ["+44 20 7946 0958", "+49 30 901820", "(212) 555-0199"], strict=True)], "kind string, norm string, text string")
    def drawn(w):
        return pii._phone_norm(pii.surrogate("k", F.col("kind"), w, F.col("norm"), F.lit(0)))
    assert all(r["a"] == r["b"] for r in df.select(drawn(pii._written(F.col("kind"), F.col("norm"))).alias("a"), drawn(F.col("text")).alias("b")).collect())


def test_surrogates_grow_where_a_space_is_full(spark):
    texts = [f"mail {i}@corp.org now" for i in range(10)]
    out = table(pii.replace(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])), "n_entities", "text")
    assert all(n == 1 and re.fullmatch(r"mail \w+@\w+\.example now", t) for n, t in out.values()) and len({t for _, t in out.values()}) == 10
    kinds = {"card": "4539578763621486", "ssn": "123456789", "phone": "+442079460958", "iban": "DE89370400440532013000", "ip": "10.20.30.40", "surname": "smith", "secret": "24be64439e3e49cf"}
    df = spark.createDataFrame(list(kinds.items()), "kind string, norm string")
    def drawn(draw):
        return pii.surrogate("k", F.col("kind"), pii._written(F.col("kind"), F.col("norm")), F.col("norm"), F.lit(draw))
    for r in df.select(drawn(0).alias("a"), drawn(pii.DRAWS + 2).alias("b")).collect():
        assert len(r["b"]) >= len(r["a"]) + 3


def test_surrogates_of_further_forms(spark):
    names = ["Mrs. O'Brien", "Mr. J. Smith", "Mr. J. R. R. Smith", "Mr J Smith", "Mr. McDonald", "Mr Smith", "Dr Jones", "Mr. SMITH", "Mrs. O’Brien", "Mr. Smith's"]
    phones = ["1-800-555-1234", "555 123 4567", "(020) 7946 0958", "+1 800 555 1234", "1 (800) 555-1234"]
    texts = [f"so {x} it is" for x in names + phones]
    out = table(pii.replace(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])), "n_entities", "text")
    got = dict(zip(names + phones, (re.fullmatch("so (.*) it is", out[i][1]).group(1) for i in range(len(texts))), strict=True))
    assert all(out[i][0] == 1 for i in range(len(texts)))
    for x in names:
        assert not re.search("Brien|Smith|SMITH|Donald|Mc|Jones", got[x]) and got[x].split()[0] == x.split()[0], x
    smith = got["Mr Smith"].split()[-1]
    assert all(got[x].split()[-1] == smith for x in ("Mr. J. Smith", "Mr. J. R. R. Smith", "Mr J Smith")) and got["Mr. SMITH"] == "Mr. " + smith.upper()
    assert got["Mr. Smith's"] == f"Mr. {smith}'s" and got["Mrs. O'Brien"] == got["Mrs. O’Brien"]
    for x in phones:
        assert got[x] != x and re.sub(r"\d", "", got[x]) == re.sub(r"\d", "", x)
    assert len({re.sub(r"\D", "", got[x]) for x in ("1-800-555-1234", "+1 800 555 1234", "1 (800) 555-1234")}) == 1


def test_surrogates_whole_table(spark, small):
    got = table(queries.op1_pii_surrogates(spark, SF_SMALL), "n_entities", "text")
    seen = {}
    for d, t in small:
        n, new = got[d]
        private = re.findall(r"[\w.]+@[\w.]+\w", t) + re.findall(r"\+\d \(\d{3}\) \d{3}-\d{4}", t) + re.findall(r'(?i)token = "(\w+)"', t)
        assert all(p not in new for p in private) and (n > 0) >= bool(private)
        assert n > 0 or new == t
        if len(t.split()) == len(new.split()):
            for x, y in zip(t.split(), new.split(), strict=True):
                assert seen.setdefault(x, y) == y            # one value, one surrogate
    assert len(got) == len(small)


# ------------------------------------------------------------------ 2 neighbours

def neighbours_of(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return dict(out)


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300 + i, [1.0] * 8) for i in range(200)]
    data += [(600, None), (700, [0.0] * 8), (800, [None] + [1.0] * 7), (900, [float("nan")] * 8), (1000, [float("inf")] * 8), (1100, [1.0] * 3), (None, [1.0] * 8)]
    data += data[:5]
    df = spark.createDataFrame([(i, v, "clash", "clash") for i, v in data], "vec_id long, embedding array<float>, name string, h string").repartition(5)
    got = neighbours_of(ann.search(df, F.col("vec_id") % 100 == 0))
    want = brute.neighbours({i: (i, v) for i, v in data if v is None or len(v) == 8}.values())
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]] and np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12)
    few = ann.search(df.filter("vec_id in (0, 1, 2)"), F.col("vec_id") == 0)
    assert few.count() == 2 and ann.search(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_recall(spark):
    got = neighbours_of(queries.op2_balanced_posting_lists(spark, SF_SMALL.replace("0.001", "0.1")))
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/embeddings.parquet").collect()]
    want = brute.neighbours(data)
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.9 * sum(map(len, want.values()))


def test_neighbours_are_exact_with_hundreds_of_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 8)              # 250 lists, far more than a query probes at first
    rows_ = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/embeddings.parquet").select("vec_id", "embedding")
    got = neighbours_of(ann.search(rows_, F.col("vec_id") % 100 == 0))
    assert {q: [i for _, i in x] for q, x in got.items()} == {
        q: [i for _, i in x] for q, x in brute.neighbours([(r["vec_id"], r["embedding"]) for r in rows_.collect()]).items()}


def test_posting_lists_are_balanced_and_the_graph_connected():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(900, 6)), rng.normal(size=(100, 6)) * 0.01 + 5])
    centres = ann.balanced_centroids(x, 16)
    g = ann.Graph(centres)
    assert len(centres) == 16 and set(g.nearest(x[0], 16)[0]) == set(range(16))
    at, d = g.nearest(x[3], 4)
    assert np.allclose(np.sort(np.sqrt(((centres - x[3]) ** 2).sum(axis=1)))[:4], d) and g.lists_of(x[3])[0] == at[0]


# ------------------------------------------------------------------ 3 n-gram join

@pytest.mark.parametrize("rule", [(3, 9, 10), (5, 4, 5)])
def test_ngram_join(spark, odd, doubled, empty, small, rule):
    want = brute.jaccard_components(pairs(), *rule)
    assert table(ngram_join.near_equal(odd, ngram_join.Join(*rule)), "n_shingles", "component_id") == want
    twice = ngram_join.near_equal(doubled, ngram_join.Join(*rule)).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in twice if r["doc_id"]) == {(d, *v): 2 for d, v in want.items()}
    assert [r["component_id"] for r in twice if r["doc_id"] is None] == [None]
    assert ngram_join.near_equal(empty).count() == 0
    got = ngram_join.near_equal(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), ngram_join.Join(*rule))
    assert table(got, "n_shingles", "component_id") == brute.jaccard_components(small, *rule)


def test_ngram_join_of_graded_families(spark, monkeypatch):
    """Chains of edits around the threshold, with groups larger than a block."""
    monkeypatch.setattr(ngram_join, "LEADER_BLOCK", 4)
    monkeypatch.setattr(ngram_join, "RUN_BLOCK", 4)
    rng = np.random.default_rng(3)
    data = []
    for f in range(6):
        words = [f"f{f}w{i}" for i in range(120)]
        for k in range(15):
            w = list(words)
            for i in rng.integers(0, 120, size=k % 5):
                w[i] = f"e{rng.integers(10 ** 6)}"
            data.append((len(data), " ".join(w)))
            if k % 3 == 0:
                words = w
    got = table(ngram_join.near_equal(frame(spark, [(d, t, "en", "s") for d, t in data])), "n_shingles", "component_id")
    assert got == brute.jaccard_components(data)


def test_trie_finds_all_links():
    rng = np.random.default_rng(0)
    rule = ngram_join.Join(3, 4, 5)
    sets = [np.unique(rng.integers(0, 40, size=rng.integers(1, 30))).astype(np.uint64) for _ in range(300)]
    tree = ngram_join.Trie(rule)
    for i, s in enumerate(sets):
        want = {j for j in range(i) if 5 * (n := len(np.intersect1d(s, sets[j]))) >= 4 * (len(s) + len(sets[j]) - n)}
        assert set(tree.matches(s, lambda x: False)) == want
        for j in range(i):
            n = len(np.intersect1d(s, sets[j]))
            assert j not in want or rule.may_link(len(s), int.from_bytes(ngram_join.parity(s), "little"), len(sets[j]), int.from_bytes(ngram_join.parity(sets[j]), "little")), n
        tree.add(s, i)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 3)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(chain, "a long, b long").repartition(7)).collect()}
    assert got == {i: 0 for i in range(401)} | {1000 + i: 1000 for i in range(300)}


# ------------------------------------------------------------------ 4 line dedup

def test_line_dedup(spark, odd, doubled, empty, small):
    want = brute.line_dedup(pairs())
    assert table(line_dedup.rewrite(odd), "__removed", "text") == want
    twice = line_dedup.rewrite(doubled.filter("doc_id is not null")).collect()
    assert collections.Counter((r["doc_id"], r["__removed"], r["text"]) for r in twice) == {(d, *v): 2 for d, v in want.items()}
    assert line_dedup.rewrite(doubled).count() == doubled.count() and line_dedup.rewrite(empty).count() == 0
    kept = line_dedup.dedup_lines(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {d for d, (n, t) in want.items() if not n or t.strip()}
    got = table(queries.op4_line_dedup(spark, SF_SMALL), "n_removed", "text")
    assert got == brute.line_dedup(small)


def test_line_dedup_compares_what_leaders_leave_open(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "RUN_BLOCK", 3)
    base = "a rather long line about the weather in the mountains during the cold months of the year number "
    data = [(i, base + w) for i, w in enumerate(["one", "two of many other lines", "two of many other lakes", "one and", "three of many other lakes", "nothing else matters today at all"])]
    assert table(line_dedup.rewrite(frame(spark, [(d, t, "en", "s") for d, t in data])), "__removed", "text") == brute.line_dedup(data)


# ------------------------------------------------------------------ 5 token store

def test_token_store(spark, odd, doubled, empty, small):
    model = Tokenizer.from_file(BYTE)
    for data, df in ((pairs(), odd), (small, spark.read.parquet(f"{SF_SMALL}/documents.parquet"))):
        folder = common.shared_folder(spark)
        got = table(token_store.digest(spark, folder, token_store.write(df, BYTE, folder)), "start", "n_tokens", "ids_crc32")
        want, start = {}, 0
        for d, t in sorted(data):
            ids = brute.encoded(model, t, 2)
            want[d] = (start, len(ids), brute.crc(ids))
            start += len(ids)
        assert got == want
    found = {r["doc_id"]: r["ids"] for r in token_store.lookup(spark, folder, [small[3][0], small[77][0], -5, 10 ** 12]).collect()}
    assert found == {d: brute.encoded(model, t, 2).tolist() for d, t in (small[3], small[77])}
    folder = common.shared_folder(spark)
    twice = token_store.digest(spark, folder, token_store.write(doubled, BYTE, folder)).orderBy("start").collect()
    assert len(twice) == doubled.count() and [r["start"] for r in twice] == np.cumsum([0] + [r["n_tokens"] for r in twice])[:-1].tolist()
    folder = common.shared_folder(spark)
    assert token_store.write(empty, BYTE, folder).count() == 0


def test_perfect_hash():
    for n in (0, 1, 2, 9, 3000):
        keys = np.unique(np.random.default_rng(n).integers(-10 ** 12, 10 ** 12, n))
        s = token_store.Shard(token_store.shard_bytes(keys.tolist(), [np.array([i % 60000, 2]) for i in range(len(keys))], np.dtype("<u2")))
        assert len(s.slots) == len(keys) and [s.find(int(k)) for k in keys] == list(range(len(keys)))
        assert all(s.get(k) is None for k in range(10 ** 13, 10 ** 13 + 200))


@pytest.mark.parametrize("path, spaced", [(BYTE, True), (WORD, False)])
def test_encoder_equals_the_tokenizer(path, spaced):
    rng = np.random.default_rng(2)
    letters = list("ab0 ,.\n'_s\tÉ́ \r")
    texts = ["".join(rng.choice(letters, size=rng.integers(0, 16))) for _ in range(4000)] + [t or "" for _, t in pairs()]
    texts += ["<|endoftext|> end", "a b<|endoftext|>c, d.", "<|startoftext|> X <|ENDOFTEXT|>", "Éé ÀÖØ öÿ ÄÖÜ Straße, ſ İ ŉ ŀ Ωω Ёё Ж", "x" * 300 + " y " + "é" * 70, "İ" * 3]
    enc = tokens.Encoder(path, spaced)
    for _ in range(2):                                 # the second time from the cache
        assert [x.tolist() for x in enc.encode(texts)] == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


# ------------------------------------------------------------------ 6 mixing

def test_period_schedule_is_fair():
    share = mixing.shares({"a": 5.0, "b": 1.0, "c": 0.0, "d": 2.2}, 200)
    assert sum(share.values()) == 200 and min(share.values()) >= 1
    given = dict.fromkeys(share, 0)
    for s, k, release, deadline, slot in mixing.period_schedule(share, 200):
        assert release <= slot < deadline and k == given[s]
        given[s] += 1
        assert all(abs(given[x] - (slot + 1) * share[x] / 200) < 1 for x in share)
    assert given == share


def test_mixing(spark, odd, doubled, empty, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_CHARS", 100)
    monkeypatch.setattr(mixing, "PERIOD", 64)
    monkeypatch.setattr(mixing, "BIN_ROWS", 3)
    out = mixing.mix(odd, weights={"a": 1.0, "b": 3.0})
    assert out.columns == odd.columns and {r["doc_id"] for r in out.collect()} == {d for d, *_ in rows()}
    plan = mixing.schedule(odd, weights={"a": 1.0, "b": 3.0}).collect()
    assert all(r["__release"] <= r["__slot"] < r["__deadline"] for r in plan)
    first = [r for r in plan if r["__epoch"] == 0]
    assert sorted(r["__id"] for r in first) == [d for d, *_ in rows()]
    assert mixing.mix(doubled).filter("doc_id is null").count() >= 1
    once = collections.Counter(r["doc_id"] for r in mixing.mix(doubled).collect())
    assert set(once) == {d for d, *_ in rows()} | {None} and min(once[d] for d, *_ in rows()) >= 2
    assert mixing.mix(empty).count() == 0


def test_mixing_whole_table(spark, small):
    plan = queries.op6_pfair_mixing(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in plan if r["epoch"] == 0} == {d for d, _ in small}
    assert len({(r["doc_id"], r["epoch"]) for r in plan}) == len(plan)
    slots = collections.defaultdict(set)
    for r in plan:
        assert r["release"] <= r["slot"] < r["deadline"]
        slots[r["slot"]].add((r["source"], r["epoch"], r["block"]))
    assert all(len(x) == 1 for x in slots.values())


# ------------------------------------------------------------------ 7 language

def test_language_id(spark, odd, doubled, empty):
    got = table(language_id.identify(odd), "lang_pred", "score", "rejected", "held_out")
    assert {got[d][0] for d in (4, 5, 6, 15)} == {"und"} and all(0 <= s <= 1 for _, s, _, _ in got.values())
    assert language_id.identify(doubled).count() == doubled.count() and language_id.identify(empty).count() == 0
    none = language_id.identify(odd, held_out=F.lit(True)).select("lang_pred").distinct().collect()
    assert [r[0] for r in none] == ["und"]


def test_language_id_accuracy(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op7_language_id(spark, sf).collect()
    held = [r for r in got if r["held_out"] and truth[r["doc_id"]]]
    assert len(got) == len(truth) and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


# ------------------------------------------------------------------ 8 packing

def check_packed(got, data, model):
    want = collections.Counter()
    for d, t in data:
        ids = brute.encoded(model, t, 0)
        want.update((d, n, s, len(ids[s:s + 2048]), brute.crc(ids[s:s + 2048])) for n, s in enumerate(range(0, len(ids), 2048)))
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == np.cumsum([0] + [n for _, n in b])[:-1].tolist() and b[-1][0] + b[-1][1] <= 2048
    return len(bins)


def test_packing(spark, odd, doubled, empty, small):
    model = Tokenizer.from_file(WORD)
    check_packed(packing.pack(odd, WORD).collect(), pairs(), model)
    check_packed(packing.pack(doubled, WORD).collect(), pairs(rows() * 2) + [(None, rows()[0][1])], model)
    assert packing.pack(empty, WORD).count() == 0
    got = queries.op8_best_fit_packing(spark, SF_SMALL).collect()
    made = check_packed(got, small, model)
    lengths = np.array([r["length"] for r in got])
    assert made <= packing.bound(lengths) * 1.02 + 1


def test_packing_exchanges_between_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    rng = np.random.default_rng(4)
    lengths = rng.integers(200, 1500, 400)
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "seq long, length int").repartition(3)
    got = packing.assign(df).collect()
    fill = collections.Counter()
    for r in got:
        fill[r["sequence_id"]] += int(lengths[r["seq"]])
    alone = sum(len(set(packing.best_fit(lengths[i:i + 40])[0])) for i in range(0, 400, 40))
    assert len(got) == 400 and max(fill.values()) <= 2048 and packing.bound(lengths) <= len(fill) <= alone


def test_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(6)
    for _ in range(300):
        x = rng.integers(1, 21, rng.integers(1, 30))
        bins, offsets = packing.best_fit(x, 20)
        assert np.bincount(bins, weights=x).max() <= 20 and packing.bound(x, 20) <= bins.max() + 1


# ------------------------------------------------------------------ 9 quality

def test_quality(spark, odd, doubled, empty, small):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for data, df in ((pairs(), quality_rules.judge(odd)), (small, queries.op9_quality_rules(spark, SF_SMALL))):
        assert table(df, *names) == {d: brute.base_statistics(t) for d, t in data}
    twice = quality_rules.judge(doubled)
    assert twice.count() == doubled.count() and twice.filter("base_failed and kept").count() == 0
    assert quality_rules.judge(empty).count() == 0 and quality_rules.keep_documents(empty).count() == 0
    kept = quality_rules.keep_documents(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(
        r["doc_id"] for r in quality_rules.judge(odd).collect() if r["kept"])


def test_quality_verdicts(spark, monkeypatch):
    """The distributed estimate against one from all rows at once, group by group."""
    monkeypatch.setattr(quality_rules, "LEAST", 20)
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    key = {r["doc_id"]: (r["lang"], r["source"]) for r in docs.collect()}
    rows_ = quality_rules.statistics(docs).collect()
    good = [r for r in rows_ if not r["base_failed"]]
    many = collections.Counter(key[r["doc_id"]] for r in good)
    small_of = collections.Counter(key[r["doc_id"]][0] for r in good if many[key[r["doc_id"]]] < 20)
    groups = collections.defaultdict(list)
    for r in good:
        k = key[r["doc_id"]]
        groups[k if many[k] >= 20 else k[0] if small_of[k[0]] >= 20 else ""].append(r)
    want = {r["doc_id"]: False for r in rows_}
    for g in groups.values():
        v = np.array([[r[f"v{i}"] for i in range(4)] for r in g])
        bad = brute.mcd_verdict(v, quality_rules.FLOOR, quality_rules.COVERAGE, quality_rules.CONSISTENCY, quality_rules.CUTOFF, quality_rules.STEPS)
        want.update({r["doc_id"]: not b for r, b in zip(g, bad, strict=True)})
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs).collect()}
    assert sum(got[d] != want[d] for d in want) <= 0.005 * len(want)       # bins against exact order
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet").collect()}
    failed = {r["doc_id"] for r in rows_ if r["base_failed"]}
    assert all(got[d] for d, q in labels.items() if q == 1 and d not in failed)


def test_quality_rejects_what_is_extreme_in_one_statistic(spark):
    rng = np.random.default_rng(7)
    words = list(dict.fromkeys("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(3000)))

    def lines_of(ws):
        return "\n".join(" ".join(ws[i:i + 6]) for i in range(0, len(ws), 6))
    clean = [(i, lines_of(rng.choice(words, 120, replace=False)), "en", "s") for i in range(150)]
    few, seen = [], set()                                # 10 one-word lines, no three of them twice in the same order
    while len(few) < 200:
        w = words[rng.integers(10)]
        if (*few[-2:], w) not in seen:
            few.append(w)
            seen.add(tuple(few[-3:]))
    some = list(rng.choice(words, 73, replace=False))
    repeated = [w for i in range(16) for w in (*some[3 * (i % 8):3 * (i % 8) + 3], *some[24 + 3 * i:27 + 3 * i])] + some[72:]
    symbols = "\n".join(" ".join(rng.choice(words, 6)) + " ######" for _ in range(20))
    lines, repeated = "\n".join(few), lines_of(repeated)
    docs = frame(spark, [*clean, (1001, lines, "en", "s"), (1002, repeated, "en", "s"), (1003, symbols, "en", "s")])
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert all(got[i]["kept"] for i in range(150)) and not any(got[i]["kept"] for i in (1001, 1002, 1003))


# ------------------------------------------------------------------ 10 substrings

def test_substring_dedup(spark, odd, doubled, empty, small):
    names = ["n_words", "n_removed", "kept_sha256"]
    want = brute.substring_dedup(pairs())
    assert table(substring_dedup.remove(odd), *names) == want
    twice = substring_dedup.remove(doubled).collect()
    assert collections.Counter((r["doc_id"], *[r[n] for n in names]) for r in twice if r["doc_id"] is not None) == {(d, *v): 2 for d, v in want.items()}
    assert [r["n_removed"] for r in twice if r["doc_id"] is None] == [0]
    assert substring_dedup.remove(empty).count() == 0
    assert table(queries.op10_substring_dedup(spark, SF_SMALL), *names) == brute.substring_dedup(small)


def test_substring_dedup_hot_anchors(spark, monkeypatch):
    """A passage in most documents, dealt over cells of blocks; passages cut and moved around the width."""
    monkeypatch.setattr(substring_dedup, "HOT", 5)
    rng = np.random.default_rng(9)
    passage = [f"h{i}" for i in range(90)]
    data = []
    for d in range(60):
        own = [f"d{d}w{i}" for i in range(30)]
        lo = int(rng.integers(0, 45))
        data.append((d * 3, " ".join(own + passage[lo:lo + int(rng.integers(44, 60))] + own[::-1])))
    got = table(substring_dedup.remove(frame(spark, [(d, t, "en", "s") for d, t in data], 6)), "n_words", "n_removed", "kept_sha256")
    assert got == brute.substring_dedup(data)


def test_fm_index_against_all_windows():
    rng = np.random.default_rng(8)
    for _ in range(60):
        width, symbols = int(rng.integers(3, 8)), int(rng.choice([2, 5, 30]))
        seqs = [rng.integers(1, symbols + 1, rng.integers(1, 20)) for _ in range(rng.integers(1, 9))]
        seqs += [np.concatenate([s[:int(rng.integers(0, len(s) + 1))], rng.integers(1, symbols + 1, 1), s[int(rng.integers(0, len(s) + 1)):]]) for s in seqs[:3]]
        owner = rng.integers(0, 6, len(seqs))
        q, a, b = fm_index.covered(fm_index.FMIndex(seqs, owner, symbols, 64), seqs, owner, width)
        for i, s in enumerate(seqs):
            known = {tuple(t[k:k + width]) for t, o in zip(seqs, owner, strict=True) if o < owner[i] for k in range(len(t) - width + 1)}
            want = {j for k in range(len(s) - width + 1) if tuple(s[k:k + width]) in known for j in range(k, k + width)}
            assert want == {j for x, y, z in zip(q, a, b, strict=True) if x == i for j in range(y, z)}


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    """Each stage against the plain version of its step on its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names, functions = zip(*corpus_pipeline.STAGES, strict=True)
    assert len(names) == 5
    data = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    kept = common.settle(functions[0](spark, docs, SF_SMALL))
    assert set(data(kept)) == {(r["doc_id"], t) for r in quality_rules.judge(docs).collect() if r["kept"] for d, t in data(docs) if d == r["doc_id"]}
    lined = common.settle(functions[1](spark, kept, SF_SMALL))
    want = brute.line_dedup(data(kept))
    assert dict(data(lined)) == {d: t for d, (n, t) in want.items() if not n or t.strip()}
    apart = common.settle(functions[2](spark, lined, SF_SMALL))
    groups = brute.jaccard_components(data(lined), 5, 4, 5)
    assert {d for d, _ in data(apart)} == {d for d, (_, c) in groups.items() if c == d}
    mixed = common.settle(functions[3](spark, apart, SF_SMALL))
    assert set(data(mixed)) == set(data(apart))
    model = Tokenizer.from_file(WORD)
    check_packed(functions[4](spark, mixed, SF_SMALL).collect(), data(mixed), model)
    assert all(x.columns == docs.columns for x in (kept, lined, apart, mixed))


def test_pipeline_on_odd_rows(spark, doubled, empty):
    for docs in (doubled, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.settle(stage(spark, docs, SF_SMALL))
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()


def test_run_gives_all_stages(spark):
    assert set(corpus_pipeline.run(spark, SF_SMALL).columns) >= {"doc_id", "piece", "sequence_id"}
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_have_stable_schemas(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert len(set(df.columns)) == len(df.columns)


# ------------------------------------------------------------------ regular texts and special tokens

def regular(n):
    """Two unlike words for which a polynomial hash modulo 2**64 gives one value, whatever its base."""
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


def test_regular_texts_are_told_apart(spark):
    a, b = regular(4096)
    data = [(1, a), (2, b), (3, a), (4, f"{a}\n{b}\n{a}"), (5, " ".join(a)), (6, " ".join(b)), (7, " ".join(a))]
    df = frame(spark, [(d, t, "en", "s") for d, t in data])
    assert table(ngram_join.near_equal(df), "n_shingles", "component_id") == brute.jaccard_components(data)
    assert table(substring_dedup.remove(df), "n_words", "n_removed", "kept_sha256") == brute.substring_dedup(data)
    got = table(quality_rules.judge(df), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == {d: brute.base_statistics(t) for d, t in data}


def test_special_tokens_are_encoded_as_the_library_does(spark):
    data = [(1, "<|endoftext|> end"), (2, "a<|endoftext|>b <|startoftext|>"), (3, "<|endoftext|><|endoftext|>"), (4, "plain words")]
    df = frame(spark, [(d, t, "en", "s") for d, t in data])
    folder = common.shared_folder(spark)
    got = table(token_store.digest(spark, folder, token_store.write(df, BYTE, folder)), "n_tokens", "ids_crc32")
    model = Tokenizer.from_file(BYTE)
    assert got == {d: (len(x := brute.encoded(model, t, 2)), brute.crc(x)) for d, t in data} and got[1][0] == 3
    got = table(packing.pack(df, WORD), "length", "ids_crc32")
    model = Tokenizer.from_file(WORD)
    assert got == {d: (len(x := brute.encoded(model, t, 0)), brute.crc(x)) for d, t in data}
