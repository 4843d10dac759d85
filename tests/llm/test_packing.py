import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lotline.llm import packing as P

from .helpers import documents, rows, sentence


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.vocabulary_path(P.VOCABULARY))


def encoded(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, P.END]


def test_encoder_equals_tokenizer(tokenizer):
    odd = ["", "  ", "Don't STOP's 'tis ''s 'S x'll", "a\x1cb\x1fc", "İstanbul É́ ñ ŒUVRE ſ ß ẞ", "tab\tnew\nline\x85nb\xa0sp", "x²½3 12,5€", "<|endoftext|> hi", "<|ENDOFTEXT|>", "日本語 text", "ΑΣ ΟΔΟΣ", "a\x00b\x7f\xad", "'re're 'd'", "__a-b..c", "e\u0301"]
    rng = random.Random(4)
    odd += ["".join(rng.choices("abc DE'.,1ß½\t\n-_s", k=60)) for _ in range(100)]
    e = P.Encoder(P.vocabulary_path(P.VOCABULARY))
    for t in odd:
        assert np.frombuffer(e.encode(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_batches_equal_tokenizer(tokenizer, monkeypatch):
    """Texts of all characters below U+0300, of white space at their ends, empty, null, and such as the tokenizer encodes whole, with a cache and without."""
    rng = random.Random(5)
    texts = [f"A{chr(c)}B {chr(c)} x{chr(c)}{chr(c)}y \u00c9{chr(c)}" for c in range(0x320)] + [None, "", "  ", "a ", "\t b\n\n", "<|endoftext|>a", "x" * 200]
    texts += ["".join(rng.choices("abc DE'.,1\u00df\u00bd\t\n-_s\x85\xa0", k=rng.randint(1, 60))) for _ in range(2000)]
    for cache in (P.CACHE, 50, 0):
        monkeypatch.setattr(P, "CACHE", cache)
        e = P.Encoder(P.vocabulary_path(P.VOCABULARY))
        for k in (1, 30, 1000):
            rng.shuffle(texts)
            batch = pa.array(texts[: 2 * k], pa.string()).slice(k)
            end = np.array([P.END], "<u2").tobytes()
            for t, ids in zip(batch.to_pylist(), e.encode_all(batch, end).to_pylist(), strict=True):
                assert np.frombuffer(ids, "<u2").tolist() == encoded(tokenizer, t), t


def test_a_word_beyond_the_cache_is_cut_once_a_batch(monkeypatch):
    monkeypatch.setattr(P, "CACHE", 0)
    e, cut = P.Encoder(P.vocabulary_path(P.VOCABULARY)), []
    model = e.model
    e.model = lambda piece: cut.append(piece) or model(piece)
    e.encode("seldom word " * 500)
    assert sorted(cut) == ["seldom", "word"]


def test_long_words_are_not_kept():
    e = P.Encoder(P.vocabulary_path(P.VOCABULARY))
    for k in range(5):
        e.encode("short " + "abc" * (1000 + k) + " " + "12" * 1000)
    assert len(e.known) == 1 and max(map(len, e.known_pieces)) <= 64


def check(got, data, tokenizer, window=P.WINDOW):
    want = defaultdict(list)
    for i, t, *_ in data:
        want[i].append(encoded(tokenizer, t))
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    for i, copies in want.items():
        ids, pieces = copies[0], sorted(by_doc[i], key=lambda r: r["start"])
        assert sorted(x for r in pieces for x in range(r["start"], r["start"] + r["length"])) == sorted(list(range(len(ids))) * len(copies))
        for r in pieces:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    at = 0
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["sequence_id"] * window + r["offset"] == at and r["offset"] + r["length"] <= window
        at += r["length"]
    assert at == sum(len(c) for cs in want.values() for c in cs)


@pytest.mark.parametrize("clash", [False, True])
def test_round_trip(spark, tokenizer, clash):
    data = rows()
    got = P.pack(documents(spark, data, clash)).collect()
    check(got, data, tokenizer)
    tail = max(r["sequence_id"] for r in got)
    assert all(r["padded_to"] == P.WINDOW for r in got if r["sequence_id"] < tail)
    for r in got:
        assert zlib.crc32(np.frombuffer(r["ids"], "<u2").astype("<u4").tobytes()) == r["ids_crc32"]


def test_batches_are_encoded_in_parts(spark, tokenizer):
    data = rows()
    check(P.pack(documents(spark, data), part=300, group=3).collect(), data, tokenizer)


def looped(n, queue_of, order, share, window, phase, grain):
    """(document, first token, tokens) in the order of a plain deficit round-robin loop."""
    line = {s: [(i, k) for i in sorted((i for i in n if queue_of[i] == s), key=lambda i: (order[i], i)) for k in range(n[i])] for s in share}
    sent, deficit, out = dict.fromkeys(share, 0), dict(phase), []
    while any(sent[s] < len(line[s]) for s in share):
        for s in sorted(share):
            deficit[s] += window * share[s]
            while deficit[s] >= grain - 1e-7 and sent[s] < len(line[s]):
                deficit[s] -= grain
                out += line[s][sent[s] : sent[s] + grain]
                sent[s] += grain
    return out


@pytest.mark.parametrize("targets", [None, {"a": 1, "b": 2, "c": 1}])
def test_stream_follows_one_loop(spark, tokenizer, targets):
    rng = random.Random(8)
    data = [(i, sentence(rng, "en", rng.randint(5, 300)), "en", rng.choice(["a", "a", "a", "b", "c"]), 0) for i in range(120)]
    window = 256
    docs = documents(spark, data)
    got = P.pack(docs, targets, window=window).collect()
    check(got, data, tokenizer, window)
    from lotline.llm.common import uniform_hash

    order = {r["doc_id"]: r["u"] for r in docs.select("doc_id", uniform_hash(P.SEED, "doc_id").alias("u")).collect()}
    n = {i: len(encoded(tokenizer, t)) for i, t, *_ in data}
    queue_of = {i: s for i, _, _, s, _ in data}
    total = sum(n.values())
    share = {s: (targets[s] / 4 if targets else sum(n[i] for i in n if queue_of[i] == s) / total) for s in "abc"}
    phase = {r["__source"]: r["phase"] for r in P.queues(docs.selectExpr("source", "1L AS tokens"), targets, window).collect()}
    want = looped(n, queue_of, order, share, window, phase, P.GRAIN)
    stream = [(r["doc_id"], k) for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])) for k in range(r["start"], r["start"] + r["length"])]
    assert stream == want


def deviation(got, source, want, window, full):
    """Total-variation distance of each full window from the wanted shares."""
    held = defaultdict(Counter)
    for r in got:
        held[r["sequence_id"]][source[r["doc_id"]]] += r["length"]
    return [sum(abs(held[w][s] / window - want[s]) for s in want) / 2 for w in range(full)]


def test_every_window_holds_the_mixture(spark, tokenizer):
    """Long documents too, some as long as many windows."""
    rng = random.Random(9)
    data = [(i, sentence(rng, "en", 6000 if i % 50 == 0 else rng.choice([5, 30, 800])), "en", f"s{min(i % 12, 7)}", 0) for i in range(300)]
    source = {i: s for i, _, _, s, _ in data}
    n = {i: len(encoded(tokenizer, t)) for i, t, *_ in data}
    total = sum(n.values())
    own = Counter()
    for i, x in n.items():
        own[source[i]] += x / total
    got = P.pack(documents(spark, data)).collect()
    off = deviation(got, source, own, P.WINDOW, total // P.WINDOW)
    assert len(off) > 20 and max(off) < 0.05 and np.mean(off) < 0.03


def test_targets(spark, tokenizer):
    rng = random.Random(10)
    data = [(i, sentence(rng, "en", 30), "en", "hot" if i % 2 else "cold", 0) for i in range(400)]
    got = P.pack(documents(spark, data), targets={"hot": 3, "cold": 1}, window=512).collect()
    off = deviation(got, {i: s for i, _, _, s, _ in data}, {"hot": 0.75, "cold": 0.25}, 512, 10)
    assert max(off) < 0.04


def test_many_sources_need_no_list_on_the_driver(spark, tokenizer):
    data = [(i, "one two three", "en", f"host{i}" if i % 3 else None, 0) for i in range(600)]
    check(P.pack(documents(spark, data), window=256).collect(), data, tokenizer, 256)


def test_empty_table(spark):
    assert P.pack(documents(spark, [])).count() == 0


def test_power_of_two_tail_is_not_padded(spark, tokenizer):
    text = "the"
    assert len(encoded(tokenizer, text)) == 2
    got = P.pack(documents(spark, [(i, text, "en", "s", 0) for i in range(4)]), window=64).collect()
    assert {r["padded_to"] for r in got} == {8}
    got = P.pack(documents(spark, [(i, text, "en", "s", 0) for i in range(3)]), window=64).collect()
    assert {r["padded_to"] for r in got} == {64}
