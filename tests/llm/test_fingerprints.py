import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotline.llm import fingerprints as Z

from .helpers import documents, rows, sentence


def brute_phrases(data):
    seen, out, at = set(), [], 0
    for end in range(1, len(data) + 1):
        if data[at:end] not in seen:
            seen.add(data[at:end])
            out.append(data[at:end])
            at = end
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab c", max_size=200) | st.text(max_size=60))
def test_parse_equals_brute_force(text):
    try:
        data = text.encode()
    except UnicodeEncodeError:
        return
    phrases = []
    Z.parse(data, 0, set(), phrases)
    assert phrases == brute_phrases(data)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab é", max_size=150), st.text(alphabet="ab é", max_size=150))
def test_edited_equals_parsing_anew(a, b):
    p = Z.Parsed(a)
    text, sk = p.edited(b)
    q = len(a) // 4
    assert text == a[: len(a) - q] + b[:q]
    assert (sk == Z.sketch(brute_phrases(text.encode()))).all()


@pytest.mark.parametrize("clash", [False, True])
def test_against_brute_force(spark, clash):
    data = [r for i, r in enumerate(rows()) if r[0] != 3 or i == 3]  # texts of a repeated id are ordered by text
    got = {r["doc_id"]: r for r in Z.with_next(documents(spark, data, clash)).collect()}
    ordered = sorted((i, t or "") for i, t, *_ in data)
    assert len(got) == len(data)
    for n, (i, t) in enumerate(ordered):
        other, q = ordered[(n + 1) % len(ordered)][1], len(t) // 4
        text = t[: len(t) - q] + other[:q]
        f, e, o = (Z.sketch(brute_phrases(x.encode())) for x in (t, text, other))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(text.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (Z.text_of(f), Z.text_of(e))
        assert r["near_edited"] == pytest.approx(Z.likeness(f, e)) and r["near_next"] == pytest.approx(Z.likeness(f, o))


def test_small_tables(spark):
    assert Z.with_next(documents(spark, [])).count() == 0
    (r,) = Z.with_next(documents(spark, [(5, "abcdefgh", "en", "s", 0)])).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and r["near_next"] == 1.0
    two = Z.with_next(documents(spark, [(1, "same", "en", "s", 0), (1, "same", "en", "s", 0)])).collect()
    assert len({r["fingerprint"] for r in two}) == 1 and len(two) == 2


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_key_in_many_ranges(spark, monkeypatch, doc_id):
    """A key that many rows share is walked by many tasks, in one order all the same."""
    monkeypatch.setattr(Z, "RANGE_BYTES", 400)
    data = [(doc_id if i % 2 else i + 10, f"text {i % 4 if i % 3 else i} and more of it", "en", "s", 0) for i in range(120)]
    docs = documents(spark, data)
    got = Z.with_next(docs).collect()
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) AS h").distinct().collect()}
    ordered = sorted(((i is not None, i or 0, hashes[t]), t) for i, t, *_ in data)
    want = []
    for n, ((_, i, _), t) in enumerate(ordered):
        q = len(t) // 4
        want.append(((i or doc_id), hashlib.sha256((t[: len(t) - q] + ordered[(n + 1) % len(ordered)][1][:q]).encode()).hexdigest()))
    assert sorted(want, key=str) == sorted(((r["doc_id"], r["edited_sha256"]) for r in got), key=str)


def test_likeness_follows_editing():
    rng = random.Random(3)
    text = sentence(rng, "en", 400)
    w = text.split()
    few, many = list(w), list(w)
    for k in rng.sample(range(len(w)), 8):
        few[k] = "xq"
    for k in rng.sample(range(len(w)), 200):
        many[k] = sentence(rng, "de", 1)
    a, b, c = (Z.Parsed(x).sketch for x in (text, " ".join(few), " ".join(many)))
    assert Z.likeness(a, a) == 1 and Z.likeness(a, b) > Z.likeness(a, c)
