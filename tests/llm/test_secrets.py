import random
import re
import zlib

import pytest

from lotline.llm import secrets as S

from .helpers import WORDS, documents, rows, sentence

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(out)


def planted():
    rng = random.Random(1)
    out = []
    for i in range(300):
        parts = []
        for _ in range(6):
            parts.append(rng.choice([sentence(rng, "en", 5), 'Password: "abc123+/="', "API_KEY=short", "api-key = longenough", "apikey:abcdefgh", "AKIA" + "".join(rng.choices("ABC123", k=rng.randint(10, 20))), "".join(rng.choices("0123456789abcdef", k=rng.randint(10, 50))), "token token=secret=abcdefgh", "SECRET'  :  'a.b-c_d=e'", "AKIAAKIA", "ſecret=abcdefg", "to\u212aen=abcdefgh", "é" * 3]))
        out.append((i, rng.choice([" ", "", "\n"]).join(parts), "en", "s", 0))
    return out


def test_base_against_brute_force(spark):
    data = planted() + [(1000 + i, t, "en", "s", 0) for i, (_, t, *_) in enumerate(rows())]
    scanner = S.train(documents(spark, data))
    got = {r["doc_id"]: r["found"] for r in S.scan(documents(spark, data, clash=True), scanner).collect()}
    for i, t, *_ in data:
        found = [(s["start"], S.KINDS.index(s["kind"]), s["stop"]) for s in got[i]]
        assert [x for x in found if x[1] < 3] == brute(t or "")
        assert found == sorted(found)


@pytest.fixture(scope="module")
def scanner(spark):
    rng = random.Random(3)
    return S.train(documents(spark, [(i, sentence(rng, lang, 200) + " " + planted()[i][1], lang, "s", 0) for i, lang in enumerate(["en", "de", "fr"] * 40)]))


@pytest.mark.parametrize("name", sorted(S.ALPHABETS))
def test_random_strings_of_every_alphabet_are_found(scanner, name):
    """Letters only and digits only too, alone and behind a path, and their ends are right."""
    rng = random.Random(4)
    for size in (24, 32, 40):
        found = exact = 0
        for k in range(200):
            key = "".join(rng.choices(S.ALPHABETS[name], k=size))
            text = ("see " if k % 2 else "home/user/data/the_list/") + key + (" there" if k % 3 else "\n")
            at = text.index(key)
            got = scanner.markov(text)
            found += any(s < at + size and e > at for s, e in got)
            exact += (at, at + size) in got
        assert found >= 185 and exact >= 100


def test_ordinary_text_is_left_alone(scanner):
    rng = random.Random(5)
    words = [w for v in WORDS.values() for w in v if w.isascii()]
    pick = lambda k: ["".join(rng.choices(words, k=rng.randint(1, 2))) for _ in range(k)]
    shapes = [lambda: "_".join(pick(4)) + str(rng.randrange(10**6)), lambda: "".join(w.capitalize() for w in pick(5)), lambda: "/".join(pick(6)), lambda: " ".join(pick(30)), lambda: str(rng.randrange(10**12))]
    assert sum(bool(scanner.markov(f())) for f in shapes for _ in range(400)) < 20
    for t in ("2026-01-02", "4785-3805-9239-1139", "version_1_2_3_of_the_index", "20260102T030405", "9780306406157", "=" * 200, "-" * 80):
        assert not scanner.markov(t)


def naive(scanner, text):
    """The same by loops over characters."""
    out, run = [], []
    for i, ch in enumerate(text + " "):
        if ch in S.SYMBOLS:
            run.append(i)
            continue
        if run:
            out += naive_run(scanner, text, run[0], run[-1] + 1)
        run = []
    return sorted(out)


def naive_run(scanner, text, first, last):
    gains, digits, state = [], 0, 0
    for ch in text[first:last]:
        code = S.SYMBOLS.index(ch) + 1
        gains.append([g[state][code] for g in scanner.gain])
        digits = digits + 1 if ch.isdigit() else 0
        state = len(S.SYMBOLS) + min(digits, S.MOST_DIGITS) if digits else code

    def within(s, e):
        best = (0, 0, 0)
        for a in range(len(scanner.gain)):
            total, low, at, top = 0.0, 0.0, s, (0, 0, 0)
            for i in range(s, e):
                total += gains[i - first][a]
                if total - low > top[0] + 1e-9:
                    top = (total - low, at, i + 1)
                if total < low:
                    low, at = total, i + 1
            best = max(best, top)
        bits, i, j = best
        if bits < scanner.need:
            return []
        ends = [k for k in range(max(s, i - 3), i + 1) if k == s or text[k - 1] in "+/_=-"]
        i = max(ends, default=i)
        ends = [k for k in range(j, min(e, j + 3) + 1) if k == e or text[k] in "+/_=-"]
        j = min(ends, default=j)
        return within(s, i) + [(i, j)] + within(j, e)

    return within(first, last)


def test_stretches_against_brute_force(scanner):
    rng = random.Random(6)
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 8)):
            a = rng.choice(list(S.ALPHABETS.values()))
            parts.append(rng.choice(["".join(rng.choices(a, k=rng.randint(1, 60))), "the", "that_list", "été", "12345", "=", "\U0001f600"]))
        text = rng.choice(["", " ", "_", "/"]).join(parts)
        assert scanner.markov(text) == naive(scanner, text), text


def test_markov_spans_leave_base_spans_alone(scanner):
    text = "token=Zk9QxW37bLmP2sTv8RyA and Zk9QxW37bLmP2sTv8RyA"
    assert S.joined(scanner.spans(text)) == "assign:0:26,markov:31:51"


def test_a_very_long_text_is_scanned_whole(scanner):
    rng = random.Random(7)
    key = "".join(rng.choices(S.SYMBOLS[:62], k=40))
    text = sentence(rng, "en", 400_000) + " " + key + " " + "the_" * 300_000
    assert len(text) > 2_000_000 and scanner.markov(text) == [(text.index(key), text.index(key) + 40)]


def test_sample_covers_whole_texts():
    text = " ".join(f"word{'abcdefghij'[i % 10] * (i // 10 % 9 + 1)}{'klmnopq'[i % 7]}" for i in range(4000))
    _, words = S.labelled_strings(text + " onlyattheend")
    assert len(words) == S.SAMPLE_WORDS and S.labelled_strings("token=" + "a1" * 10 + " of it") == (["a1" * 10], sorted(["of", "it"], key=lambda w: zlib.crc32(f"{S.SEED}{w}".encode())))


@pytest.mark.parametrize("data", [[], [(1, None, None, None, None)]])
def test_empty(spark, data):
    docs = documents(spark, data)
    assert [r["found"] for r in S.scan(docs, S.train(docs)).collect()] == [[] for _ in data]


def test_what_lies_beside_a_base_span_counts_by_itself(spark):
    """A random run that goes on after a fixed pattern's span, or before it, isn't lost with it."""
    rng = random.Random(8)
    texts = ["the value of index " * 40 for _ in range(30)]
    scanner = S.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    key = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz23456789", k=48))
    hexed = "".join(rng.choices("0123456789abcdef", k=32))
    for text in (f"{hexed}G{key}", f"{key}G{hexed}", f"{key}G{hexed}G{key}"):
        found = scanner.spans(text)
        base = [(s, e) for s, k, e in found if k < 3]
        more = [(s, e) for s, k, e in found if k == 3]
        assert base and more and all(not (b < e and s < t) for s, e in more for b, t in base)
        assert sum(e - s for s, e in more) >= 0.7 * text.count(key) * len(key)


def test_sample_without_doc_ids(spark):
    """Rows without an id, or sharing one, are dealt by their text."""
    rows = [(None, f"password = {i:032x}{'z' * 4} some words {i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found, words = S.labelled_samples(df)
    assert 0.3 * S.SAMPLE_DOCS < len(found) < 2 * S.SAMPLE_DOCS and words
