"""Secret scans: fixed patterns, and character Markov models that are compared by log-likelihood ratio.

One model stands for ordinary identifiers, one for random strings of each alphabet that keys are written in. A model's state is the character before or, after digits, how many of them there were; a run of text also may end in every state. They are trained on labelled strings: what the fixed patterns find is labelled random (with seeded strings of the same alphabets, since such values are few), and the words around it ordinary, alone and joined as identifiers are.

Text is scored character by character: the bits by which an alphabet's model explains it better, less ``DRIFT``. A stretch is a secret if its sum reaches ``MIN_BITS``; of a run of the models' characters the best stretch is taken, then the best of what is left on both sides. So a key is found behind a path or inside a longer token, whatever its characters and its length. Of a stretch that touches fixed patterns' spans, what lies beside them is scored by itself.

Null texts count as empty. Spans are in code points, the end exclusive; spans that begin together are ordered by kind. Each document is scanned by itself, whole (a very long one with some 100 bytes a character), so skew and repeated rows are no matter. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Runs are greedy, so a minimum length drops the same matches that a later test would.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
VALUE_LENGTH = 6
MIN_BITS, DRIFT = 26.0, 0.4
#: Documents that the labelled sample comes from, about, words of each (chosen by hash from the whole text), and seeded strings of each alphabet.
SAMPLE_DOCS, SAMPLE_WORDS, SAMPLE_STRINGS, SAMPLE_NAMES, SEED = 2_000, 64, 3_000, 60_000, 11

LOWER = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = LOWER.upper() + LOWER + "0123456789+/_=-"
ALPHABETS = {"hex": "0123456789abcdef", "base32": LOWER.upper() + "234567", "base62": SYMBOLS[:62], "base64": SYMBOLS[:64], "base64url": SYMBOLS[:62] + "-_", "digits": "0123456789", "lower": LOWER, "upper": LOWER.upper(), "letters": SYMBOLS[:52], "lower and digits": LOWER + "0123456789"}
N = len(SYMBOLS)
#: Digits in a row that states tell apart.
MOST_DIGITS = 20
STATES = 1 + N + MOST_DIGITS
DIGITS = slice(1 + SYMBOLS.index("0"), 2 + SYMBOLS.index("9"))
#: What parts of a run lie between, and how many characters a stretch may be short of its part's end.
SEPARATORS, ENDS = [1 + SYMBOLS.index(ch) for ch in "+/_=-"], 3
CODE = np.zeros(128, np.int64)
CODE[[ord(ch) for ch in SYMBOLS]] = np.arange(1, N + 1)


def codes_of(text: str) -> np.ndarray:
    """Of every code point, the number of its symbol; 0 for what is none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, CODE[np.minimum(points, 127)], 0)


def states_before(codes: np.ndarray) -> np.ndarray:
    """The state before each character: 0 at the start of a run, the character before, or how many digits."""
    n = len(codes)
    digit = (codes >= DIGITS.start) & (codes < DIGITS.stop)
    at = np.arange(n)
    run = at - np.maximum.accumulate(np.where(digit, -1, at)) if n else at
    after = np.where(digit, N + np.minimum(run, MOST_DIGITS), codes)
    return np.concatenate([[0], after[:-1]])


class Markov:
    """log2 probabilities of a character, or the end (column 0), in a state."""

    def __init__(self, counts: np.ndarray, smooth: float):
        # a rare state is known from all states of its kind
        back = counts.sum(axis=0) + smooth
        c = counts + smooth * back / back.sum() * back.size + smooth / 10
        self.bits = np.log2(c / c.sum(axis=1, keepdims=True))

    @classmethod
    def train(cls, sample: Sequence[str], smooth: float = 0.5) -> Markov:
        codes = codes_of("".join(f"{s}\n" for s in sample))
        counts = np.bincount(states_before(codes) * (N + 1) + codes, minlength=STATES * (N + 1)).astype(float)
        return cls(counts.reshape(STATES, N + 1), smooth)


class Scanner:
    def __init__(self, random_strings: dict[str, Markov], identifiers: Markov):
        """Tables of the bits by which each alphabet's model is better, less the drift, and of the best of them."""
        self.names = list(random_strings)
        gain = np.stack([m.bits - identifiers.bits for m in random_strings.values()]) - DRIFT
        gain[:, :, 0] = -1e4  # no stretch reaches across what isn't a symbol
        self.gain, self.best = gain, gain.max(axis=0)
        #: a stretch is said to be of one of several alphabets
        self.need = MIN_BITS + np.log2(len(self.names))

    @staticmethod
    def base(text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the fixed patterns, by start and kind."""
        low = text.lower()
        out = []
        if "passw" in low or "secret" in low or "token" in low or "key" in low:
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE_LENGTH]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(out)

    @staticmethod
    def stretch(gain: np.ndarray) -> tuple[float, int, int]:
        """The largest sum of neighbours, and where they lie."""
        total = np.concatenate([[0.0], np.cumsum(gain)])
        low = np.minimum.accumulate(total)
        end = int(np.argmax(total - low))
        return float(total[end] - low[end]), int(np.argmin(total[: end + 1])), end

    def _cells(self, codes: np.ndarray) -> np.ndarray:
        return states_before(codes) * (N + 1) + codes

    def _within(self, cells: np.ndarray, at: int, out: list[tuple[int, int]]) -> None:
        """Best stretches of a run, then of what is left beside them."""
        todo = [(0, len(cells))]
        while todo:
            s, e = todo.pop()
            if e <= s or self.stretch(self.best.ravel()[cells[s:e]])[0] < self.need:
                continue
            bits, i, j = max(self.stretch(g.ravel()[cells[s:e]]) for g in self.gain)
            if bits >= self.need:
                i, j = s + i, s + j
                # a few characters more if the part ends there
                cut = np.concatenate([[True], np.isin(cells[s:e] % (N + 1), SEPARATORS), [True]])
                left, right = cut[max(0, i - s - ENDS) : i - s + 1], cut[j - s + 1 : j - s + 2 + ENDS]
                i -= int(np.argmax(left[::-1])) if left.any() else 0
                j += int(np.argmax(right)) if right.any() else 0
                out.append((at + i, at + j))
                todo += [(s, i), (j, e)]

    def markov(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the stretches that the models call random."""
        codes = codes_of(text)
        cells = self._cells(codes)
        total = np.cumsum(self.best.ravel()[cells])
        hot = np.flatnonzero(total - np.minimum.accumulate(np.concatenate([[0.0], total[:-1]])) >= self.need)
        out: list[tuple[int, int]] = []
        done = 0
        for k in hot.tolist():
            if k < done:
                continue
            # the run that the place lies in
            before = np.flatnonzero(codes[done:k] == 0)
            s = done + int(before[-1]) + 1 if len(before) else done
            step = e = k + 1
            while e < len(codes) and codes[e]:
                step = min(len(codes), e + 256)
                gap = np.flatnonzero(codes[e:step] == 0)
                e = e + int(gap[0]) if len(gap) else step
                if len(gap):
                    break
            self._within(cells[s:e], s, out)
            done = e
        return sorted(out)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """Base spans, and random stretches; of a stretch that touches base spans what lies beside them counts by itself."""
        base = self.base(text)
        covered: list[list[int]] = []
        for b, _, t in base:
            if covered and b <= covered[-1][1]:
                covered[-1][1] = max(covered[-1][1], t)
            else:
                covered.append([b, t])
        ends, more = [t for _, t in covered], []
        for s, e in self.markov(text):
            k = bisect.bisect_right(ends, s)
            if k == len(covered) or covered[k][0] >= e:
                more.append((s, 3, e))
                continue
            at = s
            while at < e:
                b, t = covered[k] if k < len(covered) else (e, e)
                own: list[tuple[int, int]] = []
                if at < (stop := min(b, e)):
                    self._within(self._cells(codes_of(text[at:stop])), at, own)
                more += [(i, 3, j) for i, j in own]
                at, k = t, k + 1
        return sorted(base + more)


def joined(spans: Sequence[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def labelled_strings(text: str, words: int = SAMPLE_WORDS, seed: int = SEED) -> tuple[list[str], list[str]]:
    """(random, ordinary) strings of a text: the values that fixed patterns find, and words elsewhere in it, those with the least hashes."""
    secrets, plain, at = [], [], 0
    for s, _, e in Scanner.base(text):
        value = re.sub(r"""^.*[:=]\x20*["']?""", "", text[s:e])
        if len(value) >= 16 and codes_of(value).all():
            secrets.append(value)
        plain.append(text[at:s])
        at = max(at, e)
    plain.append(text[at:])
    found = {w for w in re.findall("[A-Za-z]+", " ".join(plain)) if len(w) < 40}
    return secrets, sorted(found, key=lambda w: (zlib.crc32(f"{seed}{w}".encode()), w))[:words]


def labelled_samples(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED) -> tuple[list[str], list[str]]:
    """(random strings, ordinary words) of about ``SAMPLE_DOCS`` documents, chosen by a hash of their id and text; of each, ``SAMPLE_WORDS`` strings of a kind at most."""
    n = docs.count()
    share = int(min(1.0, SAMPLE_DOCS / max(n, 1)) * 2**31)
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 33)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [labelled_strings(t.as_py(), seed=seed) for t in b.column(1)]
            kept = [[x[i][:SAMPLE_WORDS] for x in found] for i in range(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(k, pa.list_(pa.string())) for k in kept)], names=["u", "random", "ordinary"])

    picked = docs.where((u <= share) & F.col(text).isNotNull()).select(u.alias("u"), F.col(text).alias("text")).mapInArrow(run, "u long, random array<string>, ordinary array<string>")
    rows = picked.orderBy("u", "random", "ordinary").limit(2 * SAMPLE_DOCS).collect()  # bounded rows of bounded size
    return [x for r in rows for x in r["random"]], [x for r in rows for x in r["ordinary"]]


def train(docs: DataFrame, **columns: str) -> Scanner:
    rng = random.Random(columns.get("seed", SEED))
    found, words = labelled_samples(docs, **columns)
    words = words or ["the", "value", "of", "index", "user", "name", "count", "list", "item", "data"]
    ordinary = list(words)
    for _ in range(SAMPLE_NAMES):
        parts = [rng.choice(words) for _ in range(rng.randint(1, 4))]
        style = rng.randrange(6)
        s = ("_".join(parts).lower(), "-".join(parts).lower(), "".join(p.capitalize() for p in parts), "_".join(parts).upper(), "/".join(parts), parts[0])[style]
        if rng.random() < 0.4:
            s += rng.choice(("", "_", "-", "/")) + str(rng.randrange(10 ** rng.randint(1, 8)))
        ordinary.append(s)
    ordinary += [str(rng.randrange(10 ** rng.randint(1, 12))) for _ in range(6000)]
    ordinary += [f"{rng.randint(1900, 2100)}{d}{rng.randint(1, 12):02}{d}{rng.randint(1, 28):02}" for _ in range(1000) for d in ("-", "/", "")]
    ordinary += ["-".join(str(rng.randrange(1000, 10000)) for _ in range(4)) for _ in range(500)] + ["=" * 40, "-" * 40, "_" * 40] * 20
    values = {name: ["".join(rng.choices(a, k=rng.randint(16, 64))) for _ in range(SAMPLE_STRINGS)] for name, a in ALPHABETS.items()}
    for v in found:  # labelled values count for the smallest alphabet that holds them
        name = min((k for k, a in ALPHABETS.items() if set(v) <= set(a)), key=lambda k: len(ALPHABETS[k]), default=None)
        if name:
            values[name].append(v)
    # a random string goes on for long: its end is no evidence
    return Scanner({k: Markov.train(v, 0.05) for k, v in values.items()}, Markov.train(ordinary))


def scan(docs: DataFrame, scanner: Scanner, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and found: an array of (kind, start, stop), by start and kind. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "stop": e} for s, k, e in scanner.spans(t.as_py() or "")] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(kind))], names=["doc_id", "found"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, found array<struct<kind string, start long, stop long>>")


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
