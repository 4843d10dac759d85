"""Spelling variants by a symmetric-delete join.

Every word emits the hash of itself and of each distinct text that lacks one of its letters, with the places where that letter may stand. Words that share a hash meet by an equi-join: a word and a text that lacks a letter of another one differ by one inserted letter; two texts that lack a letter at a common place differ by one replaced letter. Both are then verified letter by letter, since hashes may agree by chance. As the place where two such words differ is unique, each pair comes out once. So many words share a hash as the alphabet allows for their length, whatever the size of the corpus.

A word's form is the most frequent of its near words (ties: the first in code-point order), if that occurs ``RATIO`` times as often; forms therefore end, after a few steps, at a root. Roots are found by joins that double the steps each round, a stage table each.

Words are counted over all rows. Null words don't count. Nothing is capped: a word of any length emits a number for each letter, not a text. Without words the result is empty; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import U, ascii_lower, materialize, mix

MIN_LETTERS, MIN_COUNT, RATIO = 7, 2, 10
#: What parts words: all but A-Z, a-z and the letters of Latin-1.
BETWEEN = "[^A-Za-zÀ-ÿ]+"
#: Letters that one step of the emitting code holds (a longer word alone).
STEP = 1 << 18
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def runs(text: Column, letters: int = MIN_LETTERS) -> Column:
    """The runs of at least so many letters of a text (null: none), with A-Z in lower case, in order."""
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), BETWEEN), lambda x: F.length(x) >= letters), ascii_lower)


def without(word: Column, at: Column) -> Column:
    """``word`` without its letter at ``at`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def deletions(words: list[str]) -> tuple[np.ndarray, ...]:
    """Of words: the row, the hash, and the first and last place of the letter left out (-1: the word itself)."""
    size = np.array([len(w) for w in words], np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    start = np.cumsum(size) - size
    row = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(code)) - start[row]
    power = np.full(int(size.max()), BASE, U)
    power[0] = 1
    term = mix(code.astype(U) + U(1)) * np.cumprod(power, dtype=U)[at]
    upto = np.concatenate([np.zeros(1, U), np.cumsum(term, dtype=U)])
    whole = upto[start + size] - upto[start]
    first = np.flatnonzero((at == 0) | (code != np.concatenate([[0], code[:-1]])))  # equal neighbours leave the same text
    last = np.append(first[1:], len(code)) - 1
    r = row[first]
    rest = upto[first] - upto[start[r]] + (upto[start[r] + size[r]] - upto[first + 1]) * U(INVERSE)
    none = np.full(len(words), -1, np.int64)
    return np.concatenate([np.arange(len(words)), r]), mix(np.concatenate([whole, rest])), np.concatenate([none, at[first]]), np.concatenate([none, at[last]])


def emitted(words: DataFrame) -> DataFrame:
    """Of ``words`` (id, word): key, id, size, first, last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_numpy(), b.column(1).to_pylist()
            ends = np.cumsum([len(t) for t in texts])
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + STEP, "right")))
                row, key, first, last = deletions(texts[i:j])
                size = np.array([len(t) for t in texts[i:j]], np.int32)
                for s in range(0, len(row), STEP):
                    k = slice(s, s + STEP)
                    cols = [key[k].view(np.int64), ids[i:j][row[k]], size[row[k]], first[k].astype(np.int32), last[k].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "id", "size", "first", "last"])
                i = j

    return words.select("id", "word").mapInArrow(run, "key long, id long, size int, first int, last int")


def near_pairs(words: DataFrame) -> DataFrame:
    """Of ``words`` (a stage table: id, word, n): each pair of words that differ by one letter, once: a, b, word_a, n_a, word_b, n_b."""
    e = materialize(emitted(words))
    x, y = e.alias("x"), e.alias("y")
    of = lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}")
    p, q = of
    place = F.greatest(p("first"), q("first"))
    replaced = (p("first") >= 0) & (q("first") >= 0) & (p("size") == q("size")) & (p("id") < q("id")) & (place <= F.least(p("last"), q("last")))
    inserted = (p("first") < 0) & (q("first") >= 0) & (p("size") + 1 == q("size"))
    found = x.join(y, (p("key") == q("key")) & (replaced | inserted)).select(p("id").alias("a"), q("id").alias("b"), place.alias("place"))
    side = lambda s: words.select(F.col("id").alias(s), F.col("word").alias(f"word_{s}"), F.col("n").alias(f"n_{s}"))
    both = found.join(side("a"), "a").join(side("b"), "b")
    a, b, at = F.col("word_a"), F.col("word_b"), F.col("place")
    same = F.when(F.length(a) == F.length(b), without(a, at) == without(b, at)).otherwise(a == without(b, at))
    return both.where(same & (a != b)).select("a", "b", "word_a", "n_a", "word_b", "n_b")


def roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Of ``forms`` (id, form_id, form): id and root, the word at the end of each chain of forms."""
    r = materialize(forms.select("id", F.col("form_id").alias("root_id"), F.col("form").alias("root")))
    for _ in range(max_rounds):
        up = r.select(F.col("id").alias("root_id"), F.col("root_id").alias("up_id"), F.col("root").alias("up"))
        r = materialize(r.join(up, "root_id", "left").select("id", F.coalesce("up_id", "root_id").alias("root_id"), F.coalesce("up", "root").alias("root"), F.col("up_id").isNotNull().alias("went_on")))
        if not r.where("went_on").limit(1).count():
            return r.select("id", "root")
        r = r.select("id", "root_id", "root")
    raise RuntimeError("forms did not end")


def variants(occurrences: DataFrame, word: str = "word", min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per distinct word of ``occurrences`` (a row each) that occurs ``min_count`` times: word, form, root, n, n_near, form_n."""
    counted = occurrences.select(F.col(word).alias("word")).where(F.col("word").isNotNull() & (F.col("word") != "")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    words = materialize(counted.withColumn("id", F.monotonically_increasing_id()))
    side = lambda own, other: F.struct(F.col(own).alias("id"), F.struct((-F.col(f"n_{other}")).alias("less"), F.col(f"word_{other}").alias("word"), F.col(other).alias("id")).alias("near"))
    each = near_pairs(words).select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("x")).select("x.id", "x.near")
    near = materialize(each.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near")))
    w = words.join(near, "id", "left")
    has = -F.col("near.less") >= ratio * F.col("n")
    w = materialize(w.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *[F.when(has, F.col(f"near.{a}")).alias(b) for a, b in (("word", "form"), ("id", "form_id"))], F.when(has, -F.col("near.less")).alias("form_n")))
    ends = roots(w.where("form IS NOT NULL"))
    return w.join(ends, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
