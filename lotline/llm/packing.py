"""Packing by deficit round-robin over source queues.

Every source is a queue of documents in a seeded order. In each round, which is as long as a window, a queue's deficit grows by its quantum: its target share of the window. It sends tokens while the deficit covers a grain of ``GRAIN`` tokens, cutting a document where the quantum ends, and carries the rest of the deficit into later rounds. So by the end of round r a queue has sent ``grain * floor(((r + 1) * quantum + phase) / grain)`` tokens in all, and prefix sums give every token's place without any task holding a queue: deficits carry across windows and partitions as they would in one loop. (Phases keep small sources from sending in the same rounds.)

The stream of all rounds is cut into windows of ``window`` tokens: no window but the last has padding, and each holds every source that still has tokens at its target share, within a grain a source. By default the targets are the sources' own token shares, so all queues end together; with other ``targets`` some queues end early and the rest goes on among the others in their proportions.

A null or empty text is the end token alone. Null sources are one queue; sources that ``targets`` lacks, or gives nothing, send a tenth of what the least target does. A very long text is cut over many windows, at its source's quantum. Repeated rows are packed each; ties in the seeded order fall to doc_id and then to the row, and rows without a doc_id are ordered by their number. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.llm.common import bits_for, materialize, prefix_sums, released, uniform_hash

VOCABULARY, END, WINDOW, SEED = "word_bpe_49k.json", 2, 4096, 7
#: Tokens that a queue sends at once, at least.
GRAIN = 16
#: Words that a worker process keeps with their ids: the first ones it meets, which the frequent ones are among. Half as many pieces of words are kept.
CACHE = 400_000
#: Characters of the longest word that is kept.
KEPT = 64
#: Bytes of text that are encoded together, unless one text has more.
PART = 8 << 20
#: Rounds whose pieces are ordered together.
ROUNDS = 4


TWO_BYTES = [i.to_bytes(2, "little") for i in range(1 << 16)]


def vocabulary_path(name: str) -> str:
    """The place of a vocabulary file: ``name`` itself if it is a path, else that of the installed file of the name."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


#: Texts that the tokenizer encodes whole.
OTHER = r"[^\x00-\x1b\x20-\x{2ff}]|\x{130}|<\|(?:start|end)oftext\|>"


class Encoder:
    """Ids of the tokenizer as 16-bit numbers. Below U+0300 its normaliser only folds white space and case, and its pieces (letters, a digit, other signs) never reach across white space: such texts are split at white space, a batch at a time, and each different word is looked up or, the first time, cut into pieces and given to the tokenizer's model. The tokenizer encodes all other texts whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        self.known, self.known_ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self.known_pieces: dict[str, bytes] = {}
        low = [chr(c) for c in range(0x300)]
        of = lambda kind: "".join(re.escape(c) for c in low if unicodedata.category(c)[0] == kind)
        letters, digits = of("L"), of("N")
        self.pieces = re.compile(f"[{letters}]+|[{digits}]|'(?:s|t|re|ve|m|ll|d)|[^{letters}{digits}]+").findall
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in byte-level BPE
        hidden = iter(range(256, 512))
        self.bytes = {b: chr(b if b in shown else next(hidden)) for b in range(256)}

    def piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.bytes)
        ids = b"".join([TWO_BYTES[t.id] for t in self.model(shown)])
        if len(self.known_pieces) < CACHE // 2 and len(piece) <= KEPT:
            self.known_pieces[piece] = ids
        return ids

    def word(self, word: str) -> bytes:
        """Ids of what stands between white space, which in an empty text is nothing. Words, and words with one sign after them, need no pattern to be cut."""
        if not word:
            return b""
        known = self.known_pieces
        if word.isalpha():
            return known.get(word) or self.piece(word)
        head, last = word[:-1], word[-1]
        if head.isalpha() and not last.isalnum():
            return (known.get(head) or self.piece(head)) + (known.get(last) or self.piece(last))
        return b"".join([known.get(p) or self.piece(p) for p in self.pieces(word)])

    def look_up(self, words: pa.StringArray) -> tuple[np.ndarray, pa.BinaryArray]:
        """The place of each word in an array of ids, and that array."""
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(at.is_null()).dictionary_encode()
        found = [self.word(w) for w in new.dictionary.to_numpy(zero_copy_only=False).tolist()]
        ids = pa.concat_arrays([self.known_ids, pa.array(found, pa.binary())])
        places = np.array(at.fill_null(-1))
        places[places < 0] = np.array(new.indices) + len(self.known)
        if len(self.known) < CACHE:
            short = pc.less_equal(pc.utf8_length(new.dictionary), KEPT)
            kept = [x.filter(short)[: CACHE - len(self.known)] for x in (new.dictionary, ids[len(self.known) :])]
            self.known, self.known_ids = pa.concat_arrays([self.known, kept[0]]), pa.concat_arrays([self.known_ids, kept[1]])
        return places, ids

    def encode_all(self, texts: pa.StringArray, last: bytes = b"") -> pa.BinaryArray:
        """The ids of each text, and ``last`` after them. Null texts are empty."""
        texts = texts.fill_null("")
        other = pc.match_substring_regex(texts, OTHER)
        # trimmed, as Arrow looks at the character after white space, which at a text's end is another's or none
        lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(pc.if_else(other, "", texts))))
        places, ids = self.look_up(lists.flatten())
        whole = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts.filter(other).to_pylist()]
        # a text's words, or the text itself, and then what comes last
        n = np.array(pc.list_value_length(lists), np.int64)
        places = np.insert(places, np.cumsum(n)[np.array(other)], len(ids) + np.arange(len(whole)))
        ends = np.cumsum(n + np.array(other))
        places = np.insert(places, ends, len(ids) + len(whole))
        joined = pa.concat_arrays([ids, pa.array([*whole, last], pa.binary())]).take(pa.array(places))
        offsets = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset :][np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
        return pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), joined.buffers()[2]])

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].as_py()


@functools.lru_cache(4)
def encoder(path: str) -> Encoder:
    """One for each worker process: tasks that run in it later find its words known."""
    return Encoder(path)


def tokenize(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, text: str = "text", doc_id: str = "doc_id", source: str = "source", group: int = 64, part: int = PART) -> DataFrame:
    """doc_id, source, tokens, ids (little-endian 16-bit, with the end token). Texts are encoded ``part`` bytes at a time, and leave in batches of ``group`` rows."""
    last = np.array([end], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(vocabulary_path(vocabulary)).encode_all
        for b in batches:
            size = np.cumsum(np.array(pc.binary_length(b.column(2)).fill_null(0), np.int64))
            for at in np.split(np.arange(b.num_rows), np.flatnonzero(np.diff(size // part)) + 1):
                if not len(at):
                    continue
                rows = b.slice(at[0], len(at))
                ids = encode(rows.column(2).cast(pa.string()), last)
                cols = [rows.column(0), rows.column(1), pc.divide(pc.binary_length(ids), 2).cast(pa.int64()), ids]
                out = pa.RecordBatch.from_arrays(cols, names=["doc_id", "source", "tokens", "ids"])
                yield from (out.slice(k, group) for k in range(0, out.num_rows, group))

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    return d.mapInArrow(released(run), "doc_id long, source string, tokens long, ids binary")


def queues(rows: DataFrame, targets: Mapping[str, float] | None = None, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """__source, quantum (tokens a round) and phase of every source, however many there are. ``rows`` is a stage table, of which narrow columns are read twice."""
    own = rows.groupBy("source").agg(F.sum("tokens").cast("double").alias("t"))
    if targets:
        schema = T.StructType([T.StructField("__s", T.StringType()), T.StructField("w", T.DoubleType())])
        given = rows.sparkSession.createDataFrame([(k, float(w)) for k, w in targets.items() if w > 0], schema)
        own = own.join(given, own["source"].eqNullSafe(given["__s"]), "left").select("source", F.col("w").alias("t"))
    low, high, n = own.agg(F.min(F.when(F.col("t") > 0, F.col("t"))), F.sum("t"), F.count_if(~(F.coalesce("t", F.lit(0.0)) > 0))).first()
    floor = (low or 1.0) / 10
    whole = (high or 0.0) + floor * n or 1.0
    quantum = F.when(F.col("t") > 0, F.col("t")).otherwise(floor) * F.lit(window / whole)
    phase = F.pmod(F.xxhash64("source"), F.lit(grain * 64)).cast("double") / 64
    return own.select(F.col("source").alias("__source"), quantum.alias("quantum"), phase.alias("phase"))


def cuts(before: int, tokens: int, quantum: float, phase: float, grain: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and round of the pieces of a document that has ``before`` tokens before it in its queue."""
    block = np.arange(before // grain, (before + tokens - 1) // grain + 1)
    # a block is sent in the first round by whose end the quanta cover it
    rnd = np.maximum(0, np.ceil((grain * (block + 1.0) - phase) / quantum).astype(np.int64) - 1)
    first = np.flatnonzero(np.concatenate([[True], rnd[1:] != rnd[:-1]]))
    start = np.maximum(block[first] * grain - before, 0)
    return start, np.diff(np.append(start, tokens)), rnd[first]


def pieces(queued: DataFrame, grain: int = GRAIN) -> DataFrame:
    """A row for each piece: uid, source, in_queue (its first token's place in the queue), piece, tokens, round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["uid", "source", "in_queue", "piece", "tokens", "round"]
        for b in batches:
            at, n, quantum, phase = (b.column(i).to_numpy() for i in (2, 3, 4, 5))
            found = [cuts(*x, grain) for x in zip(at.tolist(), n.tolist(), quantum.tolist(), phase.tolist(), strict=True)]
            if not found:
                continue
            of = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            start, length, rnd = (np.concatenate([f[i] for f in found]) for i in range(3))
            cols = [b.column(0).take(pa.array(of)), b.column(1).take(pa.array(of)), pa.array(at[of] + start), pa.array(start), pa.array(length), pa.array(rnd)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return queued.select("uid", "source", "in_queue", "tokens", "quantum", "phase").mapInArrow(released(run), "uid long, source string, in_queue long, piece long, tokens long, round long")


def places(rows: DataFrame, targets: Mapping[str, float] | None = None, window: int = WINDOW, seed: int = SEED, grain: int = GRAIN) -> DataFrame:
    """The pieces of ``rows`` (uid, doc_id, source, tokens), one row for each of ``rows``: uid and pieces, an array of (piece, tokens, start, round), start being the place in the stream."""
    n = rows.count()
    table = queues(rows, targets, window, grain)
    d = rows.withColumn("u", F.when(F.col("doc_id").isNull(), uniform_hash(seed, "uid")).otherwise(uniform_hash(seed, "doc_id")))
    bits = bits_for(n, 64)
    d = d.withColumn("bucket", F.shiftright("u", 31 - bits).cast("long"))
    d = prefix_sums(d, "tokens", "bucket", ["u", "doc_id", "uid"], ["source"], out="in_queue", fine_count=1 << bits)
    d = d.join(table, d["source"].eqNullSafe(F.col("__source")))
    p = materialize(pieces(d, grain).withColumn("rounds", F.floor(F.col("round") / ROUNDS)))
    last = p.agg(F.max("rounds")).first()[0] or 0
    p = prefix_sums(p, "tokens", "rounds", ["round", "source", "in_queue"], out="start", fine_count=last + 1)
    return p.groupBy("uid").agg(F.collect_list(F.struct("piece", "tokens", "start", "round")).alias("pieces"))


def pack(docs: DataFrame, targets: Mapping[str, float] | None = None, window: int = WINDOW, seed: int = SEED, with_ids: bool = True, grain: int = GRAIN, **columns: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, round, padded_to and (``with_ids``) ids.

    A sequence is padded to ``window``; the last one, if it is a power of two long, isn't padded. The list of a document's pieces is as long as the document, in grains at most.
    """
    rows = materialize(tokenize(docs, **columns).withColumn("uid", F.monotonically_increasing_id()))
    at = places(rows.select("uid", "doc_id", "source", "tokens"), targets, window, seed, grain)
    end = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    of = lambda name: F.col(f"pieces.{name}").alias(name)
    both = rows.select("uid", "doc_id", "ids").join(at, "uid").select("doc_id", "ids", of("piece"), of("tokens"), of("start"), of("round"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "round", "padded_to", *(["ids"] if with_ids else [])]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: len(names)]
    tail = end % window

    def padded(sequence: int) -> int:
        return tail if sequence == end // window and tail & (tail - 1) == 0 else window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names]
            for doc, raw, *parts in zip(b.column(0).to_pylist(), b.column(1), *(b.column(i).to_pylist() for i in range(2, 6)), strict=True):
                ids = np.frombuffer(raw.as_buffer(), "<u2")
                # consecutive pieces that the stream holds without a gap are one
                runs: list[list[int]] = []
                for first, n, at, rnd in sorted(zip(*parts, strict=True)):
                    if runs and runs[-1][2] + runs[-1][1] == at:
                        runs[-1][1] += n
                    else:
                        runs.append([first, n, at, rnd])
                for first, n, at, rnd in runs:
                    done = 0
                    while done < n:
                        sequence, offset = divmod(at + done, window)
                        length = min(window - offset, n - done)
                        piece = ids[first + done : first + done + length]
                        values = (doc, first + done, length, zlib.crc32(piece.astype("<u4").tobytes()), len(ids), sequence, offset, rnd, padded(sequence), piece.tobytes())
                        for column, value in zip(out, values, strict=False):
                            column.append(value)
                        done += length
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)
    return both.mapInArrow(released(run), schema)
