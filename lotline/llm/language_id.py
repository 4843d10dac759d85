"""Language ID by compression: text is encoded with zstandard against a raw-content dictionary of each language, and the smallest encoding wins.

The dictionaries are raw text of each language, from a bounded sample of labelled rows: ``SAMPLE_DOCS`` documents a language, chosen by a hash of their id and text, up to ``DICT_BYTES`` bytes in all, from a seeded place in each. Whole texts are encoded, in chunks of ``CHUNK`` characters so that a long text doesn't become its own dictionary. Every chunk follows the same ``FILLER``, which encodes to a few bytes and keeps the encoder from storing a short chunk as it is. Texts of all lengths go the same way.

A document is rejected when the margin, the share of its size that the best language saves against the second best, is below ``MIN_MARGIN``: the bytes asked for grow with the text.

Only words count: text is lower-cased and what lies between words becomes one space, in dictionaries too. Null texts and texts without a letter are ``und`` with score 0, and rejected. With no labelled row at all every text is ``und``. Ties go to the language with more labelled rows, then to the name that sorts first. A very long text takes time in proportion and the memory of itself. Repeated rows get equal results, an empty table an empty one; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.llm.common import released

SAMPLE_DOCS, DICT_BYTES, CHUNK, LEVEL = 64, 65_536, 4_000, 12
#: Languages that get a dictionary, those with the most labelled rows first: each is one more encoding of every text.
MAX_LANGS = 128
FILLER = b" " * 128
MIN_MARGIN = 0.02
UND = "und"

between_words = re.compile(r"[\W\d_]+").sub


def plain(text: str) -> str:
    return between_words(" ", text.lower())


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES, max_langs: int = MAX_LANGS) -> dict[str, bytes]:
    """Language -> dictionary. Counts all labelled rows; keeps about ``sample_docs`` distinct rows a language, ``dict_bytes`` characters of each from a seeded place on. At most ``max_langs`` languages, and as many rows a language, reach the driver."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(max_langs).collect()}
    if not counts:
        return {}
    u = F.shiftrightunsigned(F.xxhash64(F.lit(9), F.col(doc_id), F.col(text)), 33)
    share = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(int(min(1.0, 2 * sample_docs / n) * 2**31)))])
    picked = rows.where(u < share[F.col(lang)]).select(F.col(lang).alias("lang"), u.alias("u"), F.col(doc_id).alias("doc_id"), F.substring(F.col(text), 1 + F.pmod(u, F.greatest(F.lit(1), F.length(text) - dict_bytes + 1)).cast("int"), F.lit(dict_bytes)).alias("text"))
    found: dict[str, list] = {}
    for r in picked.dropDuplicates(["lang", "u"]).orderBy("u", "doc_id").limit(4 * sample_docs * len(counts)).toLocalIterator():
        found.setdefault(r["lang"], []).append(r["text"])
    out = {}
    for k, texts in found.items():
        texts = texts[:sample_docs]
        each = max(256, dict_bytes // len(texts))
        # every document gives its share first; what is left over is filled up with the rest of them
        raw, rest = b"", b""
        for t in texts:
            b = plain(t).encode()
            raw, rest = raw + b[:each] + b" ", rest + b[each : each + dict_bytes // 4]
        out[k] = (rest[: max(0, dict_bytes - len(raw))] + raw)[-dict_bytes:]
    return {k: out[k] for k in sorted(out, key=lambda k: (-counts[k], k))}


class Model:
    def __init__(self, dictionaries: dict[str, bytes], chunk: int = CHUNK, level: int = LEVEL):
        self.langs, self.chunk = list(dictionaries), chunk
        self.coders = [self._coder(dictionaries[k], level) for k in self.langs]

    @staticmethod
    def _coder(raw: bytes, level: int) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=d, level=level, write_checksum=False, write_content_size=False, write_dict_id=False)

    def sizes(self, text: str) -> list[int]:
        text = plain(text)
        parts = [FILLER + text[i : i + self.chunk].encode() for i in range(0, len(text), self.chunk)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.coders]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """The language, a score and the margin. Score: the share of the winner when each saved byte doubles the odds."""
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UND, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(sizes)
        at = sizes.index(best)
        second = min(sizes[:at] + sizes[at + 1 :], default=0)
        return self.langs[at], 1.0 / sum(2.0 ** -min(60, s - best) for s in sizes), (second - best) / second if second else 1.0


def classify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score and rejected (no language, or a narrow margin); columns of these names are replaced. No shuffle: the dictionaries, of bounded size, go to every executor."""
    docs = docs.drop("lang_pred", "score", "rejected")
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(sent.value)
        for b in batches:
            got = [model.predict(t.as_py()) for t in b.column(text)]
            langs, scores, margins = ([g[i] for g in got] for i in range(3))
            cols = [*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array([k == UND or m < min_margin for k, m in zip(langs, margins, strict=True)], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(released(run), schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
