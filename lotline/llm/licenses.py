"""License scans by canonical digest.

A text is normalised (lower case A-Z, no copyright lines, equivalent spellings made one, punctuation and white space folded to single spaces) and the digest of the whole of it is joined with the digests of known license texts and notices. Documents are looked up as a whole, and each of their lines as a text of its own, so that a notice among other text is found too. Both go through one hash join, a row for each text and line; lines leave no row unless they are known.

Null and empty texts have no license. Lines that repeat count each, lines that are empty once normalised don't; of licenses with the same canonical text the least name counts. A very long text is made canonical whole, in the memory of a few copies of it. An empty table gives an empty result. The known table is broadcast if it has up to ``MAX_BROADCAST`` texts, as the library's own has; a larger one is joined by an exchange. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm import license_texts
from lotline.llm.common import LOWER, UPPER, ascii_lower

#: Spellings that count as one, applied in order to lower-cased text.
SPELLINGS = (
    ("licence", "license"),
    ("sublicence", "sublicense"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("https://", "http://"),
    ("&", " and "),
)
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"""
BSD_ITEMS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Names that notices give a license, beside its SPDX identifiers.
NAMES = {
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    **{f"{a}GPL-{v}": [f"GNU {n} General Public License, version {w}".replace("  ", " ") for w in {v, v.removesuffix(".0")}] + [f"GNU {n} General Public License v{v}".replace("  ", " "), f"{a}GPLv{v.removesuffix('.0')}"] for a, n, v in (("", "", "2.0"), ("", "", "3.0"), ("L", "Lesser", "2.1"), ("L", "Lesser", "3.0"), ("A", "Affero", "3.0"))},
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal License"],
    **{f"CC-{k}-{v}": [f"CC {k} {v}", f"Creative Commons {n} {v} {where}", f"Creative Commons {n} {v} {where} License"] for k, n in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")) for v, where in (("3.0", "Unported"), ("4.0", "International"))},
}
NOTICES = ("Licensed under", "Released under", "Distributed under", "This project is licensed under", "This work is licensed under", "This software is licensed under", "This code is licensed under")
#: Known texts that are broadcast at most, 100 bytes each.
MAX_BROADCAST = 20_000


def _notices() -> list[tuple[str, str]]:
    """Each notice of each name, with and without an article, and SPDX tags."""
    out = []
    for license, names in NAMES.items():
        lines = [f"{a} {b}{name}" for a in NOTICES for b in ("", "the ", "a ") for name in [*names, license]]
        ids = [license] if "GPL" not in license else [license, f"{license}-only"]
        out += [(license, t) for t in lines + [f"SPDX-License-Identifier: {i}" for i in ids]]
        if "GPL" in license:
            out.append((f"{license}-or-later", f"SPDX-License-Identifier: {license}-or-later"))
    return out


def _bsd(clauses: int, mark: str) -> str:
    return "\n\n".join([BSD_START, *[f"{mark.format(i + 1)} {t}" for i, t in enumerate(BSD_ITEMS[:clauses])], BSD_END])


#: (license, text): whole licenses and the usual notices.
KNOWN = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    *license_texts.TEXTS.items(),
    *[(f"BSD-{n}-Clause", title + _bsd(n, mark)) for n in (2, 3) for mark in ("{}.", "*") for title in ("", f"BSD {n}-Clause License\n\n")],
    *_notices(),
)


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line breaks: each line is canonical but for blanks at its ends."""
    t = ascii_lower(text)
    t = F.regexp_replace(t, COPYRIGHT_LINE, "\n")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.regexp_replace(t, "[^a-z0-9\n]+", " ")


def canonical(text: Column) -> Column:
    return one_line(canonical_lines(text))


def one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def canonical_sql(text: str) -> str:
    t = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), '{COPYRIGHT_LINE}', chr(10), 'g')"
    for a, b in SPELLINGS:
        t = f"replace({t}, '{a}', '{b}')"
    return f"trim(regexp_replace({t}, '[^a-z0-9]+', ' ', 'g'))"


def known_digests(spark: SparkSession, known: Sequence[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """known_digest and license, one row a digest. ``known``: (license, text) as a list or as a DataFrame of two columns."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame([*(KNOWN if known is None else known)], "license string, known string")
    texts = known.toDF("license", "known").where("license IS NOT NULL AND known IS NOT NULL")
    of = texts.groupBy(F.sha2(canonical(F.col("known")), 256).alias("known_digest")).agg(F.min("license").alias("license"))
    return F.broadcast(of) if texts.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else of


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", known: Sequence[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, text_digest (of the whole canonical text), text_license (null if not known), line_licenses (of its lines, sorted, comma-joined) and n_lines (that match)."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), canonical_lines(F.coalesce(F.col(text), F.lit(""))).alias("lines"), F.monotonically_increasing_id().alias("row"))
    whole = F.struct(F.sha2(one_line(F.col("lines")), 256).alias("digest"), F.lit(False).alias("line"))
    lines = F.transform(F.filter(F.transform(F.split("lines", "\n"), lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.struct(F.sha2(x, 256).alias("digest"), F.lit(True).alias("line")))
    e = d.select("row", "doc_id", F.explode(F.concat(F.array(whole), lines)).alias("x")).select("row", "doc_id", "x.digest", "x.line")
    k = known_digests(docs.sparkSession, known)
    hit = e.join(k, e["digest"] == k["known_digest"], "left").where(~F.col("line") | F.col("license").isNotNull())
    on = lambda line, c: F.when(F.col("line") == line, F.col(c))
    out = hit.groupBy("row", "doc_id").agg(F.min(on(False, "digest")).alias("text_digest"), F.min(on(False, "license")).alias("text_license"), F.collect_set(on(True, "license")).alias("found"), F.count_if("line").alias("n_lines"))
    return out.select("doc_id", "text_digest", "text_license", F.array_join(F.array_sort("found"), ",").alias("line_licenses"), F.col("n_lines").cast("long").alias("n_lines"))
