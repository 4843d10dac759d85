"""Fixtures that all operators are run over: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

WORDS = {
    "en": "the of and to in is that it was for on are with as his they be at one have this from or had by".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas sur faire plus".split(),
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["uid", "digest", "bands", "key", "bucket", "score", "leaf", "part", "u", "kept", "tokens", "found", "node", "batch", "shard", "start", "text_digest", "w"]


def sentence(rng, lang="en", n=40):
    return " ".join("".join(rng.choices(WORDS[lang], k=rng.randint(1, 2))) for _ in range(n))


def rows(seed=1, n=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, sentence(rng, lang, rng.randint(8, 120)), lang, "hot" if i % 3 == 0 else f"s{i % 5}", 0))
    out += [(n, None, None, None, None), (n + 1, "", "en", "hot", 0), (n + 2, "  \n", "en", "", 2), (n + 3, sentence(rng, "de", 20_000), "de", "hot", 1)]
    out += [(n + 4, out[0][1], "en", "s1", 0), (n + 5, out[0][1].upper(), "en", "s1", 0), out[3], out[3]]
    out += [(n + 6, out[5][1] + " one more end", out[5][2], "hot", 0), (n + 7, "é 日本語   😀 'tis", "fr", "s2", 0), (n + 8, "!!! ... ---", "en", "s2", 0)]
    return [(a, b, c, d, len(b) if b else None) for a, b, c, d, _ in out]


def documents(spark, data=None, clash=False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASH})
    return df
