import hashlib
import os
import random
from collections import Counter

import corpus_pipeline
from lotline.llm import language_id, mixing

from .helpers import WORDS, documents, rows, sentence
from .test_exact_dedup import digest
from .test_language_id import brute as brute_language
from .test_near_dedup import brute_classes, edited


def brute_mix(data):
    """The documents that the mixing stage takes, by plain loops."""
    n = {r[0]: len(r[1].split()) for r in data}
    leaves = {}
    for i, _, lang, source, _ in data:
        leaves.setdefault((f"domain{int(hashlib.md5(source.encode()).hexdigest()[:15], 16) % 4}", lang, source), []).append(i)
    supply = {k: sum(n[i] for i in v) for k, v in leaves.items()}
    plan = mixing.budgets(supply, corpus_pipeline.MIX_WEIGHTS, int(corpus_pipeline.MIX_SHARE * sum(supply.values())), 1)
    out = set()
    for k, members in leaves.items():
        if plan[k] == supply[k]:
            out |= set(members)
            continue
        before = 0
        for i in sorted(members, key=lambda i: (int(hashlib.md5(f"{mixing.SEED}|0|{i}".encode()).hexdigest()[:15], 16), i)):
            out |= {i} if before < plan[k] else set()
            before += n[i]
    return out


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    data = []
    for i in range(150):
        lang = rng.choice(list(WORDS))
        data.append((i, sentence(rng, lang, rng.randint(30, 120)), lang, "hot" if i % 3 else f"s{i % 4}", 0))
    for i in range(20):
        data.append((200 + i, data[i][1].upper(), data[i][2], "s1", 0))
        data.append((300 + i, edited(rng, data[50 + i][1], 0.01), data[50 + i][2], "s2", 0))
    data += [(400, None, "en", "s1", 0), (401, "123 !!", "en", "s1", 0), (402, "", "de", "s1", 0)]
    sf = str(tmp_path)
    documents(spark, data).write.parquet(f"{sf}/documents.parquet")

    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{sf}/{k}")
        docs = spark.read.parquet(f"{sf}/{k}")
        kept.append(docs)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())

    model = language_id.train(spark.read.parquet(f"{sf}/documents.parquet"))
    first = [r for r in data if not brute_language(r[1], model)[2]]
    assert len(first) >= len(data) - 5
    assert ids(kept[0]) == sorted(r[0] for r in first)
    last = {}
    for r in first:
        last[digest(r[1])] = max(last.get(digest(r[1]), -1), r[0])
    assert ids(kept[1]) == sorted(last.values())
    second = [r for r in first if r[0] in set(last.values())]
    assert ids(kept[2]) == sorted(set(brute_classes(second).values()))
    words = lambda d: sum(len(r["text"].split()) for r in d.collect())
    assert set(ids(kept[3])) <= set(ids(kept[2])) and set(ids(kept[3])) == brute_mix([r for r in second if r[0] in set(ids(kept[2]))]) and 0.89 < words(kept[3]) / words(kept[2]) < 0.99
    assert Counter(ids(kept[3])).most_common(1)[0][1] == 1
    assert set(ids(kept[4])) == set(ids(kept[3]))
    run = corpus_pipeline.run(spark, sf)
    same = lambda d: sorted((r["sequence_id"], r["offset"], r["doc_id"], r["ids_crc32"]) for r in d.collect())
    assert same(run) == same(kept[4])
    at = run.inputFiles()[0].rsplit("/", 2)[0]
    assert os.listdir(at.removeprefix("file://")) == ["4"]  # of the stages' tables only the last is left


def test_null_and_repeated_ids_in_every_stage(spark, tmp_path):
    """No stage loses a row for its null or repeated doc_id, or returns one that it dropped."""
    rng = random.Random(5)
    text = [sentence(rng, "en", 200) for _ in range(60)]
    data = [(None if i < 40 else 7 if i < 50 else i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(text)]
    near = [(k, edited(rng, data[i][1], 0.01), "en", "s1", 0) for k, i in ((None, 3), (7, 45))]
    docs = documents(spark, data + near + [(None, text[0].upper(), "en", "s1", 0)], clash=True)
    want, n = [63, 62, 60], 0
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "packing":
            assert docs.where("start = 0").count() == before
        elif name == "mixing":
            words = sum(len(r["text"].split()) for r in docs.collect())
            assert 0.89 < words / n < 0.99 and docs.where("doc_id IS NULL").count() >= 30
        else:
            assert docs.count() == want[k]
            n = sum(len(r["text"].split()) for r in docs.collect())


def test_edges_of_every_stage(spark, tmp_path):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing columns; and no rows at all."""
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for j, data in enumerate((rows(), [])):
            out = stage(spark, documents(spark, data, clash=True), "")
            assert name == "packing" or out.columns == corpus_pipeline.COLUMNS
            out.write.parquet(f"{tmp_path}/{k}-{j}")
            assert (spark.read.parquet(f"{tmp_path}/{k}-{j}").count() > 0) == bool(data)
