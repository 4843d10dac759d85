"""The operators of this subpackage over their whole tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm import centroids, chat, exact_dedup, fingerprints, language_id, licenses, mixing, near_dedup, ngram_join, packing, secrets, sharding, spelling
from lotline.llm.common import LOWER, UPPER, read


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    text = lambda kinds: F.array_join(F.transform(F.filter("found", lambda x: x["kind"].isin(*kinds)), lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
    n = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(text(secrets.KINDS[:3]), 256).alias("base_sha256"), text(secrets.KINDS).alias("spans"), n("markov"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack(docs, with_ids=False)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shard(docs, 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))


def _op5_sql() -> str:
    known = ", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in licenses.KNOWN)
    return f"""
WITH known AS (SELECT min(license) AS license, sha256({licenses.canonical_sql("t")}) AS digest FROM (VALUES {known}) k(license, t) GROUP BY 2),
d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS uid FROM documents),
lines AS (SELECT uid, unnest(string_split(text, chr(10))) AS line FROM d),
hits AS (SELECT uid, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n_lines
  FROM (SELECT uid, sha256({licenses.canonical_sql("line")}) AS digest FROM lines WHERE {licenses.canonical_sql("line")} <> '') JOIN known USING (digest) GROUP BY uid),
w AS (SELECT uid, doc_id, sha256({licenses.canonical_sql("text")}) AS text_digest FROM d)
SELECT doc_id, text_digest, license AS text_license, coalesce(line_licenses, '') AS line_licenses, coalesce(n_lines, 0) AS n_lines
FROM w LEFT JOIN known ON text_digest = digest LEFT JOIN hits USING (uid)
"""


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = exact_dedup.dedup(docs, exact_dedup.loads_of())
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP6_SQL = f"""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layouts, each found by its fingerprint: the table has a row for each turn, the control conversation is a JSON record with messages."""
    rows = chat.canonical_turns(read(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_turns(rows.unionByName(chat.control_conversation(spark))))


OP7_SQL = r"""
WITH t AS (SELECT conv_id, turn, CASE coalesce(role, '') WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' WHEN 'model' THEN 'assistant' WHEN 'ai' THEN 'assistant' ELSE coalesce(role, '') END AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
e AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g')) + length(role) + length(regexp_replace(role, '[^\\<\[|]', '', 'g')) AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(escaped + length('<||>' || chr(10) || chr(10) || '<|end|>' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


#: Target weights among siblings of the tree: two domains and a language count more, a source less.
OP8_WEIGHTS = {("domain0",): 3, ("domain1",): 2, ("domain0", "en"): 2, ("domain1", "en"): 2, ("domain2", "en"): 2, ("domain3", "en"): 2, ("domain0", "en", "src1"): 0.5}


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix_sources(docs, [mixing.domain(F.col("source")), "lang", "source"], OP8_WEIGHTS).drop("uid")


def _op8_sql() -> str:
    """Level by level: children that have less per weight than what their family still has are full, the others share the rest by weight."""
    hashed = lambda x: f"('0x' || substr(md5({x}), 1, 15))::BIGINT"
    weight = {1: "CASE l1 WHEN 'domain0' THEN 3000000 WHEN 'domain1' THEN 2000000 ELSE 1000000 END", 2: "CASE WHEN l2 = 'en' THEN 2000000 ELSE 1000000 END", 3: "CASE WHEN l1 = 'domain0' AND l2 = 'en' AND l3 = 'src1' THEN 500000 ELSE 1000000 END"}
    ctes, up = [], ""
    for k in (1, 2, 3):
        path = ", ".join(f"l{i}" for i in range(1, k + 1))
        family = ", ".join(f"l{i}" for i in range(1, k)) or "1"
        amount = "(SELECT least(sum(supply), sum(supply) * 2) FROM leaves)" if k == 1 else "up.amount"
        ctes.append(f"""
c{k} AS (SELECT {", ".join(f"c.l{i}" for i in range(1, k + 1))}, room, w, {amount}::HUGEINT AS amount FROM (SELECT {path}, (sum(supply) * 2)::BIGINT AS room, {weight[k]} AS w FROM leaves GROUP BY {path}) c {up} WHERE room > 0),
o{k} AS (SELECT *, coalesce(sum(room) OVER b, 0)::HUGEINT AS room_before, coalesce(sum(w) OVER b, 0)::HUGEINT AS w_before, sum(w) OVER (PARTITION BY {family})::HUGEINT AS w_all FROM c{k} WINDOW b AS (PARTITION BY {family} ORDER BY room / w, {path} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f{k} AS (SELECT *, room * (w_all - w_before) <= w * (amount - room_before) AS is_full FROM o{k}),
r{k} AS (SELECT *, amount - coalesce(sum(room) FILTER (WHERE is_full) OVER p, 0)::HUGEINT AS rest, w_all - coalesce(sum(w) FILTER (WHERE is_full) OVER p, 0)::HUGEINT AS rest_w, coalesce(sum(w) FILTER (WHERE NOT is_full) OVER q, 0)::HUGEINT AS upto FROM f{k} WINDOW p AS (PARTITION BY {family}), q AS (PARTITION BY {family} ORDER BY {hashed("concat_ws('/', " + path + ")")}, {path})),
a{k} AS (SELECT {path}, CASE WHEN is_full THEN room ELSE (rest * upto) // rest_w - (rest * (upto - w)) // rest_w END AS amount FROM r{k})""")
        up = f"JOIN a{k} up ON " + " AND ".join(f"up.l{i} = c.l{i}" for i in range(1, k + 1))
    return f"""
WITH d AS (SELECT doc_id, concat('domain', {hashed("coalesce(source, '')")} % 4) AS l1, coalesce(lang, '') AS l2, coalesce(source, '') AS l3, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> ''))::BIGINT AS tokens FROM documents),
leaves AS (SELECT l1, l2, l3, sum(tokens)::BIGINT AS supply FROM d GROUP BY ALL),
{",".join(ctes)},
plan AS (SELECT *, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS whole, CASE WHEN supply > 0 THEN budget % supply ELSE 0 END AS rest FROM (SELECT l1, l2, l3, supply, coalesce(amount, 0)::BIGINT AS budget FROM leaves LEFT JOIN a3 USING (l1, l2, l3))),
s AS (SELECT d.doc_id, tokens, plan.*, coalesce(sum(tokens) OVER (PARTITION BY l1, l2, l3 ORDER BY {hashed("concat_ws('|', '20261', whole, d.doc_id)")}, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN plan USING (l1, l2, l3)),
e AS (SELECT *, unnest(range(whole + CASE WHEN before < rest THEN 1 ELSE 0 END)) AS epoch FROM s)
SELECT doc_id, concat_ws('/', l1, l2, l3) AS leaf, epoch::INTEGER AS epoch, tokens, CASE WHEN epoch < whole THEN tokens ELSE least(tokens, rest - before) END::BIGINT AS tokens_used, supply AS leaf_tokens, budget AS leaf_budget FROM e
"""


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language_id.held_out(F.col("doc_id"))
    model = language_id.train(docs.where(~held))
    out = language_id.classify(docs.select("doc_id", "text", held.alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_dedup(docs).select("doc_id", "class_id", "kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of whole texts; of every 31st (document, word), by hash, the text lacks a letter."""
    d = read(spark, sf_dir, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(spelling.runs(F.col("text"))).alias("run"))
    d = d.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    word = F.when(F.col("h") % 31 == 0, spelling.without(F.col("run"), F.pmod("h", F.length("run")).cast("int"))).otherwise(F.col("run"))
    return spelling.variants(d.select(word.alias("word")).where(F.length("word") >= spelling.MIN_LETTERS))


OP11_SQL = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM (SELECT run, n, hex(encode(doc_id || ':' || run)) AS x FROM runs), crc),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
emitted AS (SELECT DISTINCT word, n, key FROM (SELECT word, n, word AS key FROM words UNION ALL SELECT word, n, substr(word, 1, i) || substr(word, i + 2) FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words))),
near AS (SELECT DISTINCT a.word AS word, a.n AS n, b.word AS other, b.n AS m FROM emitted a JOIN emitted b USING (key) WHERE a.word <> b.word
  AND CASE length(a.word) - length(b.word) WHEN 0 THEN len(list_filter(range(1, length(a.word) + 1), lambda i: substr(a.word, i, 1) <> substr(b.word, i, 1))) = 1 WHEN 1 THEN key = b.word WHEN -1 THEN key = a.word ELSE false END),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, encode(other))) AS other, max(m) AS m FROM near GROUP BY word),
formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN other END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at, form FROM formed UNION ALL SELECT chain.word, chain.form, f.form FROM chain JOIN formed f ON chain.form = f.word)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain USING (word) WHERE chain.form IS NULL
"""


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP12_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT uid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d),
t AS MATERIALIZED (SELECT uid, len(g) AS n, unnest(g) AS g FROM s),
cand AS (SELECT a.uid AS a, b.uid AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common FROM t a JOIN t b ON a.g = b.g AND a.uid < b.uid AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY ALL),
pairs AS (SELECT a, b FROM cand WHERE 100 * common >= 90 * (n + m - common)),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT uid, uid AS at FROM s UNION SELECT reach.uid, links.b FROM reach JOIN links ON reach.at = links.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, c.component_id FROM s JOIN (SELECT reach.uid, min(o.doc_id) AS component_id FROM reach JOIN s o ON reach.at = o.uid GROUP BY reach.uid) c USING (uid)
"""


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("scans")


def _op13_sql() -> str:
    """Each round: the least (distance, number) of each vector, then exact floors of means, or the old centroid."""
    far = "list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.v[i]) * (e.v[i] - c.v[i])))::BIGINT"
    ctes = []
    for r in range(4):
        ctes.append(f"a{r} AS MATERIALIZED (SELECT uid, min((d, c)) AS best FROM (SELECT uid, c.c, {far} AS d FROM e, c{r} c) GROUP BY uid)")
        if r < 3:
            ctes.append(f"m{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (SELECT a.best[2] AS c, i, sum(e.v[i]) AS s, count(*) AS n FROM a{r} a JOIN e USING (uid), range(1, 65) r(i) GROUP BY ALL) GROUP BY c)")
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m{r}.v, o.v) AS v FROM c{r} o LEFT JOIN m{r} USING (c))")
    return f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), v) - 1)::INTEGER AS c, v FROM e ORDER BY c LIMIT 16),
{", ".join(ctes)},
f AS (SELECT vec_id, best[2] AS cluster, best[1] AS distance FROM a3 JOIN e USING (uid))
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256 FROM f JOIN c3 ON c = cluster
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_packing, op3_sharding, op4_fingerprints, op5_license_scan, op6_exact_dedup, op7_chat_formatting, op8_mixing, op9_language_id, op10_near_dedup, op11_spelling_variants, op12_ngram_join, op13_centroids, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op5_license_scan": _op5_sql(), "op6_exact_dedup": OP6_SQL, "op7_chat_formatting": OP7_SQL, "op8_mixing": _op8_sql(), "op11_spelling_variants": OP11_SQL, "op12_ngram_join": OP12_SQL, "op13_centroids": _op13_sql()}
