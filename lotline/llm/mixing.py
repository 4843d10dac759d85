"""Mixing by hierarchical budgets.

A token budget flows down a tree (domain, language, source by default) by the weights of siblings. A child that has less than its share (its tokens times ``max_epochs``) hands the shortage to its siblings; only what a whole family can't use goes up to the family's own siblings. Budgets are whole tokens and add up to the total. A leaf's budget buys whole epochs of the leaf and then a token-prefix of one more, in that epoch's seeded order.

A row comes out for each selected document and epoch. The document at the end of a prefix stays whole, and ``tokens_used`` says how much of it the budget covers, so a leaf exceeds its budget by less than a document. Nulls in a tree column are a branch of their own (named ''); null and empty texts have 0 tokens, a very long one as many as it has; repeated rows count each; ties in the seeded order fall to doc_id and then to the row, and rows without a doc_id are ordered by their number. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.llm.common import bits_for, materialize, prefix_sums

TREE = ("domain", "lang", "source")
SEED = 20_261
#: Up to so many leaves the driver plans the tree and the plan is broadcast; a larger tree is planned as a table, by the same rule.
DRIVER_LEAVES = 50_000
PER_BUCKET = 64
#: Weights are kept as whole numbers of this part.
UNIT = 1_000_000


def hash60(text: Column) -> Column:
    """The first 60 bits of a text's MD5: the same in every engine."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def domain(source: Column, domains: int = 4) -> Column:
    """A domain for tables that have none: a family of sources, by the hash of the name."""
    return F.concat(F.lit("domain"), F.pmod(hash60(F.coalesce(source, F.lit(""))), F.lit(domains)).cast("string"))


def token_count(text: Column) -> Column:
    """Words between white space."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+"))).cast("long")


def _hash60(path: Sequence[str]) -> int:
    return int(hashlib.md5("/".join(path).encode()).hexdigest()[:15], 16)


def budgets(supply: Mapping[tuple, int], weights: Mapping[tuple, float], total: int, max_epochs: int) -> dict[tuple, int]:
    """Leaf -> tokens. ``weights``: path -> weight among its siblings, 1 if not given; a weight of 0 takes nothing.

    In a family, children are full that have less than their share of what is left once those with still less per weight are served. The others share the rest: each one's budget is the difference of the shares, in whole tokens, of the children up to it and before it, in the order of the names' hashes.
    """
    of = lambda path: round(weights.get(path, 1) * UNIT)
    tree: dict[tuple, dict[tuple, None]] = {}
    room: dict[tuple, int] = {}
    for leaf, tokens in supply.items():
        can = tokens * max_epochs if all(of(leaf[:j]) > 0 for j in range(1, len(leaf) + 1)) else 0
        for k in range(len(leaf) + 1):
            room[leaf[:k]] = room.get(leaf[:k], 0) + can
            if k:
                tree.setdefault(leaf[: k - 1], {})[leaf[:k]] = None
    out: dict[tuple, int] = {(): min(total, room.get((), 0))}
    for path in sorted(tree, key=len):
        left, children = out[path], [c for c in tree[path] if room[c] > 0]
        out |= dict.fromkeys(tree[path], 0)
        whole = sum(map(of, children))
        children.sort(key=lambda c: (room[c] / of(c), c))
        full = 0
        while full < len(children) and room[children[full]] * whole <= left * of(children[full]):
            c = children[full]
            out[c] = room[c]
            left, whole, full = left - room[c], whole - of(c), full + 1
        before = 0
        for c in sorted(children[full:], key=lambda c: (_hash60(c), c)):
            out[c] = left * (before + of(c)) // whole - left * before // whole
            before += of(c)
    return {leaf: out[leaf] for leaf in supply}


def _weighted(nodes: DataFrame, weights: Mapping[tuple, float], k: int) -> DataFrame:
    """``nodes`` (path) with their weight w."""
    given = [(list(p), round(w * UNIT)) for p, w in weights.items() if len(p) == k]
    if not given:
        return nodes.withColumn("w", F.lit(UNIT).cast("long"))
    table = F.broadcast(nodes.sparkSession.createDataFrame(given, "path array<string>, given long"))  # what the caller wrote down
    return nodes.join(table, "path", "left").withColumn("w", F.coalesce("given", F.lit(UNIT).cast("long"))).drop("given")


def _fill(children: DataFrame) -> DataFrame:
    """path, amount of ``children`` (family, path, room, w, amount of the family): the rule of ``budgets`` without any family in one task."""
    share = lambda a, b, c: F.expr(f"(CAST({a} AS DECIMAL(19, 0)) * CAST({b} AS DECIMAL(19, 0))) div CAST({c} AS DECIMAL(19, 0))")
    c = children.where("room > 0").withColumn("ratio", F.col("room") / F.col("w"))
    c = materialize(c.withColumns({"fine": F.floor(F.log2(F.col("ratio") + 1) * 65_536), "h": hash60(F.array_join("path", "/"))}))
    steps = materialize(c.groupBy("family", "amount", "ratio", "fine").agg(F.sum("room").alias("room"), F.sum("w").alias("w")))
    steps = materialize(prefix_sums(steps, "room", "fine", ["ratio"], ["family"], out="room_before"))
    steps = prefix_sums(steps, "w", "fine", ["ratio"], ["family"], out="w_before", total="w_all")
    whole = lambda a, b: F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")
    steps = steps.withColumns({"w_left": F.col("w_all") - F.col("w_before"), "left": F.col("amount") - F.col("room_before")})
    full = whole("room", "w_left") <= whole("w", "left")
    sums = lambda x: F.coalesce(F.sum(F.when(full, F.col(x))), F.lit(0))
    cut = materialize(steps.groupBy("family", "amount", "w_all").agg(F.max(F.when(full, F.col("ratio"))).alias("cut"), sums("room").alias("served"), sums("w").alias("done")).select("family", "cut", (F.col("amount") - F.col("served")).alias("rest"), (F.col("w_all") - F.col("done")).alias("rest_w")))
    c = materialize(c.drop("amount").join(cut, "family").withColumn("full", F.coalesce(F.col("ratio") <= F.col("cut"), F.lit(False))).withColumn("bucket", F.shiftright("h", 60 - 20)))
    others = prefix_sums(c.where("NOT full"), "w", "bucket", ["h", "path"], ["family"], out="w_before", fine_count=1 << 20)
    return c.where("full").select("path", F.col("room").alias("amount")).unionByName(others.select("path", (share("rest", "w_before + w", "rest_w") - share("rest", "w_before", "rest_w")).alias("amount")))


def budget_table(leaves: DataFrame, weights: Mapping[tuple, float], total: int, max_epochs: int, depth: int) -> DataFrame:
    """``budgets`` as a table, for trees of any size: ``leaves`` (leaf, leaf_tokens) with leaf_budget."""
    node = lambda c, k: F.slice(c, 1, k)
    d = leaves.withColumn("room", F.col("leaf_tokens") * max_epochs)
    for k in range(1, depth + 1):
        if any(len(p) == k and round(w * UNIT) <= 0 for p, w in weights.items()):
            none = [list(p) for p, w in weights.items() if len(p) == k and round(w * UNIT) <= 0]
            d = d.withColumn("room", F.when(node("leaf", k).isin([F.array(*[F.lit(x) for x in p]) for p in none]), 0).otherwise(F.col("room")).cast("long"))
    d = materialize(d)
    whole = d.agg(F.coalesce(F.sum("room"), F.lit(0))).first()[0]
    amounts = None
    for k in range(1, depth + 1):
        nodes = _weighted(d.groupBy(node("leaf", k).alias("path")).agg(F.sum("room").alias("room")), weights, k).withColumn("family", node("path", k - 1))
        if amounts is None:
            nodes = nodes.withColumn("amount", F.lit(min(total, whole)).cast("long"))
        else:
            nodes = nodes.join(amounts.withColumnRenamed("path", "family"), "family")
        amounts = materialize(_fill(nodes))
    return d.select("leaf", "leaf_tokens").join(amounts.withColumnRenamed("path", "leaf"), "leaf", "left").select("leaf", "leaf_tokens", F.coalesce("amount", F.lit(0)).cast("long").alias("leaf_budget"))


def mix_sources(docs: DataFrame, tree: Sequence[str | Column] = TREE, weights: Mapping[tuple, float] | None = None, total_share: float = 1.0, total_tokens: int | None = None, max_epochs: int = 2, seed: int = SEED, text: str = "text", doc_id: str = "doc_id", uid: str | None = None, driver_leaves: int = DRIVER_LEAVES) -> DataFrame:
    """Rows doc_id, uid, leaf, epoch, tokens, tokens_used, leaf_tokens, leaf_budget. ``uid``: a column that numbers the rows, if there is one. The budget is ``total_tokens``, or ``total_share`` of the table's tokens."""
    spark, weights = docs.sparkSession, weights or {}
    path = F.array(*[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in tree])
    number = F.monotonically_increasing_id() if uid is None else F.col(uid)
    rows = materialize(docs.select(F.col(doc_id).cast("long").alias("doc_id"), path.alias("leaf"), token_count(F.col(text)).alias("tokens"), number.alias("uid")))
    leaves = rows.groupBy("leaf").agg(F.sum("tokens").alias("leaf_tokens"))
    n, tokens = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    total = total_tokens if total_tokens is not None else int(total_share * tokens)
    found = leaves.limit(driver_leaves + 1).collect()
    if len(found) <= driver_leaves:
        supply = {tuple(r["leaf"]): r["leaf_tokens"] for r in found}
        plan = [(list(k), supply[k], b) for k, b in sorted(budgets(supply, weights, total, max_epochs).items())]
        schema = T.StructType([T.StructField("leaf", T.ArrayType(T.StringType())), T.StructField("leaf_tokens", T.LongType()), T.StructField("leaf_budget", T.LongType())])
        table = F.broadcast(spark.createDataFrame(plan, schema))  # DRIVER_LEAVES rows at most
    else:
        table = budget_table(leaves, weights, total, max_epochs, len(tree))
    times = lambda op: F.when(F.col("leaf_tokens") > 0, F.expr(f"leaf_budget {op} leaf_tokens")).otherwise(0).cast("long")
    rows = rows.join(table.withColumns({"whole": times("div"), "rest": times("%")}), "leaf")
    order = F.concat_ws("|", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row"), F.col("uid").cast("string"))))
    bits = bits_for(n, PER_BUCKET)
    rows = rows.withColumn("u", hash60(order)).withColumn("bucket", F.shiftright("u", 60 - bits))
    cut = prefix_sums(rows, "tokens", "bucket", ["u", "doc_id", "uid"], ["leaf"], fine_count=1 << bits)
    epochs = F.when(F.col("before") < F.col("rest"), F.col("whole") + 1).otherwise(F.col("whole"))
    out = cut.withColumn("epochs", epochs).where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    used = F.when(F.col("epoch") < F.col("whole"), F.col("tokens")).otherwise(F.least("tokens", F.col("rest") - F.col("before")))
    return out.select("doc_id", "uid", F.array_join("leaf", "/").alias("leaf"), F.col("epoch").cast("int").alias("epoch"), "tokens", used.alias("tokens_used"), "leaf_tokens", "leaf_budget")
