"""Merkle manifest of a dataset, and what a tampered copy folds to.

Every document is a leaf; leaves of a language, and then the languages' roots, are hashed in runs of ``FAN`` until one node
is left.  The built levels are stored as node rows that name their parent, and a recursive query ascends them: each of its
rows stands for one run of leaves, appends the siblings met on the way, and folds the leaves' possibly tampered hashes.
The siblings above a run are those of all its leaves, so they are carried once for a run and not once for a leaf.

Digests are kept as 32 bytes and hashed as hex text.  Defined results: a null value is hashed as ``-``; a null doc_id comes first
in its language and is never tampered with; null is a language of its own, the first one; of rows that share a doc_id the
smaller leaf comes first (equal rows are interchangeable); an empty table gives no rows; further columns play no part.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.llm.ordered import numbered
from amperline.llm.store import written

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MOD = 3
# At most so many runs of leaves meet in one copy of a node while they ascend.
RUNS_PER_COPY = 4096
DIGEST = 32
NO_BYTES = "X''"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(digests: str) -> str:
    return f"lower(hex({digests}))"


def _left(of: str, place: str) -> str:
    return f"substring({of}, 1, {DIGEST} * {place})"


def _right(of: str, place: str) -> str:
    return f"substring({of}, {DIGEST} * {place} + {DIGEST + 1})"


def _folded(of: str, place: str, digest: str) -> str:
    """SQL of a run's hash with ``digest`` at ``place``."""
    return f"unhex(sha2(concat({_hex(_left(of, place))}, {_hex(digest)}, {_hex(_right(of, place))}), 256))"


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, lang, doc_id, leaf, shown``: ``shown`` is the hash of the document as a verifier gets it."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MOD == 0
    own = [_field(F.col(c)) for c in FIELDS]
    leaf = _hash(F.concat(*own))
    changed = _hash(F.concat(*own[:-1], _field(lowered)))
    return docs.select(
        _field(F.col("lang")).alias("tree"),
        "lang",
        "doc_id",
        leaf.alias("leaf"),
        F.when(hit, changed).alias("changed"),
        F.monotonically_increasing_id().alias("tie"),
    )


def _grouped(nodes: DataFrame, *more: Column) -> DataFrame:
    """One level up: the runs of ``nodes(tree, lang, n, total, digest, leaves)`` of trees that have several nodes."""
    members = F.array_sort(F.collect_list(F.struct("n", "digest")))
    runs = (
        nodes.where("total > 1")
        .groupBy("tree", "lang", F.expr(f"n DIV {FAN}").alias("n"), F.expr(f"(total + {FAN - 1}) DIV {FAN}").alias("total"))
        .agg(members.alias("members"), F.sum("leaves").alias("leaves"), *more)
    )
    children = F.expr(f"aggregate(members, {NO_BYTES}, (all, m) -> concat(all, m.digest))")
    return runs.withColumn("children", children).withColumn("digest", F.expr(f"unhex(sha2({_hex('children')}, 256))")).drop("members")


def _levels(bottom: DataFrame, tops: list[DataFrame]) -> list[DataFrame]:
    """All levels above ``bottom``, each stored; the top nodes of trees are added to ``tops``."""
    most = bottom.agg(F.max("total")).first()[0] or 0
    height = math.ceil(round(math.log(max(most, 1), FAN), 9))
    found, nodes = [], bottom
    for level in range(1, height + 1):
        nodes = written(_grouped(nodes).withColumn("level", F.lit(level)), "level")
        tops.append(nodes.where("total = 1"))
        found.append(nodes)
    return found


def _id(tree: str, level: str, n: str) -> Column:
    return F.concat_ws("/", F.expr(tree), F.expr(f"string({level})"), F.expr(f"string({n})"))


def built(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, runs)``, both stored.

    ``nodes``: ``id, parent, place, children, digest, leaves, is_subroot`` of each inner node.  ``runs``: ``id, members``, the
    leaves below each node of the lowest level; a language with one leaf has no such node, and its run is the leaf itself.
    """
    rows = numbered(written(leaves(docs), "leaves"), ("lang", "doc_id", "leaf", "tie"), "lang").drop("tie")
    rows = written(rows.withColumns({"digest": F.col("leaf"), "leaves": F.lit(1).cast("long")}), "numbered")
    lone = rows.where("total = 1")
    tops = [lone]
    inner = _levels(rows, tops)
    subroots = reduce(DataFrame.unionByName, [t.select("tree", "lang", "digest", "leaves") for t in tops])
    placed = written(numbered(written(subroots, "subroots"), ("lang", "digest")), "placed")
    above = [t.withColumn("tree", F.lit("")) for t in _levels(placed.withColumn("tree", F.lit("")).withColumn("lang", F.lit(None).cast("string")), [])]
    up = placed.select(
        F.col("tree").alias("its_tree"),
        F.when(F.col("total") > 1, _id("''", "1", f"n DIV {FAN}")).alias("up"),
        (F.col("n") % FAN).cast("int").alias("up_place"),
    )
    key = ["tree", "level", "n", "total", "children", "digest", "leaves"]
    empty = rows.limit(0).select("tree", F.lit(0).alias("level"), "n", "total", F.lit(None).cast("binary").alias("children"), "digest", "leaves")
    own = reduce(DataFrame.unionByName, [t.select(*key) for t in inner], empty)
    top = own.where("total = 1").join(up, F.col("tree") == F.col("its_tree")).withColumn("is_subroot", F.lit(True))
    middle = [own.where("total > 1"), *[t.select(*key) for t in above]]
    rest = reduce(DataFrame.unionByName, middle).withColumns({
        "up": F.when(F.col("total") > 1, _id("tree", "level + 1", f"n DIV {FAN}")),
        "up_place": (F.col("n") % FAN).cast("int"),
        "is_subroot": F.lit(False),
    })
    nodes = top.drop("its_tree").unionByName(rest)
    nodes = nodes.select(_id("tree", "level", "n").alias("id"), F.col("up").alias("parent"), F.col("up_place").alias("place"), "children", "digest", "leaves", "is_subroot")
    member = F.struct("n", "doc_id", "leaf", F.coalesce("changed", "leaf").alias("shown"))
    runs = rows.where("total > 1").groupBy(_id("tree", "1", f"n DIV {FAN}").alias("id")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    single = lone.select(_id("tree", "0", "n").alias("id"), F.array(member).alias("members"))
    nodes = nodes.unionByName(
        lone.join(up, F.col("tree") == F.col("its_tree")).select(
            _id("tree", "0", "n").alias("id"), F.col("up").alias("parent"), F.col("up_place").alias("place"),
            F.col("leaf").alias("children"), F.col("leaf").alias("digest"), F.col("leaves"), F.lit(True).alias("is_subroot"),
        )
    )
    return written(nodes, "nodes"), written(runs.unionByName(single), "runs")


# A node's rows are copied by the number of runs below it, so that no key of the join has more than ``RUNS_PER_COPY`` of them.
CLIMB = f"""
WITH RECURSIVE climb (run, parent, copy, place, siblings, shown, digest, subroot) AS (
  SELECT run, parent, copy, place, {NO_BYTES}, shown, digest, subroot FROM {{starts}}
  UNION ALL
  SELECT c.run, n.parent, pmod(xxhash64(c.run), n.parent_copies), n.place,
         concat(c.siblings, {_left("n.children", "c.place")}, {_right("n.children", "c.place")}),
         transform(c.shown, s -> {_folded("n.children", "c.place", "s")}),
         n.digest, coalesce(c.subroot, CASE WHEN n.is_subroot THEN n.digest END)
  FROM climb c JOIN {{steps}} n ON n.id = c.parent AND n.copy = c.copy)
SELECT run, siblings, shown, digest AS root, subroot FROM climb WHERE parent IS NULL"""


def climbed(nodes: DataFrame, runs: DataFrame) -> DataFrame:
    """Per run of leaves: the siblings of its node up to the root, the root each leaf folds to, root and subroot; stored."""
    spark = nodes.sparkSession
    copies = nodes.select(F.col("id").alias("its_id"), F.expr(f"leaves DIV {FAN * RUNS_PER_COPY} + 1").alias("parent_copies"))
    linked = nodes.join(copies, F.col("parent") == F.col("its_id"), "left").drop("its_id")
    linked = written(linked.withColumn("parent_copies", F.coalesce("parent_copies", F.lit(1).cast("long"))), "linked")
    steps = linked.withColumn("copy", F.explode(F.expr(f"sequence(0, leaves DIV {FAN * RUNS_PER_COPY})")))
    # A lone leaf is its own run, and no hash is taken of it.
    first = f"transform(members, (m, i) -> IF(is_leaf, m.shown, {_folded('children', 'i', 'm.shown')}))"
    starts = (
        runs.join(linked, "id")
        .withColumn("is_leaf", F.expr("size(members) = 1 AND digest = members[0].leaf"))
        .select(
            F.col("id").alias("run"), "parent", F.expr("pmod(xxhash64(id), parent_copies)").alias("copy"), "place",
            F.expr(first).alias("shown"), "digest", F.expr("CASE WHEN is_subroot THEN digest END").alias("subroot"),
        )
    )
    before = spark.conf.get(ROW_LIMIT)
    # The rows of the recursion grow with the documents, so its guard against endless growth is the number of levels alone.
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return written(spark.sql(CLIMB, starts=written(starts, "starts"), steps=written(steps, "steps")), "climbed")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def audited(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    nodes, runs = built(docs)
    done = climbed(nodes, runs).join(runs.withColumnRenamed("id", "run"), "run")
    # Of a run of one, "the others" are no bytes.
    leaves_of = F.expr(f"aggregate(members, {NO_BYTES}, (all, m) -> concat(all, m.leaf))")
    each = done.withColumn("all", leaves_of).select("*", F.posexplode("members").alias("at", "member"))
    others = f"concat({_hex(_left('all', 'at'))}, {_hex(_right('all', 'at'))}, {_hex('siblings')})"
    text = lambda c: F.expr(_hex(c))
    return each.select(
        "member.doc_id",
        text("member.leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        F.expr(f"sha2({others}, 256)").alias("proof_sha256"),
        text("shown[at]").alias("folded_root"),
        (F.expr("shown[at]") == F.col("root")).alias("verified"),
    )
