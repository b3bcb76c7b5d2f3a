"""Merkle manifest of a document table: a digest for every document, one root, and a proof per document.

``H`` is the lowercase hex SHA-256 of its inputs' concatenation. A leaf is ``H`` of the fields in ``FIELDS``, each as UTF-8 byte
count, colon and value, or ``-`` if null. The leaves of a source ascend by doc_id (nulls first); every ``ARITY`` consecutive nodes (the
last run may hold fewer, even one) become their ``H`` until one node remains, and the nodes of all sources, ordered by
source (null first, bytewise), become one root in the same way.

*Places.* Each leaf gets its place in its source from ranges and sums over ranges (``numbered``), so that a source of any size is
spread. ``LEVELS`` levels at a time, blocks of ``ARITY ** LEVELS`` consecutive places are one window partition: runs never cross
blocks, and blocks have a bounded size. The block tops are the leaves of the next turn.

*Levels.* A node of level ``l`` stands on the row of its first leaf, so its siblings are found by lag and lead at the fixed offsets
``ARITY ** l`` and ``2 * ARITY ** l``, masked by the node's slot in its run and the run's length. The first row of a run
hashes the parent. On the way down the same offsets hand the proof of a parent to its children.

A proof is a list of ``(before, after)``: what stands left and right of the node in its run, one entry per level.

Null and repeated doc_ids and repeated rows are leaves like any other; rows that are equal in all fields have equal leaves and may
swap places. An empty table has no rows and no root. Texts of any length are hashed whole; columns with clashing names don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigram.operators.ranking import numbered
from lexigram.session import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
LEVELS = 6
BLOCK = ARITY**LEVELS


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(values: dict[str, Column]) -> Column:
    """The leaf of one row; ``values`` by field."""
    texts = [values[f].cast("string") for f in FIELDS]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _entry(before: Column, after: Column) -> Column:
    return F.struct(before.alias("before"), after.alias("after"))


def _nodes_at(level: int) -> Column:
    """Nodes of the row's tree at this level of the turn."""
    return F.ceil(F.col("size") / ARITY**level)


def _siblings(level: int) -> tuple[Column, Column]:
    """Left and right siblings of a node of this level on its own row, as concatenated digests."""
    row = Window.partitionBy("tree", "block").orderBy("place")
    step, node = ARITY**level, F.col(f"d{level}")
    slot = F.pmod(F.floor((F.col("place") - 1) / step), F.lit(ARITY))
    length = F.least(F.lit(ARITY), _nodes_at(level) - (F.floor((F.col("place") - 1) / step) - slot))
    left = [F.when(slot >= i, F.lag(node, i * step).over(row)) for i in range(ARITY - 1, 0, -1)]
    right = [F.when(slot + i < length, F.lead(node, i * step).over(row)) for i in range(1, ARITY)]
    return (F.concat(*[F.coalesce(x, F.lit("")) for x in side]) for side in (left, right))


def _up(leaves: DataFrame) -> DataFrame:
    """Add ``d1 .. d<LEVELS>`` and the siblings ``s0 ..`` of each node, on the rows where the nodes stand."""
    rows = leaves.withColumn("block", F.floor((F.col("place") - 1) / BLOCK)).withColumnRenamed("node", "d0")
    for level in range(LEVELS):
        before, after = _siblings(level)
        rows = rows.withColumns({"__b": before, "__a": after})
        stands = F.col(f"d{level}").isNotNull()
        many = _nodes_at(level) > 1
        first = F.pmod(F.col("place") - 1, F.lit(ARITY ** (level + 1))) == 0
        parent = F.when(first, F.when(many, digest(F.col(f"d{level}"), F.col("__a"))).otherwise(F.col(f"d{level}")))
        rows = rows.withColumns({
            f"s{level}": F.when(stands & many, _entry(F.col("__b"), F.col("__a"))), f"d{level + 1}": parent
        }).drop("__b", "__a")
    return rows


def _down(rows: DataFrame) -> DataFrame:
    """From the proof ``above`` of each block's top to the proof of every leaf."""
    row = Window.partitionBy("tree", "block").orderBy("place")
    for level in range(LEVELS - 1, -1, -1):
        step = ARITY**level
        slot = F.pmod(F.floor((F.col("place") - 1) / step), F.lit(ARITY))
        parents = [F.when(slot == i, F.lag("above", i * step).over(row) if i else F.col("above")) for i in range(ARITY)]
        rows = rows.withColumn("__p", F.coalesce(*parents))
        own = F.when(F.col(f"s{level}").isNull(), F.array().cast("array<struct<before:string,after:string>>")).otherwise(
            F.array(f"s{level}")
        )
        stands = F.pmod(F.col("place") - 1, F.lit(step)) == 0
        rows = rows.withColumn("above", F.when(stands, F.concat(own, F.col("__p")))).drop("__p")
    return rows


def trees(leaves: DataFrame) -> DataFrame:
    """``(tree, place, node, root, proof)`` of the leaves ``(tree, place, size, node)``: places from 1 and the size of each tree."""
    turns = [stored(_up(leaves), "merkle")]
    top = F.col("place") % BLOCK == 1
    while (turns[-1].agg(F.max("size").alias("n")).first()["n"] or 0) > BLOCK:
        tops = turns[-1].where(top).select(
            "tree", (F.col("block") + 1).alias("place"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col(f"d{LEVELS}").alias("node")
        )
        turns.append(stored(_up(tops), "merkle"))
    above = turns[-1].where(top).select(
        "tree", F.col("block").alias("of"), F.col(f"d{LEVELS}").alias("root"),
        F.array().cast("array<struct<before:string,after:string>>").alias("above"),
    )
    for turn in reversed(turns):
        up = above.withColumnRenamed("tree", "of_tree")
        here = turn.join(up, turn["tree"].eqNullSafe(up["of_tree"]) & (turn["block"] == up["of"]))
        first = here.withColumn("above", F.when(top, F.col("above")))
        done = _down(first).select("tree", "place", F.col("d0").alias("node"), "root", F.col("above").alias("proof"))
        above = done.select("tree", (F.col("place") - 1).alias("of"), "root", F.col("proof").alias("above"))
    return done


def fold(node: Column, proof: Column) -> Column:
    """The root that a node and its proof lead to."""
    return F.aggregate(proof, node, lambda at, level: digest(level["before"], at, level["after"]))


def manifest(docs: DataFrame, **others: Column) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof)`` per row of ``docs``, and the named columns computed from each row."""
    rows = docs.select(
        "doc_id", F.col("source").alias("tree"), leaf({f: F.col(f) for f in FIELDS}).alias("node"),
        *[c.alias(name) for name, c in others.items()], F.monotonically_increasing_id().alias("__row"),
    )
    placed = stored(numbered(rows, ["tree"], ["doc_id", "node", "__row"], "place", "size").drop("__row"), "leaves")
    within = trees(placed.select("tree", "place", "size", "node"))
    sources = within.where("place = 1").select(F.lit(0).alias("all"), F.col("tree").alias("source"), F.col("root").alias("node"))
    ranked = numbered(sources, ["all"], ["source"], "place", "size")
    over = trees(stored(ranked.withColumnRenamed("all", "tree"), "subroots"))
    whole = stored(
        ranked.join(over.drop("node"), "place").select("source", F.col("root"), F.col("proof").alias("upper")), "roots"
    )
    met = within.withColumnsRenamed({"tree": "source", "root": "subroot"}).drop("node")
    met = met.join(whole.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    on = placed["tree"].eqNullSafe(met["source"]) & (placed["place"] == met["place"])
    return placed.join(met, on).select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", F.concat("proof", "upper").alias("proof"), *others
    )


def report(docs: DataFrame) -> DataFrame:
    """The manifest with every proof's hash, and a check of rows some of whose texts lost their line ends."""
    tampered = leaf({f: F.col(f) for f in FIELDS} | {"text": F.translate("text", "\n", "")})
    drawn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    rows = manifest(docs, other=F.when(drawn, tampered))
    proof = F.concat_ws("", F.flatten(F.transform("proof", lambda x: F.array(x["before"], x["after"]))))
    rows = rows.withColumn("folded_root", fold(F.coalesce("other", "leaf"), F.col("proof")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
