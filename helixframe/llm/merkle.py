"""Merkle manifest of a data set, with proofs, in an external-memory node store.

A leaf is the hash of a row. Within each group (a language) leaves are put in order by ranges and
numbered, and dealt into runs of RUN consecutive leaves. A run streams through its task in order: as
soon as two nodes of a level are there, their parent is made, so a task holds one open node a level.
All nodes go to the store, Parquet in one folder a level; where a run is not the whole group, its root
is a leaf of the next pass, which reads the level before in the same way, RUN times smaller. So a
hundred billion rows take four passes. The groups' roots are the leaves of one more tree.

A node is named by its coordinates: group, level, number. A proof needs the sibling of the leaf and of
each node above it. The sibling of node j of level k is needed first by leaf j << k and by 2^k leaves
on, so leaves and nodes, sorted by the first leaf that needs them, are merged in one scan that holds
one sibling a level. Siblings above the run are the same for all of its leaves and come as one row.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shared_dir, write_shared

#: Leaves of a run, as a power of two: its nodes are RUN_BITS levels high.
RUN_BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODE = "grp string, level int, pos long, digest string"
PROOF = "grp string, pos long, sides string, digests array<string>"
#: What a row of a proof scan is, in the order in which rows of one place are needed.
ABOVE, SIBLING, LEAF = 0, 1, 2


def row_hash(values: list[Column]) -> Column:
    """sha256 over each value's UTF-8 byte count, ``:`` and the value, ``-`` for null."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(v.cast("string")) for v in values]), 256)


def _hash(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def in_order(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``pos`` (0, 1, ... within its group, nulls first) and ``n`` (the group's rows).

    Rows are dealt in ranges of group and order, sorted and written with their places; the few counts
    of a range's groups give each its first number. Rows that tie in all of ``order`` are spread by a
    number of their own, so ranges stay even when a third of all rows are equal.
    """
    placed = materialize(rows.withColumn("__tie", F.monotonically_increasing_id()))
    keys = [group, *order, "__tie"]
    dealt = placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Spark gives each partition 2^33 numbers.
    at = F.monotonically_increasing_id()
    sorted_ = materialize(dealt.withColumn("__range", F.shiftright(at, 33)).withColumn("__at", at.bitwiseAND(F.lit((1 << 33) - 1))))
    counts = sorted_.groupBy(group, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    own = Window.partitionBy(group)
    before = F.coalesce(F.sum("__rows").over(own.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # At most a row for each range and one more for each group.
    firsts = counts.select(F.col(group).alias("__group"), F.col("__range").alias("__of"), (before - F.col("__first")).alias("__shift"), F.sum("__rows").over(own).alias("n"))
    met = sorted_.join(firsts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__range") == F.col("__of")))
    return met.withColumn("pos", (F.col("__at") + F.col("__shift")).cast("long")).withColumn("n", F.col("n").cast("long")).select(*rows.columns, "pos", "n")


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return max(0, n - 1).bit_length()


class _Run:
    """The open nodes of a run of a group of ``n`` leaves, whose levels end at ``top``."""

    def __init__(self, n: int, run_bits: int):
        self.top = min(height(n), run_bits)
        self.left: list[str | None] = [None] * self.top

    def add(self, pos: int, digest: str, level: int = 0):
        """The nodes (level, pos, digest) that one more node completes."""
        while level < self.top:
            if pos % 2 == 0:
                self.left[level] = (pos, digest)
                return
            digest = _hash(self.left[level][1], digest)
            self.left[level] = None
            level, pos = level + 1, pos // 2
            yield level, pos, digest

    def close(self):
        """The nodes above those that have no right neighbour."""
        for level in range(self.top):
            if self.left[level] is not None:
                pos, digest = self.left[level]
                digest = _hash(digest)
                yield level + 1, pos // 2, digest
                yield from self.add(pos // 2, digest, level + 1)


def _run_nodes(run_bits: int):
    """Of leaves (grp, pos, n, digest) in order: all nodes above them within their runs."""

    def run(batches):
        key, open_, out = None, None, []
        for batch in batches:
            for grp, pos, n, digest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (grp, pos >> run_bits) != key:
                    if open_ is not None:
                        out += [(key[0], *x) for x in open_.close()]
                    key, open_ = (grp, pos >> run_bits), _Run(n, run_bits)
                out += [(grp, *x) for x in open_.add(pos, digest)]
            if out:
                yield _nodes(out)
                out = []
        if open_ is not None and (out := [(key[0], *x) for x in open_.close()]):
            yield _nodes(out)

    return run


def _nodes(rows: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["grp", "level", "pos", "digest"])


def _streamed(rows: DataFrame, run_bits: int, *order: str) -> DataFrame:
    """Rows dealt by group and run, in order."""
    return rows.withColumn("__run", F.shiftright("pos", run_bits)).repartition("grp", "__run").sortWithinPartitions("grp", "__run", *order).drop("__run")


def build(leaves: DataFrame, store: str, run_bits: int = RUN_BITS) -> tuple[list[DataFrame], DataFrame]:
    """Write the nodes above ``leaves`` (grp, pos, n, digest) below ``store``; ([leaves of each pass], roots (grp, root)), roots being written.

    ``store/pass=P/level=K`` holds the nodes K levels above the leaves of pass P, which are K + P *
    run_bits above the first ones.
    """
    spark, passes, roots = leaves.sparkSession, [leaves.select("grp", "pos", "n", "digest")], []
    while True:
        level = passes[-1]
        path = f"{store}/pass={len(passes) - 1}"
        write_shared(_streamed(level, run_bits, "pos").mapInArrow(_run_nodes(run_bits), NODE), path, "level")
        nodes = spark.read.schema(NODE).parquet(path)
        small = F.col("n") <= (1 << run_bits)
        # The root of a group of one run: its highest node, a lone leaf itself.
        heights = level.where((F.col("pos") == 0) & small).select("grp", "n", F.col("digest").alias("leaf"))
        tops = nodes.where("pos = 0").groupBy("grp").agg(F.max_by("digest", "level").alias("top"))
        roots.append(heights.join(tops, "grp", "left").select("grp", F.coalesce("top", "leaf").alias("root")))
        more = level.where(~small & (F.col("pos") == 0)).select("grp", "n")
        rest = nodes.where(F.col("level") == run_bits).join(more, "grp")
        rest = materialize(rest.select("grp", "pos", F.ceil(F.col("n") / (1 << run_bits)).cast("long").alias("n"), "digest"))
        if rest.isEmpty():
            return passes, materialize(reduce(DataFrame.unionByName, roots))
        passes.append(rest)


def _merged(batches, run_bits: int):
    """Of rows (grp, pos, kind, level, n, digest, upper, ...): for each batch, it and (row, sides, digests, upper) of its leaves.

    Siblings are low to high. A side is L, R, or - where a node has no sibling and is hashed alone.
    """
    key, held, upper = None, {}, None
    for batch in batches:
        found = []
        for i, (grp, pos, kind, level, n, digest, above) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(7)))):
            if (grp, pos >> run_bits) != key:
                key, held, upper = (grp, pos >> run_bits), {}, None
            if kind == ABOVE:
                upper = above
            elif kind == SIBLING:
                held[level] = digest
            else:
                sides, digests = "", []
                for k in range(min(height(n), run_bits)):
                    if pos ^ 1 < n:
                        sides += "LR"[pos % 2 == 0]
                        digests.append(held[k])
                    else:
                        sides += "-"
                    pos, n = pos >> 1, (n + 1) >> 1
                found.append((i, sides + (upper["sides"] if upper else ""), digests + (upper["digests"] if upper else []), upper))
        yield batch, found


def _proofs(run_bits: int):
    def run(batches):
        for batch, found in _merged(batches, run_bits):
            if found:
                rows, sides, digests, _ = zip(*found)
                grp, pos = (batch.column(c).take(pa.array(rows)) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([grp, pos, pa.array(sides, pa.string()), pa.array(digests, pa.list_(pa.string()))], names=["grp", "pos", "sides", "digests"])

    return run


def proof_scan(leaves: DataFrame, nodes: DataFrame, uppers: DataFrame | None, run_bits: int = RUN_BITS) -> DataFrame:
    """Leaves (grp, pos, n, digest, more columns) of a pass with all that their proofs need, in the order of the merge.

    ``nodes`` are those of the pass. ``uppers`` (grp, pos, upper) has a row for a run, pos being the
    run's number, with what is common to its leaves; upper holds ``sides`` and ``digests`` at least.
    """
    below = nodes.where(F.col("level") < run_bits).select("grp", "level", "pos", "digest")
    siblings = leaves.select("grp", F.lit(0).alias("level"), "pos", "digest").unionByName(below)
    # A node stands before the first leaf that needs it: the first one below its sibling.
    first = F.call_function("shiftleft", F.col("pos").bitwiseXOR(F.lit(1).cast("long")), F.col("level"))
    rows = leaves.withColumns({"kind": F.lit(LEAF), "level": F.lit(0)}).unionByName(siblings.select("grp", first.alias("pos"), F.lit(SIBLING).alias("kind"), "level", "digest"), allowMissingColumns=True)
    if uppers is None:
        rows = rows.withColumn("upper", F.lit(None).cast("struct<sides:string,digests:array<string>>"))
    else:
        rows = rows.unionByName(uppers.select("grp", F.shiftleft("pos", run_bits).alias("pos"), F.lit(ABOVE).alias("kind"), F.lit(0).alias("level"), "upper"), allowMissingColumns=True)
    own = ["grp", "pos", "kind", "level", "n", "digest", "upper"]
    return _streamed(rows.select(*own, *[c for c in rows.columns if c not in own]), run_bits, "pos", "kind", "level")


def upper_proofs(passes: list[DataFrame], store: str, run_bits: int) -> DataFrame | None:
    """(grp, pos, sides, digests): proofs of the roots of the runs of the first pass; None if every group is one run."""
    spark, found = passes[0].sparkSession, None
    for i in range(len(passes) - 1, 0, -1):
        nodes = spark.read.schema(NODE).parquet(f"{store}/pass={i}")
        above = None if found is None else found.select("grp", "pos", F.struct("sides", "digests").alias("upper"))
        found = materialize(proof_scan(passes[i], nodes, above, run_bits).mapInArrow(_proofs(run_bits), PROOF))
    return found


def fold(leaf: str, sides: str, digests: list) -> str:
    """The root that a leaf and its proof give."""
    at, digest = 0, leaf
    for side in sides:
        if side == "-":
            digest = _hash(digest)
        else:
            digest = _hash(digests[at], digest) if side == "L" else _hash(digest, digests[at])
            at += 1
    return digest


def _verified(run_bits: int):
    """Of a proof scan whose leaves have ``doc`` and ``other``: (doc, grp, pos, leaf, subroot, root, proof_sha256, folded_root)."""

    def run(batches):
        for batch, found in _merged(batches, run_bits):
            if not found:
                continue
            rows, sides, digests, uppers = zip(*found)
            kept = batch.take(pa.array(rows))
            leaf, other = kept.column("digest"), kept.column("other")
            folded = [fold(y or x, s, d) for x, y, s, d in zip(leaf.to_pylist(), other.to_pylist(), sides, digests)]
            made = [pa.array(c, pa.string()) for c in ([u["subroot"] for u in uppers], [u["root"] for u in uppers], [_hash(*d) for d in digests], folded)]
            yield pa.RecordBatch.from_arrays([kept.column("doc"), kept.column("grp"), kept.column("pos"), leaf, *made], names=["doc", "grp", "pos", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return run


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple = FIELDS, tampered: dict | None = None, run_bits: int = RUN_BITS) -> DataFrame:
    """(doc, grp, pos, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of ``docs``.

    ``leaf`` hashes ``fields``; within each group leaves stand by id (nulls first), then by hash, and
    ``pos`` counts them from 0. ``subroot`` is the root of the group's tree, ``root`` that of the tree
    of subroots in order of their groups (null first). ``proof_sha256`` hashes the siblings from the
    leaf to the root; ``folded_root`` is what the proof makes of the row's leaf, where ``tampered``
    (column name to a Column) has replaced columns, and ``verified`` whether that is ``root``.

    Null and empty texts are values like others, and differ. Rows with equal ids, and rows that repeat,
    are leaves of their own; equal rows share what they return but for ``pos`` and the proof. A row of
    a null id or group is in the tree like others. Texts of any length are hashed whole. Other columns
    are ignored, whatever their names; a table without rows gives none.
    """
    spark = docs.sparkSession
    changed = {c: (tampered or {}).get(c, F.col(c)) for c in fields}
    same = F.lit(True)
    for c in (tampered or {}):
        same = same & changed[c].eqNullSafe(F.col(c))
    rows = docs.select(
        F.col(id_col).alias("doc"), F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")).alias("grp"),
        row_hash([F.col(c) for c in fields]).alias("leaf"), F.when(~same, row_hash([changed[c] for c in fields])).alias("other"),
    )
    leaves = materialize(in_order(rows, "grp", "doc", "leaf").withColumnRenamed("leaf", "digest"))
    store = f"{shared_dir(spark)}/helixframe-{uuid.uuid4().hex}"
    passes, roots = build(leaves, f"{store}/groups", run_bits)
    subroots = materialize(in_order(roots.select(F.lit("").alias("grp"), "root", F.col("grp").alias("name")), "grp", "name").withColumnRenamed("root", "digest"))
    top_passes, root = build(subroots, f"{store}/top", run_bits)
    # What is common to all leaves of a group: its root, the root, and the proof of its root.
    above = upper_proofs(top_passes, f"{store}/top", run_bits)
    above = None if above is None else above.select("grp", "pos", F.struct("sides", "digests").alias("upper"))
    top_nodes = spark.read.schema(NODE).parquet(f"{store}/top/pass=0")
    proved = proof_scan(subroots.select("grp", "pos", "n", "digest"), top_nodes, above, run_bits).mapInArrow(_proofs(run_bits), PROOF)
    common = subroots.join(proved, ["grp", "pos"]).join(root.withColumnRenamed("root", "whole"), "grp")
    common = materialize(common.select(F.col("name").alias("grp"), F.col("digest").alias("subroot"), F.col("whole").alias("root"), "sides", "digests"))
    lone = leaves.where((F.col("pos") == 0) & (F.col("n") <= (1 << run_bits))).select("grp", F.lit(0).cast("long").alias("pos"), F.lit("").alias("low"), F.array().cast("array<string>").alias("lows"))
    runs = upper_proofs(passes, f"{store}/groups", run_bits)
    runs = lone if runs is None else lone.unionByName(runs.select("grp", "pos", F.col("sides").alias("low"), F.col("digests").alias("lows")))
    upper = F.struct(F.concat("low", "sides").alias("sides"), F.concat("lows", "digests").alias("digests"), "subroot", "root")
    uppers = runs.join(common, "grp").select("grp", "pos", upper.alias("upper"))
    nodes = spark.read.schema(NODE).parquet(f"{store}/groups/pass=0")
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, grp string, pos long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    shown = proof_scan(leaves, nodes, uppers, run_bits).mapInArrow(_verified(run_bits), schema)
    group = F.when(F.col("grp") != "-", F.expr("substring(grp, 2)"))
    return shown.withColumn("grp", group).withColumn("verified", F.col("folded_root") == F.col("root"))
