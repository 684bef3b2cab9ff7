"""MinHash near-dedup: SuperMinHash signatures, banding, verification, union-find grouping.

A document's set holds the 64-bit hashes of its distinct five-word shingles. Documents with equal
sets are one class, named by its smallest id; only classes are compared. SuperMinHash gives each
element one rank per step of a random permutation, so a signature has less variance than one of
independent hashes, and it stops as soon as no later rank can lower a slot: after one step for long
texts. The signatures are cut into bands, and classes that share a band are candidates.

Candidates are not expanded into pairs, and what many texts share by chance does not tie unrelated
ones together. First each class is verified against the smallest class of each of its bands, which is
linear in the classes; connected components of the confirmed links are groups. What is left are
bands of three classes or more that hold several groups. Only these are verified within, bands of
equal members once: a band is dealt in blocks of a bounded number of shingles, each pair of blocks is
verified in one task on the full sets, and what leaves a task is a spanning forest of the confirmed
links, found with union-find. Large bands are dealt by size of the sets first, as sets that are
linked have sizes of a bounded ratio. Connected components of all links are the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.graph import UnionFind, connected_components

from .common import map_texts, materialize, unused

from .superminhash import Shingles, bands, signature

#: Shingles that a block holds, about; two blocks meet in a task.
BLOCK_SHINGLES = 400_000
#: The same for those that are held against the smallest set of their band alone.
LEADER_SHINGLES = 50_000
#: A class counts as large with one part in so many of all rows.
FREQUENT_CLASSES = 1000


def _signature_rows():
    shingles = Shingles()

    def row(doc, text):
        s = shingles(text)
        if not len(s):
            yield doc, 0, None, None, None
            return
        h = xxhash.xxh3_128_intdigest(s.tobytes())
        k1, k2 = np.array([h >> 64, h & (1 << 64) - 1], np.uint64).view(np.int64).tolist()
        yield doc, len(s), k1, k2, bands(signature(s))

    return row


def _set_rows():
    shingles = Shingles()

    def row(doc, text, group, roles):
        s = shingles(text)
        if len(s):
            yield doc, group, roles, len(s), s.tobytes()

    return row


def leader_links(nodes: list, sets: list, leader: int, percent: int) -> list:
    """(node, leader) of the nodes whose sets are ``percent`` similar to a set of the leader's."""
    found = []
    for own in (s for n, s in zip(nodes, sets) if n == leader):
        for node, other in zip(nodes, sets):
            if node == leader or not len(other):
                continue
            at = np.searchsorted(own, other)
            both = int((own[np.minimum(at, len(own) - 1)] == other).sum())
            if 100 * both >= percent * (len(own) + len(other) - both):
                found.append((node, leader))
    return found


def spanning_links(nodes: list, known: list, sides: list, sets: list, percent: int) -> list:
    """A spanning forest of the links of ``percent`` similarity among sets, on top of the ``known`` groups.

    ``sides`` are the blocks of the sets: if there are two, only sets of different ones are
    compared. The first node's group is followed: its members are compared with nothing again, as
    every node outside of it is compared with all.
    """
    n, found, groups = len(nodes), [], UnionFind()
    first_of: dict = {}
    for i, g in enumerate(known):
        groups.union(first_of.setdefault(g, i), i)
    across = len(set(sides)) > 1
    side = np.array(sides)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, holders = flat[order], owner[order]
    first = np.concatenate([[True], flat[1:] != flat[:-1]])
    element = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    often = np.diff(np.concatenate([start, [len(flat)]]))
    shared = np.flatnonzero(often[element] > 1)
    by_owner = shared[np.argsort(holders[shared], kind="stable")]
    bounds = np.searchsorted(holders[by_owner], np.arange(n + 1))
    for x in range(n):
        if x and groups.find(x) == groups.find(0):
            continue
        mine = element[by_owner[bounds[x] : bounds[x + 1]]]
        if 100 * len(mine) < percent * sizes[x]:
            continue  # too few of its shingles are in any other set
        lengths = often[mine]
        at = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        both = np.bincount(holders[at], minlength=n)
        hit = 100 * both >= percent * (sizes[x] + sizes - both)
        hit[x] = False
        if across:
            hit &= side != side[x]
        for y in np.flatnonzero(hit).tolist():
            if groups.union(x, y):
                found.append((nodes[x], nodes[y]))
    return found


def _grouped(keys: int, close):
    """Stream rows sorted by their first ``keys`` columns; ``close(key, rows)`` gives a key's links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        key, rows, out = None, [], []

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.int64()) for i in (0, 1)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if row[:keys] != key:
                    if len(rows) > 1:
                        out.extend(close(key, rows))
                    key, rows = row[:keys], []
                rows.append(row[keys:])
            if len(out) > 4096:
                yield flush()
        if len(rows) > 1:
            out.extend(close(key, rows))
        yield flush()

    return run


def _set(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def _verified(rows: DataFrame, roles: DataFrame, keys: tuple, columns: tuple, close) -> DataFrame:
    """Links (a, b): each node of ``roles`` (node, group, roles: an array of structs) goes with its set to each of its roles."""
    kind = roles.schema["roles"].dataType.simpleString()
    texts = rows.join(roles.withColumnRenamed("node", "doc"), "doc")
    sets = map_texts(texts, "doc", "text", f"node long, grp long, roles {kind}, n int, shingles binary", _set_rows, ("group", "roles"))
    dealt = sets.select("node", "grp", F.inline("roles"), "shingles").select(*keys, *columns)
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(_grouped(len(keys), close), "a long, b long")


def _leader_links(rows: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of nodes to the smallest node of their bands; ``pairs`` are (node, n, leader).

    A leader of very many nodes is verified in parts of a bounded number of shingles.
    """
    parts = pairs.groupBy("leader").agg(F.ceil(F.sum("n") / LEADER_SHINGLES).cast("int").alias("parts"))
    role = lambda leader, part: F.struct(leader.alias("leader"), part.alias("part"))
    members = pairs.join(parts, "leader").select("node", role(F.col("leader"), F.pmod(F.xxhash64("node"), "parts").cast("int")).alias("role"))
    own = parts.select(F.col("leader").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    own = own.select("node", role(F.col("node"), F.col("part")).alias("role"))
    roles = members.unionByName(own).groupBy("node").agg(F.collect_list("role").alias("roles")).select("node", F.lit(0).cast("long").alias("group"), "roles")

    def close(key, found):
        return leader_links([node for node, _ in found], [_set(raw) for _, raw in found], key[0], percent)

    return _verified(rows, roles, ("leader", "part"), ("node", "shingles"), close)


def _band_links(rows: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links within bands; ``members`` are (band, node, n, group).

    A band of several blocks is dealt by size first: a set meets those of its own and of the next
    class of sizes, and sets further apart are not similar enough whatever they share.
    """
    # Sums are made where the rows lie and joined back, so that the rows of a band need not meet in one task.
    with_blocks = lambda rows, name, by: rows.join(rows.groupBy(*by).agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias(name)), by)
    size = F.floor(F.ln(F.col("n").cast("double")) / (math.log(100 / percent) * 1.0001 if percent < 100 else 1e-9)).cast("long")
    sized = with_blocks(members, "whole", ["band"]).withColumn("size", F.explode(F.when(F.col("whole") > 1, F.array(size, size + 1)).otherwise(F.array(F.lit(-1).cast("long")))))
    placed = with_blocks(sized, "blocks", ["band", "size"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    # Two blocks meet once; within a block, its sets are compared where it meets itself.
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    role = F.struct("band", "size", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block")
    roles = dealt.groupBy("node", "group").agg(F.collect_list(role).alias("roles"))

    def close(key, found):
        nodes, known, sides, raws = zip(*found)
        return spanning_links(nodes, known, sides, [_set(raw) for raw in raws], percent)

    return _verified(rows, roles, ("band", "size", "low", "high"), ("node", "grp", "block", "shingles"), close)


def _with_class(signed: DataFrame) -> DataFrame:
    """(doc, n_shingles, node, bands): the class of each document that has one; bands stay with its namesake.

    A class with one part in FREQUENT_CLASSES of all rows or more would meet in one task, so those,
    at most FREQUENT_CLASSES, are broadcast and their rows spread by id, like rows without a class.
    """
    members = signed.where("doc is not null and n_shingles > 0")
    classes = members.groupBy("k1", "k2").agg(F.min("doc").alias("node"), F.count("*").alias("rows"))
    large = classes.where(F.col("rows") * FREQUENT_CLASSES >= signed.count()).select("k1", "k2", F.col("node").alias("large"))
    spread = signed.join(F.broadcast(large), ["k1", "k2"], "left")
    spread = spread.withColumn("j1", F.when(F.col("large").isNull() & F.col("k1").isNotNull(), F.col("k1")).otherwise(F.xxhash64("doc"))).withColumn("j2", F.when(F.col("large").isNull(), F.col("k2")))
    small = classes.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), "node")
    met = spread.join(small, ["j1", "j2"], "left")
    node = F.when(F.col("doc").isNotNull(), F.coalesce("large", "node"))
    return met.select("doc", "n_shingles", node.alias("node"), F.col("large").isNotNull().alias("wide"), F.when(F.col("doc") == node, F.col("bands")).alias("bands"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """(doc, n_shingles, component, kept) for each row of ``docs``.

    Documents are linked if 100 * common shingles >= ``percent`` * shingles of either; component is
    the smallest id that links reach, ``kept`` whether it is the document's own. A text of fewer
    than five words is one shingle. Null, empty and blank texts have no shingles and are linked
    with nothing, and so are rows with a null id (component null, kept). Rows with equal ids are one
    document, linked with what any of their texts is. Ids are whole numbers. Texts of any length are
    read whole. Other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    signed = materialize(map_texts(rows, "doc", "text", "doc long, n_shingles long, k1 long, k2 long, bands array<long>", _signature_rows))
    named = materialize(_with_class(signed))

    banded = named.where("bands is not null").select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    # What is said of a band: its smallest node, how many it has, and two hashes of its members.
    mark = lambda k: F.xxhash64("node", F.lit(k))
    shared = banded.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("members"), F.bit_xor(mark(1)).alias("m1"), F.bit_xor(mark(2)).alias("m2")).where("members > 1")
    met = materialize(banded.join(shared, "band"))
    pairs = met.where("node != leader").select("node", "n", "leader").distinct()
    confirmed = connected_components(_leader_links(rows, pairs, percent), contract=False)

    many = met.where("members > 2").join(confirmed, "node", "left").select("band", "node", "n", "members", "m1", "m2", F.coalesce("component", "node").alias("group"))
    mixed = many.groupBy("members", "m1", "m2", "band").agg(F.min("group").alias("g1"), F.max("group").alias("g2")).where("g1 != g2")
    mixed = mixed.groupBy("members", "m1", "m2").agg(F.min("band").alias("band")).select("band")
    links = _band_links(rows, many.select("band", "node", "n", "group").join(mixed, "band"), percent)
    links = links.unionByName(confirmed.select(F.col("node").alias("a"), F.col("component").alias("b")))

    # Texts that share an id are one document, whatever their classes.
    first = F.min("node").over(Window.partitionBy("doc"))
    shared_ids = named.where("node is not null").select("doc", "node").withColumn("first", first).where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    groups = connected_components(links.unionByName(shared_ids), contract=False)

    # Rows without a class have nothing to meet; their ids spread them. Those of large classes, at
    # most FREQUENT_CLASSES, take their groups from a broadcast and are spread too.
    wide = named.where("wide").select("node").distinct().join(groups, "node").select(F.col("node").alias("key"), F.col("component").alias("wide_component"))
    keyed = named.withColumn("key", F.coalesce("node", "doc")).join(F.broadcast(wide), "key", "left")
    keyed = keyed.withColumn("j1", F.when(F.col("wide"), F.xxhash64("doc")).otherwise(F.col("key"))).withColumn("j2", F.when(~F.col("wide"), 0))
    found = keyed.join(groups.select(F.col("node").alias("j1"), F.lit(0).alias("j2"), "component"), ["j1", "j2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("wide_component", "component", "node", "doc")).otherwise(F.col("doc"))
    return found.select("doc", "n_shingles", component.alias("component"), F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``docs`` with one document of each group, that of the smallest id. Rows with null ids stay."""
    (name,) = unused(docs, "gone")
    gone = near_duplicates(docs, id_col, text_col, percent).where("not kept").select(F.col("doc").alias(name)).distinct()
    return docs.join(gone, docs[id_col] == gone[name], "left_anti")
