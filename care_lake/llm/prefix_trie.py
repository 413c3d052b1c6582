"""Trie of the common beginnings of conversations, by halving depths.

A sequence of turns is cut at half its depth; the beginning up to the cut gets a name, made from the name of the
root above and the turns between. What lies above the cut (the upper trie) and below it (the lower forests, under the
names of the cut) no longer depend on each other and are cut again, side by side, until every depth has a name. Long
sequences are taken in chunks of 64 turns: the sequence of whole chunks is shorter by that factor and is named first, by
the same function, and its names are the roots of the chunks. So no sequence, however long, meets in one task.

Equal names are one node. The totals of subtrees go the other way: at each width of a cut, from 1 upwards, the total of
every lower forest is grafted on the nodes above its root within the upper trie, all at once. A trie of depth D takes
log2(D) rounds. Groups are limited everywhere: names are ranked by range-partitioned, sorted rows, so a turn with which a
third of all conversations begin spreads over as many partitions as its rows fill; the ancestors of a cut are met in
stretches of at most 4096 depths; only sums leave a group. The digest of the members that end at a node is read from
sorted rows as a stream.

Defined cases: rows without a conversation belong to none; null roles and texts are empty; turns with the same number
are ordered by a digest of role and text, repeated rows are turns each; a sequence without turns is a member of the root; an
empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_lake.llm.common import numbered
from care_lake.session import staged

CHUNK_BITS = 6
CHUNK = 1 << CHUNK_BITS
STRETCH_BITS = 12
ROOT = ""
DIGIT = 32  # characters of a name
SEGMENT = 1 << 16
NODE = ["depth", "conv_id"]


def ranked_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``seq, pos, symbol, weight, part``: turns in order, from 0, as digests; the weight is the UTF-8 bytes of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("seq"), F.col(turn_col).alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("symbol"),
        F.octet_length(text).cast("long").alias("weight"), F.monotonically_increasing_id().alias("row"))
    rows = staged(numbered(rows, "seq", "turn", "symbol", "row"), "turns")
    runs = rows.groupBy("part", "seq").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("seq").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("first", F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return rows.join(runs, ["part", "seq"]).select("seq", (F.col("at") - F.col("first")).alias("pos"), "symbol", "weight", "part")


def with_shared_openings(turns: DataFrame, group: Column, length: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Sequences that open as another one: turns (as ``ranked_turns``) and members (``seq``).

    The first ``length`` turns of a sequence are replaced by as many of the sequence ``group`` (all it has, if fewer; none, if
    there is no such sequence). Both are columns of ``seq``; ``length`` is at most ``longest``.
    """
    sizes = turns.groupBy("seq").agg(F.count("*").alias("n"))
    members = sizes.select("seq", group.alias("group"), length.cast("long").alias("length"))
    own = sizes.select(F.col("seq").alias("group"), F.col("n").alias("shared"))
    members = members.join(own, "group", "left").withColumn("shared", F.least("length", F.coalesce("shared", F.lit(0))))
    members = staged(members, "members")
    # the members meet the runs of their turns first, so the turns of a long sequence stay spread by partition
    runs = turns.select("part", "seq").distinct().join(members, "seq").select("part", "seq", "length", "shared")
    kept = turns.join(runs, ["part", "seq"]).where("pos >= length").withColumn("pos", F.expr("pos - length + shared"))
    heads = turns.where(F.col("pos") < longest).select(F.col("seq").alias("group"), "pos", "symbol", "weight")
    heads = heads.join(members.select("seq", "group", "length"), "group").where("pos < length")
    columns = ["seq", "pos", "symbol", "weight"]
    return kept.select(*columns).unionByName(heads.select(*columns)), members.select("seq")


def _name_of_cut(half: int):
    def name(root: Column, i: Column) -> Column:
        first = i * (2 * half)
        between = F.substring(F.col("symbols"), first * DIGIT + 1, F.lit(half * DIGIT))
        return F.when(first + half <= F.size("turns"), F.md5(F.concat(root, F.lit("/"), between)))

    return name


def named_prefixes(turns: DataFrame) -> DataFrame:
    """``seq, depth, name, weight`` for the beginning of every depth from 1; equal beginnings have equal names."""
    turn = F.struct("pos", "symbol", "weight")
    chunks = turns.groupBy("seq", F.shiftright("pos", CHUNK_BITS).alias("chunk")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    chunks = staged(chunks, "chunks").withColumn("symbols", F.array_join("turns.symbol", ""))
    whole = F.size("turns") == CHUNK
    upper = None
    if chunks.where(whole).limit(1).count():
        last = F.element_at("turns", -1)
        shorter = chunks.where(whole).select("seq", F.col("chunk").alias("pos"), F.md5("symbols").alias("symbol"), last["weight"].alias("weight"))
        upper = staged(named_prefixes(shorter), "chunk-names")
        roots = upper.select("seq", F.col("depth").alias("chunk"), F.col("name").alias("root"))
        chunks = chunks.join(roots, ["seq", "chunk"], "left")
    else:
        chunks = chunks.withColumn("root", F.lit(None).cast("string"))
    # names of the roots at this width, the first being that of the chunk; each is followed by the name of the cut below it
    names = F.array(F.coalesce("root", F.lit(ROOT)))
    for bits in range(CHUNK_BITS - 1, -1, -1):
        cuts = F.transform(names, _name_of_cut(1 << bits))
        chunks = chunks.withColumn("names", F.flatten(F.zip_with(names, cuts, lambda root, below: F.array(root, below))))
        names = F.col("names")
    found = chunks.select("seq", "chunk", "turns", F.posexplode(F.slice("names", F.lit(2), F.least(F.size("turns"), F.lit(CHUNK - 1)))).alias("i", "name"))
    found = found.select("seq", (F.col("chunk") * CHUNK + F.col("i") + 1).alias("depth"), "name", F.get("turns", F.col("i"))["weight"].alias("weight"))
    return found if upper is None else found.unionByName(upper.withColumn("depth", F.col("depth") * CHUNK))


def _paths(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every member's nodes (``seq, depth, conv_id``), and the nodes (``depth, conv_id, n_convs, weight``).

    A node is called by its depth and its smallest member.
    """
    roots = members.select("seq", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("name"), F.lit(0).cast("long").alias("weight"))
    rows = staged(numbered(named_prefixes(turns).unionByName(roots), "depth", "name", "seq"), "prefixes").drop("at")
    runs = staged(rows.groupBy("part", "depth", "name").agg(F.min("seq").alias("least"), F.count("*").alias("n"), F.min("weight").alias("weight")), "prefix-runs")
    nodes = staged(runs.groupBy("depth", "name").agg(F.min("least").alias("conv_id"), F.sum("n").alias("n_convs"), F.min("weight").alias("weight")), "nodes")
    called = runs.join(nodes.drop("weight"), ["depth", "name"]).select("part", "depth", "name", "conv_id")
    paths = staged(rows.join(called, ["part", "depth", "name"]).select("seq", "depth", "conv_id"), "paths")
    return paths, nodes.drop("name")


def subtree_sums(nodes: DataFrame, paths: DataFrame, columns: list[str]) -> DataFrame:
    """``depth, conv_id`` and the sums of ``columns`` over each node's subtree, itself included."""
    own = nodes.select(*NODE, *columns)
    sums = [F.sum(c).alias(c) for c in columns]
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    total = own
    for bits in range(deepest.bit_length()):
        width = 1 << bits
        forests = total.where(F.col("depth").bitwiseAND(2 * width - 1) == width).groupBy(*NODE).agg(*sums)
        stretch = min(bits, STRETCH_BITS)
        above = F.sequence(F.shiftright(F.col("depth") - width, stretch), F.shiftright(F.col("depth") - 1, stretch))
        forests = forests.select(F.col("conv_id").alias("seq"), F.explode(above).alias("stretch"), *columns)
        upper = paths.where(F.col("depth").bitwiseAND(width) == 0).withColumn("stretch", F.shiftright("depth", stretch))
        grafted = upper.join(forests, ["seq", "stretch"]).groupBy(*NODE).agg(*sums)
        total = total.unionByName(staged(grafted, "grafted"))
    return total.groupBy(*NODE).agg(*sums)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a node's members as text: ``depth, conv_id, place, members``, cut after some bytes."""
    node, held, size, place = None, [], 0, 0
    out = []
    for row in (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))):
        if row[:2] != node or size > SEGMENT:
            if held:
                out.append((*node, place, ",".join(held)))
                place += 1
            node, held, size = row[:2], [], 0
        held.append(str(row[2]))
        size += len(held[-1]) + 1
        if len(out) >= 1000:
            yield _table(out)
            out = []
    if held:
        out.append((*node, place, ",".join(held)))
    if out:
        yield _table(out)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("depth", pa.int64()), ("conv_id", pa.int64()), ("place", pa.int64()), ("members", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of all segments of a node, which follow each other; one node's hash is open at a time."""
    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [("depth", pa.int64()), ("conv_id", pa.int64()), ("ends_sha256", pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])

    node, state, out = None, None, []
    for batch in batches:
        for depth, conv_id, members in zip(*(batch.column(c).to_pylist() for c in ("depth", "conv_id", "members"))):
            if (depth, conv_id) == node:
                state.update(b",")
            else:
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, conv_id), hashlib.sha256()
            state.update(members.encode())
        if len(out) >= 1000:
            yield table(out)
            out = []
    if node:
        out.append((*node, state.hexdigest()))
    if out:
        yield table(out)


def end_digests(paths: DataFrame) -> DataFrame:
    """``depth, conv_id, ends_sha256`` of the nodes at which members end.

    A digest of this kind has to be read from the first member to the last. Members become text in range-partitioned, sorted
    rows; only these segments of up to 64 kB meet by node, and are hashed as they stream by.
    """
    ends = paths.groupBy("seq").agg(F.max_by("conv_id", "depth").alias("conv_id"), F.max("depth").alias("depth"))
    order = [*NODE, "seq"]
    ordered = staged(ends.select(*order), "ends").repartitionByRange(*order).sortWithinPartitions(*order)
    segments = ordered.mapInArrow(_segments, "depth long, conv_id long, place long, members string")
    segments = staged(segments.withColumn("part", F.spark_partition_id()), "end-segments")
    together = segments.repartition(*NODE).sortWithinPartitions(*NODE, "part", "place")
    return together.mapInArrow(_digests, "depth long, conv_id long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of all sequences.

    ``turns`` has ``seq, pos, symbol, weight`` (``pos`` from 0 without gaps, ``symbol`` a digest of 32 characters), ``members`` every
    ``seq`` once. Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (weights that members beyond the first share, summed over the subtree), ``ends_sha256``.
    """
    paths, nodes = _paths(turns, members)
    above = paths.select(F.col("seq").alias("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    nodes = staged(nodes.join(above, NODE, "left"), "nodes-and-parents")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", F.expr("(n_convs - 1) * weight"))
    nodes = staged(nodes, "weighted-nodes")
    sums = subtree_sums(nodes, paths, ["n_leaves", "saved_tokens"])
    out = nodes.drop("n_leaves", "saved_tokens", "weight").join(sums, NODE).join(end_digests(paths), NODE, "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
