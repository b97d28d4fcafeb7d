"""Trie of conversations: one node for every distinct sequence of first turns.

Turns are digested where they are read (SHA-256 over role and text); only digests and
sizes travel.  ``prefixes`` puts them in order by range partitions, so that a conversation
of any length spreads over tasks, and gives every turn a digest of the whole sequence up to it:
a polynomial in the turns' digests modulo 2^31 - 1 in four lanes, which continues across
partitions from one carry per partition.

A count-min sketch of these digests (counters that stop at two, two rows, merged bitwise) screens
them: it never underestimates, so an estimate of one proves that one conversation alone has
this prefix, and then its tail is emitted where it is read.  Only prefixes that may be
shared are grouped exactly by a shuffle, with partial sums before it.  The sketch has four cells a
turn, at most CELLS; beyond that more single prefixes go through the shuffle, with the same result.

Sums over subtrees need no walk of the tree.  A node's smallest member stands for it; a
conversation stands for its nodes from one depth on, its branch depth, as the members of a node
contain those of the nodes below.  So a subtree's leaves are the members that
stand for a leaf, its children those whose branch depth is the next one, and its bytes counted once are
the members' bytes from their branch depths on.  All are sums over members.

Defined cases: null turns come first; null role or text counts as empty; turns of one number stand in
the order of their digests; repeated rows are turns of their own; rows without
conv_id belong to no conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import staged

CELLS = 1 << 27  # most cells of a sketch row; the whole sketch has CELLS / 2 bytes then
SHARE = 1 / 1024  # a node with this share of all branches below it is a frequent parent
HEAD = 8  # turns of another conversation that ``rebuilt`` may take over
_SLICE = 1 << 16  # bytes of a sketch that travel together
_PIECE = 1 << 12  # conversations whose ids travel together

_PRIME = np.uint64((1 << 31) - 1)
_BASES = np.array([1_103_515_245, 48_271, 69_621, 16_807 * 3 + 2], np.uint64)
_EMPTY = hashlib.sha256(b"").hexdigest()


# ---- turns in order, with digests of their prefixes


def _powers(exponents: np.ndarray) -> np.ndarray:
    """The four bases to each exponent, modulo the prime."""
    out = np.ones((len(exponents), 4), np.uint64)
    base, left = _BASES.copy(), exponents.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * base % _PRIME
        base, left = base * base % _PRIME, left >> np.uint64(1)
    return out


def _lanes(column: pa.Array) -> np.ndarray:
    """(rows, 4) numbers of 16-byte values."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), "<u4").reshape(-1, 4).astype(np.uint64)


def _packed(lanes: np.ndarray) -> pa.Array:
    data = pa.py_buffer(np.ascontiguousarray(lanes.astype("<u4")).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(lanes), [None, pa.py_buffer((np.arange(len(lanes) + 1) * 16).astype(np.int32)), data])


_TURN = "conv_id long, depth long, n_bytes long, bytes_to long, last boolean, key binary, prefix binary, before binary"
_COLUMNS = [c.split()[0] for c in _TURN.split(", ")]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, key, n_bytes) in; depths and prefixes as if the partition's first turn began its conversation out.

    A row with ``opens`` closes the partition: its first conversation, and the state of its last one.
    """
    part = TaskContext.get().partitionId()
    conv = opens = held = None
    depth, size, sums = 0, 0, np.zeros(4, np.uint64)

    def rows(ids, columns, following, mark=None):
        last = np.append(ids[1:] != ids[:-1], following is None or ids[-1] != following)
        arrays = [pa.array(ids), *columns[:3], pa.array(last), *columns[3:]]
        ends = [pa.array(np.full(len(ids), part, np.int32)), pa.array([mark] * len(ids), pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, *ends], [*_COLUMNS, "part", "opens"])

    for batch in batches:
        if not len(batch):
            continue
        ids, sizes = (batch.column(c).to_numpy() for c in ("conv_id", "n_bytes"))
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
        goes_on = ids[0] == conv if conv is not None else False
        opens = int(ids[0]) if opens is None else opens
        depths = np.arange(len(ids)) - starts[group] + 1
        if goes_on:
            depths[group == 0] += depth
        terms = (_lanes(batch.column("key")) % (_PRIME - np.uint64(1)) + np.uint64(1)) * _powers(depths) % _PRIME
        total, total_bytes = terms.cumsum(axis=0), sizes.cumsum()
        base, base_bytes = np.zeros((len(starts), 4), np.uint64), np.zeros(len(starts), np.int64)
        base[1:], base_bytes[1:] = total[starts[1:] - 1], total_bytes[starts[1:] - 1]
        total, total_bytes = total - base[group], total_bytes - base_bytes[group]
        if goes_on:
            total[group == 0] += sums
            total_bytes[group == 0] += size
        total %= _PRIME
        if held:
            yield rows(*held, ids[0])
        held = ids, [pa.array(depths), batch.column("n_bytes"), pa.array(total_bytes), batch.column("key"), _packed(total), _packed((total + _PRIME - terms) % _PRIME)]
        conv, depth, size, sums = int(ids[-1]), int(depths[-1]), int(total_bytes[-1]), total[-1]
    if held:
        yield rows(*held, None)
        nothing = pa.array([b""], pa.binary())
        yield rows(np.array([conv]), [pa.array([depth]), pa.array([0]), pa.array([size]), nothing, _packed(sums[None]), nothing], None, opens)


def _carries(marks: list) -> tuple[dict, dict]:
    """From the partitions' closing rows in order: what each one's first conversation brings, and which ones' last goes on."""
    brings, goes_on = {}, {}
    conv = part = None
    for m in marks:
        depth, size, sums = m.depth, m.bytes_to, np.frombuffer(m.prefix, "<u4").astype(np.uint64)
        if conv is not None and m.opens == conv:
            brings[m.part] = (conv, *state)  # noqa: F821
            goes_on[part] = (conv, local)  # noqa: F821
            if m.conv_id == conv:
                sums = (state[2] + _powers(np.array([state[0]]))[0] * sums) % _PRIME  # noqa: F821
                depth, size = depth + state[0], size + state[1]  # noqa: F821
        conv, part, local, state = m.conv_id, m.part, m.depth, (depth, size, sums)
    return brings, goes_on


def _joined(brings: dict, goes_on: dict):
    """Task function: adds each partition's carry to the rows of its first conversation."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(c) for c in _COLUMNS}
            parts, ids = batch.column("part").to_numpy(), column["conv_id"].to_numpy()
            depth, size = column["depth"].to_numpy().copy(), column["bytes_to"].to_numpy().copy()
            last = column["last"].to_numpy(zero_copy_only=False).copy()
            prefix = before = None
            for p in np.unique(parts).tolist():
                if p in goes_on:
                    conv, local = goes_on[p]
                    last[(parts == p) & (ids == conv) & (depth == local)] = False
                if p in brings:
                    conv, n, more, sums = brings[p]
                    here = (parts == p) & (ids == conv)
                    if prefix is None:
                        prefix, before = _lanes(column["prefix"]), _lanes(column["before"])
                    power = _powers(np.array([n]))[0]
                    prefix[here] = (sums + power * prefix[here]) % _PRIME
                    before[here] = (sums + power * before[here]) % _PRIME
                    depth[here] += n
                    size[here] += more
            column |= {"depth": pa.array(depth), "bytes_to": pa.array(size), "last": pa.array(last)}
            if prefix is not None:
                column |= {"prefix": _packed(prefix), "before": _packed(before)}
            yield pa.RecordBatch.from_pydict(column)

    return task


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, key (16 bytes of a digest of role and text) and the text's bytes, without the texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", F.unhex(F.substring(whole, 1, 32)).alias("key"), F.octet_length(text).cast("long").alias("n_bytes")
    )


def prefixes(turns: DataFrame, *order: Column) -> DataFrame:
    """Turns in order within their conversations: depth from 1, bytes so far, ``last``, and digests of the sequence with and without the turn.

    ``turns`` is read twice (once for the range bounds) and should be written already.
    """
    tag = F.monotonically_increasing_id()  # spreads rows that agree in all else; their order does not matter
    rows = turns.withColumn("_tag", tag)
    keys = [F.col("conv_id"), *order, F.col("key"), F.col("_tag")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "key", "n_bytes")
    local = staged(ordered.mapInArrow(_local, f"{_TURN}, part int, opens long"), "turns")
    marks = local.where("opens is not null").select("part", "opens", "conv_id", "depth", "bytes_to", "prefix").orderBy("part").collect()  # one row per partition
    return local.where("opens is null").drop("opens").mapInArrow(_joined(*_carries(marks)), _TURN)


# ---- the sketch


def _cells(prefix: np.ndarray, depth: np.ndarray, cells: int) -> list[np.ndarray]:
    mixed = (prefix[:, 0] << np.uint64(32) | prefix[:, 1]) ^ (depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (prefix[:, 2] << np.uint64(31) | prefix[:, 3])
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    mask = np.uint64(cells - 1)
    return [(mixed >> np.uint64(33)) & mask, mixed & mask]


def _bits(plane: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (plane[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _set(plane: np.ndarray, cell: np.ndarray) -> None:
    np.bitwise_or.at(plane, cell >> np.uint64(3), np.uint8(1) << (cell & np.uint64(7)).astype(np.uint8))


def _sketch(cells: int):
    """Task function: turns in, slices of this task's sketch out (bits for seen once, seen twice)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros((2, 2, max(cells // 8, 1)), np.uint8)
        for batch in batches:
            for row, cell in enumerate(_cells(_lanes(batch.column("prefix")), batch.column("depth").to_numpy(), cells)):
                cell, n = np.unique(cell, return_counts=True)
                _set(twice[row], cell[(n > 1) | _bits(once[row], cell)])
                _set(once[row], cell)
        yield from _slices({(r, k): (once[r, k : k + _SLICE], twice[r, k : k + _SLICE]) for r in range(2) for k in range(0, once.shape[1], _SLICE)})

    return task


def _slices(parts: dict) -> Iterator[pa.RecordBatch]:
    for (r, k), (once, twice) in parts.items():
        if once.any():
            columns = [[r], [k], [once.tobytes()], [twice.tobytes()]]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["row", "at", "once", "twice"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: adds up slices; a sum of two or more is two."""
    parts: dict = {}
    for batch in batches:
        for r in batch.to_pylist():
            once, twice = (np.frombuffer(r[c], np.uint8) for c in ("once", "twice"))
            o, t = parts.get((r["row"], r["at"]), (np.zeros_like(once), np.zeros_like(twice)))
            parts[r["row"], r["at"]] = o | once, t | twice | (o & once)
    yield from _slices(parts)


def sketch(turns: DataFrame, cells: int) -> np.ndarray:
    """Bits of the cells counted twice or more, (2, cells / 8) bytes, at most CELLS / 4 in all."""
    schema = "row int, at long, once binary, twice binary"
    merged = turns.select("prefix", "depth").mapInArrow(_sketch(cells), schema).repartition("row", "at").mapInArrow(_merge, schema)
    out = np.zeros((2, max(cells // 8, 1)), np.uint8)
    for r in merged.select("row", "at", "twice").collect():  # CELLS / 4 bytes at most
        out[r.row, r["at"] : r["at"] + len(r.twice)] = np.frombuffer(r.twice, np.uint8)
    return out


def _screen(cells: int, shared):
    """Task function: adds ``single`` and ``before_single``, whether the prefix with and without the turn is proven to be one conversation's."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = shared.value
        for batch in batches:
            depth = batch.column("depth").to_numpy()
            proven = []
            for name, d in (("prefix", depth), ("before", depth - 1)):
                a, b = _cells(_lanes(batch.column(name)), d, cells)
                proven.append(~(_bits(twice[0], a) & _bits(twice[1], b)))
            yield batch.append_column("single", pa.array(proven[0])).append_column("before_single", pa.array(proven[1] & (depth > 1)))

    return task


# ---- the trie


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: sorted (depth, prefix, conv_id) in; runs of one node's ids as text out."""
    node, ids = None, []

    def piece():
        columns = [[node[0]], [node[1]], [ids[0]], [",".join(map(str, ids))]]
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["depth", "prefix", "first", "ids"])

    for batch in batches:
        for depth, prefix, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "prefix", "conv_id")), strict=True):
            if ids and ((depth, prefix) != node or len(ids) == _PIECE):
                yield piece()
                ids = []
            node = depth, prefix
            ids.append(conv)
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: a node's pieces in order in, the digest of all its ids out; holds one digest's state."""
    node = state = None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([node[0]]), pa.array([node[1]], pa.binary()), pa.array([state.hexdigest()])], ["depth", "prefix", "ends_sha256"])

    for batch in batches:
        for depth, prefix, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "prefix", "ids")), strict=True):
            if (depth, prefix) != node:
                if node:
                    yield done()
                node, state = (depth, prefix), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if node:
        yield done()


def ends_digests(ends: DataFrame) -> DataFrame:
    """By node (depth, prefix): SHA-256 of the ids of the conversations that end there, ascending, joined by commas.

    Ids are ordered by range partitions and joined to pieces there, so that a node at which
    many conversations end reaches the one task that digests it as a few pieces.
    """
    keys = ["depth", "prefix", "conv_id"]
    pieces = ends.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keys).mapInArrow(_pieces, "depth long, prefix binary, first long, ids string")
    together = pieces.repartition("depth", "prefix").sortWithinPartitions("depth", "prefix", "first").select("depth", "prefix", "ids")
    return together.mapInArrow(_hashed, "depth long, prefix binary, ends_sha256 string")


_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _parents(branches: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """``branches`` with ``parent``, the conversation that stands for the node (depth - 1, before).

    Nodes with ``least`` children or more are few and come as a broadcast; no other key of the join is frequent.
    """
    key = [F.col("depth").alias("_depth"), F.col("prefix").alias("_prefix"), F.col("rep").alias("parent"), "n_children"]
    many = nodes.where(F.col("n_children") >= F.lit(least)).select(*key).drop("n_children")
    few = nodes.where(F.col("n_children") < F.lit(least)).select(*key).drop("n_children").withColumnRenamed("parent", "_parent")
    on = (F.col("depth") - 1 == F.col("_depth")) & (F.col("before") == F.col("_prefix"))
    first = branches.join(F.broadcast(many), on, "left").drop("_depth", "_prefix")
    known = first.where("parent is not null")
    rest = first.where("parent is null").drop("parent").join(few, on).withColumnRenamed("_parent", "parent").drop("_depth", "_prefix")
    return known.unionByName(rest)


def trie(turns: DataFrame, ids: DataFrame, cells: int | None = None, share: float = SHARE) -> DataFrame:
    """One row per node of the conversations ``ids`` (conv_id, distinct), whose turns are ``prefixes``.

    ``n_leaves`` counts childless nodes of the subtree; ``saved_tokens`` sums (n_convs - 1) times the bytes of the
    last text over the subtree.
    """
    spark = turns.sparkSession
    if cells is None:
        cells = 1 << min(max((4 * turns.select("depth").count()).bit_length(), 16), CELLS.bit_length() - 1)
    seen = spark.sparkContext.broadcast(sketch(turns, cells))
    rows = staged(turns.drop("key").mapInArrow(_screen(cells, seen), _TURN.replace("key binary, ", "") + ", single boolean, before_single boolean"), "screened")
    single, shared = rows.where("single"), rows.where("not single")
    node = ["depth", "prefix"]
    of_node = [F.min(c).alias(c) for c in ("n_bytes", "bytes_to", "before")]
    nodes = staged(
        shared.groupBy(*node).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("rep"), F.count_if("last").alias("n_ends"), *of_node), "nodes"
    )

    # of each conversation: its bytes, its branch depth, the bytes before that, and whether it stands for a leaf
    none = F.lit(None).cast("long")
    start = (F.col("bytes_to") - F.col("n_bytes")).alias("start")

    def of_conv(df, conv, total=none, branch=none, start=none, leaf=F.lit(0)):
        return df.select(F.col(conv).alias("conv_id"), total.alias("total"), branch.alias("branch"), start.alias("start"), leaf.alias("leaf"))

    records = of_conv(rows.where("last"), "conv_id", total=F.col("bytes_to"), leaf=F.col("single").cast("int"))
    records = records.unionByName(of_conv(nodes, "rep", branch=F.col("depth"), start=start, leaf=(F.col("n_convs") == F.col("n_ends")).cast("int")))
    records = records.unionByName(of_conv(single.where("not before_single"), "conv_id", branch=F.col("depth"), start=start))
    convs = records.groupBy("conv_id").agg(F.max("total").alias("total"), F.min("branch").alias("branch"), F.min("start").alias("start"), F.max("leaf").alias("leaf"))
    convs = staged(convs.withColumn("own", F.coalesce(F.col("total") - F.col("start"), F.lit(0))), "convs")

    # sums over the members of shared nodes; of these the one with a branch depth up to the node's stands for it
    stands = F.col("branch") <= F.col("depth")
    members = shared.select("conv_id", *node, "last").join(convs, "conv_id")
    sums = members.groupBy(*node).agg(
        F.sum("leaf").alias("n_leaves"),
        (F.count_if(F.col("branch") == F.col("depth") + 1) + F.count_if(stands & ~F.col("last"))).alias("n_children"),
        F.sum("total").alias("total"),
        F.sum("own").alias("own"),
        F.sum(F.when(stands, F.col("own"))).alias("rep_own"),
        F.sum(F.when(stands, F.col("total"))).alias("rep_total"),
        F.sum(F.when(stands, F.col("branch"))).alias("rep_branch"),
    )
    once = F.col("own") - F.col("rep_own") + F.col("rep_total") - F.col("start")
    nodes = nodes.withColumn("start", start).join(sums, node).withColumn("saved_tokens", F.col("total") - F.col("n_convs") * F.col("start") - once)
    nodes = staged(nodes.select("rep", *node, "before", "n_convs", "n_ends", "n_children", "n_leaves", "saved_tokens", "rep_branch"), "sums")

    # ends: digests of the ids where more than one conversation may end; turnless conversations end at the root
    turnless = ids.join(rows.where("last").select("conv_id"), "conv_id", "left_anti")
    nowhere = turnless.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("prefix"))
    ends = ends_digests(shared.where("last").select("conv_id", *node).unionByName(nowhere))

    # the root, and how many branches there are
    all_ids = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    all_sums = convs.agg(F.count_if(F.col("branch") == 1).alias("n_children"), F.count("branch").alias("branches"), F.sum("leaf").alias("leaves"), (F.sum("total") - F.sum("own")).alias("saved"))
    top = all_ids.crossJoin(all_sums).first()  # one row beside one row
    zero = F.lit(0).cast("long")
    root = spark.createDataFrame([(top.conv_id, top.n_convs, top.n_children, top.leaves or 1, top.saved or 0)], "conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    root = root.where("n_convs > 0").withColumn("depth", zero).withColumn("prefix", F.lit(b"")).withColumn("parent_conv_id", none)

    # parents: those of branches are looked up, below the root and inside a conversation they are known
    least = max(share * top.branches, 2)
    branch = F.col("rep_branch") == F.col("depth")
    at_root, own = F.col("depth") == 1, F.lit(top.conv_id).cast("long")
    inner = nodes.select(F.col("rep").alias("conv_id"), *node, "before", "n_convs", "n_children", "n_leaves", "saved_tokens", branch.alias("looked"))
    outer = single.select("conv_id", *node, "before", "last", "before_single")
    below = _parents(inner.where(~at_root & F.col("looked")), nodes, least).unionByName(
        inner.where(at_root | ~F.col("looked")).withColumn("parent", F.when(at_root, own).otherwise(F.col("conv_id")))
    )
    found = below.withColumnRenamed("parent", "parent_conv_id").unionByName(root, allowMissingColumns=True).join(ends, node, "left")
    tails = _parents(outer.where(~at_root & ~F.col("before_single")), nodes, least).unionByName(
        outer.where(at_root | F.col("before_single")).withColumn("parent", F.when(at_root, own).otherwise(F.col("conv_id")))
    )
    one = F.lit(1).cast("long")
    tails = tails.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), one.alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends_sha256"),
    )
    return found.select(*_NODE).unionByName(tails).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text), ordered by turn."""
    turns = staged(digests(conversations), "digests")
    return trie(prefixes(turns, F.col("turn").asc_nulls_first()), turns.select("conv_id").distinct())


def rebuilt(turns: DataFrame) -> DataFrame:
    """``prefixes`` of conversations that begin like another one.

    Of conversation c the first h turns (h = crc32(c) mod 9) give way to the first h of
    conversation c - c % 5.  At most nine conversations take the same head, of HEAD turns at most.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)
    slim = turns.select("conv_id", "depth", "key", "n_bytes")
    heads = slim.where((F.col("depth") <= HEAD) & (F.col("conv_id") % 5 == 0)).withColumnRenamed("conv_id", "head")
    takers = slim.where("depth = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("head"), h.alias("h"))
    taken = takers.join(heads, "head").where("depth <= h").select("conv_id", "depth", "key", "n_bytes")
    both = staged(taken.unionByName(slim.where(F.col("depth") > h)), "rebuilt")
    return prefixes(both, F.col("depth"))  # the depths order the turns, whatever gaps are left


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the ``rebuilt`` conversations; those left without turns are members of the root."""
    turns = staged(digests(conversations), "digests")
    return trie(rebuilt(prefixes(turns, F.col("turn").asc_nulls_first())), turns.select("conv_id").distinct())


SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), original AS (
  SELECT conv_id, k, strlen(text) AS n_bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS d FROM t
), crc AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM t
  UNION ALL
  SELECT conv_id, s, i + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END
  FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(s[i // 8 + 1]) AS BIGINT)) ELSE c END AS x FROM crc WHERE i < 8 * strlen(s))
), ids AS (
  SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % 9 AS h, conv_id - conv_id % 5 AS head FROM crc WHERE i = 8 * strlen(s)
), parts AS (
  SELECT ids.conv_id, 0 AS own, o.d AS d, o.k, o.n_bytes FROM ids JOIN original o ON o.conv_id = ids.head AND o.d <= ids.h
  UNION ALL
  SELECT ids.conv_id, 1, o.d, o.k, o.n_bytes FROM ids JOIN original o ON o.conv_id = ids.conv_id AND o.d > ids.h
), turns AS (
  SELECT conv_id, n_bytes, k, row_number() OVER (PARTITION BY conv_id ORDER BY own, d) AS depth FROM parts
), rows AS (
  SELECT conv_id, depth, n_bytes, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path,
         count(*) OVER (PARTITION BY conv_id) AS len
  FROM turns
  UNION ALL
  SELECT conv_id, 0, 0, '', (SELECT count(*) FROM turns WHERE turns.conv_id = ids.conv_id) FROM ids
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(n_bytes) AS n_bytes, bool_and(len = depth) AS childless,
         sha256(coalesce(string_agg(CASE WHEN len = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM rows GROUP BY path, depth
), below AS (
  SELECT r.path, r.depth, sum(CASE WHEN u.childless THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.n_bytes) AS saved_tokens
  FROM nodes u JOIN rows r ON r.conv_id = u.conv_id AND r.depth <= u.depth
  GROUP BY r.path, r.depth
), links AS (
  SELECT c.path, c.depth, p.conv_id AS parent_conv_id, p.path AS parent_path
  FROM nodes c JOIN rows r ON r.conv_id = c.conv_id AND r.depth = c.depth - 1 JOIN nodes p ON p.path = r.path AND p.depth = r.depth
), children AS (
  SELECT parent_path, count(*) AS n FROM links GROUP BY parent_path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, l.parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.path = n.path AND b.depth = n.depth
LEFT JOIN links l ON l.path = n.path AND l.depth = n.depth LEFT JOIN children c ON c.parent_path = n.path
"""
