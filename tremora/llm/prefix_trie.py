"""Prefix trie of conversations, rolled up by centroid decomposition.

Turns are numbered by one range-partitioned sort, so a conversation may be as long as it
likes. Each prefix of a conversation gets a digest; equal prefixes are one node.

The forest of parent edges is split into connected components of at most ``BOUND`` nodes:
first the largest subtrees that hold at most ``BOUND`` turns of conversations are cut off,
each whole; their totals go to the nodes they hang from. What is above them, a small part of
the trie, is split at centroids by Spark, one round for all components at a time, while it has
components of more than ``BOUND`` nodes. Inside a component, tasks go on splitting at
centroids. At every split the total of what hangs from the centroid is added to each node on
the path from the centroid to the top of its component; a node's sum is whole when it has
become a centroid itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tremora.llm.common import materialise

BOUND = 50_000  # nodes of a component that one task takes
BLOCK = 256  # turns of a conversation that one task hashes in order
SALTS = 16
FAMILY, LENT = 20, 4  # conversations that share openings, and one more than the most turns they share
_TEXT = 1 << 20  # characters of joined ids that are handed on together

# turns ---------------------------------------------------------------------------------------------


def _digested(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words) of every row; texts go no further than this."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def _numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in order with (part, conv_id, at), and per (part, conv_id) what turns ``at`` into a place in the conversation."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "digest", "_row"]  # rows that are equal in all else may be told apart, to part them
    rows = turns.withColumn("_row", F.monotonically_increasing_id())
    ordered = materialise(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "conv_id", "digest", "words", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")), "turns")
    spans = ordered.groupBy("part", "conv_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    return ordered, materialise(
        spans.withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")), "turn-spans")


def _own(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % LENT


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, place from 0, digest, words, length) of the rebuilt conversations, (conv_id, length) of all)."""
    ordered, spans = _numbered(materialise(_digested(conversations), "digests"))
    convs = spans.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("base", F.expr(f"conv_id - conv_id % {FAMILY}"))
    bases = convs.where("conv_id = base").select("base", F.least(F.col("n"), F.lit(LENT - 1)).alias("lent"))
    taken = F.least(_own(F.col("conv_id")), F.coalesce("lent", F.lit(0)))
    convs = materialise(convs.join(bases, "base", "left").select(
        "conv_id", "base", _own(F.col("conv_id")).alias("skip"), taken.alias("taken"),
        (taken + F.greatest(F.col("n") - _own(F.col("conv_id")), F.lit(0))).alias("length")), "conversations")
    placed = ordered.join(spans.select("part", "conv_id", "shift"), ["part", "conv_id"]).withColumn("place", F.col("at") + F.col("shift"))
    own = placed.join(spans.select("part", "conv_id").join(convs, "conv_id"), ["part", "conv_id"]).where("place >= skip").select(
        "conv_id", (F.col("place") - F.col("skip") + F.col("taken")).alias("place"), "digest", "words", "length")
    opening = placed.where(f"place < {LENT - 1} and conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), "place", "digest", "words")
    lent = opening.join(convs.where("taken > 0"), "base").where("place < taken").select("conv_id", "place", "digest", "words", "length")
    return own.unionByName(lent), convs.select("conv_id", "length")


# prefixes ------------------------------------------------------------------------------------------

_PREFIX = pa.schema([(c, pa.int64()) for c in ("conv_id", "length", "depth", "n1", "n2", "p1", "p2", "words")])
_PREFIX_DDL = ", ".join(f"{c} long" for c in _PREFIX.names)


def _halves(digests: list[bytes]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())]


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of every prefix within a block, from the digest before it."""
    for b in batches:
        out: list[list] = [[] for _ in range(4)]
        nodes, parents = [], []
        for conv, length, block, start, end, turns in zip(*(b.column(c).to_pylist() for c in ("conv_id", "length", "block", "start", "end", "turns"))):
            state = bytes(start) if start else bytes(16)
            for turn in turns:
                parents.append(state)
                state = hashlib.sha256(state + turn["digest"]).digest()[:16]
                nodes.append(state)
                for column, value in zip(out, (conv, length, turn["place"] + 1, turn["words"])):
                    column.append(value)
            if end and len(turns) == BLOCK:
                nodes[-1] = bytes(end)
        conv, length, depth, words = (pa.array(c, pa.int64()) for c in out)
        yield pa.RecordBatch.from_arrays([conv, length, depth, *_halves(nodes), *_halves(parents), words], schema=_PREFIX)


def _fold_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for turns in b.column("turns").to_pylist():
            state = b""
            for turn in turns:
                state = hashlib.sha256(state + turn["digest"]).digest()
            out.append(state)
        names = ["conv_id", "length", "place", "digest"]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("length"), b.column("block"), pa.array(out, pa.binary())], names=names)


def prefixes(turns: DataFrame, longest: int) -> DataFrame:
    """(conv_id, length, depth, node, its parent, words of its last turn) for every prefix with turns.

    Nodes are 128 bits of SHA-256 in two longs; the root is (0, 0). Conversations of more than
    BLOCK turns are hashed block by block, starting from the prefixes of their blocks.
    """
    grouped = turns.groupBy("conv_id", "length", F.expr(f"place div {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "words"))).alias("turns"))  # at most BLOCK
    if longest <= BLOCK:
        grouped = grouped.withColumns({"start": F.lit(None).cast("binary"), "end": F.lit(None).cast("binary")})
        return grouped.mapInArrow(_chain, _PREFIX_DDL)
    grouped = materialise(grouped, "turn-blocks")
    full = grouped.where(F.size("turns") == BLOCK).mapInArrow(_fold_blocks, "conv_id long, length long, place long, digest binary")
    above = prefixes(full.withColumn("words", F.lit(0).cast("long")), longest // BLOCK)
    binary = [F.col("conv_id"), F.col("depth"), *(F.unhex(F.concat(*(_hex(c) for c in pair))).alias(name)
                                                 for name, pair in (("end", ("n1", "n2")), ("start", ("p1", "p2"))))]
    above = materialise(above.select(*binary), "block-prefixes")
    ends = above.select("conv_id", (F.col("depth") - 1).alias("block"), "end")
    starts = above.select("conv_id", F.col("depth").alias("block"), F.col("end").alias("start"))
    return grouped.join(starts, ["conv_id", "block"], "left").join(ends, ["conv_id", "block"], "left").mapInArrow(_chain, _PREFIX_DDL)


def _hex(long: str) -> Column:
    """The eight bytes of a long, lowest first, in hex."""
    return F.concat(*(F.lpad(F.hex(F.shiftrightunsigned(F.col(long), 8 * k).bitwiseAND(255)), 2, "0") for k in range(8)))


# members -------------------------------------------------------------------------------------------

_END_DDL = "n1 long, n2 long, part int, seq int, text string, sha string"
_END = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("text", pa.string()), ("sha", pa.string())])


def _join_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id): digests of nodes that lie whole in the part, texts of its first and last node."""
    part, at, first, seq, held, size = TaskContext.get().partitionId(), None, True, 0, [], 0
    done: list[tuple] = []

    def flush(last: bool) -> None:
        nonlocal held, size, seq
        if held:
            text = ",".join(held)
            whole = last and not first and not seq
            done.append((*at, part, seq, None if whole else text, hashlib.sha256(text.encode()).hexdigest() if whole else None))
            held, size, seq = [], 0, seq + 1

    for b in batches:
        for row in zip(b.column("n1").to_pylist(), b.column("n2").to_pylist(), b.column("conv_id").to_pylist()):
            if row[:2] != at:
                flush(True)
                first = at is None
                at, seq = row[:2], 0
            held.append(str(row[2]))
            size += len(held[-1])
            if size > _TEXT:
                flush(False)
        if len(done) > 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(_END.names, r)) for r in done], schema=_END)
            done.clear()
    flush(False)  # the next part may go on with this node
    yield pa.RecordBatch.from_pylist([dict(zip(_END.names, r)) for r in done], schema=_END)


def _join_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, digest = None, None
    for b in batches:
        out = []
        for row in b.to_pylist():
            node = (row["n1"], row["n2"])
            if node != at:
                if at:
                    out.append((*at, digest.hexdigest()))
                at, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(row["text"].encode())
        yield _sha_rows(out)
    if at:
        yield _sha_rows([(*at, digest.hexdigest())])


def _sha_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["n1", "n2", "ends_sha256"])


def member_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the ascending conv_ids of each node, joined by commas.

    The ids of a node are joined in as many parts as they fill; one task then only hashes the joined
    texts of the nodes that go across parts, a megabyte at a time, which the digest requires in order.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["n1", "n2", "conv_id"]
    joined = materialise(ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_join_ids, _END_DDL), "members")
    across = joined.where("sha is null").repartition("n1", "n2").sortWithinPartitions("n1", "n2", "part", "seq")
    return joined.where("sha is not null").select("n1", "n2", F.col("sha").alias("ends_sha256")).union(
        across.mapInArrow(_join_texts, "n1 long, n2 long, ends_sha256 string"))


# centroids -----------------------------------------------------------------------------------------


def _salted(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows joined with the few, whose keys may each meet a third of all rows: every key is dealt out to SALTS parts."""
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int")
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how).drop("_salt")


def split_at_centroids(nodes: DataFrame, paths: DataFrame, bound: int) -> DataFrame:
    """Nodes in components of at most ``bound`` nodes, ``up_*`` holding what the splits have added to them.

    ``nodes`` has n1, n2, conv_id, depth, weight, leaves and saved, all in component (c1, c2); ``paths``
    the (conv_id, depth, node, parent) of their conversations. ``weight`` is that of a node's subtree, and
    more than its children's together. In a component, the nodes of more than half its weight are the path
    from the centroid to the top, so no edge is walked; what hangs from the centroid is found by
    looking up, for every node, the prefix of its conversation at the centroid's depth.
    """
    nodes = materialise(nodes.withColumns({"up_leaves": F.lit(0).cast("long"), "up_saved": F.lit(0).cast("long")}), "heavy")
    reach = nodes.groupBy("conv_id").agg(F.max("depth").alias("reach"))
    paths = materialise(paths.join(reach, "conv_id").where("depth <= reach").select(
        "conv_id", F.col("depth").alias("next"), F.col("n1").alias("l1"), F.col("n2").alias("l2"),
        F.col("p1").alias("q1"), F.col("p2").alias("q2")), "heavy-paths")
    comp = ["c1", "c2"]
    while True:
        sizes = nodes.groupBy(*comp).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("total"))
        big = materialise(sizes.where(F.col("n") > bound).drop("n"), "big")
        if big.isEmpty():
            return nodes
        rest = _salted(nodes, big, comp, "left_anti")
        open_ = _salted(nodes, big, comp).withColumn("above", 2 * F.col("weight") > F.col("total"))
        centre = open_.where("above").groupBy(*comp).agg(F.max(F.struct("depth", "n1", "n2", "weight")).alias("z"))
        open_ = _salted(open_, centre, comp).withColumn("next", F.col("z.depth") + 1)
        found = open_.join(paths, ["conv_id", "next"], "left").withColumns({
            "centre": F.expr("n1 = z.n1 and n2 = z.n2"),
            "under": F.expr("depth > z.depth and q1 <=> z.n1 and q2 <=> z.n2")})
        found = materialise(found, "around-centroids")
        total = found.where("under or centre").groupBy(*comp).agg(F.sum("leaves").alias("z_leaves"), F.sum("saved").alias("z_saved"))
        moved = _salted(found, total, comp)
        one = "not under and not centre and above"
        split = moved.select(
            *(F.expr(f"case when centre then n{k} when under then l{k} else c{k} end").alias(f"c{k}") for k in (1, 2)),
            "n1", "n2", "conv_id", "depth", F.expr(f"case when {one} then weight - z.weight else weight end").alias("weight"),
            *(F.expr(f"case when centre then 0L else {v} end").alias(v) for v in ("leaves", "saved")),  # in z_* now
            *(F.expr(f"up_{v} + case when centre or ({one}) then z_{v} else 0L end").alias(f"up_{v}") for v in ("leaves", "saved")))
        nodes = materialise(rest.select(*split.columns).unionByName(split), "split")


def centroid_sums(parent: np.ndarray, component: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one row per node) over each node's subtree within its component.

    ``parent`` is a place before the node's own, or -1 at the top of a component. All components
    are split at their centroids at once, as often as the largest can be halved.
    """
    n = len(parent)
    up = parent.tolist()
    size = [1] * n
    for i in range(n - 1, -1, -1):
        if up[i] >= 0:
            size[up[i]] += size[i]
    place, free, at = [0] * n, [0] * n, 0
    for i in range(n):  # places in preorder: a subtree is an interval
        if up[i] < 0:
            place[i], at = at, at + size[i]
        else:
            place[i] = free[up[i]]
            free[up[i]] += size[i]
        free[i] = place[i] + 1
    place, spread = np.array(place, np.int64), np.array(size, np.int64)
    order = np.empty(n, np.int64)
    order[place] = np.arange(n)
    spread, above = spread[order], np.where(parent[order] >= 0, place[parent[order]], -1)
    values, sums = values[order], np.zeros_like(values)
    label, weight, live = np.unique(component[order], return_inverse=True)[1].reshape(-1), spread.copy(), np.arange(n)
    while len(live):
        _, own = np.unique(label[live], return_inverse=True)
        half = np.bincount(own)[own]
        path = 2 * weight[live] > half
        centre = np.zeros(own.max() + 1, np.int64)
        centre[own[path]] = live[path]  # the last of a path in preorder is the deepest
        z = centre[own]
        inside = (live >= z) & (live < z + spread[z])
        total = np.zeros((len(centre), values.shape[1]), values.dtype)
        np.add.at(total, own[inside], values[live[inside]])
        sums[live[path]] += total[own[path]]
        lost = weight[centre]
        weight[live[path]] -= lost[own[path]]
        under = inside & (live != z)
        below = np.flatnonzero(under)[np.argsort(own[under], kind="stable")]
        label[live] = own
        label[live[below]] = len(centre) - 1 + np.cumsum(above[live[below]] == z[below])  # from child to child of the centroid
        live = live[live != z]
    out = np.empty_like(sums)
    out[order] = sums
    return out


_ROLLED = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_ROLLED_DDL = ", ".join(f"{c} long" for c in _ROLLED) + ", ends_sha256 string"


def _roll(t: pa.Table) -> pa.RecordBatch:
    """Whole components, each in ascending depth."""
    col = {c: t.column(c).to_numpy() for c in ("n1", "n2", "p1", "p2", "c1", "c2", "conv_id", "leaves", "saved", "up_leaves", "up_saved")}
    component = np.cumsum(np.append(False, (np.diff(col["c1"]) != 0) | (np.diff(col["c2"]) != 0)))
    places = {key: i for i, key in enumerate(zip(col["n1"].tolist(), col["n2"].tolist()))}
    parent = np.array([places.get(key, -1) for key in zip(col["p1"].tolist(), col["p2"].tolist())], np.int64)
    root = (col["n1"] == 0) & (col["n2"] == 0)
    parent[(component[parent] != component) | root] = -1
    sums = centroid_sums(parent, component, np.stack([col["leaves"], col["saved"]], axis=1))
    inside = parent >= 0
    parent_conv = t.column("parent_conv_id").combine_chunks()
    parent_conv = pa.compute.if_else(pa.array(inside), pa.array(col["conv_id"][parent]), parent_conv)
    done = {"parent_conv_id": parent_conv, "n_leaves": pa.array(sums[:, 0] + col["up_leaves"]), "saved_tokens": pa.array(sums[:, 1] + col["up_saved"])}
    names = [*_ROLLED, "ends_sha256"]
    return pa.RecordBatch.from_arrays([done.get(c) if c in done else t.column(c).combine_chunks() for c in names], names=names)


def _roll_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components in order; those that have ended are rolled up together."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= BOUND:
            t = pa.Table.from_batches(held)
            a, c = t.column("c1").to_numpy(), t.column("c2").to_numpy()
            last = int(np.flatnonzero((a != a[-1]) | (c != c[-1]))[-1]) + 1 if len(a) and ((a != a[-1]) | (c != c[-1])).any() else 0
            if last:
                yield _roll(t.slice(0, last))
            held = t.slice(last).to_batches()
            rows = t.num_rows - last
    if rows:
        yield _roll(pa.Table.from_batches(held))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations, with the sums of its subtree.

    Rows without conv_id belong to no conversation. Turns come in the order of ``turn``, null first;
    rows with the same turn in that of a digest of (role, text), each a turn of its own. A null
    role or text is empty. An empty table has no nodes; otherwise the root has depth 0. Other columns are ignored.
    """
    turns, lengths = rebuilt_turns(conversations)
    longest = lengths.agg(F.max("length")).first()[0]
    inner = prefixes(turns, longest or 0)
    root = lengths.select("conv_id", "length", *(F.lit(0).cast("long").alias(c) for c in _PREFIX.names[2:]))
    paths = materialise(inner.unionByName(root), "prefixes")
    node, comp = ["n1", "n2"], ["c1", "c2"]
    found = paths.groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"), *(F.max(c).alias(c) for c in ("depth", "p1", "p2", "words")), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
    found = materialise(found, "nodes")
    children = found.where("depth > 0").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = member_digests(paths.where("depth = length"))
    nodes = materialise(found.join(children, node, "left").join(ends, node, "left").select(
        *node, "p1", "p2", "conv_id", "depth", "n_convs", "weight", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        F.col("n_children").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie")

    # subtrees of at most BOUND turns, whole; a conversation is in one of them at most
    heavy = nodes.where(F.col("weight") > BOUND).select("n1", "n2", "conv_id", "depth", "weight", "leaves", "saved")
    heavy = materialise(heavy, "heavy")
    many = heavy.count()
    above = heavy.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    light = nodes.where(F.col("weight") <= BOUND)
    zero = F.lit(0).cast("long")
    if many:
        hung = _salted(paths.where("depth > 0").select("conv_id", "depth", "n1", "n2", "p1", "p2"), above.drop("parent_conv_id"), ["p1", "p2"])
        tops = hung.groupBy("conv_id").agg(F.max(F.struct("depth", "n1", "n2")).alias("top")).select(
            "conv_id", F.col("top.n1").alias("c1"), F.col("top.n2").alias("c2"))
        light = _salted(light.where("depth > 0").join(tops, "conv_id"), above, ["p1", "p2"], "left")
    else:
        light = light.withColumns({"c1": zero, "c2": zero, "parent_conv_id": F.lit(None).cast("long")})
    light = materialise(light.withColumns({"up_leaves": zero, "up_saved": zero}), "light")
    columns = [*comp, *node, "p1", "p2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "leaves", "saved", "up_leaves", "up_saved", "ends_sha256"]
    every = light.select(*columns)
    if many:
        totals = light.groupBy(*comp).agg(
            F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"),
            *(F.max(F.when(F.expr("n1 = c1 and n2 = c2"), F.col(p))).alias(p) for p in ("p1", "p2")))  # where the top hangs
        hanging = totals.groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.sum("t_leaves").alias("t_leaves"), F.sum("t_saved").alias("t_saved"))
        heavy = heavy.join(hanging, node, "left").select(
            zero.alias("c1"), zero.alias("c2"), *node, "conv_id", "depth", "weight",
            *((F.col(v) + F.coalesce(f"t_{v}", zero)).alias(v) for v in ("leaves", "saved")))
        if many > BOUND:
            heavy = split_at_centroids(heavy, paths.where("depth > 0"), BOUND)
        else:
            heavy = heavy.withColumns({"up_leaves": zero, "up_saved": zero})
        known = _salted(nodes.drop("leaves", "saved", "weight"), above, ["p1", "p2"], "left")
        heavy = heavy.drop("conv_id", "depth", "weight").join(known, node)
        every = every.unionByName(heavy.select(*columns))
    whole = every.repartition(*comp).sortWithinPartitions(*comp, "depth")
    rolled = whole.mapInArrow(_roll_up, _ROLLED_DDL)
    return rolled.withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id")))


#: crc32 bit by bit, prefixes as lists, subtrees through the members' deeper prefixes
ORACLE = r"""
WITH RECURSIVE conv AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc(conv_id, k, v) AS (
  SELECT conv_id, 0, 4294967295::BIGINT FROM conv
  UNION ALL
  SELECT conv_id, k + 1, xor(w >> 1, CASE WHEN w % 2 = 1 THEN 3988292384 ELSE 0 END::BIGINT) FROM (
    SELECT conv_id, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(conv_id::VARCHAR, k // 8 + 1, 1))::BIGINT) ELSE v END AS w
    FROM crc WHERE k < 8 * length(conv_id::VARCHAR))),
lent AS (SELECT conv_id, (xor(v, 4294967295::BIGINT) % 4)::BIGINT AS h FROM crc WHERE k = 8 * length(conv_id::VARCHAR)),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:h], []), c.own[h + 1:]) AS turns
  FROM conv c JOIN lent USING (conv_id) LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 20),
paths AS (
  SELECT conv_id, turns[1:d] AS prefix, d AS depth, len(turns) AS length
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT prefix, depth, row_number() OVER () AS id, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = length) AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(prefix[depth].t, '[^\x20\x09-\x0D]+')) END AS words
  FROM paths GROUP BY prefix, depth),
edge AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.id AS parent,
    n.id NOT IN (SELECT q.id FROM node q JOIN node c ON c.depth = q.depth + 1 AND c.prefix[1:q.depth] = q.prefix) AS leaf
  FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]),
member AS (SELECT p.conv_id, n.id, p.depth FROM paths p JOIN node n ON n.depth = p.depth AND n.prefix = p.prefix),
below AS (SELECT DISTINCT a.id, b.id AS inner_id FROM member a JOIN member b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
  SELECT b.id, sum(CASE WHEN e.leaf THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((e.n_convs - 1) * e.words)::BIGINT AS saved_tokens
  FROM below b JOIN edge e ON e.id = b.inner_id GROUP BY b.id)
SELECT e.conv_id, e.depth::BIGINT AS depth, e.parent_conv_id, e.n_convs::BIGINT AS n_convs,
  (SELECT count(*) FROM edge c WHERE c.parent = e.id)::BIGINT AS n_children, n_leaves, saved_tokens,
  sha256(coalesce(e.ends, '')) AS ends_sha256
FROM edge e JOIN sums USING (id)
"""
