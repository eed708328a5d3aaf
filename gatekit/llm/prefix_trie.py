"""A prefix trie over conversations: per distinct beginning its members and subtree sums.

A conversation c is rebuilt first: the first h turns of its head, conversation
c - c % 100, then its own turns after its first h; h = crc32(c) % 6. A node is a distinct
sequence of the first d turns (role, text); its key is the exclusive or of a 128-bit hash
of each turn with its place, so the keys of all beginnings come from one running sum.

1. Turns are numbered by a range partitioning (no conversation has to fit into a task) and
   gathered into segments of at most ``SEGMENT`` turns; equal segments become one, with a
   weight and its smallest conversation.
2. Segments go to prefix shards: by the key of their first turn, or of their first 2, 4,
   8 .. turns where more than ``SHARED`` distinct segments begin alike.
3. A shard numbers its turns densely and packs BASE and CHECK of a double-array trie. The
   segments are sent through it, all at once and place by place, which gives every state
   its members; then the subtree sums go up from the deepest states.
4. Nodes above a shard's prefix, and those that a segment passes on to the next one, have
   children elsewhere. Their parts are merged by key over all shards, and their subtree
   sums are made by pointer doubling over these nodes alone.

The digest of the conversations that end at a node is taken while their sorted ids stream
through a task; they are never held together.

Cases: a null role or text is empty; turns come in the order of ``turn``, null first, ties
by the hash of role and text; a repeated row is a further turn; rows with a null
conversation belong to none and are left out; a conversation without turns after its
rebuilding is a member of the root; an empty table gives an empty result; other columns
are ignored, whatever their names. Texts of any length are hashed whole.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatekit.llm.common import stored
from gatekit.llm.double_array import DoubleArray
from gatekit.llm.sharding import numbered

#: Turns of a segment.
SEGMENT = 1024
#: Distinct segments that may share a shard's prefix.
SHARED = 256
#: Turns that a shard gets on average.
SHARD_TURNS = 4096
#: Most turns that a conversation takes from its head (h is below that + 1).
HEAD = 5
BLOCK = 100

KEY = ["depth", "x1", "x2"]
_TURN = "struct<d:int,t1:long,t2:long,f1:long,f2:long,points:long>"


def rebuilt(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every conversation, and its turns (conv_id, length, d from 1,
    t1, t2: hash of the turn, points: code points of its text)."""
    r, t = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(r, t).alias("t1"),
        F.xxhash64(t, F.lit(7), r).alias("t2"), F.char_length(t).cast("long").alias("points"))
    rows, _ = numbered(rows, ["conv_id", "turn", "t1", "t2"])
    rows = stored(rows.select("conv_id", "t1", "t2", "points", "row_number"), "turns")
    own = rows.groupBy("conv_id").agg(F.min("row_number").alias("start"), F.count(F.lit(1)).alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).alias("h")
    own = stored(own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("head"), h, "start", "n"), "conversations")
    heads = own.filter(F.col("conv_id") == F.col("head")).select(F.col("conv_id").alias("head_id"), F.col("start").alias("head_start"), F.col("n").alias("head_n"))
    taken = F.least("h", F.coalesce("head_n", F.lit(0)))
    convs = own.join(heads, F.col("head") == F.col("head_id"), "left").withColumn("taken", taken).select(
        "conv_id", "head", "h", "start", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    pos = F.col("row_number") - F.col("start")
    tails = rows.join(convs, "conv_id").withColumn("pos", pos).filter(F.col("pos") >= F.col("h")).select(
        "conv_id", "length", (F.col("taken") + F.col("pos") - F.col("h") + 1).cast("int").alias("d"), "t1", "t2", "points")
    # at most HEAD turns of a head, for at most BLOCK conversations
    first = rows.filter(F.col("conv_id") % BLOCK == 0).join(own.select("conv_id", "start"), "conv_id").withColumn("pos", pos).filter(F.col("pos") < HEAD)
    first = first.select(F.col("conv_id").alias("head"), "pos", "t1", "t2", "points")
    begun = convs.filter(F.col("taken") > 0).join(first, "head").filter(F.col("pos") < F.col("taken")).select(
        "conv_id", "length", (F.col("pos") + 1).cast("int").alias("d"), "t1", "t2", "points")
    return convs.select("conv_id", "length"), begun.unionByName(tails)


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, length, at: depth before the segment, s1, s2 and e1, e2: keys of the
    nodes before and at its end, turns)."""
    hashed = turns.withColumn("f1", F.xxhash64("d", "t1", "t2")).withColumn("f2", F.xxhash64("t2", "t1", "d"))
    at = (F.expr(f"(d - 1) div {SEGMENT}") * SEGMENT).cast("int").alias("at")
    segs = stored(hashed.groupBy("conv_id", "length", at).agg(
        F.sort_array(F.collect_list(F.struct("d", "t1", "t2", "f1", "f2", "points"))).alias("turns"),
        F.bit_xor("f1").alias("e1"), F.bit_xor("f2").alias("e2")), "segments")
    zero = F.lit(0).cast("long")
    short = segs.filter(F.col("at") == 0).withColumns({"s1": zero, "s2": zero})
    if segs.filter(F.col("at") > 0).isEmpty():
        return short
    w = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = segs.filter(F.col("length") > SEGMENT).select("conv_id", "at", F.bit_xor("e1").over(w).alias("s1"), F.bit_xor("e2").over(w).alias("s2"))
    later = segs.filter(F.col("at") > 0).join(before, ["conv_id", "at"]).withColumns(
        {"e1": F.col("e1").bitwiseXOR(F.col("s1")), "e2": F.col("e2").bitwiseXOR(F.col("s2"))})
    return short.unionByName(later)


def _prefix_key(n: Column, start: str, part: str) -> Column:
    return F.aggregate(F.slice("turns", F.lit(1), n), F.col(start), lambda x, t: x.bitwiseXOR(t[part]))


def sharded(segs: DataFrame) -> DataFrame:
    """Distinct segments (at, s1, s2, more, turns, weight, least) with ``cut``, the length
    of their shard's prefix, and ``shard``."""
    more = (F.col("at") + F.size("turns") < F.col("length")).alias("more")
    own = ["at", "e1", "e2", "more"]
    some = stored(segs.select("conv_id", "at", "s1", "s2", "e1", "e2", more, "turns").groupBy(*own).agg(
        F.first("s1").alias("s1"), F.first("s2").alias("s2"), F.first("turns").alias("turns"),
        F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("least")), "distinct-segments")
    total = some.agg(F.sum(F.size("turns"))).first()[0] or 0
    lengths = [1 << k for k in range(SEGMENT.bit_length())]
    ladder = F.array(*[F.when(F.size("turns") >= n, F.struct(F.lit(n).alias("n"), _prefix_key(F.lit(n), "s1", "f1").alias("p1"), _prefix_key(F.lit(n), "s2", "f2").alias("p2"))) for n in lengths])
    steps = some.select(*own, F.inline(F.array_compact(ladder)))
    common = stored(steps.groupBy("at", "n", "p1", "p2").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > SHARED).drop("c"), "common-prefixes")
    if common.isEmpty():
        out = some.withColumn("cut", F.lit(1))
    else:  # the common ones among a segment's prefixes are its shortest
        cuts = steps.join(common, ["at", "n", "p1", "p2"]).groupBy(*own).agg((2 * F.max("n")).cast("int").alias("cut"))
        out = some.join(cuts, own, "left").withColumn("cut", F.coalesce("cut", F.lit(1)))
    p1, p2 = _prefix_key(F.col("cut"), "s1", "f1"), _prefix_key(F.col("cut"), "s2", "f2")
    shards = max(1, total // SHARD_TURNS)
    return out.withColumn("shard", F.pmod(F.xxhash64("at", p1, p2), F.lit(shards)))


_NODE = "depth int, x1 long, x2 long, p1 long, p2 long, conv_id long, n long, kids long, leaves long, saved long, points long, ends long, upper boolean, parent_conv_id long"


def _shard_nodes(rows: pa.Table) -> pa.Table:
    """The nodes of one shard, by a double-array trie over its segments."""
    at, s1, s2, weight, least, cut = (rows.column(c).to_numpy().astype(np.int64) for c in ("at", "s1", "s2", "weight", "least", "cut"))
    more = rows.column("more").to_numpy(zero_copy_only=False)
    turns = rows.column("turns").combine_chunks()
    size = np.diff(turns.offsets.to_numpy())
    flat = turns.flatten()
    t1, t2, f1, f2, points = (flat.field(c).to_numpy() for c in ("t1", "t2", "f1", "f2", "points"))
    first = np.cumsum(size) - size
    # dense ids of the turns, then of the nodes before the segments
    turn_ids = _dense(t1, t2)
    roots = _dense(at, s1, s2)
    symbol = roots + (turn_ids.max(initial=-1) + 1)
    ids = turn_ids.tolist()
    trie = DoubleArray.build([[r, *ids[a:a + n]] for r, a, n in zip(symbol.tolist(), first.tolist(), size.tolist())])
    m = len(trie.check)
    level = np.full(m, -1, np.int64)
    n, kids, leaves, saved, ends = (np.zeros(m, np.int64) for _ in range(5))
    conv, length = np.full(m, np.iinfo(np.int64).max), np.zeros(m, np.int64)
    depth, x1, x2, p1, p2 = (np.zeros(m, np.int64) for _ in range(5))
    upper = np.zeros(m, bool)
    # the segments, place by place
    state = trie.step(np.zeros(len(size), np.int64), symbol)
    y1, y2 = s1.copy(), s2.copy()
    level[state], depth[state], x1[state], x2[state], upper[state] = 0, at, s1, s2, True
    begins = at == 0  # the root's members; nodes between two segments get theirs from the first one
    np.add.at(n, state[begins], weight[begins])
    np.minimum.at(conv, state[begins], least[begins])
    for k in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > k)
        j = first[on] + k
        old, state[on] = state[on], trie.step(state[on], turn_ids[j])
        to = state[on]
        if (to < 0).any():
            raise ValueError("a segment is missing from its trie")
        p1[to], p2[to] = y1[on], y2[on]
        y1[on] ^= f1[j]
        y2[on] ^= f2[j]
        level[to], depth[to], x1[to], x2[to], length[to] = k + 1, at[on] + k + 1, y1[on], y2[on], points[j]
        np.add.at(n, to, weight[on])
        np.minimum.at(conv, to, least[on])
        upper[to[(k + 1 < cut[on]) | more[on]]] = True
    np.add.at(ends, state[~more], weight[~more])
    # subtree sums of the states whose subtree lies here, deepest first
    parent = trie.check
    for k in range(int(level.max()), 0, -1):
        here = np.flatnonzero((level == k) & ~upper)
        leaves[here] += kids[here] == 0
        saved[here] += (n[here] - 1) * length[here]
        for total, x in ((kids, np.ones(len(here), np.int64)), (leaves, leaves[here]), (saved, saved[here])):
            np.add.at(total, parent[here], x)
    out = np.flatnonzero(level >= 0)
    inside = ~upper[out] & ~upper[np.maximum(parent[out], 0)]
    met, top = n[out] > 0, level[out] == 0
    null = {"conv_id": ~met, "p1": top, "p2": top, "parent_conv_id": ~inside}
    got = {"depth": depth, "x1": x1, "x2": x2, "p1": p1, "p2": p2, "conv_id": conv, "n": n, "kids": kids, "leaves": leaves, "saved": saved, "points": length, "ends": ends}
    columns = {c: pa.array(v[out], pa.int32() if c == "depth" else pa.int64(), mask=null.get(c)) for c, v in got.items()}
    columns["upper"] = pa.array(upper[out])
    columns["parent_conv_id"] = pa.array(conv[np.maximum(parent[out], 0)], pa.int64(), mask=~inside)
    return pa.table(columns)


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 0 on of the distinct rows of some arrays."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), np.int64)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def upper_sums(parts: DataFrame) -> DataFrame:
    """The nodes with children in several places: (depth, x1, x2, p1, p2, conv_id, n,
    kids, leaves, saved, ends) from what the shards know of them."""
    merged = stored(parts.groupBy(*KEY).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.sum("kids").alias("kids"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("points").alias("points"), F.sum("ends").alias("ends")), "upper")
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")]
    further = merged.filter(F.col("depth") > 0).select(*up).groupBy(*KEY).agg(F.count(F.lit(1)).alias("more"))
    now = merged.join(further, KEY, "left").withColumn("kids", F.col("kids") + F.coalesce("more", F.lit(0)))
    now = now.withColumns({"leaves": F.col("leaves") + (F.col("kids") == 0).cast("long"), "saved": F.col("saved") + (F.col("n") - 1) * F.col("points"),
                           "j1": F.col("p1"), "j2": F.col("p2")}).drop("more", "points")
    now, far = stored(now, "upper"), 1
    deepest = now.agg(F.max("depth")).first()[0] or 0
    while far <= deepest:  # sums over less than `far` steps down become sums over less than twice that
        jump = [(F.col("depth") - far).alias("depth"), F.col("j1").alias("x1"), F.col("j2").alias("x2")]
        below = now.filter(F.col("depth") >= far).select(*jump, "leaves", "saved").groupBy(*KEY).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        beyond = now.select((F.col("depth") + far).alias("depth"), F.col("x1").alias("j1"), F.col("x2").alias("j2"), F.col("j1").alias("k1"), F.col("j2").alias("k2"))
        now = now.join(below, KEY, "left").join(beyond, ["depth", "j1", "j2"], "left").select(
            *KEY, "p1", "p2", "conv_id", "n", "kids", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), "ends", F.col("k1").alias("j1"), F.col("k2").alias("j2"))
        now, far = stored(now, "upper"), far * 2
    return now.drop("j1", "j2")


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of the conversations (conv_id) that end at each key.
    Their ids stream through a task in order; only one digest is held."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        names, kinds = [*KEY, "ends_sha256"], [pa.int32(), pa.int64(), pa.int64(), pa.string()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        for batch in batches:
            d, x1, x2, ids = (batch.column(c).to_numpy() for c in (*KEY, "conv_id"))
            cuts = np.flatnonzero((np.diff(d) != 0) | (np.diff(x1) != 0) | (np.diff(x2) != 0)) + 1
            done = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                if a == b:
                    continue
                text = ",".join(map(str, ids[a:b].tolist())).encode()
                here = (int(d[a]), int(x1[a]), int(x2[a]))
                if here == key:
                    sha.update(b"," + text)
                else:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = here, hashlib.sha256(text)
            if done:
                yield out(done)
        if key is not None:
            yield out([(*key, sha.hexdigest())])
    rows = ends.select(F.col("depth").cast("int").alias("depth"), "x1", "x2", "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return rows.mapInArrow(digests, "depth int, x1 long, x2 long, ends_sha256 string")


def trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    convs, turns = rebuilt(conversations, conv, turn, role, text)
    convs = stored(convs, "rebuilt")
    segs = stored(segments(turns), "segments")
    nodes = stored(sharded(segs).groupBy("shard").applyInArrow(_shard_nodes, _NODE), "nodes")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    still = convs.filter(F.col("length") == 0)
    root = still.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0).select(
        F.lit(0).alias("depth"), zero.alias("x1"), zero.alias("x2"), none.alias("p1"), none.alias("p2"), "conv_id", "n", zero.alias("kids"),
        zero.alias("leaves"), zero.alias("saved"), zero.alias("points"), F.col("n").alias("ends"))
    upper = upper_sums(nodes.filter("upper").drop("upper", "parent_conv_id").unionByName(root))
    columns = ["depth", "x1", "x2", "conv_id", "parent_conv_id", "n", "kids", "leaves", "saved", "ends"]
    above = upper.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.filter(~F.col("upper"))
    every = (inner.filter(F.col("parent_conv_id").isNotNull()).select(*columns)
             .unionByName(inner.filter(F.col("parent_conv_id").isNull()).drop("parent_conv_id").join(above, ["depth", "p1", "p2"]).select(*columns))
             .unionByName(upper.join(above, ["depth", "p1", "p2"], "left").select(*columns)))
    ends = segs.filter(F.col("at") + F.size("turns") == F.col("length")).select(F.col("length").alias("depth"), F.col("e1").alias("x1"), F.col("e2").alias("x2"), "conv_id")
    ends = ends.unionByName(still.select(F.col("length").alias("depth"), zero.alias("x1"), zero.alias("x2"), "conv_id"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    done = every.filter(F.col("ends") > 0).join(end_digests(ends), KEY).unionByName(every.filter(F.col("ends") == 0).withColumn("ends_sha256", empty))
    return done.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
                       F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")
