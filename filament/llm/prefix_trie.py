"""Operator 12, prefix trie of conversations: which opening turns are shared, by whom, and what sharing saves.

A node is a distinct sequence of first turns (role, text); the conversations that start with it are its members.
No trie is built.  The conversations' sequences are sorted, and a node is an interval of the sorted row whose
inner neighbours share at least ``depth`` turns (LCP).  Over the LCPs stands a sparse table of range minima; each
prefix searches the left and the right end of its interval in it by halving steps, by itself (``Extents``).  Prefixes
that a row does not share with the one before it are the candidates, each a node of its own; they come in
preorder, so sums over subtrees are differences of running sums.

How it runs on many tasks:

1. Turns are numbered and shrink to a 128-bit hash and a length; equal sequences mean equal hashes (not compared
   byte by byte).  A running XOR of position-salted hashes tells which prefixes stand in two conversations; a
   conversation goes into the sorted row only up to one turn beyond what it shares, so a long one is short
   there.  Its other nodes have one member and one child and come straight from its turns.
2. The sequences are range-partitioned by (sequence, id), so copies spread over tasks, and each sorted partition (block)
   is searched by itself.  Nodes that hold neither the block's first nor last row lie in it and are whole.
3. Nodes that hold one of these may go on in other blocks.  The first and last rows of all blocks are a sorted
   row again, of two rows a block; the same search over its LCPs gives each such part the name of its node, its leftmost
   row there.  Parts are added up by name, and sums over the subtrees of these nodes are differences again.

What the driver holds is three numbers a block.

Defined results: turns of a conversation are in ascending order, null first, equal ones by content; null role
or text is empty; rows without a conversation id belong to none; repeated rows are turns each; an empty table
gives no rows, the root included.  Texts of any length count whole.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, staged

#: fixed values: head turns that may be shared, conversations that share a donor
HEAD_MOD = 6
GROUP = 100
#: sequences of a block; fewer where the session asks for more partitions
BLOCK_ROWS = 1 << 15
BROADCAST_NODES = 1 << 20
HEX = 32  # characters of a turn's hash
NO_LCP = (1 << 31) - 1


def turn_rows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, pos`` (from 1), ``hash, size`` (code points of the text) of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # the role's length tells where the text begins
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, HEX)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), key.alias("hash"),
                        F.length(text).cast("long").alias("size")).where("conv IS NOT NULL")
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "hash")
    return rows.select("conv", F.row_number().over(order).cast("long").alias("pos"), "hash", "size")


def with_shared_heads(rows: DataFrame, head_mod: int = HEAD_MOD, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Each conversation c gets the first h turns of conversation c - c % group, then its own after its first h;
    h = crc32(c as text) % head_mod.  Returns the new rows and ``conv, n_turns`` of all conversations (0 too)."""
    donor = (F.col("conv") - F.col("conv") % group).alias("donor")
    h = (F.crc32(F.col("conv").cast("string")) % head_mod).alias("h")
    heads = rows.where((F.col("conv") % group == 0) & (F.col("pos") < head_mod))
    given = heads.groupBy(F.col("conv").alias("donor")).agg(F.max("pos").alias("given"))
    taken = F.least("h", F.coalesce("given", F.lit(0)))
    convs = rows.groupBy("conv").agg(F.max("pos").alias("n")).select("conv", "n", donor, h).join(given, "donor", "left").select(
        "conv", "donor", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    convs = staged(convs)
    own = rows.select("*", donor, h).where("pos > h").join(given, "donor", "left").select(
        "conv", (F.col("pos") - F.col("h") + taken).alias("pos"), "hash", "size")
    lent = convs.join(heads.select(F.col("conv").alias("donor"), "pos", "hash", "size"), "donor").where("pos <= taken").select("conv", "pos", "hash", "size")
    return own.unionByName(lent), convs.select("conv", "n_turns")


class Extents:
    """Ends of intervals of a sorted row: ``lcp[i]`` is what rows i - 1 and i share (``lcp[0]`` is not read)."""

    def __init__(self, lcp: np.ndarray):
        self.n, self.table, width = len(lcp), [lcp], 1
        while 2 * width <= self.n:
            self.table.append(np.minimum(self.table[-1][:-width], self.table[-1][width:]))
            width *= 2

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row that shares ``depth`` turns with row ``at`` and all between."""
        at = np.array(at, np.int64)
        for k in reversed(range(len(self.table))):
            to = at - (1 << k)
            at = np.where((to >= 0) & (self.table[k][np.maximum(to + 1, 0).clip(max=len(self.table[k]) - 1)] >= depth), to, at)
        return at

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last such row."""
        at = np.array(at, np.int64)
        for k in reversed(range(len(self.table))):
            to = at + (1 << k)
            at = np.where((to < self.n) & (self.table[k][(at + 1).clip(max=len(self.table[k]) - 1)] >= depth), to, at)
        return at

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The minimum of rows a to b."""
        out = np.empty(len(a), self.table[0].dtype)
        level = np.frexp((b - a + 1).astype(float))[1] - 1
        for k in np.unique(level).tolist():
            at = level == k
            out[at] = np.minimum(self.table[k][a[at]], self.table[k][b[at] - (1 << k) + 1])
        return out


def shared_turns(a: str, b: str) -> int:
    """How many first turns two sequences of hashes share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // HEX
    x, y = (np.frombuffer(s[:n].encode(), np.uint8) for s in (a, b))
    return int(np.argmax(x != y)) // HEX


def id_list(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


NODE = {"conv": "long", "depth": "long", "parent": "long", "n_convs": "long", "n_children": "long", "n_leaves": "long", "saved": "long", "ends": "string"}
# of nodes that may go on in other blocks: row of the block's ends that they hold (2 * block: first, + 1: last), their parent's
# (nodes under such a parent have it too), size of the last text, whether turns were cut off; block: its ends
PART = {"kind": "string", "block": "int", "row": "int", "parent_row": "int", "size": "long", "cut": "boolean",
        "first": "string", "last": "string", "inner": "int"}


def search_block(conv: np.ndarray, n_turns: np.ndarray, seqs: list[str], sizes: list[np.ndarray], block: int):
    """All nodes of one block; ``seqs`` sorted, then ``conv``."""
    n = len(conv)
    held = np.array([len(s) // HEX for s in seqs])
    lcp = np.array([-1, *(shared_turns(a, b) for a, b in zip(seqs, seqs[1:]))], np.int64)
    extents, least_conv = Extents(lcp), Extents(conv)
    new = held - lcp
    start = np.append(0, np.cumsum(new))
    owner = np.repeat(np.arange(n), new)
    depth = np.arange(start[-1]) - start[owner] + lcp[owner] + 1
    left, right = extents.left(owner, depth), extents.right(owner, depth)
    members = right - left + 1
    least = least_conv.least(left, right)
    above = extents.left(np.arange(n), np.maximum(lcp, 0))  # who owns the node where a row leaves the one before it
    opens = depth == lcp[owner] + 1
    parent = np.where(opens, start[above[owner]] + lcp[owner] - lcp[above[owner]] - 1, np.arange(len(owner)) - 1)
    whole = (left > 0) & (right < n - 1)
    below = parent[whole]
    children = np.bincount(below, minlength=len(owner)) if len(below) else np.zeros(len(owner), np.int64)
    at_end = depth == held[owner]
    cut = at_end & (n_turns[owner] > held[owner])
    children = children + (cut & whole)
    flat = np.concatenate([np.zeros(0, np.int64), *sizes])
    last_size = np.zeros(len(owner), np.int64)
    last_size[depth > 0] = flat[((np.cumsum(held) - held)[owner] + depth - 1)[depth > 0]]
    leaf = whole & ((children == 0) | cut)
    saved = np.where(whole, (members - 1) * last_size, 0)
    stop = start[right + 1]
    sums = [np.append(0, np.cumsum(x)) for x in (leaf, saved)]
    n_leaves, saved = (s[stop] - s[:-1] for s in sums)
    # members that end here: the interval's first rows, if its owner does
    copy = np.append(False, (lcp[1:] == held[1:]) & (held[1:] == held[:-1]))
    run_end = np.append(np.flatnonzero(~copy)[1:], n)[np.cumsum(~copy) - 1] if n else copy
    ends = [id_list(conv[i:run_end[i]]) if e else "" for i, e in zip(owner.tolist(), (at_end & ~cut).tolist())]
    row = np.where(left == 0, 2 * block, 2 * block + 1)
    known = parent >= 0
    above_whole = known & whole[parent]
    common = {"conv": least, "depth": depth, "n_convs": members, "n_children": children, "n_leaves": n_leaves, "saved": saved, "block": np.full(len(owner), block),
              "kind": np.where(whole, "node", "part"), "size": last_size, "cut": cut, "row": row,
              "parent_row": np.where(above_whole, -1, np.where(known, row[parent], -1)), "parent": np.where(above_whole, least[parent], -1),
              "ends": [digest(e) if w else e for w, e in zip(whole.tolist(), ends)]}
    none = [None] * len(owner)
    yield common | {"first": none, "last": none, "inner": none}
    yield {c: [None] for c in (*NODE, *PART)} | {"kind": ["block"], "block": [block], "first": [seqs[0]], "last": [seqs[-1]],
                                               "inner": [int(lcp[1:].min()) if n > 1 else NO_LCP]}


def searched(seqs: DataFrame, n_blocks: int) -> DataFrame:
    """Nodes, parts and block ends of ``conv, n_turns, seq, sizes``."""

    def run(batches):
        conv, n_turns, seq, sizes = [], [], [], []
        for b in batches:
            conv.append(b.column("conv").to_numpy())
            n_turns.append(b.column("n_turns").to_numpy())
            seq += b.column("seq").to_pylist()
            sizes += [np.array(s, np.int64) for s in b.column("sizes").to_pylist()]
        if conv:
            yield from search_block(np.concatenate(conv), np.concatenate(n_turns), seq, sizes, TaskContext.get().partitionId())

    ranged = seqs.repartitionByRange(n_blocks, "seq", "conv").sortWithinPartitions("seq", "conv")
    return staged(arrow_map(ranged, run, ", ".join(f"{k} {t}" for k, t in (NODE | PART).items())))


def ends_of_blocks(found: DataFrame):
    """The sorted row of the blocks' first and last rows: block numbers and LCPs (three numbers a block)."""
    spark = found.sparkSession
    blocks = found.where("kind = 'block'").select("block", "first", "last", "inner")
    inner = sorted((r["block"], r["inner"]) for r in blocks.select("block", "inner").collect())
    numbers = [b for b, _ in inner]
    if not numbers:
        return spark.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    before = spark.createDataFrame([(b, a) for a, b in zip(numbers, numbers[1:])] or [(-1, -1)], "block int, before int")

    def share(batches):
        for b in batches:
            yield {"block": b.column(0), "n": [shared_turns(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]}

    pairs = blocks.join(F.broadcast(before), "block").select("before", "block", "first").join(
        blocks.select(F.col("block").alias("before"), "last"), "before").select("block", "first", "last")
    border = {r["block"]: r["n"] for r in arrow_map(pairs, share, "block int, n int").collect()}
    lcp = [x for b, i in inner for x in (border.get(b, -1), i)]
    return spark.sparkContext.broadcast((np.array(numbers, np.int64), np.array(lcp, np.int64)))


def named(df: DataFrame, ends, row: str, depth, name: str, last: bool = False) -> DataFrame:
    """Adds ``name``, the leftmost (or rightmost) end of a block in the node of that depth that holds end ``row``."""
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*df.schema.fields, StructField(name, LongType())])
    names = df.columns

    def run(batches):
        numbers, lcp = ends.value
        extents = Extents(lcp)
        for b in batches:
            r = np.array(b.column(row).to_pylist(), np.int64)
            at = 2 * np.searchsorted(numbers, r >> 1) + (r & 1)
            d = np.array(b.column(depth).to_pylist(), np.int64)
            yield {c: b.column(c) for c in names} | {name: (extents.right if last else extents.left)(at, d)}

    return arrow_map(df, run, schema)


def spine(parts: DataFrame, ends) -> DataFrame:
    """The nodes that hold an end of a block, whole: ``at, depth`` (their name) and the columns of ``NODE``."""
    spark = parts.sparkSession
    parts = named(named(parts.drop("first", "last", "inner", "kind", "parent").withColumn("up", F.col("depth") - 1), ends, "row", "depth", "at"),
                  ends, "row", "depth", "stop", last=True)
    parts = parts.withColumn("above", F.when(F.col("up") >= 0, F.col("row")).otherwise(F.lit(None)))
    parts = staged(named(parts.withColumn("above", F.coalesce("above", "row")).withColumn("up", F.greatest("up", F.lit(0))), ends, "above", "up", "parent_at"))
    whole = parts.groupBy("at", "depth").agg(
        F.min("conv").alias("conv"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.max("size").alias("size"), F.max("cut").alias("cut"), F.max("stop").alias("stop"), F.max("parent_at").alias("parent_at"))
    whole = staged(whole)
    kids = whole.where("depth > 0").groupBy(F.col("parent_at").alias("at"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("kids"))
    whole = whole.join(kids, ["at", "depth"], "left").withColumn(
        "n_children", F.col("inner_children") + F.coalesce("kids", F.lit(0)) + F.col("cut").cast("long"))
    own_leaf = F.when((F.col("n_children") == 0) | F.col("cut"), 1).otherwise(0)
    below = Window.partitionBy("at").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    whole = whole.withColumn("own_leaf", own_leaf).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("size"))
    whole = staged(whole.withColumn("leaf_run", F.sum("own_leaf").over(below)).withColumn("saved_run", F.sum("own_saved").over(below)))
    # running sums over the ends of blocks
    n = len(ends.value[1])
    totals = np.zeros((2, n + 1), np.int64)
    for r in whole.groupBy("at").agg(F.sum("own_leaf").alias("l"), F.sum("own_saved").alias("s")).collect():  # an end of a block each
        totals[:, r["at"] + 1] = r["l"], r["s"]
    runs = spark.sparkContext.broadcast(np.cumsum(totals, axis=1))
    kept = whole.select("at", "depth", "conv", "n_convs", "n_children", "parent_at", "leaves", "leaf_run", "saved", "saved_run", "stop")

    def subtree(batches):
        for b in batches:
            at, stop = (b.column(c).to_numpy() for c in ("at", "stop"))
            leaf, saved = (x[stop + 1] - x[at + 1] for x in runs.value)
            yield {c: b.column(c) for c in ("at", "depth", "conv", "n_convs", "n_children", "parent_at")} | {
                "n_leaves": leaf + b.column("leaves").to_numpy() + b.column("leaf_run").to_numpy(),
                "saved": saved + b.column("saved").to_numpy() + b.column("saved_run").to_numpy()}

    summed = arrow_map(kept, subtree, "at long, depth long, conv long, n_convs long, n_children long, parent_at long, n_leaves long, saved long")

    def hashed(batches):
        """One state at a time over parts in order: memory does not grow with a node's members."""
        key, state = None, None
        for b in batches:
            for k, text in zip(zip(b.column("at").to_pylist(), b.column("depth").to_pylist()), b.column("ends").to_pylist()):
                if k != key:
                    if key is not None:
                        yield {"at": [key[0]], "depth": [key[1]], "ends": [state.hexdigest()]}
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if key is not None:
            yield {"at": [key[0]], "depth": [key[1]], "ends": [state.hexdigest()]}

    lists = parts.where("ends <> ''").select("at", "depth", "block", "ends").repartition("at", "depth").sortWithinPartitions("at", "depth", "block")
    out = summed.join(arrow_map(lists, hashed, "at long, depth long, ends string"), ["at", "depth"], "left").withColumn(
        "ends", F.coalesce("ends", F.lit(digest(""))))
    up = out.select(F.col("at").alias("parent_at"), F.col("depth").alias("up"), F.col("conv").alias("parent"))
    return staged(out.withColumn("up", F.col("depth") - 1).join(up, ["parent_at", "up"], "left").select("at", *NODE))


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the conversations' trie: ``conv`` (smallest member), ``depth, parent`` (its parent's
    conv), ``n_convs, n_children, n_leaves, saved`` (over the subtree, (members - 1) * size of the last text) and
    ``ends`` (SHA-256 of the ids that end there).  ``rows``: conv, pos from 1 without gaps, hash, size; ``convs``: conv, n_turns."""
    spark = rows.sparkSession
    running = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = staged(rows.withColumn("prefix", F.bit_xor(F.xxhash64("pos", "hash")).over(running)))
    twice = rows.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1").select("prefix")
    shared = rows.join(twice, "prefix", "left_semi").groupBy("conv").agg(F.max("pos").alias("shared"))
    convs = staged(convs.join(shared, "conv", "left").select("conv", "n_turns", F.coalesce("shared", F.lit(0)).alias("shared")))
    rows = rows.join(convs, "conv").select("conv", "pos", "hash", "size", "n_turns", "shared")
    heads = rows.where("pos <= shared + 1").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("pos", "hash", "size"))).alias("turns"))
    seqs = convs.join(heads, "conv", "left").select(
        "conv", "n_turns", F.coalesce(F.array_join(F.col("turns.hash"), ""), F.lit("")).alias("seq"),
        F.coalesce(F.col("turns.size"), F.array().cast("array<long>")).alias("sizes"))
    seqs = staged(seqs)
    n_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seqs.count() // BLOCK_ROWS))
    found = searched(seqs, n_blocks)
    ends = ends_of_blocks(found)
    top = spine(found.where("kind = 'part'"), ends)
    nodes = found.where("kind = 'node'")
    loose = named(nodes.where("parent_row >= 0").drop("parent", "kind", "first", "last", "inner").withColumn("up", F.col("depth") - 1), ends, "parent_row", "up", "at")
    above = top.select("at", F.col("depth").alias("up"), F.col("conv").alias("parent"))
    if above.count() <= BROADCAST_NODES:
        above = F.broadcast(above)
    tails = rows.where("pos > shared + 1").select(
        "conv", F.col("pos").alias("depth"), F.col("conv").alias("parent"), F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("pos") < F.col("n_turns"), 1).otherwise(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved"), F.when(F.col("pos") < F.col("n_turns"), F.lit(digest(""))).otherwise(
            F.sha2(F.col("conv").cast("string").cast("binary"), 256)).alias("ends"))
    return nodes.where("parent_row < 0").select(*NODE).unionByName(loose.join(above, ["at", "up"]).select(*NODE)).unionByName(
        top.select(*NODE)).unionByName(tails)
