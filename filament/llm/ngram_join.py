"""Operator 10, n-gram Jaccard join by prefix trees.

A document's set: the distinct ``N``-word shingles of its whole text, A-Z lower-cased, words cut
at white space; fewer words form one shingle; no words, no set and no link.  Shingles are 58-bit
hashes; above them 6 bits hold how common the shingle is, so numeric order is the global
order: rare ones first.  Commonness only orders, the results don't depend on it: for a share of
all shingles (dealt by hash, far more than prefixes need) Spark finds over all documents which stand in
one place only, and how often the most common ones stand; the other shingles come last.

Two sets with Jaccard >= ``T`` share a shingle among the first |x| - ceil(T |x|) + 1 of each.
1. Equal sets form a class; from here on one set stands for it.
2. Shingles that stand in the prefixes of several classes of like length link candidates: a set
   of n shingles is filed under the shingle and its length's power of 1/T and the next, which any
   partner shares; the shorter of two partners has a shared shingle already among its first
   n - ceil(2T/(1+T) n) + 1, so groups in which no set has are left out.  Each candidate
   goes to the block of the smallest class it shares a shingle with.
3. A block's sets are stored in a trie; each set walks it, carrying the overlap of the
   shared path, and leaves subtrees that cannot reach the overlap needed by their
   remaining lengths, or that hold its own component only.  Its links go to ``components``.
4. Shingles whose sets are still in several components are joined the same way, each
   group of candidates once.  Sets of groups larger than ``BLOCK`` are filed anew: cut by hash into
   more parts than partners' sets may differ in shingles (``part_keys``), so that partners agree in a part.
   Groups that are large even so are cut into sub-blocks that meet in pairs.  No pair of candidates is left out.
Blocks hold at most about ``BLOCK`` sets (and of long ones fewer), so no group lands in one task.  Before sets are sent, their
parities (``parity``, about 1/20 of a set) meet in the blocks: two sets differ in at least as many shingles
as their parities do in bits, so sets that can reach no set of another component there stay away.

Defined results: a null text is empty: 0 shingles, its own component.  Rows with equal ids are
joined by their texts like others; a null id is passed over when the smallest id is taken.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ID_BYTES, arrow_map, components, semi_join_ids, staged
from .keyset import LOW, distinct, maybe_repeated, mix, repeated_keys

N = 3
T_NUM, T_DEN = 9, 10
BLOCK = 512
#: bytes of sets that a trie is made of
BLOCK_BYTES = 32 << 20
LEVEL_SHIFT = np.uint64(58)
HASH_MASK = np.uint64((1 << 58) - 1)
UNKNOWN = 62
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93)


def shingle_hashes(text: str | None, n: int = N) -> np.ndarray:
    """The distinct shingles of a text as sorted 58-bit hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        h = mix(h + w[i:len(w) - size + 1 + i] * np.uint64(MULTIPLIERS[i % 5] + 2 * (i // 5)))
    return distinct(h & HASH_MASK)[0]


class Order:
    """The global order of shingles: ``bitmap`` knows the repeated among the sampled ones, ``common``
    the counts of the most common."""

    def __init__(self, sampled: int, bitmap, common: tuple[np.ndarray, np.ndarray]):
        self.sampled, self.bitmap, (self.keys, counts) = sampled, bitmap, common
        self.levels = np.array([min(60, 2 + int(n).bit_length()) for n in counts], np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Hashes with their level on top, in global order."""
        if not len(hashes):
            return hashes
        k = mix(hashes)
        level = np.where(sampled(k, self.sampled), maybe_repeated(k, self.bitmap).astype(np.uint64), np.uint64(UNKNOWN))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, k & LOW), len(self.keys) - 1)
            level = np.where((self.keys[at] == k & LOW) & (level == 1), self.levels[at], level)
        return np.sort(hashes | level << LEVEL_SHIFT)


def sampled(keys: np.ndarray, sixteenths: int) -> np.ndarray:
    return (keys & np.uint64(15)) < sixteenths


def prefix_length(n: int, num: int = T_NUM, den: int = T_DEN) -> int:
    return n - -(-num * n // den) + 1 if n else 0


def length_class(n: int, num: int, den: int) -> int:
    """The power of den/num that a length reaches; partners' classes differ by one at most."""
    k, limit = 0, 1.0
    while limit * den / num <= n:
        limit, k = limit * den / num, k + 1
    return k


def parity(s: np.ndarray) -> bytes:
    """A bit for each value of the shingles' low hash bits: do an odd number of them have it?  Halves
    combined by exclusive or are the parity of half the width."""
    width = max(64, 1 << (2 * len(s) - 1).bit_length())
    at = (mix(s & HASH_MASK) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=width).astype(np.uint8) & 1, bitorder="little").tobytes()


def reaching(sizes: list[int], parities: list[bytes], known: list, num: int, den: int) -> np.ndarray:
    """Which sets have one of another component that they may link with, going by sizes and parities."""
    width = min(map(len, parities)) // 8
    bits = []
    for p in parities:
        x = np.frombuffer(p, np.uint64)
        while len(x) > width:
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        bits.append(x)
    bits, n = np.array(bits), np.array(sizes, np.int64)
    firsts: dict = {}
    part = np.array([firsts.setdefault(k, i) if k is not None else i for i, k in enumerate(known)])
    out = np.zeros(len(n), bool)
    for i in range(1, len(n)):
        both = n[i] + n[:i]
        least = np.bitwise_count(bits[i] ^ bits[:i]).sum(axis=1, dtype=np.int64)  # they differ in
        shared = np.minimum((both - least) // 2, np.minimum(n[i], n[:i]))
        near = (shared * (num + den) >= num * both) & (part[:i] != part[i])
        out[:i] |= near
        out[i] = near.any()
    return out


def part_keys(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set of which two sets with Jaccard >= num/den share one: for its length's class and the next, the
    hash space is cut into more parts than partners may differ in shingles, and each part's content is a
    key.  Empty parts are keys only where a set has too few others to agree with any partner in one of those."""
    h, n, out = mix(s & HASH_MASK), len(s), []
    for k in (length_class(n, num, den), length_class(n, num, den) + 1):
        longest = int((den / num) ** (k + 1)) + 1
        most = 2 * (den - num) * longest // (num + den)  # partners differ in
        parts = most + most // 4 + 2
        place = (mix(h + np.uint64(MULTIPLIERS[1])) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        first = np.flatnonzero(np.diff(place[order], prepend=-1))
        at, content = place[order][first], np.add.reduceat(h[order], first)
        if len(at) <= min(most, (den - num) * n // num):
            none = np.setdiff1d(np.arange(parts), at)
            at, content = np.append(at, none), np.append(content, np.zeros(len(none), np.uint64))
        out.append(mix(content + mix(at.astype(np.uint64) + np.uint64(k << 32))))
    return np.concatenate(out).astype(np.int64)


class Trie:
    """Sets in global order as a path-compressed trie, and the walk that joins a set with it.

    Built from the sorted sets: neighbours' common prefixes give the nodes.  A node is
    ``[label, depth, shortest, longest, children, members, one, heads, rank]``: the shingles on its
    edge, where they begin, the lengths below it, children, sets that end here, a component that
    all sets below belong to (or None), and the beginnings of the children's edges side by side,
    so that a walk tests the bounds of many children at once, and the place of its first set in
    sorted order (a set only looks for partners before it, so each pair is tested once).
    """

    def __init__(self, sets: list[np.ndarray], parent: list[int]):
        self.sets, self.parent = sets, parent
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.rank = {i: k for k, i in enumerate(order)}
        self.root = self.build(order, 0) if order else None

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def build(self, order: list[int], depth: int) -> list:
        root, stack = None, [(order, depth, None)]
        while stack:
            group, at, above = stack.pop()
            first, last = self.sets[group[0]], self.sets[group[-1]]
            m = min(len(first), len(last))
            differ = np.flatnonzero(first[at:m] != last[at:m])
            end = at + int(differ[0]) if len(differ) else m
            lengths = [len(self.sets[i]) for i in group]
            members = [i for i in group if len(self.sets[i]) == end]
            parts = {self.find(i) for i in group}
            node = [first[at:end], at, min(lengths), max(lengths), [], members, group[0] if len(parts) == 1 else None, None, self.rank[group[0]]]
            rest = [i for i in group if len(self.sets[i]) > end]
            a = 0
            while a < len(rest):
                head, b = self.sets[rest[a]][end], a + 1
                while b < len(rest) and self.sets[rest[b]][end] == head:
                    b += 1
                stack.append((rest[a:b], end, node))
                a = b
            if above is None:
                root = node
            else:
                above[4].append(node)
        return root

    def walk(self, q: int, num: int, den: int) -> list[int]:
        """Links of set ``q`` that join its component to others; unites them on the way."""
        x, links, place = self.sets[q], [], self.rank[q]
        size = len(x)
        stack = [(self.root, 0, 0)]
        while stack:
            node, seen, shared = stack.pop()
            own = self.find(q)
            if node[8] >= place or node[6] is not None and self.find(node[6]) == own:
                continue
            label, depth, lo, hi, children, members = node[:6]
            for a in range(0, len(label), 128):  # the bound is looked at along long edges too
                part = label[a:a + 128]
                at = np.searchsorted(x[seen:], part)
                inside = at < size - seen
                shared += int(np.count_nonzero(x[seen:][at[inside]] == part[inside]))
                depth += len(part)
                seen += int(np.searchsorted(x[seen:], part[-1], "right"))
                best = min(max(size - seen + depth, lo), hi)  # the length below that comes closest
                if (shared + min(size - seen, best - depth)) * (num + den) < num * (size + best):
                    break
            else:
                for y in members:
                    if self.rank[y] < place and self.find(y) != own and shared * (num + den) >= num * (size + len(self.sets[y])):
                        self.parent[self.find(y)] = own
                        links.append(y)
                if not children and all(self.find(y) == own for y in members):
                    node[6] = own
                if len(children) > 3:
                    children = self.reachable(node, x, seen, shared, num, den)
                stack += [(c, seen, shared) for c in children]
        return links

    def reachable(self, node: list, x: np.ndarray, seen: int, shared: int, num: int, den: int) -> list:
        """The children whose bound holds behind the first shingles of their edges (about as many as
        a partner may lack), tested side by side."""
        children = node[4]
        if node[7] is None:
            width = min(512, 16 + int(1.2 * node[3] * (den - num) / (den + num)))
            heads = np.full((len(children), width), ~np.uint64(0))
            sizes = np.array([min(width, len(c[0])) for c in children])
            for row, c, n in zip(heads, children, sizes):
                row[:n] = c[0][:n]
            node[7] = (heads, sizes, heads[np.arange(len(children)), sizes - 1],
                       np.array([c[2] for c in children]), np.array([c[3] for c in children]))
        heads, sizes, last, lo, hi = node[7]
        rest, size = x[seen:], len(x)
        at = np.searchsorted(rest, heads.ravel())
        hit = at < len(rest)
        hit[hit] = rest[at[hit]] == heads.ravel()[hit]
        both = shared + hit.reshape(heads.shape).sum(axis=1)  # the filling is no shingle
        gone = seen + np.searchsorted(rest, last, "right")
        depth = node[1] + len(node[0]) + sizes
        best = np.clip(size - gone + depth, lo, hi)
        good = (both + np.minimum(size - gone, best - depth)) * (num + den) >= num * (size + best)
        return [children[i] for i in np.flatnonzero(good)]


def join_block(nodes: list[bytes], sets: list[np.ndarray], known: list, num: int, den: int) -> list[tuple[bytes, bytes]]:
    """Links that, with ``known`` components, connect whatever of the block is connected."""
    firsts: dict = {}
    parent = [firsts.setdefault(k, i) if k is not None else i for i, k in enumerate(known)]
    trie = Trie(sets, parent)
    return [(nodes[q], nodes[y]) for q in range(len(sets)) for y in trie.walk(q, num, den)]


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (staged, with ``id`` and ``tkey``) and the texts ``t`` that they name."""
    size = wanted.agg(F.sum(F.lit(64) + (8 * F.size("blocks") if "blocks" in wanted.columns else F.lit(0)))).first()[0] or 0
    side = (F.broadcast(wanted) if size <= BROADCAST_ID_BYTES else wanted).withColumnRenamed("id", "wid").withColumnRenamed("tkey", "wkey")
    return docs.join(side, F.col("id").eqNullSafe(F.col("wid")) & (F.col("tkey") == F.col("wkey")))


def may_link(members: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """``members`` without the blocks in which a class can link with none of another component."""
    rows = members.join(classes.select("sig", "n", "parity"), "sig").select(F.explode("blocks").alias("block"), "sig", "known", "n", "parity")
    rows = rows.repartition("block").sortWithinPartitions("block", "sig")

    def run(batches):
        block, held = None, ([], [], [], [])

        def close():
            out: dict = {"block": [], "sig": [], "known": []}
            at = np.flatnonzero(reaching(*held[1:], num, den)) if len(held[0]) > 1 else []
            pieces = -(-2 * sum(8 * held[1][i] for i in at) // BLOCK_BYTES)
            pairs = combinations(range(pieces), 2) if pieces > 2 else [(0, 0)]  # long sets meet in pairs of pieces
            for k, pair in enumerate(pairs):
                own = [i for m, i in enumerate(at) if pieces <= 2 or m % pieces in pair]
                out["block"] += [xxhash.xxh3_64_intdigest(f"{block} {k}") - (1 << 63)] * len(own)
                out["sig"] += [held[0][i] for i in own]
                out["known"] += [held[3][i] for i in own]
            return out

        for b in batches:
            for key, sig, known, n, bits in zip(*(c.to_pylist() for c in b.columns)):
                if key != block:
                    if held[0]:
                        yield close()
                    block, held = key, ([], [], [], [])
                if not held[0] or held[0][-1] != sig:
                    for to, v in zip(held, (sig, n, bits, known)):
                        to.append(v)
        if held[0]:
            yield close()

    near = arrow_map(rows, run, "block long, sig binary, known binary")
    return near.groupBy("sig", "known").agg(F.collect_set("block").alias("blocks"))


def join_blocks(docs: DataFrame, members: DataFrame, classes: DataFrame, order: Callable, n: int, num: int, den: int) -> DataFrame:
    """A trie per block: ``members(sig, blocks, known)`` says which blocks a class goes to, and
    ``classes(sig, id, tkey, n, parity)`` which document gives its set.  Sets are made from the texts and go, in
    one shuffle, to those of their blocks where they may link.  Returns ``u, v``."""
    wanted = staged(may_link(members, classes, num, den).join(classes.drop("n", "parity"), "sig"))
    texts = texts_of(docs, wanted)

    def deal(batches):
        ranked = order()
        names = ("block", "sig", "known", "set")
        for b in batches:
            out: dict = {k: [] for k in names}
            size = 0
            for text, sig, known, blocks in zip(*(c.to_pylist() for c in b.columns)):
                own = ranked(shingle_hashes(text, n)).tobytes()
                for block in blocks:
                    for k, v in zip(names, (block, sig, known, own)):
                        out[k].append(v)
                    size += len(own)
                    if size > 4 << 20:
                        yield out
                        out, size = {k: [] for k in names}, 0
            yield out

    rows = arrow_map(texts.select("t", "sig", "known", "blocks"), deal, "block long, sig binary, known binary, set binary")
    rows = rows.repartition("block").sortWithinPartitions("block", "sig")

    def run(batches):
        block, held = None, ([], [], [])

        def close():
            links = join_block(*held, num, den) if len(held[0]) > 1 else []
            return {"u": [a for a, _ in links], "v": [b for _, b in links]}

        for b in batches:
            for at in range(0, b.num_rows, 64):  # sets are long; few at a time leave Arrow's memory
                for key, sig, known, data in zip(*(c.to_pylist() for c in b.slice(at, 64).columns)):
                    if key != block:
                        if held[0]:
                            yield close()
                        block, held = key, ([], [], [])
                    if held[0] and held[0][-1] == sig:
                        continue
                    held[0].append(sig)
                    held[1].append(np.frombuffer(data, np.uint64))
                    held[2].append(known)
        if held[0]:
            yield close()

    return arrow_map(rows, run, "u binary, v binary")


def blocks_of_leads(filed: DataFrame) -> DataFrame:
    """``sig, blocks`` from ``filed(token, sig, lead)``: a block for each lead; large ones are cut, the lead goes to each piece."""
    pairs = filed.select("lead", "sig").distinct()
    size = pairs.groupBy("lead").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("cuts"))
    dealt = pairs.join(size, "lead").withColumn("salt", F.when(
        F.col("sig") == F.col("lead"), F.sequence(F.lit(0), F.col("cuts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("sig"), F.col("cuts")).cast("int"))))
    return dealt.select("lead", "sig", F.explode("salt").alias("salt")).groupBy("sig").agg(
        F.collect_list(F.xxhash64("lead", "salt")).alias("blocks"))


def with_components(filed: DataFrame, roots: DataFrame) -> DataFrame:
    """``filed(token, sig)`` and the component ``known`` of each class."""
    return staged(filed.select("token", "sig").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
                  .select("token", "sig", F.coalesce("root", "sig").alias("known")))


def open_groups(filed: DataFrame) -> DataFrame:
    """``token, m``: groups of ``filed(token, sig, known)`` with several components, equal ones once."""
    groups = filed.groupBy("token").agg(F.min("known").alias("a"), F.max("known").alias("b"), F.count("*").alias("m"),
                                        F.bit_xor(F.xxhash64("sig")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(7), "sig")).alias("h2")).where("a < b")
    return groups.groupBy("h1", "h2", "m").agg(F.min("token").alias("token")).select("token", "m")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                       num: int = T_NUM, den: int = T_DEN) -> DataFrame:
    """One row per document: the id, ``n_shingles`` and ``component_id``; links hold where
    ``den * |x & y| >= num * |x | y|``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).withColumn("tkey", F.xxhash64("t"))
    id_type = docs.schema["id"].dataType.simpleString()
    share = min(16, max(8, -(-32 * (den - num) // den)))  # sixteenths: half of all shingles, or twice the share of a prefix

    def keys(b):
        for t in b.column(0).to_pylist():
            k = mix(shingle_hashes(t, n))
            yield k[sampled(k, share)]

    rare, common = repeated_keys(docs.select("t"), keys)
    common = spark.sparkContext.broadcast(common)
    order = lambda: Order(share, rare.value, common.value)  # noqa: E731  made where it is used

    def signature(s: np.ndarray) -> bytes | None:
        return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None

    def features(batches):
        ranked = order()
        for b in batches:
            sets = [ranked(shingle_hashes(t, n)) for t in b.column(2).to_pylist()]
            yield {"id": b.column(0), "tkey": b.column(1), "n": [len(s) for s in sets], "sig": [signature(s) for s in sets],
                   "prefix": [s[:prefix_length(len(s), num, den)].tobytes() for s in sets], "parity": list(map(parity, sets))}

    feat = staged(arrow_map(docs.select("id", "tkey", "t"), features, f"id {id_type}, tkey long, n long, sig binary, prefix binary, parity binary"), spark)
    bitmap, _ = repeated_keys(feat.where("n > 0").select("prefix"),
                           lambda b: (mix(np.frombuffer(p, np.uint64)) for p in b.column(0).to_pylist()))

    def shared(batches):
        for b in batches:
            out: dict = {"sig": [], "token": [], "early": []}
            for s, p, size in zip(*(c.to_pylist() for c in b.columns)):
                p = np.frombuffer(p, np.uint64)
                at = np.flatnonzero(maybe_repeated(mix(p), bitmap.value))
                if len(at):
                    length = length_class(size, num, den)
                    early = at < size + 1 - -(-2 * num * size // (den + num))
                    for k in (length, length + 1):  # keys that meet by chance only test more
                        out["token"].append(mix(p[at] + np.uint64(k) * np.uint64(MULTIPLIERS[0])).astype(np.int64))
                        out["early"].append(early)
                        out["sig"] += [s] * len(at)
            if out["sig"]:
                yield {"sig": out["sig"], "token": np.concatenate(out["token"]), "early": np.concatenate(out["early"])}

    occ = staged(arrow_map(feat.where("n > 0").select("sig", "prefix", "n"), shared, "sig binary, token long, early boolean").distinct(), spark)
    lead = occ.groupBy("token").agg(F.min("sig").alias("lead"), F.max("sig").alias("last"), F.max("early").alias("early")).where("lead < last and early")
    occ = staged(occ.drop("early").join(lead.drop("last", "early"), "token"), spark)

    # one document per candidate class gives its set
    place = feat.where("n > 0").join(occ.select("sig").distinct(), "sig", "left_semi").groupBy("sig").agg(
        F.min(F.struct("id", "tkey", "n", "parity")).alias("p"))
    classes = staged(place.select("sig", "p.*"), spark)

    members = blocks_of_leads(occ).withColumn("known", F.lit(None).cast("binary"))
    links = staged(join_blocks(docs, members, classes, order, n, num, den), spark)  # blocks whose hashes meet only test more
    first = components(links)

    # shingles whose classes are still in several components; sets of large groups are filed by their parts
    at = with_components(occ, first)
    groups = staged(open_groups(at), spark)
    large = at.join(groups.where(F.col("m") > BLOCK), "token", "left_semi").select("sig").distinct()
    large = staged(large.join(classes.select("sig", "id", "tkey"), "sig"), spark)

    def parts(batches):
        for b in batches:
            for text, sig in zip(*(c.to_pylist() for c in b.columns)):
                keys = part_keys(shingle_hashes(text, n), num, den)
                yield {"token": keys, "sig": [sig] * len(keys)}

    filed = with_components(arrow_map(texts_of(docs, large).select("t", "sig"), parts, "token long, sig binary").distinct(), first)
    small = at.join(groups.where(F.col("m") <= BLOCK), "token").select("sig", "known", F.xxhash64("token").alias("block"))
    cut = filed.join(open_groups(filed).withColumn(
        "cuts", F.when(F.col("m") <= BLOCK, 1).otherwise(F.ceil(F.col("m") / F.lit(BLOCK / 2))).cast("int")), "token")
    cut = cut.withColumn("i", F.pmod(F.xxhash64("sig"), F.col("cuts")).cast("int"))
    cut = cut.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).where("cuts = 1 or i <> j")
    cut = cut.select("sig", "known", F.xxhash64("token", F.least("i", "j"), F.greatest("i", "j")).alias("block"))
    rest = small.unionByName(cut).groupBy("sig", "known").agg(F.collect_set("block").alias("blocks"))
    more = staged(join_blocks(docs, rest, classes, order, n, num, den), spark)

    final = components(links.unionByName(more).unionByName(first.select(F.col("node").alias("u"), F.col("root").alias("v"))))
    rows = feat.select("id", "n", "sig").join(final.withColumnRenamed("node", "sig"), "sig", "left").select(
        "id", "n", F.coalesce("root", "sig").alias("group"))
    least = rows.where("group is not null").groupBy("group").agg(F.min("id").alias("least"))
    return rows.join(least, "group", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """All columns of ``docs``; of each component the document with the smallest id stays.  Of rows
    with equal id one stays; documents with a null id stay."""
    found = staged(jaccard_components(docs.where(F.col(id_col).isNotNull()), id_col, text_col, n, num, den))
    gone = staged(found.where(F.col("component_id") != F.col(id_col)).select(id_col).distinct())
    again = staged(found.groupBy(id_col).count().where("count > 1").select(id_col))
    kept = semi_join_ids(docs, gone, [id_col], "left_anti")
    if again.isEmpty():
        return kept
    return semi_join_ids(kept, again, [id_col], "left_anti").unionByName(
        semi_join_ids(kept, again, [id_col]).dropDuplicates([id_col]))
