"""Operator 6, embedding near-dedup by product quantisation.

Vectors are scaled to length 1 (double precision); cosine >= t means a distance of at most
r = sqrt(2 - 2t).  Bit-equal vectors form a class and are handled once, with their number.
1. Fit: coarse centroids, and a codebook per subspace for the residuals, by k-means on at most about
   ``SAMPLE`` vectors (dealt by a hash).  The number of inverted lists follows the row count: about
   ``PER_LIST`` vectors a list, at most ``MAX_LISTS``.
2. Index: every vector gets its list, its residual's codes and its quantisation error e.
3. Search: a vector probes each list whose cell comes within r of it: the distance to the plane between
   its own centroid's cell and the list's is at most r, and so is the distance to the ball of the
   list's vectors.  No partner can stand in another list; the number of probes isn't capped.
   Distances from queries to codes (asymmetric) come from products with the decoded vectors, which a block
   decodes once, in single precision with the rounding error allowed for; candidates are those with
   distance - e <= r, which no partner misses.  Only lists that some query of a slice probes are multiplied.
4. Rerank: exact cosine in double precision.
Lists stand in an order that keeps near ones together, in bins of about one block, and larger bins are cut into
blocks of that size: ``BLOCKS`` blocks of at least ``BLOCK`` vectors, and more where they would hold over
``BLOCK_BYTES``.  A query goes once to a bin of which it probes any list, and each pair of bins meets once, at
either of them by turns.  So no list is held by one task, and up to BLOCKS * BLOCK_BYTES of vectors the number of
blocks that a vector is dealt to doesn't grow.  A block returns its vectors' numbers of links and, for the
components, each vector's smallest linked one: as many rows as vectors, not pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing; the others link with those of their own length only, each length with lists of its own.  Rows
with equal ids are vectors of their own; null ids are passed over when the smallest id is taken.  Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, components, staged

THRESHOLD = 0.95
SAMPLE = 8192
PER_LIST = 200
MAX_LISTS = 2048
SUBSPACE = 8
CODES = 256
BLOCK = 256
BLOCKS = 16
BLOCK_BYTES = 16 << 20
QUERIES = 512  # a slice of queries
BASE = 2048  # a slice of a block
PAIR_BYTES = 16 << 20  # vectors that are paired at a time
SIGMAS = np.inf  # read by nothing: probes reach r, whatever a test sets here


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))]
    for _ in range(rounds):
        near = np.argmin(squared(x, c), axis=1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)


def neighbourly(c: np.ndarray) -> np.ndarray:
    """An order in which near points stand together: halves along the line between two far points, and so on."""
    if len(c) <= 2:
        return np.arange(len(c))
    one = c[np.argmax(((c - c.mean(axis=0)) ** 2).sum(1))]
    other = c[np.argmax(((c - one) ** 2).sum(1))]
    order = np.argsort(c @ (other - one), kind="stable")
    return np.concatenate([half[neighbourly(c[half])] for half in np.array_split(order, 2)])


class Quantiser:
    """Coarse centroids and one codebook per subspace."""

    def __init__(self, coarse: np.ndarray, books: list[np.ndarray]):
        self.coarse, self.books = coarse, books
        self.apart: np.ndarray | None = None  # distances between centroids
        cuts = np.cumsum([0] + [c.shape[1] for c in books])
        self.parts = list(zip(cuts, cuts[1:]))

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int) -> Quantiser:
        coarse = kmeans(sample, lists)
        coarse = coarse[neighbourly(coarse)]
        rest = sample - coarse[np.argmin(squared(sample, coarse), axis=1)]
        return cls(coarse, [kmeans(rest[:, a:a + SUBSPACE], CODES) for a in range(0, sample.shape[1], SUBSPACE)])

    def encode(self, x: np.ndarray):
        """List, codes and quantisation error of unit vectors."""
        d = squared(x, self.coarse)
        own = np.argmin(d, axis=1)
        rest = x - self.coarse[own]
        codes = np.stack([np.argmin(squared(rest[:, a:b], c), axis=1) for (a, b), c in zip(self.parts, self.books)], axis=1)
        back = np.concatenate([c[codes[:, m]] for m, c in enumerate(self.books)], axis=1)
        return own, codes.astype(np.uint8), np.linalg.norm(rest - back, axis=1)

    def probes(self, x: np.ndarray, own: np.ndarray, radius: np.ndarray, r: float, among=slice(None)) -> np.ndarray:
        """Which lists (columns; those of ``among``) may hold a vector within ``r`` of each row."""
        if self.apart is None:
            self.apart = np.sqrt(squared(self.coarse, self.coarse))
        d = squared(x, self.coarse[among])
        rest = x - self.coarse[own]
        beyond = d - (rest * rest).sum(1)[:, None]  # twice the distance to the plane, times ``apart``
        return (beyond <= 2 * self.apart[own][:, among] * (r + 1e-6) + 1e-9) & (np.sqrt(d) <= radius[among][None, :] + r + 1e-6)

    def decode(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.coarse[lists] + np.concatenate([c[codes[:, m]] for m, c in enumerate(self.books)], axis=1)


def unit_vectors(column) -> list[np.ndarray | None]:
    """Rows as unit vectors in double precision, None for what links with nothing."""
    out = []
    for v in column.to_pylist():
        x = None
        if v and None not in v:
            x = np.array(v, np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                x = x / top
                x = x / np.sqrt((x * x).sum())
            else:
                x = None
        out.append(x)
    return out


class Base:
    """A slice of a block, decoded.  A unit vector q is within r of one of its vectors only if q.decoded reaches
    ``least``: |q - decoded| <= r + err, less what single precision may lose."""

    def __init__(self, x: np.ndarray, lists: np.ndarray, codes: np.ndarray, err: np.ndarray, quant: Quantiser, r: float):
        back = quant.decode(lists, codes)
        size = (back * back).sum(1)
        lost = (x.shape[1] + 8) * np.finfo(np.float32).eps * (1 + np.sqrt(size))
        self.x, self.back = x, back.astype(np.float32)
        self.least = ((1 + size - (r + err + 1e-6) ** 2) / 2 - lost).astype(np.float32)
        self.lists, self.at = np.unique(lists, return_inverse=True)


def link_block(base: Base, qx: np.ndarray, own: np.ndarray, quant: Quantiser, radius: np.ndarray, r: float, threshold: float):
    """``(queries, base vectors, links)``: found by distances to codes in the lists that are probed, confirmed by
    exact cosine.  ``links`` is boolean, for the queries and vectors that are candidates at all."""
    asked = quant.probes(qx, own, radius, r, base.lists).any(axis=0)
    cols = np.flatnonzero(asked[base.at])
    part = slice(None) if asked.all() else cols
    near = qx.astype(np.float32) @ base.back[part].T >= base.least[part][None, :]
    rows, some = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near, cols = near[np.ix_(rows, some)], cols[some]
    if near.sum() * 4 > near.size:
        return rows, cols, near & (qx[rows] @ base.x[cols].T >= threshold - 1e-15)
    links = np.zeros(near.shape, bool)
    i, j = np.nonzero(near)
    step = max(1, PAIR_BYTES // (16 * qx.shape[1]))
    for a in range(0, len(i), step):
        k, m = i[a:a + step], j[a:a + step]
        links[k, m] = np.einsum("ij,ij->i", qx[rows[k]], base.x[cols[m]]) >= threshold - 1e-15
    return rows, cols, links


def travels(a: int, b: int) -> bool:
    """Of two blocks (or bins) that meet, does ``a`` go to ``b``?  Each goes to about half of the others."""
    return (a < b) == ((a + b) % 2 == 0)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: the id, ``n_links``, ``component_id`` and ``kept``."""
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    df = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    r = float(np.sqrt(2 - 2 * threshold))

    def prepare(batches):
        for b in batches:
            xs = unit_vectors(b.column(1))
            yield {"id": b.column(0), "sig": [None if x is None else xxhash.xxh3_128_digest(x.tobytes()) for x in xs],
                   "x": [None if x is None else x.tobytes() for x in xs]}

    rows = staged(arrow_map(df, prepare, f"id {id_type}, sig binary, x binary"), spark)
    good = rows.where("sig is not null")
    copies = good.groupBy("sig").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    reps = staged(good.select("sig", "x").dropDuplicates(["sig"]).join(copies.drop("least"), "sig"), spark)
    widths = {t["bytes"]: t["count"] for t in reps.groupBy(F.octet_length("x").alias("bytes")).count().collect()}
    n = sum(widths.values())
    if not n:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.lit(True).alias("kept"))
    part = F.pmod(F.xxhash64(F.lit("pq"), "sig"), F.lit(1 << 20)) < max(1, round(min(1.0, SAMPLE / n) * (1 << 20)))
    sample: dict = {w: [] for w in widths}
    for t in sorted(reps.where(part).select("sig", "x").limit(2 * SAMPLE).collect(), key=lambda t: t["sig"]):
        sample[len(t["x"])].append(np.frombuffer(t["x"]))
    fitted, first, lists = {}, {}, 0  # by bytes of a vector: its quantiser, its first list
    for w, m in sorted(widths.items()):
        fitted[w] = Quantiser.fit(np.array(sample[w] or [np.zeros(w // 8)]), max(1, min(MAX_LISTS, m // PER_LIST)))
        first[w] = lists
        lists += len(fitted[w].coarse)
    parts = spark.sparkContext.broadcast({w: (q.coarse, q.books) for w, q in fitted.items()})  # bounded: the sample's size

    def by_width(column):
        """``(bytes, rows, vectors)`` of a batch."""
        data = column.to_pylist()
        for w in sorted({len(v) for v in data}):
            at = [i for i, v in enumerate(data) if len(v) == w]
            yield w, at, np.array([np.frombuffer(data[i]) for i in at])

    def index(batches):
        quants = {w: Quantiser(*q) for w, q in parts.value.items()}
        for b in batches:
            which, err, away = np.zeros(b.num_rows, int), np.zeros(b.num_rows), np.zeros(b.num_rows)
            coded: list = [None] * b.num_rows
            for w, at, x in by_width(b.column(1)):
                own, codes, err[at] = quants[w].encode(x)
                which[at] = own + first[w]
                away[at] = np.linalg.norm(x - quants[w].coarse[own], axis=1)
                for i, c in zip(at, codes):
                    coded[i] = c.tobytes()
            yield {"sig": b.column(0), "x": b.column(1), "copies": b.column(2), "list": which, "codes": coded, "err": err, "away": away}

    indexed = staged(arrow_map(reps, index, "sig binary, x binary, copies long, list int, codes binary, err double, away double"), spark)
    sizes = {t["list"]: t for t in indexed.groupBy("list").agg(F.count("*").alias("n"), F.max("away").alias("away")).collect()}  # MAX_LISTS a length
    radius = np.array([sizes[i]["away"] if i in sizes else -np.inf for i in range(lists)])
    bins, cuts = np.zeros(lists, int), []
    held, block = 0, BLOCK
    starts = {first[w]: max(BLOCK, min(BLOCK_BYTES // max(w, 1), -(-m // BLOCKS))) for w, m in widths.items()}  # vectors of a block
    for i in range(lists):
        m = sizes[i]["n"] if i in sizes else 0
        block = starts.get(i, block)
        if not cuts or i in starts or held + m > block:
            cuts.append(1)
            held = 0
        held += m
        bins[i], cuts[-1] = len(cuts) - 1, max(1, -(-held // block))
    shape = spark.sparkContext.broadcast((radius, bins, cuts))

    def deal(batches):
        quants = {w: Quantiser(*q) for w, q in parts.value.items()}
        radius, bins, cuts = shape.value
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            which = np.array(cols[3])
            out: dict = {k: [] for k in ("bin", "block", "role", "sig", "x", "copies", "list", "codes", "err")}
            for w, at, x in by_width(b.column(1)):
                span = slice(first[w], first[w] + len(quants[w].coarse))
                probe = quants[w].probes(x, which[at] - first[w], radius[span], r)
                for i, asks in zip(at, probe):
                    sig, data, n, c, codes, err, _ = (col[i] for col in cols)
                    own = int(bins[c])
                    mine = xxhash.xxh3_64_intdigest(sig) % cuts[own]
                    # asks half of the other blocks of its bin and all of half of the other bins
                    to = [(own, k) for k in range(cuts[own]) if k != mine and travels(mine, k)]
                    to += [(j, k) for j in np.unique(bins[span][asks]).tolist() if j != own and travels(own, j) for k in range(cuts[j])]
                    for row in [(own, mine, 0, sig, data, n, c, codes, err), *((j, k, 1, sig, data, n, c, None, None) for j, k in to)]:
                        for name, v in zip(out, row):
                            out[name].append(v)
            yield out

    dealt = arrow_map(indexed, deal, "bin int, block int, role int, sig binary, x binary, copies long, list int, codes binary, err double")
    dealt = dealt.repartition("bin", "block").sortWithinPartitions("bin", "block", "role", "list")

    def search(batches):
        quants = {w: Quantiser(*q) for w, q in parts.value.items()}
        radius = shape.value[0]
        key, held, bases, asked = None, [], [], []

        def vectors(rows: list) -> np.ndarray:
            return np.frombuffer(b"".join(t[4] for t in rows)).reshape(len(rows), -1)

        def decoded() -> list:
            """The slices of the block that is held, with their rows."""
            for a in range(len(bases) * BASE, len(held), BASE):
                rows = held[a:a + BASE]
                w = len(rows[0][4])
                codes = np.frombuffer(b"".join(t[7] for t in rows), np.uint8).reshape(len(rows), -1)
                bases.append((rows, Base(vectors(rows), np.array([t[6] for t in rows]) - first[w], codes, np.array([t[8] for t in rows]),
                                         quants[w], r)))
            return bases

        def meet(block: tuple, queries: list, itself: bool = False):
            rows, base = block
            w = len(rows[0][4])
            own = np.array([t[6] for t in queries]) - first[w]
            span = slice(first[w], first[w] + len(quants[w].coarse))
            qx = base.x if itself else vectors(queries)
            i, j, links = link_block(base, qx, own, quants[w], radius[span], r, threshold)
            if itself:  # rounding is not symmetric, the cosine is
                both = np.union1d(i, j)
                whole = np.zeros((len(both), len(both)), bool)
                whole[np.ix_(np.searchsorted(both, i), np.searchsorted(both, j))] = links
                i, j, links = both, both, whole | whole.T
                np.fill_diagonal(links, False)
            if not links.any():
                return
            left, right = [queries[k] for k in i], [rows[k] for k in j]
            ends = [(left, links, right)] + ([] if itself else [(right, links.T, left)])
            out: dict = {"sig": [], "n": [], "to": []}
            for some, m, others in ends:
                n = m @ np.array([t[5] for t in others])
                hit = [some[k][3] for k in np.flatnonzero(n)]
                out["sig"] += hit
                out["n"] += n[n > 0].tolist()
                out["to"] += hit  # a loop: counts no edge
            edges = spanning(links, [t[3] for t in left], [t[3] for t in right])
            out["sig"] += [u for u, _ in edges]
            out["n"] += [0] * len(edges)
            out["to"] += [v for _, v in edges]
            yield out

        def answer(queries):
            for block in decoded():
                yield from meet(block, queries)

        def own():
            slices = decoded()
            for k, block in enumerate(slices):
                yield from meet(block, block[0], True)
                for later, _ in slices[k + 1:]:
                    for a in range(0, len(later), QUERIES):
                        yield from meet(block, later[a:a + QUERIES])

        for b in batches:
            for t in zip(*(c.to_pylist() for c in b.columns)):
                if t[:2] != key:
                    if asked:
                        yield from answer(asked)
                    if held:
                        yield from own()
                    key, held, bases, asked = t[:2], [], [], []
                if t[2] == 0:
                    held.append(t)
                else:
                    asked.append(t)
                    if len(asked) == QUERIES:
                        yield from answer(asked)
                        asked = []
        if asked:
            yield from answer(asked)
        if held:
            yield from own()

    found = staged(arrow_map(dealt, search, "sig binary, n long, to binary"), spark)
    counts = found.groupBy("sig").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("sig").alias("u"), F.col("to").alias("v"))).withColumnRenamed("node", "sig")
    out = rows.select("id", "sig").join(counts, "sig", "left").join(copies.select("sig", "copies"), "sig", "left").join(roots, "sig", "left")
    out = out.withColumn("group", F.coalesce("root", "sig"))
    least = copies.join(roots, "sig", "left").groupBy(F.coalesce("root", "sig").alias("group")).agg(F.min("least").alias("least"))
    out = out.join(least, "group", "left").withColumn("component_id", F.coalesce("least", "id"))
    links = F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return out.select(F.col("id").alias(id_col), links.alias("n_links"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def spanning(links: np.ndarray, left: list, right: list) -> list[tuple]:
    """Edges (at most one per row and column) that connect what ``links`` connects."""
    rows, cols = links.any(axis=1), links.any(axis=0)
    i, j = np.flatnonzero(rows), np.flatnonzero(cols)
    if not len(i):
        return []
    m = links[np.ix_(i, j)]
    lab = np.arange(len(i))
    while True:
        down = np.where(m, lab[:, None], len(i)).min(axis=0)
        new = np.where(m, down[None, :], len(i)).min(axis=1)
        if (new == lab).all():
            break
        lab = new
    head = [left[i[k]] for k in lab]
    return [(left[i[k]], head[k]) for k in range(len(i)) if lab[k] != k] + [(right[j[k]], left[i[down[k]]]) for k in range(len(j))]
