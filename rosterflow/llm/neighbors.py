"""Most similar vectors for every vector: a forest of hash prefixes over sorted arrays.

Every tree gives a vector long hash strings: a first symbol, the nearest of up to ANCHORS directions fitted on a bounded
sample of the model's vectors (and a second string from the second nearest), then BITS signs of random projections. A
tree is the array of all vectors sorted by hash string, cut over the tasks at first symbols. Descending, a range of equal prefix
is divided symbol by symbol until at most BLOCK vectors are left, so every vector ends at the longest prefix it shares with
enough others. Where the last division left too few, its vectors ascend in all trees alike: their candidates are those BLOCK
vectors next to them in the array that share the prefix one symbol shorter. More vectors with one and the same string are
all compared with each other as long as they fit in a task (HOT vectors, NUMBERS numbers); beyond that they are
divided by directions of their own (``divided``). A vector is compared with all its candidates, and the best of all
trees are merged per vector. A model with no more than BLOCK vectors is one block, so its result is exact. What is compared
depends on the vectors and ids only, not on the number of tasks or the layout of the input.

Only sample and anchors, both of bounded size, touch the driver. Vectors travel as 16-bit integers with a scale
(error of a cosine about 1e-6) and ids as 16 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.runtime import ship, width

TREES, PROBES = 2, 2
ANCHORS, SAMPLE, PASSES = 1_024, 16_384, 4  # of all models together; passes of the fit
BITS, BLOCK = 32, 4_096
HOT = 65_536  # vectors under one prefix that go to one task
NUMBERS = 1 << 24  # numbers of vectors that are compared in one go
AXES, TURNS = 32, 4  # directions that divide a range of one hash string, and how often it is divided
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def usable(active: Column, vector: Column, dimensions: Column) -> Column:
    """Active, not null, of as many numbers as stated; finiteness and norm are looked at with the numbers."""
    return F.coalesce(active.cast("boolean") & vector.isNotNull() & (F.size(vector) == dimensions), F.lit(False))


def _unit(column: pa.Array, n: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to norm 1, and which of them are usable."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, dims)
    with np.errstate(all="ignore"):
        top = np.abs(x).max(axis=1, initial=0)
        x = x / top[:, None]
        norm = np.linalg.norm(x, axis=1)
        ok = np.isfinite(top) & (top > 0) & np.isfinite(norm)
        return (x / norm[:, None]).astype(np.float32), ok


def _fit(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k directions by spherical k-means over a sample."""
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(PASSES if k > 1 else 0):
        near = (x @ c.T).argmax(axis=1)
        order = np.argsort(near, kind="stable")
        starts = np.flatnonzero(np.diff(near[order], prepend=-1))
        sums = np.add.reduceat(x[order], starts)
        norms = np.linalg.norm(sums, axis=1)
        c[near[order][starts]] = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-12)[:, None], sums)
    return c


class Tree:
    """Hash functions of one tree over one model."""

    def __init__(self, sample: np.ndarray, total: int, seed: int, block: int = BLOCK) -> None:
        rng = np.random.default_rng(seed)
        k = int(max(1, min(ANCHORS, len(sample) // 8, 4 * PROBES * total // block))) if total > block else 1
        self.anchors = _fit(sample, k, rng)
        self.planes = rng.standard_normal((sample.shape[1], BITS)).astype(np.float32)
        # prefixes that hold many vectors by the sample's measure get more of their bits into the partition key
        first = (sample @ self.anchors.T).argmax(axis=1)
        held = np.bincount(first, minlength=k) * (PROBES * total / max(1, len(sample)))
        self.depth = np.clip(np.ceil(np.log2(np.maximum(held / HOT, 1))), 0, BITS).astype(np.int64)
        # identical hash strings can't be divided by bits of this tree; their vectors get bits of their own, centred on them
        bits = self.bits(sample)
        _, where, count = np.unique(np.stack([first.astype(np.uint64), bits], axis=1), axis=0, return_inverse=True, return_counts=True)
        same = count[where.reshape(-1)] * (total / max(1, len(sample)))
        self.spread: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for f, b, s in zip(first, bits, same):
            if s > HOT and (int(f), int(b)) not in self.spread:
                mine = sample[(first == f) & (bits == b)]
                centre, axes = _axes(mine)
                depth = min(30, int(np.ceil(np.log2(s / HOT))))
                turned = axes @ _turn(axes.shape[1], rng)[:, :depth]
                self.spread[int(f), int(b)] = centre, turned, np.median((mine - centre) @ turned, axis=0)

    def bits(self, x: np.ndarray) -> np.ndarray:
        return ((x @ self.planes > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.uint64))).astype(np.uint64)

    def share(self, x: np.ndarray, first: np.ndarray, bits: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Number of the share of each vector among those of its hash string; copies, which lie on an edge, go by id."""
        out = np.zeros(len(x), np.int64)
        for (f, b), (centre, axes, middle) in self.spread.items():
            at = np.flatnonzero((first == f) & (bits == b))
            off = (x[at] - centre) @ axes - middle
            own = (salt[at, None] >> np.arange(axes.shape[1])) & 1
            out[at] = np.where(np.abs(off) < 1e-6, own, off > 0) @ (1 << np.arange(axes.shape[1]))
        return out

    def symbols(self, x: np.ndarray) -> Iterator[np.ndarray]:
        near = x @ self.anchors.T
        rows = np.arange(len(x))
        for _ in range(min(PROBES, near.shape[1])):
            best = near.argmax(axis=1)
            yield best
            near[rows, best] = -np.inf


def _axes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre of some vectors and the directions in which they differ most."""
    centre = x.mean(axis=0)
    _, axes = np.linalg.eigh(np.atleast_2d(np.cov((x - centre).T, bias=True)))
    return centre, axes[:, -AXES:].astype(np.float32)


def _turn(n: int, rng: np.random.Generator) -> np.ndarray:
    return np.linalg.qr(rng.standard_normal((n, n)))[0].astype(np.float32)


def divided(x: np.ndarray, size: int = BLOCK, seed: int = 0) -> Iterator[np.ndarray]:
    """Places of at most ``size`` vectors of a range that share a whole hash string, each vector TURNS times.

    The vectors are centred on the range and halved at the median of the direction in which they differ most, until
    they fit; each turn takes other directions, so that neighbours parted by one edge meet in another turn.
    """
    rng = np.random.default_rng(seed)
    centre, axes = _axes(x[rng.choice(len(x), min(len(x), SAMPLE), replace=False)])
    off = (x - centre) @ axes
    for turn in range(TURNS):
        y = off @ _turn(off.shape[1], rng) if turn else off
        todo = [np.arange(len(x))]
        while todo:
            at = todo.pop()
            if len(at) <= size:
                yield at
                continue
            order = np.argpartition(y[at, y[at].var(axis=0).argmax()], len(at) // 2)
            todo += [at[order[: len(at) // 2]], at[order[len(at) // 2 :]]]


def blocks(bits: np.ndarray, size: int = BLOCK) -> list[tuple[int, int, int, int]]:
    """(lo, hi, from, to) over a sorted array of the bits of one first symbol: vectors lo to hi and their candidates.

    Prefixes of variable length; a range under a quarter of ``size`` gets the ``size`` vectors around it that share the next
    shorter prefix. More than ``size`` equal strings stay whole, for ``divided``.
    """
    out: list[tuple[int, int, int, int]] = []
    todo = [(0, len(bits), 0, 0, len(bits))]
    while todo:
        lo, hi, bit, above, below = todo.pop()
        if hi - lo > size and bit < BITS:
            mask = np.uint64(1) << np.uint64(BITS - 1 - bit)
            mid = lo + int(np.searchsorted((bits[lo:hi] & mask) > 0, True))
            todo += [(a, b, bit + 1, lo, hi) for a, b in ((mid, hi), (lo, mid)) if b > a]
        elif 4 * (hi - lo) < size < below - above:
            start = max(above, min((lo + hi - size) // 2, below - size))
            out.append((lo, hi, start, start + size))
        elif hi > lo:
            out.append((lo, hi, lo, hi))
    return out


def _nearest(ids: np.ndarray, x: np.ndarray, k: int, lo: int = 0, hi: int | None = None) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Of each distinct id in lo to hi of a block the k most similar others of the block, packed as (id, cosine)."""
    asked = ids[lo:hi]
    ids, at = np.unique(ids, return_index=True)
    x = x[at]
    asked = np.flatnonzero(np.isin(ids, asked))
    k = min(k, len(ids) - 1)
    if k < 1:
        return
    kind = np.dtype([("id", "V16"), ("cos", "<f4")])
    step = max(16, (1 << 21) // len(ids))  # rows of scores at a time
    for first in range(0, len(asked), step):
        mine = asked[first : first + step]
        s = x[mine] @ x.T
        s[np.arange(len(s)), mine] = -np.inf
        best = np.argpartition(s, s.shape[1] - k, axis=1)[:, -k:]
        found = np.empty(best.shape, kind)
        found["id"] = ids[best].view("V16")
        found["cos"] = np.take_along_axis(s, best, 1)
        yield ids[mine], [r.tobytes() for r in found]


def similar_pairs(df: DataFrame, ident: str, model: list[str], vector: str, active: str, dimensions: str, k: int = 5, block: int = BLOCK) -> DataFrame:
    """(id_a, id_b), id_a < id_b: pairs of usable rows of one model of which one is among the other's k nearest.

    Rows that aren't usable (inactive or null flag, null vector, other length than stated, null or unusable numbers,
    norm zero) and rows with a null id are left out; a row that comes twice counts once; null model names are
    equal to each other. Equal cosines are ordered by id. Vectors of different length are never compared.
    Approximate beyond ``block`` vectors a model. At most 1,024 models, else ValueError. Empty tables give no rows.
    """
    spark = df.sparkSession
    ship(spark)
    c = lambda x: F.col(f"`{x}`")
    rows = df.where(usable(c(active), c(vector), c(dimensions)) & c(ident).isNotNull()).select(c(ident).cast("string").alias("id"), F.xxhash64(*[c(m) for m in model], F.size(c(vector))).alias("model"), F.size(c(vector)).alias("dims"), c(vector).cast("array<float>").alias("vector")).where("dims > 0")
    counts = rows.groupBy("model", "dims").agg(F.count("*").alias("n"), F.count_if(~F.col("id").rlike(UUID)).alias("odd")).limit(1_025).collect()
    if len(counts) > 1_024:
        raise ValueError("more than 1,024 models")
    if not counts:
        return spark.createDataFrame([], "id_a string, id_b string")
    plain = not any(r.odd for r in counts)
    key = F.unhex(F.replace("id", F.lit("-"), F.lit(""))) if plain else F.unhex(F.md5("id"))
    share = SAMPLE // len(counts) + 1
    chance = F.lit(0.0)
    for r in counts:
        chance = F.when(F.col("model") == r.model, F.lit(min(1.0, share / r.n))).otherwise(chance)
    # a sample by id, in order of id, so that it is the same whatever the layout of the input
    lot = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    got = rows.where(lot < chance).select("model", "dims", "id", "vector").limit(2 * SAMPLE + 2_048).toArrow().sort_by("id")
    trees: dict[int, list[Tree]] = {}
    sampled = np.asarray(got.column("model").to_numpy())
    for r in counts:
        mine = got.filter(pa.array(sampled == r.model)).combine_chunks().column("vector")
        flat = mine.combine_chunks() if isinstance(mine, pa.ChunkedArray) else mine
        x, ok = _unit(flat, len(flat), r.dims) if len(flat) else (np.zeros((0, r.dims), np.float32), np.zeros(0, bool))
        x = x[ok]
        if not len(x):
            x = np.ones((1, r.dims), np.float32)
        # a copy counts as a vector here; that only makes partitions smaller
        trees[r.model] = [Tree(x, r.n, 1_000 * t + 17, block) for t in range(TREES if r.n > block else 1)]
    shared = spark.sparkContext.broadcast(trees)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            models = batch.column("model").to_numpy()
            for m in np.unique(models):
                part = batch.filter(pa.array(models == m))
                dims = part.column("dims")[0].as_py()
                x, ok = _unit(part.column("vector"), part.num_rows, dims)
                x, keys = x[ok], np.frombuffer(b"".join(part.column("key").filter(pa.array(ok)).to_pylist()), "V16")
                if not len(x):
                    continue
                scale = np.abs(x).max(axis=1) / 32_767
                packed = np.empty(len(x), [("scale", "<f4"), ("q", "<i2", (dims,))])
                packed["scale"], packed["q"] = scale, np.rint(x / scale[:, None])
                body = pa.array([r.tobytes() for r in packed], pa.binary())
                ids = pa.array([k.tobytes() for k in keys], pa.binary())
                salt = keys.view("u1").reshape(-1, 16)[:, 15].astype(np.int64) * 256 + keys.view("u1").reshape(-1, 16)[:, 14]
                for t, tree in enumerate(shared.value[int(m)]):
                    bits = tree.bits(x)
                    for first in tree.symbols(x):
                        cut = tree.depth[first].astype(np.uint64)
                        part_of = np.where(cut > 0, bits >> (np.uint64(BITS) - np.maximum(cut, 1)), 0).astype(np.int64)
                        if tree.spread:
                            part_of += tree.share(x, first, bits, salt) << 33
                        n = len(x)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, m)), pa.array(np.full(n, t, np.int32)), pa.array(first.astype(np.int32)), pa.array(part_of), pa.array(bits.astype(np.int64)), ids, body], ["model", "tree", "first", "part", "bits", "key", "body"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by model, tree, first, part, bits, key; every (model, tree, first, part) is an array of its own."""
        held: list[pa.RecordBatch] = []

        def work(part: pa.Table) -> Iterator[pa.RecordBatch]:
            bits = part.column("bits").to_numpy().astype(np.uint64)
            # numbers of one body: a scale and 16-bit integers
            raw = b"".join(part.column("body").to_pylist())
            dims = (len(raw) // len(bits) - 4) // 2
            packed = np.frombuffer(raw, [("scale", "<f4"), ("q", "<i2", (dims,))])
            ids = np.frombuffer(b"".join(part.column("key").to_pylist()), [("high", ">u8"), ("low", ">u8")])
            for lo, hi, a, b in blocks(bits, block):
                x = packed["q"][a:b].astype(np.float32) * packed["scale"][a:b, None]
                whole = max(block, min(HOT, NUMBERS // dims))
                if b - a <= whole:
                    lists = _nearest(ids[a:b], x, k, lo - a, hi - a)
                else:
                    lists = (got for at in divided(x, whole, part.column("first")[0].as_py()) for got in _nearest(ids[a:b][at], x[at], k))
                for own, near in lists:
                    yield pa.RecordBatch.from_arrays([pa.array([i.tobytes() for i in own], pa.binary()), pa.array(near, pa.binary())], ["key", "near"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(n).to_numpy() for n in ("model", "tree", "first", "part")], axis=1)
            starts = [0, *(np.flatnonzero(np.any(np.diff(marks, axis=0) != 0, axis=1)) + 1).tolist(), len(marks)]
            for lo, hi in zip(starts, starts[1:]):
                if held and np.any(marks[lo] != last):
                    yield from work(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = marks[lo]
        if held:
            yield from work(pa.Table.from_batches(held))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by key: the lists of all trees of one vector are one, its best k give pairs."""
        a: list[bytes] = []
        b: list[bytes] = []
        now, best = None, {}

        def close() -> None:
            for i, _ in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]:
                a.append(min(now, i))
                b.append(max(now, i))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
            a.clear()
            b.clear()
            return out

        for batch in batches:
            for key_, near in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key_ != now:
                    if now is not None:
                        close()
                    now, best = key_, {}
                cosines = np.frombuffer(near, [("id", "V16"), ("cos", "<f4")])["cos"].tolist()
                for n, cos in enumerate(cosines):
                    i = near[20 * n : 20 * n + 16]
                    if cos > best.get(i, -2.0):
                        best[i] = cos
            if len(a) >= 50_000:
                yield flush()
        if now is not None:
            close()
        yield flush()

    n = width(spark)
    strings = rows.select("model", "dims", "vector", key.alias("key")).mapInArrow(hashed, "model long, tree int, first int, part long, bits long, key binary, body binary")
    arrays = strings.repartition(n, "model", "tree", "first", "part").sortWithinPartitions("model", "tree", "first", "part", "bits", "key")
    lists = arrays.mapInArrow(compared, "key binary, near binary")
    pairs = lists.repartition(n, "key").sortWithinPartitions("key").mapInArrow(merged, "a binary, b binary").distinct()
    if plain:
        text = lambda x: F.lower(F.regexp_replace(F.hex(x), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))
        return pairs.select(text("a").alias("id_a"), text("b").alias("id_b"))
    names = rows.select(key.alias("key"), "id").distinct()
    both = pairs.join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
