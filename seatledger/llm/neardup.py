"""MinHash near-duplicate detection with an LSH forest.

A document is the set of its distinct word shingles. Its signature of minimum
hashes is read in many rotations, the trees of the forest. Each tree is a sorted
order: rows are range-partitioned and sorted by the rotated signature, and every
row is compared with its neighbours on both sides, whose longest common prefix
(LCP) tells how deep they part. Rows with an LCP of ``DEPTH`` values or more form
a region; a pair of similarity 0.8 is in one region of a tree with probability
0.41, and the number of trees is the one that leaves it unseen by all of them
with less than ``MISS``.

Every link is confirmed on the full sets. First, in a few trees, regions are cut
into runs of at most ``RUN`` rows where their neighbours' LCPs are least, so each
region is compared at a depth of its own, and runs share their border rows; that
joins most groups. Then, in all trees, only documents of different components in
one region are compared, block against block, so no group is gathered in one
task and no pair of a joined group is ever formed. Equal sets are one node from
the start.

A region that still holds too much work for that (``WIDE`` pairs beside its
largest component) is descended: its documents get orders of twice the depth, of
as many trees as that depth needs for the same ``MISS``, and so on until regions
are narrow or the depth is ``DEEPEST``, where all that is left is compared.

Defined results: a null or wordless text has an empty set and is linked with
nothing; a null doc_id is kept, with a null component; rows with one doc_id are
compared by their texts; other columns are ignored; an empty table gives an
empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, map_batches, materialise, utf8

#: Values that rows of one region share at first and at last, and values of the sort key beyond them.
DEPTH, DEEPEST, TAIL = 4, 16, 4
#: How likely a pair of just the wanted similarity is in no region of any tree.
MISS = 1e-7
RUN = 256
#: Pairs of a region, beside those inside its largest component, beyond which it is descended.
WIDE = 1 << 24
#: Bytes of sets that a run or one side of a block holds, unless one set is larger.
BYTES = 32 << 20
#: Buckets of hashes by whose counts pairs are told that have too little in common.
BUCKETS = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hash of each word, computed once; emptied before it grows beyond a million."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values: by sorting, which beats a hash table here."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingle_set(text: str | None, k: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; of all words where there are fewer."""
    words = utf8(text).lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(k, len(words))
    n = len(h) - k + 1
    acc = h[:n] + np.uint64(k)
    for j in range(1, k):
        acc = mix(acc) * _MIX + h[j : n + j]
    return distinct(mix(acc))


def trees_for(depth: int, percent: int) -> int:
    """Trees that leave a pair of similarity ``percent`` / 100 without a common prefix of ``depth`` values with less than MISS."""
    return max(1, math.ceil(math.log(MISS) / math.log1p(-((min(percent, 99) / 100) ** depth))))


def _coefficients(n: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signature(items: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One minimum of 32 bits for each pair of coefficients."""
    best = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 262_144 // len(a))
    for at in range(0, len(items), step):
        np.minimum(best, (items[at : at + step, None] * a + b).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def describe(docs: DataFrame, k: int, hashes: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit hash of the set; null if empty), sig of so many values."""

    def make():
        import xxhash

        cache, (a, b) = WordHashes(), _coefficients(hashes)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, keys, sigs = [], [], []
            for cell in batch.column(1):
                items = shingle_set(cell.as_py(), k, cache)
                n.append(len(items))
                keys.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                sigs.append(signature(items, a, b).tobytes() if len(items) else None)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "set_key", "sig"])

        return step

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, n_shingles long, set_key binary, sig binary")


def _order_rows(ids: np.ndarray, sig: np.ndarray, depth: int) -> list[pa.RecordBatch]:
    """tree, key, id for every rotation of the signatures: the next depth + TAIL values, as bytes that sort as they do."""
    out, width = [], depth + TAIL
    for t in range(sig.shape[1] // depth):
        keys = np.ascontiguousarray(np.take(sig, np.arange(t * depth, t * depth + width) % sig.shape[1], axis=1).astype(">u4"))
        offsets = np.arange(len(ids) + 1, dtype=np.int32) * (4 * width)
        key = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(keys)])
        out.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), t, np.int32)), key, pa.array(ids, pa.int64())], names=["tree", "key", "id"]))
    return out


def order_rows(nodes: DataFrame, depth: int, trees: int) -> DataFrame:
    """Rows of the sorted orders for nodes (id, sig), or (id, items) at greater depths, which take hashes of their own."""
    column = "sig" if "sig" in nodes.columns else "items"

    def make():
        a, b = _coefficients(depth * trees, 20 + depth)

        def step(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
            cells = [np.frombuffer(x.as_py(), np.uint32 if column == "sig" else np.uint64) for x in batch.column(1)]
            sig = np.stack(cells if column == "sig" else [signature(x, a, b) for x in cells])
            return _order_rows(batch.column(0).to_numpy(zero_copy_only=False), sig, depth)

        return step

    return map_batches(nodes.select("id", column), make, "tree int, key binary, id long", 500)


def cut_runs(lcp: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A region of len(lcp) rows as runs of at most ``most``, parted where neighbours have least in common.

    ``lcp[i]`` is the common prefix of rows i - 1 and i. Deeper parts that fit together stay together.
    """
    out, todo = [], [(0, len(lcp))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= most:
            out.append((lo, hi))
            continue
        inner = lcp[lo + 1 : hi]
        least = inner.min()
        if least == inner.max():  # nothing tells its rows apart
            out += [(x, min(x + most, hi)) for x in range(lo, hi, most)]
            continue
        ends = [*(np.flatnonzero(inner == least) + lo + 1).tolist(), hi]
        first, last = lo, lo
        for end in ends:
            if end - first > most and last > first:
                out.append((first, last))
                first = last
            if end - first > most:
                todo.append((first, end))
                first = end
            last = end
        if last > first:
            out.append((first, last))
    return sorted(out)


ORDERED = "tree int, prefix long, part int, run int, own boolean, id long"


def orders(rows: DataFrame, depth: int) -> DataFrame:
    """The rows that have a neighbour with ``depth`` values in common, in their runs (columns of ``ORDERED``).

    ``prefix`` names the region, a run is known by tree, part and run, and ``own`` is false
    for the row of the run before that a run begins with. A region on the border of two
    partitions has runs in both; its first and last rows are kept even if they are alone.
    """
    width = depth + TAIL

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = batch.column(1).cast(pa.binary(4 * width))
        keys = np.frombuffer(raw.buffers()[1], ">u4", width * len(raw), 4 * width * raw.offset).reshape(-1, width)
        return batch.column(0).to_numpy(), keys.astype(np.uint32), batch.column(2).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n_runs, edge, held = TaskContext.get().partitionId(), 0, True, None

        def regions(tree, keys, ids, last: bool):
            """The batch of all regions but the last, unless ``last``; and where the last one begins."""
            nonlocal n_runs, edge
            same = (tree[1:] == tree[:-1])[:, None] & (keys[1:] == keys[:-1])
            lcp = np.concatenate([[0], np.cumprod(same, axis=1).sum(axis=1)]).astype(np.int64)
            begins = np.flatnonzero(lcp < depth)
            ends = np.append(begins[1:], len(ids))
            if not last:
                begins, ends = begins[:-1], ends[:-1]
            keep = ends - begins > 1
            if edge and len(keep):
                keep[0], edge = True, False
            if last and len(keep):
                keep[-1] = True
            rows, runs, own = [], [], []
            for lo, hi in zip(begins[keep].tolist(), ends[keep].tolist(), strict=True):
                for x, y in cut_runs(lcp[lo:hi], RUN) if hi - lo > RUN else [(0, hi - lo)]:
                    first = lo + max(0, x - 1)
                    rows.append(np.arange(first, lo + y))
                    runs.append(np.full(lo + y - first, n_runs, np.int32))
                    own.append(np.arange(first, lo + y) >= lo + x)
                    n_runs += 1
            if not rows:
                return None
            at = np.concatenate(rows)
            acc = tree[at].astype(np.uint64) + np.uint64(1)
            for j in range(depth):
                acc = mix(acc * _MIX + keys[at, j])
            cols = [pa.array(tree[at]), pa.array(acc.view(np.int64)), pa.array(np.full(len(at), part, np.int32)), pa.array(np.concatenate(runs)), pa.array(np.concatenate(own)), pa.array(ids[at])]
            return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in ORDERED.split(", ")])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = read(batch)
            held = now if held is None else tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            tree, keys, ids = held
            parts = np.flatnonzero((tree[1:] != tree[:-1]) | (keys[1:, :depth] != keys[:-1, :depth]).any(axis=1))
            if len(parts):
                if (out := regions(*held, False)) is not None:
                    yield out
                held = tuple(x[parts[-1] + 1 :] for x in held)
        if held is not None and (out := regions(*held, True)) is not None:
            yield out

    return rows.repartitionByRange("tree", "key", "id").sortWithinPartitions("tree", "key", "id").mapInArrow(run, ORDERED)


def _confirm(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among rows (job, id, comp, side, items): pairs of one job that are similar enough.

    Pairs of one component are skipped, also those joined on the way; so are pairs of
    side 1 with side 1, which other jobs have.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, comps, sides = (table.column(c).to_pylist() for c in ("id", "comp", "side"))
        # Sorted hashes, where Arrow has them: nothing is copied.
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("items")]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
        sizes = np.array([len(sets[i]) for i in order])
        # Sets have no more in common than the lesser of their counts in each bucket, so no similar pair is passed over.
        counts = np.stack([np.bincount((sets[i] >> np.uint64(56)).astype(np.int64), minlength=BUCKETS) for i in order]).astype(np.int32)
        a, b = [], []
        for x, i in enumerate(order):
            end = int(np.searchsorted(sizes, 100 * sizes[x] // percent, "right"))
            most = np.minimum(counts[x + 1 : end], counts[x]).sum(axis=1)
            near = np.flatnonzero(100 * most >= percent * (sizes[x + 1 : end] + sizes[x] - most)) + x + 1
            for j in (order[y] for y in near.tolist()):
                if sides[i] == 1 and sides[j] == 1:
                    continue
                ri, rj = find(comps[i]), find(comps[j])
                if ri == rj:
                    continue
                n, m = len(sets[i]), len(sets[j])
                at = np.searchsorted(sets[j], sets[i])
                both = int((sets[j][np.minimum(at, m - 1)] == sets[i]).sum()) if m else 0
                if 100 * both >= percent * (n + m - both):
                    root[max(ri, rj)] = min(ri, rj)
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("job").applyInArrow(run, "a long, b long")


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """node, root: the smallest node of each connected component, by alternating star contraction.

    Edges become stars around the smallest node; each round is a table in the shared
    folder. Nothing is gathered by node: minima are combined before the shuffle.
    """

    def both_ways(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large_star(e: DataFrame) -> DataFrame:
        sym = both_ways(e)
        least = sym.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        return sym.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        low = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        moved = low.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.union(least.select("a", F.col("m").alias("b")))

    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    mark = None
    while True:
        edges = materialise(small_star(large_star(edges)).distinct(), label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(now)


def _components_of(rows: DataFrame, comp_of: DataFrame | None) -> DataFrame:
    """``rows`` with the component of each id, its own where it has no link."""
    if comp_of is None:
        return rows.withColumn("comp", F.col("id"))
    return rows.join(comp_of.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("root", "id")).drop("root")


def _run_jobs(ordered: DataFrame, comp_of: DataFrame | None, trees: int, sizes: DataFrame) -> DataFrame:
    """The runs of the first trees as jobs; a run of large sets is dealt into several, and later jobs meet what those part."""
    rows = _components_of(ordered.where(F.col("tree") < trees), comp_of).join(sizes, "id")
    total = F.sum("bytes").over(Window.partitionBy("tree", "part", "run"))
    rows = rows.withColumn("cut", F.pmod(F.xxhash64("id"), F.ceil(total / BYTES)).cast("int"))
    return rows.select("id", F.struct("tree", F.col("part").cast("long").alias("region"), "run", F.col("cut").alias("other"), F.lit(0).alias("kind")).alias("job"), "comp", F.lit(0).alias("side"))


def _mixed(ordered: DataFrame, comp_of: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of regions that still hold several components, with the sizes of the largest one (n1, in bytes b1) and the rest (n0, b0).

    Members of the largest component are side 1, the rest side 0.
    """
    rows = _components_of(ordered.where("own").select("tree", "prefix", "id"), comp_of).join(sizes, "id")
    by_comp = rows.groupBy("tree", "prefix", "comp").agg(F.count("*").alias("k"), F.sum("bytes").alias("kb"))
    first = F.struct("k", "comp")
    main = by_comp.groupBy("tree", "prefix").agg(
        F.max_by("comp", first).alias("main"), F.count("*").alias("comps"), F.max("k").alias("n1"), (F.sum("k") - F.max("k")).alias("n0"), F.max_by("kb", first).alias("b1"), (F.sum("kb") - F.max_by("kb", first)).alias("b0")
    )
    return rows.drop("bytes").join(main.where("comps > 1"), ["tree", "prefix"]).withColumn("side", (F.col("comp") == F.col("main")).cast("int"))


def _cross_jobs(rows: DataFrame) -> DataFrame:
    """Block jobs over the rows of :func:`_mixed`: blocks of side 0 meet each other and every block of side 1."""
    blocks = lambda n: F.ceil(F.greatest(F.col(n) / RUN, F.col(n.replace("n", "b")) / BYTES)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    # A hash deals a side into its blocks, so no region is numbered in one task.
    rows = rows.withColumn("block", F.pmod(F.xxhash64("tree", "id"), F.when(F.col("side") == 1, blocks("n1")).otherwise(blocks("n0"))).cast("int"))
    # Job (run, other, kind): block `run` of side 0 with block `other` of side 1, or of side 0.
    with_main = rows.withColumn("o", F.explode(F.when(F.col("side") == 1, upto("n0")).otherwise(upto("n1")))).select(
        "id", "comp", "side", "tree", "prefix", F.when(F.col("side") == 1, F.col("o")).otherwise(F.col("block")).alias("run"), F.when(F.col("side") == 1, F.col("block")).otherwise(F.col("o")).alias("other"), F.lit(1).alias("kind")
    )
    rest = rows.where("side = 0 and n0 > 1 and comps > 2").withColumn("o", F.explode(upto("n0"))).select(
        "id", "comp", F.lit(0).alias("side"), "tree", "prefix", F.least("block", "o").alias("run"), F.greatest("block", "o").alias("other"), F.lit(2).alias("kind")
    )
    return with_main.union(rest).select("id", F.struct("tree", F.col("prefix").alias("region"), "run", "other", "kind").alias("job"), "comp", "side")


def find(docs: DataFrame, shingle_words: int = 2, percent: int = 80, first_trees: int = 2) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id, kept; ``row_key`` is the hash of the set."""
    depth, trees = DEPTH, trees_for(DEPTH, percent)
    sets = materialise(describe(docs, shingle_words, depth * trees), "near-sets")
    known = sets.where("set_key is not null and doc_id is not null")
    nodes = materialise(known.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")), "near-nodes")
    ordered = materialise(orders(order_rows(nodes, depth, trees), depth), "near-orders")
    wanted = ordered.select("id").distinct()

    def make():
        cache = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            items = [shingle_set(c.as_py(), shingle_words, cache).tobytes() for c in batch.column(1)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.binary()), pa.array([len(x) for x in items], pa.int64())], names=["id", "items", "bytes"])

        return step

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("text is not null").join(wanted, "id", "left_semi")
    # Of rows with one id, each brings its set: a link of any of them is a link of the id.
    items = materialise(map_batches(texts, make, "id long, items binary, bytes long"), "near-items")
    sizes = items.groupBy("id").agg(F.sum("bytes").alias("bytes"))
    items = items.drop("bytes")

    as_edges = lambda c: c.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = None
    while True:
        links = materialise(_confirm(_run_jobs(ordered, roots, first_trees, sizes).join(items, "id"), percent), "near-links")
        roots = components(links if roots is None else as_edges(roots).union(links))
        mixed = materialise(_mixed(ordered, roots, sizes), "near-mixed")
        wide = (F.col("n0") * (F.col("n0") + F.col("n1")) > WIDE) & F.lit(depth < DEEPEST)
        links = materialise(_confirm(_cross_jobs(mixed.where(~wide)).join(items, "id"), percent), "near-links")
        roots = components(as_edges(roots).union(links))
        deeper = mixed.where(wide).select("id").distinct()
        if deeper.isEmpty():
            break
        depth = 2 * depth
        ordered = materialise(orders(order_rows(items.join(deeper, "id", "left_semi"), depth, trees_for(depth, percent)), depth), "near-orders")
    node_root = nodes.select("set_key", "id").join(roots.withColumnRenamed("node", "id"), "id", "left").select("set_key", F.coalesce("root", "id").alias("component"))
    mine = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return sets.select("doc_id", "n_shingles", "set_key").join(node_root, "set_key", "left").select(
        "doc_id", F.col("set_key").alias("row_key"), "n_shingles", mine.alias("component_id"), F.coalesce(mine == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def dedup(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id (null last), row_key, number of the row.

    Rows are numbered in a stored table and compared by that number, so rows that share a doc_id, or have none,
    are documents of their own.
    """
    row = fresh("_sl_row", docs.columns)
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    ids = rows.select(row, F.col("doc_id").cast("long").alias("id"))
    found = find(rows.select(F.col(row).alias("doc_id"), "text"), shingle_words, percent).select(F.col("doc_id").alias(row), "row_key", "component_id")
    found = materialise(found.join(ids, row).withColumn("place", F.struct(F.col("id").isNull(), "id", "row_key", row)).drop("id", "row_key"), "near-found")
    best = found.groupBy("component_id").agg(F.min("place").alias("best"), F.count("*").alias("n")).where("n > 1")
    gone = found.join(best, "component_id").where(F.col("place") != F.col("best")).select(row)
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
