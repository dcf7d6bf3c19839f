"""Words that differ by one code point, grouped under their commonest spelling.

Words are counted in the JVM. Each then has a vector: how often each of 24 groups of
letters occurs in it, the commonest letters in groups of their own. Two words one code
point apart have vectors that differ by one surplus, one deficit, or one of each (or by
nothing, where both letters are of one group). The vectors, in lexicographic order, are a
trie: a level for each group, a branch for each count. It is cut into cells, subtrees of
some thousand words, by the counts of its upper nodes. A depth-first search carries all
words of a batch through the trie at once, each with a budget of one surplus and then one
deficit, first through the upper nodes, which says what cells a word must visit, then
through the cell. A cell that very many words visit is dealt to several tasks, each with all
words of the cell and a share of the visitors. What reaches a leaf together is compared letter by letter. A pair is met
once, from the word whose vector is larger, since its first difference is the surplus.

Defined results: a null text has no words, a null id counts as an empty string, repeated
rows count again, other columns are ignored, an empty table gives no rows. Texts and words
are read whole; words of over 32 code points are compared one pair at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean_batches, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters with a group, and so a level, of their own; the others share eight more by code point.
OWN_LEVELS = "enaitohrsludcgbf"
LEVELS = len(OWN_LEVELS) + 8
#: Counts from here on share a branch, which brings vectors nearer together and never apart.
MOST = 15
#: Levels that the first count of the trie's nodes goes down; so there are at most 16 ** 4 of them.
FIRST_LEVELS = 4
#: A cell has at most so many words, or 1 / 8192 of all, unless they share a whole vector; so there are 8192 larger nodes on a level at most.
CELL_WORDS, CELLS = 16_384, 8_192
#: Words that visit a cell in one task, by the most words that a cell has.
ASKED = 4
#: Words that go through a cell at once, pairs that are compared at once, vectors that are compared without further branching, bytes of a word in a matrix.
BATCH, PAIRS, BUCKET, WIDE = 65_536, 1 << 18, 128, 32


def counts(docs: DataFrame, modulus: int = 31, least: int = 7) -> DataFrame:
    """word, n: maximal runs of letters up to U+00FF, A-Z lowered, where one of ``modulus`` loses a code point; of ``least`` or more."""
    run = F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    rows = rows.select("id", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"), F.char_length("run").alias("length"))
    at = (F.col("h") % F.col("length")).cast("int")
    word = F.when(F.col("h") % modulus == 0, F.concat(F.expr("substring(run, 1, cast(h % length as int))"), F.expr("substring(run, cast(h % length as int) + 2)"))).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


def _levels() -> np.ndarray:
    out = np.arange(256) % 8 + len(OWN_LEVELS)
    out[[ord(c) for c in OWN_LEVELS]] = np.arange(len(OWN_LEVELS))
    return out


def vectors(words: list[bytes]) -> np.ndarray:
    """A row for each word (one byte a code point) with the counts of its letter groups."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.repeat(np.arange(len(words)), size) * LEVELS + _levels()[np.frombuffer(b"".join(words), np.uint8)]
    return np.minimum(np.bincount(at, minlength=len(words) * LEVELS), MOST).astype(np.int8).reshape(-1, LEVELS)


def _key(v: np.ndarray, depth: int) -> np.ndarray:
    """Upper nodes by the levels above them, four bits each, 15 levels at most."""
    key = np.zeros(len(v), np.int64)
    for k in range(depth):
        key = key << 4 | v[:, k]
    return key


@dataclass
class Cells:
    """The upper trie: rows of ``first`` are the least vectors of the cells, each cut after ``depth`` levels, in order."""

    prefix: np.ndarray
    depth: np.ndarray


def _decode(prefix: int, depth: int) -> list[int]:
    return [prefix >> 4 * (depth - 1 - k) & 15 for k in range(depth)]


def cells(words: DataFrame, total: int, cell_words: int = CELL_WORDS) -> Cells:
    """Cut the trie where a node has few enough words; counts of at most 16 ** 4 nodes, then of the children of large ones, reach the driver."""
    most = max(cell_words, total // CELLS)
    found: list[tuple[int, ...]] = []
    large: list[tuple[int, ...]] = [()]
    depth = 0
    while large and depth < 15:
        step = min(FIRST_LEVELS if depth == 0 else 2, 15 - depth)
        inside = np.sort(np.array([sum(c << 4 * (len(p) - 1 - k) for k, c in enumerate(p)) for p in large], np.int64))
        nodes = _node_counts(words, depth, step, inside)
        depth += step
        # Counts of the levels between follow from those below.
        tree: dict[tuple[int, ...], int] = {}
        for key, n in nodes:
            path = tuple(_decode(key, depth))
            for d in range(depth - step + 1, depth + 1):
                tree[path[:d]] = tree.get(path[:d], 0) + n
        big = {p for p, n in tree.items() if n > most}
        roots = set(large)
        found += [p for p in tree if p not in big and (p[:-1] in big or p[:-1] in roots)]
        large = [p for p in big if len(p) == depth]
    found = sorted(found + large)
    prefix = np.full((len(found), LEVELS), -1, np.int8)
    for i, p in enumerate(found):
        prefix[i, : len(p)] = p
    return Cells(prefix, np.array([len(p) for p in found], np.int64))


def _node_counts(words: DataFrame, depth: int, step: int, inside: np.ndarray) -> list[tuple[int, int]]:
    """Words of each node ``step`` levels below the given ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = vectors([w.encode("latin-1") for w in batch["word"].to_pylist()])
            if depth:
                v = v[np.isin(_key(v, depth), inside)]
            keys, n = np.unique(_key(v, depth + step), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], names=["node", "n"])

    rows = words.select("word").mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    return [(r["node"], r["n"]) for r in rows.collect()]


class Trie:
    """Sorted distinct vectors: a node is a run of rows that agree on the levels above it."""

    def __init__(self, sorted_vectors: np.ndarray, depth: np.ndarray | None = None):
        self.v = sorted_vectors
        #: Levels that count for each row; below them, anything goes.
        self.depth = depth

    def search(self, q: np.ndarray, found) -> None:
        """``found(words, lo, hi)``, again and again: rows of ``q`` that are the rows lo to hi, or one more of a group, or that and one less of a later one."""
        if len(self.v) and len(q):
            self._visit(0, len(self.v), 0, q, np.arange(len(q)), np.zeros(len(q), np.int8), found)

    def _visit(self, lo: int, hi: int, k: int, q: np.ndarray, live: np.ndarray, spent: np.ndarray, found) -> None:
        """spent: 0 nothing, 1 the surplus, 2 the surplus and the deficit."""
        if hi - lo == 1 and self.depth is not None:
            live = self._rest(lo, k, int(self.depth[lo]), q, live, spent)
            if len(live):
                found(live, lo)
            return
        if self.depth is None and (hi - lo <= BUCKET or k == LEVELS):
            self._bucket(lo, hi, q, live, found)
            return
        column = self.v[lo:hi, k]
        cuts = np.flatnonzero(column[1:] != column[:-1]) + lo + 1
        mine = q[live, k]
        for a, b in zip([lo, *cuts.tolist()], [*cuts.tolist(), hi], strict=True):
            diff = mine - self.v[a, k]
            ok = (diff == 0) | (diff == 1) & (spent == 0) | (diff == -1) & (spent == 1)
            if ok.any():
                self._visit(a, b, k + 1, q, live[ok], spent[ok] + (diff[ok] != 0), found)

    def _rest(self, row: int, k: int, depth: int, q: np.ndarray, live: np.ndarray, spent: np.ndarray) -> np.ndarray:
        spent = spent.copy()
        for j in range(k, depth):
            diff = q[live, j] - self.v[row, j]
            ok = (diff == 0) | (diff == 1) & (spent == 0) | (diff == -1) & (spent == 1)
            live, spent = live[ok], spent[ok] + (diff[ok] != 0)
        return live

    def _bucket(self, lo: int, hi: int, q: np.ndarray, live: np.ndarray, found) -> None:
        """Few vectors: those at a squared distance of two at most, of which a surplus, or a surplus before a deficit, stays."""
        v, each = self.v[lo:hi].astype(np.float32), max(1, PAIRS * 4 // (hi - lo))
        norm = (v * v).sum(1)
        for at in range(0, len(live), each):
            some = q[live[at : at + each]].astype(np.float32)
            apart = some @ v.T
            apart *= -2
            apart += norm
            apart += (some * some).sum(1)[:, None]
            who, what = np.nonzero(apart <= 2.5)
            who, what = live[at : at + each][who], what + lo
            diff = q[who] - self.v[what]
            total, change = diff.sum(1), np.abs(diff).sum(1)
            first = diff[np.arange(len(diff)), (diff != 0).argmax(1)]
            ok = (change == 0) | (first == 1) & ((total == 1) & (change == 1) | (total == 0) & (change == 2))
            if ok.any():
                found(who[ok], what[ok])


def _matrix(words: list[bytes], size: np.ndarray) -> np.ndarray:
    """The first bytes of each word, with zeros behind."""
    out = np.zeros((len(words), WIDE + 1), np.uint8)
    kept = np.minimum(size, WIDE)
    row = np.repeat(np.arange(len(words)), kept)
    col = np.arange(len(row)) - np.repeat(np.cumsum(kept) - kept, kept)
    out[row, col] = np.frombuffer(b"".join([w[:WIDE] for w in words]), np.uint8)
    return out


def one_apart(a: bytes, b: bytes) -> bool:
    """Exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


class Words:
    """Words of a cell or a batch with what comparisons need."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n = words, n
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.v, self.bytes = vectors(words), _matrix(words, self.size)
        self.near = np.zeros(len(words), np.int64)
        self.best_n = np.zeros(len(words), np.int64)
        self.best: list[bytes | None] = [None] * len(words)

    def take(self, order: np.ndarray) -> "Words":
        return Words([self.words[i] for i in order.tolist()], self.n[order])

    def gain(self, mine: np.ndarray, other: "Words", theirs: np.ndarray) -> None:
        """Words ``mine`` have near words ``theirs`` of ``other``: the one of largest n, then least in order, is kept."""
        self.near += np.bincount(mine, minlength=len(self.near))
        n = other.n[theirs]
        for i in np.flatnonzero(n >= self.best_n[mine]).tolist():
            w, k, word = int(mine[i]), int(n[i]), other.words[theirs[i]]
            if k > self.best_n[w] or k == self.best_n[w] and (self.best[w] is None or word < self.best[w]):
                self.best_n[w], self.best[w] = k, word

    def rows(self) -> pa.RecordBatch | None:
        some = np.flatnonzero(self.near)
        if not len(some):
            return None
        text = lambda x: [x[i].decode("latin-1") for i in some.tolist()]
        return pa.RecordBatch.from_arrays([pa.array(text(self.words)), pa.array(self.near[some]), pa.array(self.best_n[some]), pa.array(text(self.best))], names=["word", "n_near", "best_n", "best"])


def _verified(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Which of the pairs are one code point apart."""
    more = a.size[i] - b.size[j]
    ok = np.zeros(len(i), bool)
    long = (a.size[i] > WIDE) | (b.size[j] > WIDE)
    same = np.flatnonzero((more == 0) & ~long)
    ok[same] = (a.bytes[i[same]] != b.bytes[j[same]]).sum(1) == 1
    for longer, l, shorter, s, sign in ((a, i, b, j, 1), (b, j, a, i, -1)):
        cut = np.flatnonzero((more == sign) & ~long)
        if len(cut):
            x, y = longer.bytes[l[cut]], shorter.bytes[s[cut], :WIDE]
            apart, moved = x[:, :WIDE] != y, x[:, 1:] != y
            first = np.where(apart.any(1), apart.argmax(1), WIDE)
            last = np.where(moved.any(1), WIDE - 1 - moved[:, ::-1].argmax(1), -1)
            ok[cut] = last < first
    for k in np.flatnonzero(long).tolist():
        ok[k] = one_apart(a.words[i[k]], b.words[j[k]])
    return ok


class Cell:
    """The words of a cell under its trie."""

    def __init__(self, words: Words):
        order = np.lexsort(words.v.T[::-1])
        self.own = words.take(order)
        v = self.own.v
        starts = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]).any(1)])
        self.start, self.size = starts, np.diff(np.r_[starts, len(v)])
        self.trie = Trie(np.ascontiguousarray(v[starts]))

    def search(self, batch: Words, own: bool) -> None:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        pending = 0

        def settle() -> None:
            nonlocal pending
            if not held:
                return
            q, c = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            held.clear()
            pending = 0
            size = self.size[c]
            ends = np.cumsum(size)
            # Leaves may hold many words: their pairs come in slices of a bounded number.
            for lo in range(0, int(ends[-1]), PAIRS):
                at = np.arange(lo, min(lo + PAIRS, int(ends[-1])))
                which = np.searchsorted(ends, at, "right")
                i, j = q[which], self.start[c[which]] + at - (ends[which] - size[which])
                if own:
                    i, j = i[j != i], j[j != i]
                    twin = (batch.v[i] == self.own.v[j]).all(1)
                    i, j = i[~twin | (j < i)], j[~twin | (j < i)]
                ok = _verified(batch, i, self.own, j)
                i, j = i[ok], j[ok]
                batch.gain(i, self.own, j)
                self.own.gain(j, batch, i)

        def found(q: np.ndarray, c: np.ndarray) -> None:
            nonlocal pending
            held.append((q, c))
            pending += int(self.size[c].sum())
            if pending >= PAIRS:
                settle()

        self.trie.search(batch.v, found)
        settle()


def _route(tree: Cells, words: list[str], n: np.ndarray) -> pa.RecordBatch:
    """A row for each word and cell that it visits; ``mine`` in its own."""
    v = vectors([w.encode("latin-1") for w in words])
    who: list[np.ndarray] = []
    where: list[np.ndarray] = []

    def found(q: np.ndarray, row: int) -> None:
        who.append(q)
        where.append(np.full(len(q), row, np.int32))

    Trie(tree.prefix, tree.depth).search(v, found)
    q, c = np.concatenate(who), np.concatenate(where)
    levels = np.arange(LEVELS)
    mine = ((v[q] == tree.prefix[c]) | (levels >= tree.depth[c][:, None])).all(1)
    return pa.RecordBatch.from_arrays([pa.array(c), pa.array(mine), pa.array(words).take(pa.array(q)), pa.array(n[q])], names=["cell", "mine", "word", "n"])


def _tasks(words: DataFrame, total: int) -> int:
    """Tasks for work that is heavy for its bytes: as many as shuffles have, more for many words."""
    return max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // CELL_WORDS)


def shared_out(routed: DataFrame, most: int) -> DataFrame:
    """``routed`` with ``part``: cells with over ``most`` visitors have several, each with all words of the cell and a share of the visitors."""
    parts = routed.groupBy("cell").agg(F.ceil(F.sum((~F.col("mine")).cast("long")) / most).cast("int").alias("parts")).where("parts > 1")
    rows = routed.join(F.broadcast(parts), "cell", "left")
    part = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("mine"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))
    return rows.select("cell", F.explode(part).alias("part"), "mine", "word", "n")


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n_near, best_n, best for each of the distinct ``words`` (word, n) that has near words: their number, the largest n of them, and the first word with it."""
    total = words.count()
    tree = cells(words, total, cell_words)
    lean_batches(words.sparkSession)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            held.clear()
            return _route(tree, t["word"].to_pylist(), t["n"].to_numpy())

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= BATCH // 2:
                    yield out()
        if held:
            yield out()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell = None, None  # at: a cell and a part of it
        own: list[pa.RecordBatch] = []
        asked: list[pa.RecordBatch] = []

        def words_of(parts: list[pa.RecordBatch]) -> Words:
            t = pa.Table.from_batches(parts)
            parts.clear()
            return Words([w.encode("latin-1") for w in t["word"].to_pylist()], t["n"].to_numpy())

        def answers(last: bool) -> Iterator[pa.RecordBatch]:
            """Of the words that have asked; with ``last`` also those of the cell, which ends."""
            nonlocal cell
            if own:
                cell = Cell(words_of(own))
                if at[1] == 0:  # the other parts have the same words
                    cell.search(cell.own, True)
            found = []
            if asked:
                batch = words_of(asked)
                cell.search(batch, False)
                found.append(batch.rows())
            if last and cell is not None:
                found.append(cell.own.rows())
                cell = None
            yield from (x for x in found if x is not None)

        for batch in batches:
            ids, parts = batch["cell"].to_numpy(), batch["part"].to_numpy()
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]) | (parts[1:] != parts[:-1])) + 1).tolist(), len(ids)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if (ids[lo], parts[lo]) != at:
                    yield from answers(True)
                    at = (ids[lo], parts[lo])
                part = batch.slice(lo, hi - lo)
                mine = part["mine"].true_count
                if mine:
                    own.append(part.slice(0, mine))
                if mine < part.num_rows:
                    asked.append(part.slice(mine))
                    if sum(p.num_rows for p in asked) >= BATCH:
                        yield from answers(False)
        yield from answers(True)

    routed = materialise(words.select("word", "n").mapInArrow(route, "cell int, mine boolean, word string, n long"), "spelling-routes")
    dealt = shared_out(routed, ASKED * max(cell_words, total // CELLS))
    met = dealt.repartition(_tasks(words, total), "cell", "part").sortWithinPartitions("cell", "part", F.desc("mine")).mapInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("k"), "best"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.k")).alias("best_n"), "b.best")


def group(docs: DataFrame, ratio: int = 10, least_n: int = 2, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n, root: a word's form is its commonest near word if ``ratio`` times as common; the root ends the chain of forms."""
    words = counts(docs).where(F.col("n") >= least_n)
    words = materialise(words.repartition(_tasks(words, 0)), "spelling-words")
    near = near_words(words, cell_words)
    formed = F.col("best_n") >= ratio * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
    )
    rows = materialise(rows, "spelling-forms")
    most = rows.agg(F.max("n")).first()[0] or 1
    # Each form is ``ratio`` times as common as its word, so chains have a known length and halve in each round.
    links = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, math.log(most, ratio)))))):
        links = links.join(links.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
