"""Language-model scoring with a weighted backoff automaton.

The model is a smoothed trigram model: P(w | h) is
((1 - g) * c(hw) + (mu + g * c(h)) * P(w | shorter h)) / (c(h) + mu), down to
add-one unigrams; g, the share taken from each count, is the corpus's share of
n-grams seen once among all. As an automaton, each seen history is a state, each
seen n-gram an arc with its log-probability and the state it leads to, and each
state has a failure arc to the next shorter history, with weight
(mu + g * c(h)) / (c(h) + mu). A text is scored in one traversal from left to
right that carries the state: a token takes the arc of the state, or the failure
arcs until a state has one, whose weights add up.

The model covers the whole training corpus and is never held in one place.
Documents are dealt into blocks of bounded size, and each block is turned into
token numbers once, in a table that requests and scores read instead of texts.
Each block asks, for every distinct n-gram of its documents, how often the
corpus has it: the requests go
to shards by hash, carry the block's own counts, and the answers come back in
the order of the requests. From them each block builds the states and arcs that
its documents can reach, and traverses them.

n-grams are known by 56 bits of a hash: among 10^10 different ones, a given one
shares its hash with another with probability 10^-7. Requests are sorted,
delta-coded and compressed; answers carry the counts only.

Defined results: a null or empty text is one end token; repeated rows count
and are scored one by one; a null doc_id counts as the empty string where the
held-out part is chosen; other columns are ignored; an empty table gives an
empty one. With no training text every count is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, utf8
from .neardup import WordHashes, mix
from .toxicity import held_out

ORDER = 3
MU = 2.0
#: Bytes of text in a block, and tokens of a segment. More memory allows larger blocks and less traffic.
BLOCK_BYTES, SEGMENT = 6 << 20, 128
_U = np.uint64
_MIX = _U(0x9E3779B97F4A7C15)
END, BEGIN = _U(0x1234567890ABCDEF), _U(0x0FEDCBA987654321)


def pack(x: np.ndarray) -> bytes:
    """Sorted 64-bit numbers: differences, byte planes, Zstandard."""
    import zstandard

    d = np.diff(x, prepend=_U(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(_U).ravel(), dtype=_U)


def pack_counts(x: np.ndarray) -> bytes:
    import zstandard

    wide = x.astype(np.int64)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_counts(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


class Tokens:
    """Documents of a block as one array of token hashes, each ended by END, with where they begin."""

    def __init__(self, texts, cache: WordHashes):
        parts, lengths = [], []
        for text in texts:
            words = utf8(text).lower().split()
            h = np.empty(len(words) + 1, _U)
            h[:-1] = np.fromiter(map(cache.__getitem__, words), _U, len(words))
            h[-1] = END
            parts.append(h)
            lengths.append(len(h))
        self.hashes = np.concatenate(parts) if parts else np.empty(0, _U)
        self.lengths = np.array(lengths, np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.vocabulary, self.words = np.unique(self.hashes, return_inverse=True)

    @classmethod
    def stored(cls, lengths: np.ndarray, vocabulary: np.ndarray, words: np.ndarray) -> Tokens:
        """The same from lengths, sorted distinct token hashes, and the number of the one at each token."""
        self = cls.__new__(cls)
        self.hashes, self.lengths, self.begins = vocabulary[words], lengths, np.cumsum(lengths) - lengths
        self.vocabulary, self.words = vocabulary, words
        return self

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n-gram that ends at each token; before a text stands BEGIN. Order 1 is the token's own."""
        h, m = self.hashes, len(self.hashes)
        acc = h.copy()
        place = np.arange(m) - np.repeat(self.begins, self.lengths)
        for j in range(1, n):
            before = np.full(m, BEGIN, _U)
            before[j:] = h[:-j] if j else h
            before[place < j] = BEGIN
            acc = mix(acc * _MIX + before + _U(j))
        return acc >> _U(8)

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams in order, and the number of the one that ends at each token."""
        if n == 1:
            keys, where = np.unique(self.vocabulary >> _U(8), return_inverse=True)
            return keys, where[self.words]
        return np.unique(self.grams(n), return_inverse=True)


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the high bits, so that sorted hashes are grouped by shard."""
    return ((grams >> _U(24)) * _U(shards)) >> _U(32)


BLOCK = "block int, doc_id array<long>, held_out array<boolean>, lengths array<long>, vocabulary binary, words binary"
REQUEST = "block int, shard int, n int, grams binary, counts binary"
#: Blocks are rows of some MB: row groups are closed by their bytes, looked at after every row.
_ROW_GROUPS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


def _tokenise(rows: pa.Table) -> pa.Table:
    """The documents of one block as one row."""
    tokens = Tokens((c.as_py() for c in rows.column("text")), WordHashes())
    return pa.table({
        "block": rows.column("block").slice(0, 1),
        "doc_id": pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
        "held_out": pa.array([rows.column("held_out").to_pylist()], pa.list_(pa.bool_())),
        "lengths": pa.array([tokens.lengths], pa.list_(pa.int64())),
        "vocabulary": pa.array([pack(tokens.vocabulary)], pa.binary()),
        "words": pa.array([pack_counts(tokens.words)], pa.binary()),
    })


def _stored(block: pa.RecordBatch | pa.Table) -> Tokens:
    lengths, vocabulary, words = (block.column(c)[0].as_py() for c in ("lengths", "vocabulary", "words"))
    return Tokens.stored(np.array(lengths, np.int64), unpack(vocabulary), unpack_counts(words))


def _requests(row: pa.RecordBatch, orders: tuple[int, ...], shards: int) -> pa.RecordBatch:
    """Of one block: for each of the orders and each shard, the distinct n-grams and their training counts here."""
    block = row.column("block")[0].as_py()
    tokens = _stored(row)
    learn = np.repeat(~np.array(row.column("held_out")[0].as_py(), bool), tokens.lengths)
    cols: list[list] = [[] for _ in range(5)]
    for n in orders:
        keys, where = tokens.distinct(n)
        counts = np.bincount(where, weights=learn, minlength=len(keys)).astype(np.int64)
        cuts = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1, dtype=_U))
        for s in range(shards):
            a, b = int(cuts[s]), int(cuts[s + 1])
            if a < b:
                for x, v in zip(cols, (block, s, n, pack(keys[a:b]), pack_counts(counts[a:b])), strict=True):
                    x.append(v)
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types, strict=True)], names=["block", "shard", "n", "grams", "counts"])


def _answers(rows: pa.Table) -> pa.Table:
    """Of one shard and order: the corpus counts for each block, in the order it asked."""
    keys = [unpack(x) for x in rows.column("grams").to_pylist()]
    counts = [unpack_counts(x) for x in rows.column("counts").to_pylist()]
    lengths = [len(k) for k in keys]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    first = np.diff(every[order], prepend=~every[order[:1]]) != 0
    group = np.cumsum(first) - 1
    totals = np.bincount(group, weights=np.concatenate(counts)[order]).astype(np.int64)
    back = np.empty(len(every), np.int64)
    back[order] = totals[group]
    cuts = np.cumsum(lengths)[:-1]
    return pa.table({
        "block": rows.column("block"), "shard": rows.column("shard"), "n": rows.column("n"),
        "totals": pa.array([pack_counts(x) for x in np.split(back, cuts)], pa.binary()),
        # Once for the shard: n-grams seen once, different ones, and all.
        **{k: pa.array([int(v)] + [0] * (len(lengths) - 1), pa.int64()) for k, v in (("once", (totals == 1).sum()), ("types", (totals > 0).sum()), ("all", totals.sum()))},
    })


class Automaton:
    """States, arcs and failure arcs over the n-grams of one block, as arrays.

    State 0 is the root, states 1 to order - 1 are the beginnings of a text (so many BEGINs),
    and each n-gram of fewer than order tokens that the corpus has is one more. An arc is
    known by state * words + word; the root has one for every word of the block.
    """

    def __init__(self, tokens: Tokens, order: int, counts: dict[int, np.ndarray], grams: dict[int, tuple[np.ndarray, np.ndarray]], total: int, types: int, texts: int, share: dict[int, float]):
        """``counts[n]`` of the distinct n-grams, and in ``grams[n]`` a token where each ends and the number of the one at each token."""
        place = np.arange(len(tokens.hashes)) - np.repeat(tokens.begins, tokens.lengths)
        self.order, self.words, self.word = order, len(counts[1]), grams[1][1]
        states = {0: np.zeros(1, np.int64)}
        held, fails = [total] + [texts] * (order - 1), [0] + list(range(order - 1))
        held, fails, lengths = [np.array(held, np.float64)], [np.array(fails, np.int64)], [np.arange(order)]
        n_states = order
        for k in range(1, order):
            seen = counts[k] > 0
            states[k] = np.where(seen, np.cumsum(seen) - 1 + n_states, -1)
            n_states += int(seen.sum())
            held.append(counts[k][seen].astype(np.float64))
            fails.append(np.zeros(int(seen.sum()), np.int64) if k == 1 else states[k - 1][grams[k - 1][1][grams[k][0][seen]]])
            lengths.append(np.full(int(seen.sum()), k))
        held, self.fail, length = np.concatenate(held), np.concatenate(fails), np.concatenate(lengths)
        taken = np.array([0.0, 0.0] + [share[n] for n in range(2, order + 1)])[length + 1]
        # What the failure arc of a state weighs; the root has none.
        weight = (MU + taken * held) / (held + MU)
        weight[0] = 1.0
        self.log_fail = np.log10(weight)

        prob = (counts[1] + 1.0) / (total + types + 1.0)
        keys, logs, targets = [np.arange(self.words)], [np.log10(prob)], [np.maximum(states[1], 0) if order > 1 else np.zeros(self.words, np.int64)]
        for n in range(2, order + 1):
            at, c = grams[n][0], counts[n]
            shorter = grams[n - 1][1][at]
            history = np.where(place[at] > 0, states[n - 1][grams[n - 1][1][at - 1]], n - 1)
            seen = c > 0
            h = np.where(seen, history, 0)
            prob = np.where(seen, (1 - share[n]) * c / (held[h] + MU) + weight[h] * prob[shorter], 0.0)
            keys.append(history[seen] * self.words + self.word[at[seen]])
            logs.append(np.log10(prob[seen]))
            targets.append(states[n][seen] if n < order else states[n - 1][shorter[seen]])
        keys = np.concatenate(keys)
        by = np.argsort(keys, kind="stable")
        self.arcs, self.logs, self.targets = keys[by], np.concatenate(logs)[by], np.concatenate(targets)[by]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log10 probability of each word in its state, and the state after it."""
        cost, after, todo = np.zeros(len(state)), np.empty(len(state), np.int64), np.arange(len(state))
        while len(todo):
            key = state[todo] * self.words + word[todo]
            arc = np.searchsorted(self.arcs, key)
            arc[arc == len(self.arcs)] = 0
            hit = self.arcs[arc] == key
            done, arc = todo[hit], arc[hit]
            cost[done] += self.logs[arc]
            after[done] = self.targets[arc]
            todo = todo[~hit]
            cost[todo] += self.log_fail[state[todo]]
            state[todo] = self.fail[state[todo]]
        return cost, after


def walk(tokens: Tokens, model: Automaton) -> np.ndarray:
    """Log10 probability of each token of the block, by one traversal of the automaton.

    The texts are cut into segments that are walked side by side, one token to the right in
    each step. A segment begins order - 1 tokens early, which leads it from the root, or from
    the beginning of its text, into the state that all tokens before it lead to.
    """
    logs = np.zeros(len(tokens.hashes))
    if not len(logs):
        return logs
    first = np.concatenate([np.arange(b, b + n, SEGMENT) for b, n in zip(tokens.begins.tolist(), tokens.lengths.tolist(), strict=True)])
    doc = np.searchsorted(tokens.begins, first, side="right") - 1
    stop = np.minimum(first + SEGMENT, (tokens.begins + tokens.lengths)[doc])
    at = np.maximum(first - (model.order - 1), tokens.begins[doc])
    state = np.where(at == tokens.begins[doc], model.order - 1, 0)
    while len(at):
        cost, state = model.step(state.copy(), model.word[at])
        own = at >= first
        logs[at[own]] = cost[own]
        at = at + 1
        live = at < stop
        at, first, stop, state = at[live], first[live], stop[live], state[live]
    return logs


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(key, block: pa.Table, answers: pa.Table, order: int, shards: int, total: int, types: int, texts: int, share: dict[int, float]) -> pa.Table:
    names = [f.split()[0] for f in SCORES.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    if not block.num_rows:
        return pa.table({n: pa.array([], t) for n, t in zip(names, kinds, strict=True)})
    tokens = _stored(block)
    got = {(s, n): x for s, n, x in zip(answers.column("shard").to_pylist(), answers.column("n").to_pylist(), answers.column("totals").to_pylist(), strict=True)}
    counts, grams = {}, {}
    for n in range(1, order + 1):
        keys, where = tokens.distinct(n)
        counts[n] = np.concatenate([unpack_counts(got.pop((s, n))) for s in range(shards) if (s, n) in got])
        if len(keys) != len(counts[n]):
            raise ValueError(f"block {key[0]}: {len(keys)} {n}-grams and {len(counts[n])} answers")
        end = np.empty(len(keys), np.int64)
        end[where] = np.arange(len(where))
        grams[n] = end, where
    logs = walk(tokens, Automaton(tokens, order, counts, grams, total, types, texts, share))
    seen = counts[1][grams[1][1]]
    base = np.log10((seen + 1.0) / (total + types + 1.0))
    known = (seen > 0).astype(np.float64)
    doc = np.repeat(np.arange(len(tokens.lengths)), tokens.lengths)
    by = lambda x: np.bincount(doc, weights=x, minlength=len(tokens.lengths))
    ids, held = (block.column(c)[0].as_py() for c in ("doc_id", "held_out"))
    cols = [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(tokens.lengths), pa.array(by(known).astype(np.int64)), pa.array(by(base)), pa.array(by(logs))]
    return pa.table(dict(zip(names, cols, strict=True)))


def score(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES, mod: int = 7, rest: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", held_out(F.col("doc_id"), mod, rest))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count("*").alias("n"), F.count_if(~F.col("held_out")).alias("texts")).first()
    blocks = max(1, -(-size["bytes"] // block_bytes))
    shards = blocks
    # The text's hash deals rows with one id to several blocks.
    dealt = own.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    stored = materialise(dealt.groupBy("block").applyInArrow(_tokenise, BLOCK), "lm-blocks", **_ROW_GROUPS)

    def answered(orders: tuple[int, ...]) -> DataFrame:
        requests = map_batches(stored, lambda: lambda row: _requests(row, orders, shards), REQUEST, rows=1)
        return materialise(requests.groupBy("shard", "n").applyInArrow(_answers, "block int, shard int, n int, totals binary, once long, types long, all long"), "lm-answers")

    # The longer n-grams ask in jobs of their own, so that not all requests lie on disk at once.
    answers = answered(tuple(n for n in (1, 2) if n <= order))
    for n in range(3, order + 1):
        answers = answers.union(answered((n,)))
    # A row for each order comes to the driver.
    sums = {r["n"]: r for r in answers.groupBy("n").agg(F.sum("once").alias("once"), F.sum("types").alias("types"), F.sum("all").alias("all")).collect()}
    total, types, texts = (sums[1]["all"], sums[1]["types"], size["texts"]) if sums else (0, 0, 0)
    share = {n: min(0.99, max(0.01, r["once"] / max(1, r["all"]))) for n, r in sums.items()}
    scored = stored.groupBy("block").cogroup(answers.select("block", "shard", "n", "totals").groupBy("block")).applyInArrow(lambda key, left, right: _score(key, left, right, order, shards, total, types, texts, share), SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
