"""LM scoring by a hierarchical Pitman-Yor model whose seating is sampled by Gibbs.

Tokens are words (A-Z lower-cased) and one end per text. A token is a customer of the restaurant of its context, the two
tokens before it; the parent of that restaurant is the one of the last token alone, whose parent is the root, whose own
parent is uniform over the V known tokens and one for all unknown ones. Every context of the training texts, of one token or
of two, has its own restaurant, so the model grows with the corpus. A dish's first customer opens a table, and each table is
a customer of the parent.

Gibbs: a sweep lets all customers of a dish in a restaurant leave and seats them again one after the other, a new table with
probability a / (a + n - d t), a = (theta + d T) P_parent(dish), for n customers and t tables of the dish so far and T
tables in the restaurant. Each customer has a random number of its own, so that the decisions of all dishes' customers can be followed
at once: the same rule for two customers or a billion (see seat). All restaurants of a level go on at once, under the totals of the sweep before. The first
`burn` sweeps are passed over, and the predictive probabilities of the others are averaged. Every draw is a hash of dish,
restaurant and sweep, and all counts are whole numbers, so scores don't depend on how the input is dealt (but for the last bits of sums).
Discounts are estimated from the numbers of dishes with one and two customers, level by level.

How it is spread: a bucket holds the restaurants of its last tokens and those below them, so that two of three levels are
local. The dishes of a last token with more than a quarter of a bucket's share of all tokens are dealt over all
buckets by hash (`frequent` finds them; this changes where things are, not what they are). What buckets share is summed by key in
parts: the root's customers of each word, and the totals of restaurants whose dishes are spread. Buckets send keys
once and then what has changed; parts seat the root and send sums back, and with them the bucket's own seating. The blocks of tokens are shuffled once: all passes
read the same exchange within one plan, so that a lost executor's share is made again from it or from the input.

What moves: for each chunk of about `chunk_tokens` tokens and each bucket one block of hashes, different triples and the
documents of their occurrences, about ten bytes a token (more where many buckets make blocks small, as each then names more words for
itself), and back sums for each document of the chunk. A frequent triple is one entry
a chunk and a few bytes for each of its places. Every word of every text counts.

Defined results: null, empty and blank texts are one end; held out is crc32 of the id's decimal text modulo 10 = 0 (a
null id's text is empty, so it is held out); repeated rows count each time; a context that was never met passes its parent's probabilities on;
without training documents base_score is that of N = V = 0 and score that of the uniform base; a very long text is one chunk's
(it is cut nowhere); an empty table gives an empty table; the result has the columns of RESULT only, whatever others docs has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, keyed, mix, slices

SWEEPS = 3
BURN = 1
THETA = 1.0
CHUNK_TOKENS = 4_000_000
BUCKET_TOKENS = 2_500_000
SEED = 7
RESULT = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")

#: Any fixed values: the hashes of the end and of the two places before a text, and what tells kinds of keys and draws apart.
_END, _START, _BEFORE = (np.uint64(x) for x in (0x2545F4914F6CDD00, 0x9FB21C651E98DF00, 0xC2B2AE3D27D4EB00))
_ONE, _TWO, _THREE, _STEP = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))
#: Words are told apart by 56 bits of their hash; the first of a context's two by 32, among the contexts of one last token.
_MASK, _TAG = np.uint64((1 << 64) - 256), np.uint64((1 << 64) - (1 << 32))
_STATS = ("ones3", "twos3", "ones2", "twos2", "customers", "tables", "V", "N", "ones1", "twos1")
_BLOCK = "bucket int, chunk long, n_docs int, block binary"


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * _ONE ^ mix(w + _TWO))


def context_key(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(x * _TWO ^ mix(v + _THREE))


def triple_key(x: np.ndarray, pair: np.ndarray) -> np.ndarray:
    return mix(pair ^ mix(x + _ONE))


def _tokens(batch: pa.RecordBatch, text: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, hash of the token before, tag of the one before that, text's index) of all tokens."""
    w = Words(batch.column(text), lower=True)
    n = w.counts + 1
    first = np.cumsum(n) - n
    hashes = np.full(n.sum(), _END, np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    inside = np.ones(len(hashes), bool)
    inside[first + w.counts] = False
    hashes[inside] = w.hashes & _MASK
    one, two = np.empty_like(hashes), np.empty_like(hashes)
    one[1:], two[2:] = hashes[:-1], hashes[:-2]
    two[first] = _BEFORE
    two[(first + 1)[w.counts > 0]] = _START
    one[first] = _START
    return hashes, one, two & _TAG, doc


def frequent(docs: DataFrame, share: float) -> list[int]:
    """Hashes of the tokens that are about `share` or more of the tokens before others; it only decides how work is spread.

    A task sends its tokens of half that share or more, so the list is of 2 / share tokens a task at most.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for whole in batches:
            for batch in slices(whole):
                _, one, _, _ = _tokens(batch, 0)
                total += len(one)
                new, n = np.unique(one, return_counts=True)
                often = n >= max(2, len(one) * share / 4)
                keys, at = np.unique(np.concatenate([keys, new[often]]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n[often]])).astype(np.int64)
        often = counts >= total * share / 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(keys[often], np.uint64(0)).view(np.int64)), pa.array(np.append(counts[often], total))], ["token", "n"]
        )

    counts = docs.select("text").mapInArrow(found, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = {r.token: r.n for r in counts.collect()}
    total = rows.pop(0, 0)
    return sorted(t & (1 << 64) - 1 for t, n in rows.items() if n >= total * share)


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the narrowest type that holds them."""
    most = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([x for a in arrays for x in (a.dtype.itemsize, len(a))], np.int64).tobytes()
    # bytes of one rank stand together, so that the equal high bytes of sorted hashes' steps pack well
    raw = head + b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(block: bytes, n: int) -> list[np.ndarray]:
    raw = pa.decompress(block[8:], decompressed_size=int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    head = np.frombuffer(raw, np.int64, 2 * n)
    at, out = 16 * n, []
    for size, length in zip(head[::2].tolist(), head[1::2].tolist()):
        kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[size]
        flat = np.frombuffer(raw, np.uint8, size * length, at).reshape(size, length)
        out.append(np.ascontiguousarray(flat.T).reshape(-1).view(kind))
        at += size * length
    return out


def _order(x: np.ndarray) -> np.ndarray:
    """np.argsort of hashes, equal ones by place: their high bits and their places are sorted as one number, which takes a quarter of the time
    of sorting places; what only the low bits tell apart is put in order after."""
    bits = np.uint64(max(1, (len(x) - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = x & ~low
    packed |= np.arange(len(x), dtype=np.uint64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    packed >>= bits
    same = packed[1:] == packed[:-1]
    near = np.flatnonzero(same)
    near = near[x[order[near]] != x[order[near + 1]]]
    if len(near):
        run = np.append(0, np.cumsum(~same))
        mixed = np.zeros(int(run[-1]) + 1, bool)
        mixed[run[near]] = True
        some = np.flatnonzero(mixed[run])  # whole runs, so that sorting them all at once moves none out of its run
        order[some] = order[some][np.argsort(x[order[some]], kind="stable")]
    return order


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique with the index of the first occurrence and the inverse."""
    order = _order(x)
    x = x[order]
    opens = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=opens[1:])
    inverse = np.empty(len(x), np.int32)
    inverse[order] = np.cumsum(opens, dtype=np.int32) - 1
    return x[opens], order[opens], inverse


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences modulo 2 ** 64 of hashes, small where sorted; np.cumsum gives them back."""
    return np.diff(x, prepend=np.uint64(0))


def _place(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _even(spark: SparkSession, n: int) -> list[int]:
    """n numbers that repartition(n, number) deals one to each partition (0 .. n - 1 where too few were tried)."""
    tried = spark.range(int(4 * n * (np.log(n) + 3))).select(F.col("id").cast("int").alias("id"))
    rows = tried.groupBy(F.pmod(F.hash("id"), F.lit(n))).agg(F.min("id").alias("id")).select("id").collect()
    return sorted(r.id for r in rows) if len(rows) == n else list(range(n))


def _blocks(docs: DataFrame, spread: list[int], names: list[int], chunk_tokens: int) -> DataFrame:
    """(bucket: one of names, chunk: its first rid, n_docs, block): different triples and the documents of their occurrences."""
    buckets = len(names)
    hot = np.array(spread, np.uint64)
    bits = max(1, (buckets - 1).bit_length())

    def flush(parts: list[tuple], first: int, n_docs: int) -> pa.RecordBatch:
        w, v, x, doc = (np.concatenate([p[k] for p in parts]) for k in range(4))
        train = np.packbits(np.concatenate([p[4] for p in parts]))
        parts.clear()
        bucket = _place(np.where(np.isin(v, hot), pair_key(v, w), mix(v)), buckets)
        # by last token, by tag, by word: equal triples get neighbours, but for chance, and tags small steps
        of_v = (64 - bits) * 2 // 5
        of_w = 64 - bits - 2 * of_v
        key = (v >> np.uint64(64 - of_v)) << np.uint64(of_v + of_w)
        key |= (x >> np.uint64(64 - of_v)) << np.uint64(of_w)
        key |= w >> np.uint64(64 - of_w)
        key |= bucket << np.uint64(64 - bits)
        edges = np.append(0, np.cumsum(np.bincount(bucket.astype(np.int64), minlength=buckets)))
        bucket = None
        order = _order(key)
        key = None
        rows = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            own = order[edges[b] : edges[b + 1]]
            tri = triple_key(x[own], pair_key(v[own], w[own]))
            opens = np.flatnonzero(np.append(True, tri[1:] != tri[:-1]))
            heads, n = own[opens], len(opens)
            known, _, at = _distinct(np.concatenate([v[heads], w[heads]]))
            often = np.bincount(at, minlength=len(known))
            by = np.argsort(np.uint16(65535) - np.minimum(often, 65535).astype(np.uint16), kind="stable")  # frequent words get low numbers
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            known, at = known[by], _small(rank[at])
            size = _small(np.diff(np.append(opens, len(own))))
            tags = (x[heads] >> np.uint64(32)).astype(np.uint32)
            rows.append((names[b], _pack(_steps(known), np.diff(tags, prepend=np.uint32(0)), at[:n], at[n:], size, _small(doc[own]), train)))
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([first] * n, pa.int64()), pa.array([n_docs] * n, pa.int32()),
             pa.array([r[1] for r in rows], pa.binary())], ["bucket", "chunk", "n_docs", "block"],
        )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, first, n_docs, n = [], 0, 0, 0
        for whole in batches:
            for batch in slices(whole, "text"):
                rid = batch.column(0)[0].as_py()
                if parts and (n >= chunk_tokens or rid != first + n_docs):
                    yield flush(parts, first, n_docs)
                    parts, n_docs, n = [], 0, 0
                if not parts:
                    first = rid
                w, v, x, doc = _tokens(batch, 2)
                parts.append((w, v, x, (doc + n_docs).astype(np.int32), ~np.asarray(batch.column(1).cast(pa.uint8())).astype(bool)))
                n_docs, n = n_docs + batch.num_rows, n + len(w)
        if parts:
            yield flush(parts, first, n_docs)

    return docs.select("rid", "held_out", "text").mapInArrow(found, _BLOCK)


# ---- seating -------------------------------------------------------------------------------------------------

#: Customers whose numbers are drawn at a time.
DRAWS = 1 << 20


def seat(c: np.ndarray, a: np.ndarray, d: float, key: np.ndarray, salt: int) -> np.ndarray:
    """Tables of dishes whose c customers sit down one after the other: a new table with probability a / (a + n - d t).

    Customer n (from 0) has the uniform number u of dish, salt and n, and opens a table if u (a + n - d t) < a, that is, if there
    are more than r = (u (a + n) - a) / (d u) tables. As t <= n, only customers with r < n can. They are few, are sifted out piece by piece,
    and their chain of decisions is followed for all dishes at once: from no tables but the first, each round
    counts who opens one given those so far, until nobody is added. This is what they would do one by one, whatever c is.
    """
    t = (c > 0).astype(np.int64)
    many = np.flatnonzero(c > 1)
    if not len(many):
        return t
    stream = mix(key[many] ^ mix(np.full(len(many), salt, np.uint64)))
    ends = np.cumsum(c[many] - 1)
    extra = a[many]
    dishes, thresholds = [], []
    for lo in range(0, int(ends[-1]), DRAWS):
        hi = min(lo + DRAWS, int(ends[-1]))
        i, j = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left")
        size = np.minimum(ends[i : j + 1], hi) - np.maximum(ends[i : j + 1] - (c[many[i : j + 1]] - 1), lo)
        dish = np.repeat(np.arange(i, j + 1), size)
        n = np.arange(lo, hi) - (ends - (c[many] - 1))[dish] + 1
        u = ((mix(stream[dish] + n.astype(np.uint64) * _STEP) >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
        r = (u * (extra[dish] + n) - extra[dish]) / (d * u)
        can = np.flatnonzero(r < n)
        dishes.append(dish[can])
        thresholds.append(r[can])
    dish, r = np.concatenate(dishes), np.concatenate(thresholds)
    opens = np.append(True, dish[1:] != dish[:-1]) if len(dish) else np.zeros(0, bool)
    first = np.repeat(np.flatnonzero(opens), np.diff(np.append(np.flatnonzero(opens), len(dish))))
    new = r < 1
    while len(new):
        before = np.append(0, np.cumsum(new))
        more = r < 1 + before[:-1] - before[first]
        if (more == new).all():
            break
        new = more
    t[many] += np.bincount(dish[new], minlength=len(many))
    return t


def discount(ones: float, twos: float) -> float:
    return min(0.95, max(0.05, (ones + 0.5) / (ones + 2 * twos + 1.0)))


class _Bucket:
    """One bucket: triples (x, v, w) and their customers, pairs (v, w), contexts (x, v), last tokens v and words w."""

    def __init__(self, blocks: pa.Table, spread: np.ndarray, names: list[int], seed: int):
        self.seed, self.names = seed, names
        parts = len(names)
        blocks = blocks.sort_by("chunk")
        self.rows = []
        xs, vs, ws, c = [], [], [], []
        for chunk, n_docs, block in zip(*(blocks.column(k).to_pylist() for k in ("chunk", "n_docs", "block"))):
            steps, x, v, w, size, doc, train = _unpack(block, 7)
            known = np.cumsum(steps, dtype=np.uint64)
            ends = np.cumsum(size, dtype=np.int64)
            run = np.append(0, np.cumsum(np.unpackbits(train)[doc], dtype=np.int64))
            xs.append(np.cumsum(x, dtype=np.uint32).astype(np.uint64) << np.uint64(32)), vs.append(known[v]), ws.append(known[w]), c.append(run[ends] - run[ends - size])
            self.rows.append((chunk, n_docs, size, doc))
        cuts = np.cumsum([len(k) for k in xs])[:-1]
        x, v, w = (np.concatenate(k) for k in (xs, vs, ws))
        xs, vs, ws = None, None, None  # held once only
        pair = pair_key(v, w)
        self.tri, first, at = _distinct(triple_key(x, pair))
        self.c = np.bincount(at, np.concatenate(c), len(self.tri)).astype(np.int64)
        self.at = np.split(at, cuts)
        x, v, w, pair = x[first], v[first], w[first], pair[first]
        self.pair, first, self.pair_of = _distinct(pair)
        self.word, _, self.word_of = _distinct(w[first])  # of a pair
        self.last, _, self.last_of = _distinct(v[first])
        w = pair = None
        self.context, head, self.context_of = _distinct(context_key(x, v))
        # what is shared: the words, and of spread last tokens their contexts and their own customers and tables
        self.far = np.flatnonzero(np.isin(v[head], spread))
        self.far_last = np.flatnonzero(np.isin(self.last, spread))
        far = self.last[self.far_last]
        key = np.concatenate([self.word, mix(self.context[self.far] ^ _ONE), mix(far ^ _TWO), mix(far ^ _THREE)])
        rank = np.concatenate([np.zeros(len(self.word), np.int8), np.ones(len(key) - len(self.word), np.int8)])
        part = _place(key, parts)
        self.order = np.lexsort((key, rank, part))  # of the message: by part, words first
        self.keys, self.rank, self.edges = key[self.order], rank[self.order], np.searchsorted(part[self.order], np.arange(parts + 1, dtype=np.uint64))
        self.customers = self._sum(self.context_of, self.c, len(self.context))

    @staticmethod
    def _sum(of: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(of, x, n).astype(np.int64)

    def start(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tables of triples, customers of pairs, tables of pairs: one table for each dish."""
        t3 = (self.c > 0).astype(np.int64)
        c2 = self._sum(self.pair_of, t3, len(self.pair))
        return t3, c2, (c2 > 0).astype(np.int64)

    def shared(self, state: tuple) -> np.ndarray:
        """What a state adds to the shared sums, in the order of keys."""
        t3, c2, t2 = state
        last = (self._sum(self.last_of, z, len(self.last))[self.far_last] for z in (c2, t2))
        contexts = self._sum(self.context_of, t3, len(self.context))[self.far]
        return np.concatenate([self._sum(self.word_of, t2, len(self.word)), contexts, *last])[self.order]

    def fixed(self) -> np.ndarray:
        """Training tokens of words and contexts, in the order of keys."""
        words = self._sum(self.word_of, self._sum(self.pair_of, self.c, len(self.pair)), len(self.word))
        return np.concatenate([words, self.customers[self.far], np.zeros(2 * len(self.far_last), np.int64)])[self.order]

    def message(self, state: tuple, number: int, bucket: int, before: tuple = (0.0, 0.0, 0.0)) -> Iterator[tuple]:
        """Rows of _MESSAGE: keys and sums at first, in later rounds what has been added, and the state itself, which comes back."""
        now, counts = self.shared(state), [0.0] * 4
        if number == 0:
            fixed = self.fixed()
            counts = [float((z == k).sum()) for z in (self.c, state[1]) for k in (1, 2)]
        else:
            now = now - self.shared(self.start())
        for p in np.flatnonzero(np.diff(self.edges)).tolist():
            own = slice(self.edges[p], self.edges[p + 1])
            cut = int((self.rank[own] == 0).sum())
            if number == 0:
                key = self.keys[own]
                block = _pack(_steps(key[:cut]), _steps(key[cut:]), _small(now[own]), _small(fixed[own]))
            else:
                block = _pack(_small(now[own]))
            yield self.names[p], bucket, number, False, block, *counts, *before
            counts = [0.0] * 4
        if number:
            t3, c2, t2 = state
            yield bucket, bucket, number, True, _pack(_small(t3[self.c > 1]), _small(t2[c2 > 1])), *counts, *before

    def replies(self, back: pa.Table) -> dict[int, dict]:
        """By round: its state, the sums and root tables in the order of keys, and the numbers of the whole model."""
        rounds: dict[int, dict] = {}
        place = {name: p for p, name in enumerate(self.names)}
        for r in sorted(back.to_pylist(), key=lambda r: (r["round"], place[r["part"]])):
            x = rounds.setdefault(r["round"], {"sum": [], "tables1": [], "fixed": [], **{s: r[s] for s in _STATS}})
            if r["state"]:
                few, pairs = (z.astype(np.int64) for z in _unpack(r["block"], 2))
                t3 = (self.c > 0).astype(np.int64)
                t3[self.c > 1] = few
                c2 = self._sum(self.pair_of, t3, len(self.pair))
                t2 = (c2 > 0).astype(np.int64)
                t2[c2 > 1] = pairs
                x["state"] = t3, c2, t2
                continue
            for name, z in zip(("sum", "tables1", "fixed"), _unpack(r["block"], 3)):
                x[name].append(z)
        rounds[0]["state"] = self.start()
        n, f, g = len(self.word), len(self.far), len(self.far_last)
        for x in rounds.values():
            inside = np.empty(len(self.order), np.int64)
            inside[self.order] = np.concatenate(x["sum"])
            x["c1"], x["far"], x["far_c"], x["far_t"] = np.split(inside, [n, n + f, n + f + g])
            x["t1"] = np.empty(n, np.int64)
            x["t1"][self.order[self.rank == 0]] = np.concatenate(x["tables1"])
        first = rounds[0]
        fixed = np.empty(len(self.order), np.int64)
        fixed[self.order] = np.concatenate(first["fixed"])
        self.seen, self.customers = fixed[:n], self.customers.copy()
        self.customers[self.far] = fixed[n : n + f]
        self.d = [discount(first[f"ones{k}"], first[f"twos{k}"]) for k in (1, 2, 3)]
        self.V, self.N = first["V"], first["N"]
        return rounds

    def parents(self, x: dict, theta: float) -> tuple[np.ndarray, ...]:
        """Root's probabilities of words, last tokens' of pairs, and tables of last tokens and contexts, under a round's state."""
        t3, c2, t2 = x["state"]
        d1, d2, _ = self.d
        p0 = (x["c1"] - d1 * x["t1"] + (theta + d1 * x["tables"]) / (self.V + 1)) / (theta + x["customers"])
        customers, tables = (self._sum(self.last_of, z, len(self.last)) for z in (c2, t2))
        customers[self.far_last], tables[self.far_last] = x["far_c"], x["far_t"]
        p1 = (c2 - d2 * t2 + (theta + d2 * tables[self.last_of]) * p0[self.word_of]) / (theta + customers[self.last_of])
        below = self._sum(self.context_of, t3, len(self.context))
        below[self.far] = x["far"]
        return p0, p1, tables, below

    def sweep(self, x: dict, theta: float, number: int) -> tuple:
        """The state after one more sweep."""
        _, d2, d3 = self.d
        p0, p1, tables, below = self.parents(x, theta)
        t3 = seat(self.c, (theta + d3 * below[self.context_of]) * p1[self.pair_of], d3, self.tri, self.seed + 3 * number)
        c2 = self._sum(self.pair_of, t3, len(self.pair))
        return t3, c2, seat(c2, (theta + d2 * tables[self.last_of]) * p0[self.word_of], d2, self.pair, self.seed + 3 * number + 1)

    def predict(self, x: dict, theta: float) -> np.ndarray:
        """Probability of each triple's word after its context."""
        _, p1, _, below = self.parents(x, theta)
        d3, of = self.d[2], self.context_of
        return (self.c - d3 * x["state"][0] + (theta + d3 * below[of]) * p1[self.pair_of]) / (theta + self.customers[of])


_COUNTS = _STATS[:4]
_MESSAGE = "part int, bucket int, round int, state boolean, block binary, " + ", ".join(f"{c} double" for c in (*_COUNTS, "V", "T", "d"))
_REPLY = "bucket int, part int, round int, state boolean, block binary, own array<double>"


def _batches(rows: Iterator[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}
    fields = [pa.field(n, kinds[t]) for n, t in (x.strip().split(" ") for x in schema.split(","))]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


def _answers(messages: pa.Table, number: int, theta: float, seed: int) -> Iterator[tuple]:
    """The replies of one part in a round, a row of _REPLY for each bucket; the numbers are in the first."""
    first, later, stats = {}, {}, dict.fromkeys(_STATS, 0.0)
    part = messages.column("part")[0].as_py()
    for r in messages.to_pylist():
        if r["state"]:  # goes back as it is
            yield r["bucket"], part, number, True, r["block"], [0.0] * len(_STATS)
            continue
        (first if r["round"] == 0 else later)[r["bucket"]] = r
        for s in _COUNTS:
            stats[s] += r[s]
    buckets, sent = sorted(first), []
    if not buckets:
        return
    for b in buckets:
        x, y, a, f = _unpack(first[b]["block"], 4)
        a = a.astype(np.int64)
        if number:
            a += _unpack(later[b]["block"], 1)[0].astype(np.int64)
        sent.append((np.cumsum(x, dtype=np.uint64), np.cumsum(y, dtype=np.uint64), a, f.astype(np.int64)))
    kinds = []
    for k in (0, 1):  # words, then the others
        sizes = [len(q[k]) for q in sent]
        key, _, at = _distinct(np.concatenate([q[k] for q in sent]))
        sums = [np.bincount(at, np.concatenate([q[j][len(q[0]) :] if k else q[j][: len(q[0])] for q in sent]), len(key)).astype(np.int64) for j in (2, 3)]
        kinds.append((key, np.split(at, np.cumsum(sizes)[:-1]), *sums))
    (key, words, c1, seen), (_, others, far, far_fixed) = kinds
    if number:
        new = next(iter(later.values()))
        t1 = seat(c1, np.full(len(c1), (theta + new["d"] * new["T"]) / (new["V"] + 1)), new["d"], key, seed + 3 * number + 2)
    else:
        t1 = (c1 > 0).astype(np.int64)
        stats |= {"V": float((seen > 0).sum()), "N": float(seen.sum()), "ones1": float((c1 == 1).sum()), "twos1": float((c1 == 2).sum())}
    stats |= {"customers": float(c1.sum()), "tables": float(t1.sum())}
    for b, i, j in zip(buckets, words, others):
        fixed = np.concatenate([seen[i], far_fixed[j]]) if number == 0 else np.zeros(0, np.int64)
        yield b, part, number, False, _pack(_small(np.concatenate([c1[i], far[j]])), _small(t1[i]), _small(fixed)), list(stats.values())
        stats = dict.fromkeys(_STATS, 0.0)


def score(
    docs: DataFrame,
    sweeps: int = SWEEPS,
    burn: int = BURN,
    theta: float = THETA,
    seed: int = SEED,
    chunk_tokens: int = CHUNK_TOKENS,
    bucket_tokens: int = BUCKET_TOKENS,
) -> DataFrame:
    """The columns of RESULT for each of docs; the states after sweeps burn + 1 .. sweeps are averaged."""
    own = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "rid")
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    own = own.select("rid", "doc_id", out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    bytes_ = own.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = int(max(16, bytes_ // (6 * bucket_tokens)))
    spread = np.array(frequent(own, 1 / (4 * buckets)), np.uint64)
    names = _even(docs.sparkSession, buckets)
    raw = _blocks(own, spread.tolist(), names, chunk_tokens).repartition(buckets, "bucket")

    def bucket_of(table: pa.Table) -> int:
        return table.column("bucket")[0].as_py()

    def begin(blocks: pa.Table) -> pa.Table:
        b = _Bucket(blocks, spread, names, seed)
        return _batches(b.message(b.start(), 0, bucket_of(blocks)), _MESSAGE)

    def again(number: int):
        def swept(blocks: pa.Table, back: pa.Table) -> pa.Table:
            b = _Bucket(blocks, spread, names, seed)
            x = b.replies(back)[number - 1]
            return _batches(b.message(b.sweep(x, theta, number), number, bucket_of(blocks), (b.V, x["tables"], b.d[0])), _MESSAGE)

        return swept

    def answers(number: int):
        def answered(messages: pa.Table) -> pa.Table:
            return _batches(_answers(messages, number, theta, seed), _REPLY)

        return answered

    first = raw.groupBy("bucket").applyInArrow(begin, _MESSAGE).repartition(buckets, "part")
    replies: list[DataFrame] = []
    for number in range(sweeps + 1):
        sent = first
        if number:
            back = replies[0] if number == 1 else replies[0].union(replies[-1])
            later = raw.groupBy("bucket").cogroup(back.groupBy("bucket")).applyInArrow(again(number), _MESSAGE)
            sent = first.union(later.repartition(buckets, "part"))
        reply = sent.groupBy("part").applyInArrow(answers(number), _REPLY).repartition(buckets, "bucket")
        # one row of sums, from the exchange that the replies take, too: both ask for all columns, so that it is the same
        sums = [F.sum(F.col("own")[i]).alias(s) for i, s in enumerate(_STATS)]
        rest = [F.sum(F.length("block")).alias("bytes"), *[F.max(c).alias(f"most_{c}") for c in ("bucket", "part", "round", "state")]]
        replies.append(reply.crossJoin(F.broadcast(reply.agg(*sums, *rest))))

    def scored(blocks: pa.Table, back: pa.Table) -> pa.Table:
        b = _Bucket(blocks, spread, names, seed)
        rounds = b.replies(back)
        p = np.log10(sum(b.predict(rounds[k], theta) for k in range(burn + 1, sweeps + 1)) / (sweeps - burn))
        word = b.word_of[b.pair_of]
        base, known = np.log10((b.seen + 0.1) / (b.N + 0.1 * (b.V + 1)))[word], (b.seen > 0)[word]

        def sums() -> Iterator[tuple]:
            for (chunk, n_docs, size, doc), at in zip(b.rows, b.at):
                each = np.repeat(at, size)
                some = np.flatnonzero(tokens := np.bincount(doc, minlength=n_docs))
                floats = (np.bincount(doc, z[each], n_docs)[some].view(np.uint64) for z in (p, base))
                yield bucket_of(blocks), chunk, n_docs, _pack(_small(_steps(some.astype(np.uint64))), *floats, _small(np.bincount(doc, known[each], n_docs)[some].astype(np.int64)), _small(tokens[some]))

        return _batches(sums(), _BLOCK).append_column("train", pa.array([int(b.N)] * len(b.rows), pa.int64()))

    result = "rid long, score double, base_score double, n_known long, n_tokens long, train_tokens long"

    def together(blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("bucket")
        rid, n_docs, train = (blocks.column(k)[0].as_py() for k in ("chunk", "n_docs", "train"))
        sums = [np.zeros(n_docs) for _ in range(4)]
        for block in blocks.column("block").to_pylist():
            steps, p, base, known, tokens = _unpack(block, 5)
            at = np.cumsum(steps, dtype=np.int64)
            for to, x in zip(sums, (p.view(np.float64), base.view(np.float64), known, tokens)):
                to[at] += x
        columns = [rid + np.arange(n_docs), *sums[:2], *(x.astype(np.int64) for x in sums[2:]), np.full(n_docs, train)]
        return pa.table([pa.array(c) for c in columns], names=[f.split()[0] for f in result.split(", ")])

    back = reduce(DataFrame.union, [replies[0], *replies[max(1, burn + 1) :]])
    parts = raw.groupBy("bucket").cogroup(back.groupBy("bucket")).applyInArrow(scored, _BLOCK + ", train long")
    sums = parts.groupBy("chunk").applyInArrow(together, result)
    return own.select("rid", "doc_id", "held_out").join(sums, "rid").select(*RESULT)
