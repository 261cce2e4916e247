"""Language-model scoring by a hierarchical Pitman-Yor model (numbered operator 10).

Words are drawn from context restaurants that share one parent, the root restaurant over all words, whose own parent is uniform over
the known words and one unknown. The context of a word is the word before it, known by its 64-bit hash, or a text's start: every
word that precedes another has a restaurant of its own, however rare.

Seating (Chinese restaurant, discounts from the counts of counts): for a word and a context only its number of customers and tables matter. A Gibbs
sweep takes all customers of a (context, word) section away, its tables and their root customers with them, and draws its tables anew given the
rest: t tables of c customers have odds S(c, t) * prod over i < t of (strength + discount * (T + i)) * P_root(word after i more tables), with the
generalised Stirling numbers S of the discount and the other tables T of the context. Each table is a customer of the root, where the
word's section is drawn likewise. After BURN_IN sweeps, the predictive probabilities of the following SAMPLES sweeps are averaged. Three things
are approximate: sections of one sweep are drawn given the sums of the sweep before, sections of more than EXACT customers are
seated in turn by jumps to the next new table, and discounts stay as first set.

Distribution: texts become flushes (a flush is some million tokens: its words, and its tokens as numbers of them). Of a flush each distinct
(word, context) pair goes once to the group of its word; a word of more than PART_TOKENS training tokens is dealt in parts by context, as many as
its count asks for, so no word is a hot key. A group keeps its pairs as sections and, for each flush, which section each pair is. After a sweep,
tables of a context are added up at the context's home bucket and come back to the groups that have the context; who has which is sent once. Groups,
buckets and flushes lie in bucketed tables, so joins move only the small side. Seats are stored after each sweep. At the end a group returns one
number for each (flush, pair), and flushes add up their documents. What moves follows distinct (flush, pair) and (group, context) entries.
Nothing depends on the order or the files of the rows, but the last digits of sums (probabilities return in single precision).

Defined results: null and empty texts are the end token alone; a null doc_id is no held-out document; repeated rows count and are scored each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm import textkit as K
from candela.llm.stages import bucketed, written

FREQUENT = 1 << 20               # at most so many words are dealt in parts: the bound of what is broadcast
PART_TOKENS = 400_000            # training tokens of a part
GROUP_TOKENS = 3_200_000
FLUSH_TOKENS = 2_400_000
BURN_IN, SAMPLES = 1, 2
STRENGTH = 1.0
EXACT = 256                      # sections of so many customers are drawn from their exact conditional
SEED = 29
END = np.uint64(0x5E0FD0C5E0FD0C11)   # the end token's hash


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, each compressed."""
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
        small = pa.compress(raw, codec="zstd", asbytes=True) if raw else b""
        out += [np.array([len(raw), len(small)], "<u8").tobytes(), small]
    return b"".join(out)


def _unpack(blob: bytes, *dtypes) -> list[np.ndarray]:
    out, at = [], 0
    for d in map(np.dtype, dtypes):
        size, small = map(int, np.frombuffer(blob, "<u8", 2, at))
        raw = pa.decompress(blob[at + 16:at + 16 + small], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(d.itemsize, -1).T).view(d).ravel())
        at += 16 + small
    return out


def _gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _rows(batches):
    """The rows of batches, one in memory at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))
    return docs.select(F.col(doc_id).cast("long").alias("id"), held.alias("held"), K.text_column(docs, text).alias("text"))


_FLUSH = ("<u8", "<u4", "<i8", "u1", "u1", "<u4")     # gaps of the word hashes; word of each token; ids, whether null, held out, tokens


def _flushes(docs: DataFrame) -> DataFrame:
    """(flush, n_train, n_tokens, blob): the texts as numbers of the flush's words, bucketed by flush."""
    schema = pa.schema([("flush", pa.int64()), ("n_train", pa.int64()), ("n_tokens", pa.int64()), ("blob", pa.binary())])

    def run(batches):
        part, seq, tokens, rows, size = TaskContext.get().partitionId(), 0, [], [], 0

        def out():
            words, number = np.unique(np.concatenate(tokens), return_inverse=True)
            about = [np.concatenate(x) for x in zip(*rows)]
            blob = _pack(_gaps(words), number.astype("<u4"), *about)
            return pa.RecordBatch.from_arrays([pa.array([part << 24 | seq]), pa.array([int(about[3][about[2] == 0].sum())]), pa.array([len(number)]), pa.array([blob], pa.binary())], schema=schema)
        for batch in batches:
            for piece in K.chunks(batch, "text"):
                w = K.words(piece.column("text"), K.SPACE_WORD, lower=True)
                tokens.append(np.insert(w.hash, w.first[1:], END))
                ids = piece.column("id")
                rows.append((ids.fill_null(0).to_numpy().astype("<i8"), np.asarray(ids.is_null()).astype(np.uint8),
                             piece.column("held").to_numpy(zero_copy_only=False).astype(np.uint8), (np.diff(w.first) + 1).astype("<u4")))
                size += len(tokens[-1])
                if size >= FLUSH_TOKENS:
                    yield out()
                    seq, tokens, rows, size = seq + 1, [], [], 0
                    K.release()
        if rows:
            yield out()
        tokens.clear()
        K.release()
    found = docs.mapInArrow(run, "flush bigint, n_train bigint, n_tokens bigint, blob binary")
    return bucketed(found, "op10-flushes", "flush", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class Flush:
    """A flush read again: ``words`` (sorted hashes), the word number of each token, and its documents."""

    def __init__(self, blob: bytes):
        gaps, self.number, self.ids, self.null, self.held, self.size = _unpack(blob, *_FLUSH)
        self.words = np.cumsum(gaps, dtype=np.uint64)

    def train(self) -> np.ndarray:
        return np.repeat(self.held == 0, self.size)

    def pairs(self, split: tuple[np.ndarray, np.ndarray]):
        """(keys, number of the split word of each key from 1 or 0, distinct pairs as key number << 32 | context's word number, pair of each token)."""
        hashes, parts = split
        n, h = self.number, self.words
        context = np.empty(len(n), np.uint64)       # what follows an end token starts a text
        context[0], context[1:] = np.searchsorted(h, END), n[:-1]
        at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
        cut = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
        token = np.flatnonzero(cut[n])
        w = n[token]
        part = (h[context[token]] >> np.uint64(32)) * parts[at[w]] >> np.uint64(32) if len(token) else np.zeros(0, np.uint64)
        cut_key = K.mix(h[w] ^ K.mix(part + np.uint64(1)))
        keys = np.unique(np.concatenate((h[~cut], cut_key)))
        code = np.searchsorted(keys, h).astype(np.uint64)[n]
        code[token] = np.searchsorted(keys, cut_key)
        of_split = np.zeros(len(keys), "<u4")
        of_split[code[token]] = at[w] + 1
        pairs, nth = np.unique(code << np.uint64(32) | context, return_inverse=True)
        return keys, of_split, pairs, nth


def _split_words(flushes: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, parts) of the words with more than PART_TOKENS training tokens. All words of all flushes are counted. At most
    FREQUENT rows reach the driver."""
    def run(batches):
        for row in _rows(batches):
            f = Flush(row["blob"])
            c = np.bincount(f.number[f.train()], minlength=len(f.words))
            yield pa.RecordBatch.from_arrays([pa.array(f.words[c > 0].view(np.int64)), pa.array(c[c > 0])], names=["h", "c"])
    counts = flushes.select("blob").mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))
    found = sorted((r["h"] & (1 << 64) - 1, r["c"]) for r in counts.filter((F.col("c") > PART_TOKENS) & (F.col("c") * FREQUENT >= total)).toLocalIterator())
    return np.array([h for h, _ in found], np.uint64), np.array([-(-c // PART_TOKENS) for _, c in found], np.uint64)


_PAIRS = ("<u8", "<u4", "<u4", "<u8", "<u4", "<u4")     # keys, split words, pairs per key; contexts, number of each pair's among them, customers


def _sent(flushes: DataFrame, split, groups: int) -> DataFrame:
    """(g, flush, blob): the distinct pairs of a flush that belong to group g, with their training customers."""
    def run(batches):
        for row in _rows(batches):
            f = Flush(row.pop("blob"))
            keys, of_split, pairs, nth = f.pairs(split.value)
            customers = np.bincount(nth[f.train()], minlength=len(pairs)).astype("<u4")
            words = f.words
            del f, nth
            bounds = np.searchsorted(pairs, np.arange(len(keys) + 1, dtype=np.uint64) << np.uint64(32))
            group = ((keys >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)   # ascending with the key
            cut = np.searchsorted(group, np.arange(groups + 1))
            for g in np.unique(group):
                a, b = cut[g], cut[g + 1]
                lo, hi = bounds[a], bounds[b]
                contexts, number = np.unique(pairs[lo:hi] & np.uint64(0xFFFFFFFF), return_inverse=True)
                blob = _pack(_gaps(keys[a:b]), of_split[a:b], np.diff(bounds[a:b + 1]).astype("<u4"), _gaps(words[contexts]), number.astype("<u4"), customers[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array([int(g)]), pa.array([row["flush"]]), pa.array([blob], pa.binary())], names=["g", "flush", "blob"])
            del words, pairs, customers, keys, bounds
            K.release()
    return flushes.select("flush", "blob").mapInArrow(run, "g bigint, flush bigint, blob binary")


def _groups(sent: DataFrame, groups: int) -> DataFrame:
    """One row per group: its sections (body), the slices of its contexts for their home buckets (homes), and what each flush's pairs are (spans)."""
    piece = pa.list_(pa.struct([("at", pa.int64()), ("blob", pa.binary())]))
    schema = pa.schema([("g", pa.int64()), ("body", pa.binary()), ("homes", piece), ("spans", piece)])

    def run(batches):
        for row in _rows(batches):
            got = [(x["flush"], *_unpack(x["blob"], *_PAIRS)) for x in row.pop("blobs")]
            contexts = np.unique(np.concatenate([np.cumsum(x[4], dtype=np.uint64) for x in got]))
            words = np.unique(np.concatenate([np.cumsum(x[1], dtype=np.uint64) for x in got]))
            split = np.zeros(len(words), "<u4")
            ids, key_at, customers = [], [], []
            for _, k, q, per, ctx, number, c in got:
                w = np.searchsorted(words, np.cumsum(k, dtype=np.uint64))
                split[w] = q
                ids.append(np.repeat(w.astype(np.uint64) << np.uint64(32), per) | np.searchsorted(contexts, np.cumsum(ctx, dtype=np.uint64)).astype(np.uint64)[number])
                key_at.append(w.astype("<u4"))
                customers.append(c)
            flushes = [x[0] for x in got]
            del got
            sections, nth = np.unique(np.concatenate(ids), return_inverse=True)
            c = np.bincount(nth, weights=np.concatenate(customers), minlength=len(sections)).astype("<u4")
            cuts = np.cumsum([0] + [len(x) for x in ids])
            del ids, customers
            spans = [{"at": f, "blob": _pack(_gaps(nth[lo:hi].astype("<u4")), _gaps(k))} for f, k, lo, hi in zip(flushes, key_at, cuts, cuts[1:])]
            del nth
            ctx = (sections & np.uint64(0xFFFFFFFF)).astype("<u4")
            per = np.bincount((sections >> np.uint64(32)).astype(np.int64), minlength=len(words)).astype("<u4")
            del sections
            bucket = ((contexts >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)     # ascending with the hash
            cut = np.searchsorted(bucket, np.arange(groups + 1))
            tables, seated = np.bincount(ctx[c > 0], minlength=len(contexts)).astype("<u4"), np.bincount(ctx, weights=c, minlength=len(contexts)).astype("<u8")
            homes = [{"at": int(b), "blob": _pack(_gaps(contexts[cut[b]:cut[b + 1]]), tables[cut[b]:cut[b + 1]], seated[cut[b]:cut[b + 1]])} for b in np.unique(bucket)]
            sizes = np.diff(cut).astype("<u4")
            yield pa.RecordBatch.from_pylist([{"g": row["g"], "body": _pack(per, split, ctx, c, sizes), "homes": homes, "spans": spans}], schema=schema)
            del contexts, words, ctx, c, homes, spans, tables, seated
            K.release()
    kind = "array<struct<at: bigint, blob: binary>>"
    together = sent.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("flush", "blob"))).alias("blobs"))
    return bucketed(together.mapInArrow(run, f"g bigint, body binary, homes {kind}, spans {kind}"), "op10-groups", "g", groups)


class Group:
    """The sections of one group: of each its word, context and training customers; words are numbered, and ``freq`` is 0 or the
    number of the split word of which the word is a part."""

    def __init__(self, g: int, body: bytes):
        self.g = g
        per, freq, ctx, c, self.sizes = _unpack(body, "<u4", "<u4", "<u4", "<u4", "<u4")
        self.word, self.freq = np.repeat(np.arange(len(per)), per), freq.astype(np.int64)
        self.ctx, self.c = ctx.astype(np.int64), c.astype(np.int64)

    def per_word(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=x, minlength=len(self.freq)).astype(np.int64)

    def slices(self, t: np.ndarray):
        """(bucket, tables of each of the group's contexts of that bucket)."""
        tables, at = np.bincount(self.ctx, weights=t, minlength=int(self.sizes.sum())).astype("<u4"), np.cumsum(self.sizes)
        return [(b, tables[at[b] - self.sizes[b]:at[b]]) for b in np.flatnonzero(self.sizes)]


def seat(customers: np.ndarray, odds: np.ndarray, discount: float, rng, per_table: np.ndarray | float = 0.0) -> np.ndarray:
    """Tables of sections after seating their customers one after the other; ``odds``, and ``per_table`` for each table the section has,
    weigh a new table."""
    tables = (customers > 0).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    j = np.ones(len(live))
    odds, per_table = np.maximum(odds, 1e-300), np.broadcast_to(per_table, len(tables))
    while len(live):
        base, weight = j - discount * tables[live], odds[live] + per_table[live] * tables[live]
        # customers until the next new table: its survival is about (base / (base + m)) ** weight; one by one up to the 32nd
        u = rng.random(len(live))
        with np.errstate(over="ignore"):
            m = base * np.expm1(np.minimum(700, -np.log(u) / weight))
        one = j < 32
        opens = u < weight / (base + weight)
        step = np.where(one, 1.0, np.floor(m) + 1)
        j = j + step
        inside = j <= customers[live]
        tables[live[inside & (~one | opens)]] += 1
        stay = j < customers[live]
        live, j = live[stay], j[stay]
    return tables


def _stirling(discount: float, n: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: [c, t] for c customers at t tables."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(1, n + 1)
    for c in range(n):
        with np.errstate(divide="ignore"):
            out[c + 1, 1:] = np.logaddexp(out[c, :-1], np.log(np.maximum(c - discount * t, 0)) + out[c, 1:])
    return out


def draw(customers: np.ndarray, others: np.ndarray, discount: float, parent, rng) -> np.ndarray:
    """Tables of sections given the ``others`` tables of their restaurants; ``parent(sections, i)`` is the parent's probability of a section's
    word after i more of its tables."""
    tables = (customers > 0).astype(np.int64)
    many = np.flatnonzero(customers > EXACT)
    if len(many):
        p = parent(many, np.zeros(1))[:, 0]
        tables[many] = seat(customers[many], (STRENGTH + discount * others[many]) * p, discount, rng, discount * p)
    some = np.flatnonzero((customers > 1) & (customers <= EXACT))
    some = some[np.argsort(customers[some], kind="stable")]
    ways = _stirling(discount, int(customers[some].max(initial=1)))
    for c in np.unique(customers[some]):
        a, b = np.searchsorted(customers[some], [c, c + 1])
        for lo in range(a, b, 1 + 500_000 // c):
            rows, i = some[lo:min(b, lo + 1 + 500_000 // c)], np.arange(c, dtype=float)
            odds = ways[c, 1:c + 1] + np.cumsum(np.log(STRENGTH + discount * (others[rows, None] + i)) + np.log(np.maximum(parent(rows, i), 1e-300)), axis=1)
            share = np.cumsum(np.exp(odds - odds.max(axis=1, keepdims=True)), axis=1)
            tables[rows] = 1 + (share < rng.random(len(rows))[:, None] * share[:, -1:]).sum(axis=1)
    return tables


class Chain:
    """The seats of a group: tables ``t`` of its sections, root tables ``s`` of its words. ``shared`` has the sums over all groups."""

    def __init__(self, g: Group, seats: bytes | None = None):
        self.g = g
        if seats is None:
            self.t = (g.c > 0).astype(np.int64)
            self.s = np.minimum(1, g.per_word(self.t))
        else:
            self.t, self.s = (x.astype(np.int64) for x in _unpack(seats, "<u4", "<u4"))

    def _root_counts(self, shared: dict) -> tuple[np.ndarray, np.ndarray]:
        """Root customers and tables of each section's word."""
        f, n0, s = self.g.freq, self.g.per_word(self.t), self.s.copy()
        cut = f > 0
        n0[cut], s[cut] = shared["freq_n0"][f[cut] - 1], shared["freq_s"][f[cut] - 1]
        return n0[self.g.word], s[self.g.word]

    def root(self, shared: dict) -> np.ndarray:
        """The root's probability of each section's word."""
        n0, s = self._root_counts(shared)
        new = (STRENGTH + shared["d0"] * shared["root_tables"]) / (shared["types"] + 1)
        return (np.maximum(n0 - shared["d0"] * s, 0) + new) / (STRENGTH + shared["root_customers"])

    def sweep(self, number: int, shared: dict, tables: np.ndarray) -> None:
        """Draws all sections again; ``tables`` are those of each context over all groups."""
        g, rng, d0, own = self.g, np.random.default_rng([SEED, self.g.g, number]), shared["d0"], self.t
        n0, s = self._root_counts(shared)
        n0 = n0 - own
        s = np.minimum(s, n0)
        base = 1 / (shared["types"] + 1)
        new = (STRENGTH + d0 * shared["root_tables"]) * base

        def root(rows, i):
            seated = n0[rows, None] + i
            at = np.maximum(s[rows, None], seated > 0)
            return (np.maximum(seated - d0 * at, 0) + new) / (STRENGTH + shared["root_customers"] - own[rows, None] + i)
        self.t = draw(g.c, tables[g.ctx] - own, shared["d1"], root, rng)
        self.s = draw(g.per_word(self.t), shared["root_tables"] - self.s, d0, lambda rows, i: np.full((len(rows), len(i)), base), rng)

    def predictive(self, shared: dict, tables: np.ndarray, customers: np.ndarray) -> np.ndarray:
        """P(word | context) of each section, by the sums of the sweep just made."""
        d1, ctx = shared["d1"], self.g.ctx
        return (np.maximum(self.g.c - d1 * self.t, 0) + (STRENGTH + d1 * tables[ctx]) * self.root(shared)) / (STRENGTH + customers[ctx])


_SCALARS = ("tokens", "types", "sections1", "sections2", "root_customers", "root_tables", "roots1", "roots2")
_SLICE, _FREQ_C, _FREQ_N0, _SCALAR, _SEATS = range(5)     # kinds of rows
_STATE = pa.schema([("g", pa.int64()), ("kind", pa.int32()), ("at", pa.int64()), ("value", pa.int64()), ("blob", pa.binary())])
_STATE_SQL = "g bigint, kind int, at bigint, value bigint, blob binary"


def _counts(chain: Chain) -> pa.RecordBatch:
    """What a group adds to the sums of fixed number."""
    g = chain.g
    own, n0, c = g.freq == 0, g.per_word(chain.t), g.per_word(g.c)
    scalar = (g.c.sum(), (own & (c > 0)).sum(), (g.c == 1).sum(), (g.c == 2).sum(), n0[own].sum(), chain.s[own].sum(), (own & (n0 == 1)).sum(), (own & (n0 == 2)).sum())
    kinds, ats, values = [np.full(len(scalar), _SCALAR)], [np.arange(len(scalar))], [np.array(scalar)]
    for kind, x in ((_FREQ_C, c), (_FREQ_N0, n0)):
        ids, inv = np.unique(g.freq[~own] - 1, return_inverse=True)
        kinds.append(np.full(len(ids), kind))
        ats.append(ids)
        values.append(np.bincount(inv, weights=x[~own], minlength=len(ids)))
    kind, at, value = (np.concatenate(x) for x in (kinds, ats, values))
    n = len(kind)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, g.g)), pa.array(kind.astype(np.int32)), pa.array(at.astype(np.int64)), pa.array(value.astype(np.int64)), pa.nulls(n, pa.binary())], schema=_STATE)


def _shared(rows: DataFrame, history: list[dict], words: int) -> dict:
    """Sums over all groups, added up by Spark; at most 2 * FREQUENT + 8 rows reach the driver."""
    out = {"freq_c": np.zeros(words, np.int64), "freq_n0": np.zeros(words, np.int64), "scalar": np.zeros(len(_SCALARS), np.int64)}
    name = {_FREQ_C: "freq_c", _FREQ_N0: "freq_n0", _SCALAR: "scalar"}
    for r in rows.filter(F.col("kind").isin(*name)).groupBy("kind", "at").agg(F.sum("value").alias("value")).toLocalIterator():
        out[name[r["kind"]]][r["at"]] = r["value"]
    out |= dict(zip(_SCALARS, map(int, out.pop("scalar"))))
    # root sections of the split words are seated here, a bounded number
    discount = lambda one, two: min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5
    out["d1"] = history[0]["d1"] if history else discount(out["sections1"], out["sections2"])
    out["d0"] = history[0]["d0"] if history else discount(out["roots1"], out["roots2"])
    out["types"] += int((out["freq_c"] > 0).sum())
    last = history[-1] if history else {"root_tables": out["root_tables"], "freq_s": np.minimum(1, out["freq_n0"])}
    base = lambda rows, i: np.full((len(rows), len(i)), 1 / (out["types"] + 1))
    out["freq_s"] = draw(out["freq_n0"], np.maximum(0, last["root_tables"] - last["freq_s"]), out["d0"], base, np.random.default_rng([SEED, len(history)]))
    out["root_tables"] += int(out["freq_s"].sum())
    out["root_customers"] += int(out["freq_n0"].sum())
    return out


_PART_SQL = "g bigint, tag string, bucket bigint, blob binary"


def _part(g: int, tag: str, bucket: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([g], pa.int64()), pa.array([tag]), pa.array([bucket], pa.int64()), pa.array([blob], pa.binary())], names=["g", "tag", "bucket", "blob"])


def _homes(stored: DataFrame, groups: int) -> DataFrame:
    """The home buckets: who has which of a bucket's contexts (tag "who"), and for each group the customers and first tables of its
    contexts, in its order. Bucketed by bucket."""
    def run(batches):
        for row in _rows(batches):
            got = [(x["g"], *_unpack(x["blob"], "<u8", "<u4", "<u8")) for x in row.pop("sent")]
            ids, nth = np.unique(np.concatenate([np.cumsum(x[1], dtype=np.uint64) for x in got]), return_inverse=True)
            tables, customers = (np.bincount(nth, weights=np.concatenate([x[i] for x in got]), minlength=len(ids)) for i in (2, 3))
            sizes, at = [len(x[1]) for x in got], 0
            yield _part(None, "who", row["bucket"], _pack(np.array([x[0] for x in got], "<i8"), np.array(sizes, "<u4"), nth.astype("<u4")))
            for (g, *_), size in zip(got, sizes):
                mine = nth[at:at + size]
                at += size
                yield _part(g, "customers", row["bucket"], _pack(customers[mine].astype("<u8")))
                yield _part(g, "tables 0", row["bucket"], _pack(tables[mine].astype("<u4")))
            del got, ids, nth, tables, customers
            K.release()
    sent = stored.select("g", F.explode("homes").alias("x")).select("g", F.col("x.at").alias("bucket"), F.col("x.blob").alias("blob"))
    return bucketed(sent.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("g", "blob"))).alias("sent")).mapInArrow(run, _PART_SQL), "op10-homes", "bucket", groups)


def _tables(homes: DataFrame, state: DataFrame, number: int) -> DataFrame:
    """For each group the tables of its contexts after a sweep, added up in the home buckets."""
    def run(batches):
        for row in _rows(batches):
            gs, sizes, nth = _unpack(row["who"], "<i8", "<u4", "<u4")
            sent = {x["g"]: x["blob"] for x in row.pop("sent")}
            total = np.bincount(nth, weights=np.concatenate([_unpack(sent[g], "<u4")[0] for g in gs.tolist()]))
            at = 0
            for g, size in zip(gs.tolist(), sizes.tolist()):
                yield _part(g, f"tables {number}", row["bucket"], _pack(total[nth[at:at + size]].astype("<u4")))
                at += size
    sent = state.filter(F.col("kind") == _SLICE).groupBy(F.col("at").alias("bucket")).agg(F.collect_list(F.struct("g", "blob")).alias("sent"))
    who = homes.filter("tag = 'who'").select("bucket", F.col("blob").alias("who"))
    return written(who.join(sent.hint("shuffle_hash"), "bucket").mapInArrow(run, _PART_SQL), "op10-tables")


def _with(stored: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """The groups with the parts sent to each."""
    sent = reduce(DataFrame.unionByName, parts).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("tag", "bucket", "blob"))).alias("parts"))
    return stored.join(sent.hint("shuffle_hash"), "g")


def _of(row, tag: str, dtype) -> np.ndarray:
    """A group's parts of one tag, in the order of its contexts."""
    return np.concatenate([_unpack(x["blob"], dtype)[0] for x in row["parts"] if x["tag"] == tag]).astype(np.int64)


def _seats(row, number: int) -> bytes | None:
    return next((x["blob"] for x in row["parts"] if x["tag"] == f"seats {number}"), None)


def _swept(stored: DataFrame, parts: list[DataFrame], shared: dict, number: int) -> DataFrame:
    """The state after sweep ``number`` (from 1): seats, the context slices of each group, and what it adds to the sums."""
    past = stored.sparkSession.sparkContext.broadcast(shared)

    def run(batches):
        for row in _rows(batches):
            chain = Chain(Group(row["g"], row.pop("body")), _seats(row, number - 1))
            chain.sweep(number, past.value, _of(row, f"tables {number - 1}", "<u4"))
            yield _counts(chain)
            for kind, at, blob in [(_SEATS, number, _pack(chain.t.astype("<u4"), chain.s.astype("<u4"))), *((_SLICE, int(b), _pack(x)) for b, x in chain.g.slices(chain.t))]:
                yield pa.RecordBatch.from_pylist([{"g": row["g"], "kind": kind, "at": at, "value": 0, "blob": blob}], schema=_STATE)
            del chain
            K.release()
    return written(_with(stored.select("g", "body"), parts).mapInArrow(run, _STATE_SQL), "op10-state")


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sweeps: int = BURN_IN + SAMPLES, burn_in: int = BURN_IN) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the text under
    the add-one unigram model and under the hierarchical model)."""
    spark = docs.sparkSession
    flushes = _flushes(_documents(docs, doc_id, text))
    schema = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    size = flushes.agg(F.sum("n_train").alias("train"), F.sum("n_tokens").alias("all")).first()
    if not size["all"]:
        return spark.createDataFrame([], schema)
    groups = max(8, -(-size["all"] // GROUP_TOKENS))
    words = _split_words(flushes, size["train"])
    split = spark.sparkContext.broadcast(words)
    stored = _groups(_sent(flushes, split, groups), groups)
    homes = _homes(stored, groups)

    def start(batches):
        for row in _rows(batches):
            yield _counts(Chain(Group(row["g"], row["body"])))

    history = [_shared(stored.select("g", "body").mapInArrow(start, _STATE_SQL), [], len(words[0]))]
    tables, seats = [homes.filter("tag = 'tables 0'")], []
    for k in range(1, sweeps + 1):
        state = _swept(stored, [tables[-1], *seats[-1:]], history[-1], k)
        history.append(_shared(state, history, len(words[0])))
        tables.append(_tables(homes, state, k))
        seats.append(state.filter(F.col("kind") == _SEATS).select("g", F.lit(f"seats {k}").alias("tag"), F.lit(0).cast("long").alias("bucket"), "blob"))
    past, samples = spark.sparkContext.broadcast(history), range(burn_in + 1, sweeps + 1)
    returned = pa.schema([("flush", pa.int64()), ("g", pa.int64()), ("blob", pa.binary())])

    def probabilities(batches):
        for row in _rows(batches):
            g = Group(row["g"], row.pop("body"))
            customers = _of(row, "customers", "<u8")
            p = sum(Chain(g, _seats(row, k)).predictive(past.value[k], _of(row, f"tables {k}", "<u4"), customers) for k in samples) / len(samples)
            log_p, c = np.log10(p).astype("<f4"), g.per_word(g.c)
            c[g.freq > 0] = past.value[0]["freq_c"][g.freq[g.freq > 0] - 1]
            for x in row["spans"]:
                sections, keys = (np.cumsum(y, dtype=np.uint32) for y in _unpack(x["blob"], "<u4", "<u4"))
                yield pa.RecordBatch.from_pylist([{"flush": x["at"], "g": row["g"], "blob": _pack(log_p[sections], c[keys].astype("<u8"))}], schema=returned)
            del g, customers, p, log_p, c
            K.release()

    train, smooth = history[0]["tokens"], float(np.log10(history[0]["tokens"] + history[0]["types"] + 1))

    def documents(batches):
        for row in _rows(batches):
            f = Flush(row.pop("blob"))
            log_p, c = (np.concatenate(x) for x in zip(*(_unpack(x["blob"], "<f4", "<u8") for x in row.pop("returned"))))
            _, _, pairs, nth = f.pairs(split.value)
            c = c[(pairs >> np.uint64(32)).astype(np.int64)]
            doc, n = np.repeat(np.arange(len(f.size)), f.size), len(f.size)
            known, base, mine = (np.bincount(doc, weights=x[nth], minlength=n) for x in (c > 0, np.log10(c + 1.0), log_p))
            for lo in range(0, n, 10_000):
                s = slice(lo, lo + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(f.ids[s], mask=f.null[s].astype(bool)), pa.array(f.held[s].astype(bool)), pa.array(f.size[s].astype(np.int64)), pa.array(known[s].astype(np.int64)),
                                                  pa.array(np.full(len(f.ids[s]), train)), pa.array(base[s] - f.size[s] * smooth), pa.array(mine[s])], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
            del f, log_p, c, pairs, nth, doc, known, base, mine
            K.release()

    parts = [homes.filter("tag = 'customers'"), *(tables[k] for k in samples), *(seats[k - 1] for k in samples)]
    back = _with(stored.select("g", "body", "spans"), parts).mapInArrow(probabilities, "flush bigint, g bigint, blob binary")
    back = back.groupBy("flush").agg(F.array_sort(F.collect_list(F.struct("g", "blob"))).alias("returned"))
    return flushes.select("flush", "blob").join(back.hint("shuffle_hash"), "flush").mapInArrow(documents, schema)
