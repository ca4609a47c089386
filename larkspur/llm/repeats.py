"""Finding equal windows of tokens across a corpus, level by level.

Tokens are words or bytes, each with a 64-bit value. A window of ``n`` tokens has a hash that is the same
wherever the same tokens stand. To find equal windows of a target length without shuffling them all, each
target window is stood for by the smallest hash among the shorter windows inside it: equal target windows have equal
stand-ins, and neighbouring windows mostly share one. Only windows whose stand-in is found elsewhere go on to the next level, which is
twice as long.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time; a longer text is worked on by itself.
BLOCK = 1 << 20
MASK = (1 << 64) - 1


class Hash:
    """Polynomial hashes modulo 2**64 over random token values, mixed at the end."""

    def __init__(self, seed):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 62)) << 1 | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) ^ rng.integers(
            0, 1 << 62, 256, dtype=np.uint64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def grow(self, n):
        if len(self.powers) < n:
            for name, x in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(n, x, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sums(self, values):
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[:len(values)], out=out[1:])
        return out

    def windows(self, values, n):
        """The hash of each window of ``n`` values."""
        if len(values) < n:
            return np.zeros(0, np.uint64)
        c = self.sums(values)
        return mixed((c[n:] - c[:-n]) * self.inverses[:len(c) - n])

    def spans(self, values, starts, ends):
        c = self.sums(values)
        return mixed((c[ends] - c[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def mixed(x):
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


ONE, TWO = Hash(101), Hash(202)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_spans(raw):
    """Starts and ends of the words in an array of bytes."""
    gap = np.ones(len(raw) + 2, bool)
    gap[1:-1] = SPACE[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[0::2], edge[1::2]


class Block:
    """Some documents' tokens: values under two hashes, the document of each, and the tokens before each
    document. ``unit`` is words or bytes. Documents are joined by a space, which no word spans; byte
    windows across the join are left out by the document numbers."""

    def __init__(self, texts, unit, second=False):
        raw = np.frombuffer(b" ".join(texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        self.raw, self.begin, self.size = raw, begin, size
        if unit == "words":
            starts, ends = word_spans(raw)
            self.values = ONE.spans(ONE.table[raw], starts, ends)
            self.others = TWO.spans(TWO.table[raw], starts, ends) if second else None
            self.starts, self.ends = starts, ends
            self.doc = np.searchsorted(begin, starts, "right") - 1
        else:
            self.values = ONE.table[raw]
            self.others = TWO.table[raw] if second else None
            self.doc = np.repeat(np.arange(len(texts)), size + 1)[:len(raw)]
            # The joining space gets a number of its own so that no window holds it.
            self.doc[begin[1:] - 1] = -1 - np.arange(1, len(texts))
        self.first = np.searchsorted(self.doc, np.arange(len(texts))) if unit == "words" else begin
        self.count = np.bincount(self.doc[self.doc >= 0], minlength=len(texts)) if len(self.doc) else np.zeros(
            len(texts), np.int64)

    def whole(self, n):
        """Which windows of ``n`` tokens lie inside one document."""
        m = len(self.doc) - n + 1
        return self.doc[:max(m, 0)] == self.doc[n - 1:] if m > 0 else np.zeros(0, bool)

    def stand_ins(self, n, short):
        """For each window of ``n`` tokens the smallest hash of the windows of ``short`` tokens inside it."""
        h = ONE.windows(self.values, short)
        width, have = n - short + 1, 1
        while have < width and len(h):
            step = min(have, width - have)
            h = np.minimum(h[:-step], h[step:]) if len(h) > step else h[:0]
            have += step
        return h[:max(len(self.doc) - n + 1, 0)]

    def places(self, n, short):
        """For each window of ``n`` tokens where its stand-in is: the first of equal ones."""
        h = ONE.windows(self.values, short)
        at, width, have = np.arange(len(h), dtype=np.int32), n - short + 1, 1
        while have < width and len(at):
            step = min(have, width - have)
            left, right = at[:-step] if len(at) > step else at[:0], at[step:]
            at = np.where(h[left] <= h[right], left, right)
            have += step
        return h, at[:max(len(self.doc) - n + 1, 0)]


def blocks(batch, size=BLOCK):
    """Row ranges of an Arrow batch with text in column 1, of about ``size`` bytes each."""
    lengths = np.array([x.as_buffer().size if x.is_valid else 0 for x in batch.column(1)], np.int64)
    a, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield a, i
            a, held = i, 0
        held += n
    if a < len(lengths):
        yield a, len(lengths)


def texts(batch, a, b):
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(1)[a:b]]


def slim(docs, text="text"):
    """doc_id and text; null ids and texts are left out, as they can neither match nor be matched."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))


def level_rows(docs, unit, n, short):
    """(h, doc_id) for the stand-ins of every document, once per run of neighbours."""

    def emit(batches):
        for batch in batches:
            for a, b in blocks(batch):
                x = Block(texts(batch, a, b), unit)
                h = x.stand_ins(n, short)
                ok = x.whole(n)
                h, doc = h[ok], x.doc[:len(ok)][ok]
                if len(h):
                    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
                    ids = np.asarray(batch.column(0)[a:b])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[new].view(np.int64)), pa.array(ids[doc[new]])], names=["h", "doc_id"])

    return docs.where("doc_id is not null and text is not null").mapInArrow(emit, "h long, doc_id long")


def places_rows(docs, unit, n, short):
    """(h, doc_id, n) for the stand-ins of every document, once each, with the number of their places:
    a stand-in may be found again in its own document, next to itself too."""

    def emit(batches):
        for batch in batches:
            for a, b in blocks(batch):
                x = Block(texts(batch, a, b), unit)
                h, at = x.places(n, short)
                at = at[x.whole(n)]
                if not len(at):
                    continue
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
                h, doc = h[at], x.doc[at]
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
                times = np.diff(np.concatenate([first, [len(h)]]))
                ids = np.asarray(batch.column(0)[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[first].view(np.int64)), pa.array(ids[doc[first]]), pa.array(times.astype(np.int64))],
                    names=["h", "doc_id", "n"])

    return docs.where("doc_id is not null and text is not null").mapInArrow(emit, "h long, doc_id long, n long")


#: Stand-ins in more rows or places than this are dealt out window by window instead of together.
HOT = 5_000


def common(rows, apart, places=None):
    """(doc_id, hs, hot, n) for documents with stand-ins for which ``apart``, an aggregate, holds. ``places`` is the
    number of places that a row stands for (one); ``n`` sums up those of stand-ins that aren't hot.

    Counting sums up before the shuffle, and the join back has one row per stand-in on its other side, so
    hot ones can be split.
    """
    places = F.lit(1) if places is None else places
    shared = rows.groupBy("h").agg(apart.alias("apart"), F.sum(places).alias("m")).where("apart").select(
        F.col("h").alias("g"), (F.col("m") > HOT).alias("is_hot"))
    return rows.join(shared, F.col("h") == F.col("g")).groupBy("doc_id").agg(
        F.collect_set("h").alias("hs"), F.collect_set(F.when(F.col("is_hot"), F.col("h"))).alias("hot"),
        F.sum(F.when(~F.col("is_hot"), places).otherwise(0)).alias("n"))


def live_windows(batch, a, b, unit, n, short, hot, second):
    """The block of rows a..b and, of its windows with a shared stand-in, those that are hot or not: their
    places in the block, stand-ins, documents and, by whether the row begins a run, the runs."""
    x = Block(texts(batch, a, b), unit, second)
    h, ok = x.stand_ins(n, short), x.whole(n)
    column = batch.column(2 if not hot else 3)
    wanted = np.unique(np.asarray(column[a:b].flatten())).view(np.uint64)
    ok &= np.isin(h, wanted)
    if not hot:
        never = np.unique(np.asarray(batch.column(3)[a:b].flatten())).view(np.uint64)
        if len(never):
            ok &= ~np.isin(h, never)
    at = np.flatnonzero(ok)
    h, doc = h[at], x.doc[at]
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(
        at) else np.zeros(0, bool)
    return x, at, h, doc, new


def covered(ids, starts, lengths):
    """Maximal runs of covered tokens as sorted arrays (id, begin, end)."""
    order = np.lexsort((starts, ids))
    i, a, z = ids[order], starts[order], (starts + lengths)[order]
    if not len(i):
        return i, a, z
    change = np.concatenate([[True], i[1:] != i[:-1]])
    # Ends so far within each id: ids are numbered so that the running maximum starts anew.
    lift = np.cumsum(change).astype(np.int64) * (int(z.max()) + 2)
    reach = np.maximum.accumulate(z + lift)
    begins = np.concatenate([[True], (a + lift)[1:] > reach[:-1]])
    first = np.flatnonzero(begins)
    return i[first], a[first], (reach - lift)[np.concatenate([first[1:] - 1, [len(i) - 1]])]


def merged(spans):
    """Sorted, disjoint (begin, end) of a document's overlapping spans."""
    out = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


def spans_of(found):
    """(d, spans) per document from rows (doc_id, a, z)."""
    return found.groupBy(F.col("doc_id").alias("d")).agg(F.collect_list(F.struct("a", "z")).alias("spans"))


def hot_rows(docs, unit, n, short):
    """(k1, k2, doc_id, a) for each window with a hot stand-in."""

    def emit(batches):
        for batch in batches:
            for a, b in blocks(batch):
                x, at, h, doc, _ = live_windows(batch, a, b, unit, n, short, True, True)
                if len(at):
                    ids = np.asarray(batch.column(0)[a:b])
                    k1, k2 = ONE.windows(x.values, n)[at], TWO.windows(x.others, n)[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(ids[doc]),
                         pa.array((at - x.first[doc]).astype(np.int64))], names=["k1", "k2", "doc_id", "a"])

    return docs.where(F.size("hot") > 0).mapInArrow(emit, "k1 long, k2 long, doc_id long, a long")
