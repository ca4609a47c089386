"""Scoring texts by a causal self-attention model over subword ids, trained by the tasks in numpy.

A text is the sequence of its words (runs of characters other than space and \\t \\n \\v \\f \\r, A-Z in lower case) and one end. Each
word is encoded with a space before it; the end has an id of its own.

What is learned, all from rows that are not held out:

* counts of every word and of every id, over all texts. The most frequent ids are classes of their own, the
  others share classes of about equal counts; an id's share of its class is its count and one;
* a layer of causal self-attention over the ids before, with a residual, that gives the next id's class: first one of
  ``GROUPS`` groups of classes, then one of its ``MEMBERS``. It starts as the class counts. All windows are dealt to
  learners of about ``LEARNER`` windows, each trains on its own, and their parameters are averaged in a
  tree (``ROUNDS`` times, each with other documents). The parameters have a fixed size.

A text is scored in windows of ``WINDOW`` ids, of which each shares a half with the one before: each id is scored once, in
the later half of its window, so it sees at least the half a window before it, if the text has so much. Places count
by their distance only, so what attention needs of an id is worked out once, not once a window.

Word counts stay a table. Words of a bounded number of the most frequent ones travel with the tasks, the other
words of each document are joined with the table.

Rows without doc_id are scored but not learned from, as if held out. Null text is empty: only the end. Repeated rows are
documents of their own. Other columns are not read. An empty table gives no rows, and one without learning rows a uniform
model.
"""

import collections
import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from larkspur.llm.packing import TOKENIZER
from larkspur.llm.repeats import blocks, texts
from larkspur.session import new_path

WINDOW = 32
#: Size of vectors, and vectors for ids (the less frequent ids share 64 of them).
WIDTH, INPUTS = 16, 2048
#: Classes: groups, members of a group, and of all classes those that several ids share.
GROUPS, MEMBERS, SHARED = 32, 32, 64
OWN = GROUPS * MEMBERS - SHARED
#: Rounds of training; every document is in one of them.
ROUNDS = 2
LEARNER, BATCH, RATE = 32_768, 32, 0.01
#: What fills up a document's last window; no id is as large.
FILL = 65_535
#: Scores are cut off here, so that their exponentials stay numbers of 32 bits.
LIMIT = 60
#: Parameter sets averaged by one task.
FAN_IN = 32
#: Targets of one group that are multiplied together while training.
TOGETHER = 16
#: Ids that are scored at a time, at most, where texts have no more.
PIECE = 1 << 15
#: Words that travel with the tasks, at most, and their bytes, at most.
COMMON_WORDS, COMMON_BYTES = 1 << 16, 64
#: Words whose ids a task remembers, and word counts that it holds before it hands them on.
REMEMBER, HOLD = 1 << 18, 1 << 19
END_ID, IDS = 50256, 50257
SHARED_INPUTS = 64
NAMES = ("E", "R", "Wi", "Wo", "Wg", "bg", "Wc", "bc")


def words(raw):
    return raw.lower().split()


class Subwords:
    """Ids of words, remembered from text to text."""

    def __init__(self, folder=None, name=TOKENIZER):
        import base64

        import public_tokenizers
        import tiktoken

        path = f"{folder}/{name}.tiktoken" if folder else public_tokenizers.path(f"{name}.tiktoken")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.opens = np.zeros(IDS, bool)
        self.opens[[i for piece, i in ranks.items() if piece[:1] == b" "]] = True
        self.forget()

    def forget(self):
        """Entry 0 is the end."""
        self.at, self.all = {b"": 0}, [b""]
        self.ids, self.begin = np.array([END_ID], np.int32), np.array([0, 1])

    def learn(self, new):
        """Entries for distinct words that have none."""
        # A word holds no space, so ids that open with one begin the words.
        ids = self.encode(b" " + b" ".join(new))
        begin = np.flatnonzero(self.opens[ids])
        self.at.update(zip(new, range(len(self.all), len(self.all) + len(new))))
        self.all += new
        self.begin = np.concatenate([self.begin[:-1], self.begin[-1] + begin, [self.begin[-1] + len(ids)]])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, raw):
        try:
            return np.array(self.coder.encode_ordinary(raw.decode()), np.int32)
        except BaseException as e:  # the library's panics are no Exceptions; a long word can't be matched at once
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
        from larkspur.llm.packing import encoder

        return np.array(encoder()(raw.decode()), np.int32)

    def entries(self, found):
        """The entry of each word of a list."""
        if len(self.at) > REMEMBER:
            self.forget()
        # Each distinct word is looked up in the large table once.
        own = dict.fromkeys(found)
        own = dict(zip(own, map(self.at.get, own)))
        new = [w for w, entry in own.items() if entry is None]
        if new:
            own.update(zip(new, range(len(self.all), len(self.all) + len(new))))
            self.learn(new)
        return np.fromiter(map(own.__getitem__, found), np.int64, len(found))

    def encoded(self, raws):
        """Entries of the words and the end of some texts, how many each text has, their ids end to end, and where each text's ids begin."""
        found, size = [], []
        for raw in raws:
            w = words(raw)
            found += w
            found.append(b"")
            size.append(len(w) + 1)
        entries, size = self.entries(found), np.array(size, np.int64)
        ids, n = self.sequence(entries)
        last = np.concatenate([[0], np.cumsum(n)])
        return entries, size, ids, last[np.concatenate([[0], np.cumsum(size)])]

    def sequence(self, entries):
        """The ids of all entries, and how many each has."""
        n = self.begin[entries + 1] - self.begin[entries]
        at = np.repeat(self.begin[entries] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.ids[at], n


def slim(docs):
    """doc_id, text, and whether the row is held out."""
    i = F.col("doc_id").cast("long")
    return docs.select(i.alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(
        F.crc32(i.cast("string")) % 7 == 2, F.lit(True)).alias("held_out"))


def word_counts(docs):
    """(word, c) over the texts, the end as the word without letters."""

    def count(batches):
        held = collections.Counter()
        for batch in batches:
            for a, b in blocks(batch):
                held[b""] += b - a
                for raw in texts(batch, a, b):
                    held.update(words(raw))
                if len(held) > HOLD:
                    yield given(held)
                    held = collections.Counter()
        if held:
            yield given(held)

    def given(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])

    return docs.select("doc_id", "text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def id_counts(counted, folder=None):
    """The count of each id: one row for each id at most comes to the driver."""

    def count(batches):
        coder, total = Subwords(folder), np.zeros(IDS, np.int64)
        for batch in batches:
            coder.forget()
            entries = coder.entries(batch.column(0).to_pylist())
            ids, n = coder.sequence(entries)
            np.add.at(total, ids, np.repeat(np.asarray(batch.column(1)), n))
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(total[on])], names=["id", "n"])

    total = np.zeros(IDS, np.int64)
    for r in counted.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[r["id"]] = r["n"]
    return total


class Vocabulary:
    """Classes and vectors of ids, from their counts."""

    def __init__(self, total):
        order = np.lexsort((np.arange(IDS), -total))
        weight = (total + 1.0)[order]
        rest = np.cumsum(weight[OWN:])
        cls = np.concatenate([np.arange(OWN), OWN + np.minimum((rest - weight[OWN:]) * SHARED // rest[-1], SHARED - 1).astype(int)])
        rank = np.arange(IDS)
        row = np.where(rank < INPUTS - SHARED_INPUTS, rank, INPUTS - SHARED_INPUTS + rank % SHARED_INPUTS)
        self.cls, self.row = np.zeros(IDS, np.int32), np.zeros(IDS, np.int32)
        self.cls[order], self.row[order] = cls, row
        mass = np.bincount(cls, weight, OWN + SHARED)
        self.inside = np.zeros(IDS)
        self.inside[order] = np.log10(weight / mass[cls])
        self.mass = np.maximum(mass, 1).reshape(GROUPS, MEMBERS)


def start(vocabulary, seed=7):
    """Parameters that give the class counts whatever came before."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.3 / math.sqrt(WIDTH), shape).astype(np.float32)
    mass = vocabulary.mass
    return {"E": draw(INPUTS, WIDTH) * 3, "R": np.zeros(WINDOW, np.float32), "Wi": draw(WIDTH, 3 * WIDTH), "Wo": draw(WIDTH, WIDTH),
            "Wg": np.zeros((WIDTH, GROUPS), np.float32), "bg": np.log(mass.sum(axis=1) / mass.sum()).astype(np.float32),
            "Wc": np.zeros((GROUPS, WIDTH, MEMBERS), np.float32),
            "bc": np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32)}


def reach(n, first):
    """Distance back from each of the places ``first`` on of ``n`` to each place; negative: not seen."""
    return np.arange(first, n)[:, None] - np.arange(n)


def beyond(z, more=0):
    """Whether a score, of which ``more`` may still be added or taken away, is beyond ``LIMIT``. Only then a softmax has to be
    worked out from the scores less their row's maximum, which takes far longer than this."""
    return z.size > 0 and not (z.max() + more < LIMIT and z.min() - more > -LIMIT)


def attend(m, rows):
    """Vectors after causal attention, for windows of input rows."""
    batch, n = rows.shape
    x = m["E"].take(rows, axis=0)
    qkv = (x.reshape(-1, WIDTH) @ m["Wi"]).reshape(batch, n, 3 * WIDTH)
    q, k, v = qkv[:, :, :WIDTH], qkv[:, :, WIDTH:2 * WIDTH], qkv[:, :, 2 * WIDTH:]
    back = reach(n, 0)
    a = q @ k.transpose(0, 2, 1)
    a *= x.dtype.type(1 / math.sqrt(WIDTH))
    far = beyond(a, np.abs(m["R"]).max())
    a += np.where(back >= 0, m["R"][back], -np.inf).astype(x.dtype)
    if far:
        a -= a.max(axis=2, keepdims=True)
    np.exp(a, out=a)
    a /= a @ np.ones((n, 1), x.dtype)
    o = a @ v
    return x, q, k, v, a, o, x + (o.reshape(-1, WIDTH) @ m["Wo"]).reshape(o.shape)


def attended(m, rows, begin):
    """Vectors after attention for texts of input rows end to end, in windows of two halves: every place with
    the places up to it in its half and those of the half before."""
    half, size = WINDOW // 2, np.diff(begin)
    parts = -(-size // half)
    first = np.cumsum(parts) - parts  # each text's first half
    place = np.arange(begin[-1]) + np.repeat(first * half - begin[:-1], size)
    # What is needed of a row: its query, key, value as it is added to the row's own vector, and that vector.
    e, d = m["E"], WIDTH
    table = np.concatenate([e @ m["Wi"], e], axis=1)
    table[:, :d] *= e.dtype.type(1 / math.sqrt(d))
    table[:, 2 * d:3 * d] = table[:, 2 * d:3 * d] @ m["Wo"]
    table = np.concatenate([table, np.zeros((1, 4 * d), e.dtype)])
    # A half of nothing stands before the first one.
    padded = np.full((parts.sum() + 1) * half, len(table) - 1)
    padded[half + place] = rows
    back = reach(WINDOW, half)
    bias = np.where(back >= 0, m["R"][back], -np.inf).astype(e.dtype)
    alone = np.zeros(parts.sum(), bool)
    alone[first] = True
    out, ones = np.empty((len(alone), half, d), e.dtype), np.ones((WINDOW, 1), e.dtype)
    for at in range(0, len(out), 64):
        z = min(at + 64, len(out))
        halves = table.take(padded[at * half:(z + 1) * half], axis=0)
        own = halves[half:].reshape(-1, half, 4 * d)
        # Neighbouring windows share a half, which is not copied.
        seen = np.lib.stride_tricks.sliding_window_view(halves, WINDOW, axis=0)[::half]
        a = own[:, :, :d] @ seen[:, d:2 * d]
        a += bias
        a[alone[at:z], :, :half] = -np.inf
        np.exp(np.minimum(a, LIMIT, out=a), out=a)
        o = a @ seen[:, 2 * d:3 * d].transpose(0, 2, 1)
        o /= a @ ones
        np.add(o, own[:, :, 3 * d:], out=out[at:z])
    return out.reshape(-1, d).take(place, axis=0)


def softmax_loss(z, which, scale):
    """Minus the natural logarithm of the softmax of each row of ``z`` at one place, summed, and its gradient times
    ``scale``; ``z`` is overwritten."""
    place = np.arange(len(z)) * z.shape[1] + which
    if beyond(z):
        z -= z.max(axis=1, keepdims=True)
    own = z.take(place).sum()
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    z *= (scale / total)[:, None]
    z.reshape(-1)[place] -= scale
    return np.log(total).sum() - own, z


def summed(rows, x, like):
    """The rows of ``x`` that have the same number in ``rows`` added up, in an array as ``like``."""
    out, width = np.zeros(like.size, like.dtype), like.shape[1]
    np.add.at(out, (rows[:, None] * width + np.arange(width)).ravel(), x.ravel())
    return out.reshape(like.shape)


def by_group(cls):
    """Places of targets in the order of their groups, and where each group begins."""
    order = np.argsort(cls // MEMBERS, kind="stable")
    return order, np.searchsorted(cls[order] // MEMBERS, np.arange(GROUPS + 1))


def log_of(z, which):
    """Natural logarithm of the softmax of each row of ``z`` at one place; ``z`` is overwritten."""
    np.clip(z, -LIMIT, LIMIT, out=z)
    own = z[np.arange(len(z)), which]
    np.exp(z, out=z)
    return own - np.log(z @ np.ones(z.shape[1], z.dtype))


def class_logs(m, h, cls):
    """Natural logarithm of the probability of each class asked for."""
    group, member = np.divmod(cls, MEMBERS)
    order = np.argsort(group.astype(np.int16), kind="stable")
    begin = np.searchsorted(group[order], np.arange(GROUPS + 1))
    h, group, member = h.take(order, axis=0), group[order], member[order]
    out = np.empty(len(cls), h.dtype)
    for at in range(0, len(cls), 4096):
        out[at:at + 4096] = log_of(h[at:at + 4096] @ m["Wg"] + m["bg"], group[at:at + 4096])
    for g in np.flatnonzero(np.diff(begin)):
        for at in range(begin[g], begin[g + 1], 4096):
            z = min(at + 4096, begin[g + 1])
            out[at:z] += log_of(h[at:z] @ m["Wc"][g] + m["bc"][g], member[at:z])
    logs = np.empty_like(out)
    logs[order] = out
    return logs


def gradients(m, rows, cls):
    """Loss per target and the gradients of a batch of windows; targets of -1 don't count."""
    x, q, k, v, a, o, h = attend(m, rows)
    d = WIDTH
    want, flat = cls.ravel(), h.reshape(-1, d)
    at = np.flatnonzero(want >= 0)
    # Targets in the order of their groups; each group's are dealt into blocks of ``TOGETHER``, the last one filled up with zeros.
    order, begin = by_group(want[at])
    at = at[order]
    # Biases are weights of a last one.
    want, own = want[at], np.ones((len(at), d + 1), x.dtype)
    own[:, :d] = flat.take(at, axis=0)
    scale = x.dtype.type(1 / max(len(at), 1))
    group, member = np.divmod(want, MEMBERS)
    loss, p = softmax_loss(own @ np.concatenate([m["Wg"], m["bg"][None]]), group, scale)
    part = own.T @ p
    g = {"Wg": part[:d], "bg": part[d], "Wc": np.zeros_like(m["Wc"]), "bc": np.zeros_like(m["bc"])}
    down = p @ m["Wg"].T
    if len(at):
        size = np.diff(begin)
        many = -(-size // TOGETHER)
        first = np.cumsum(many) - many
        slot, block = np.arange(len(at)) + np.repeat(first * TOGETHER - begin[:-1], size), np.repeat(np.arange(GROUPS), many)
        weights = np.concatenate([m["Wc"], m["bc"][:, None]], axis=1).take(block, axis=0)
        dealt = np.zeros((len(block) * TOGETHER, d + 1), x.dtype)
        dealt[slot] = own
        dealt = dealt.reshape(-1, TOGETHER, d + 1)
        more, p = softmax_loss((dealt @ weights).reshape(-1, MEMBERS).take(slot, axis=0), member, scale)
        loss += more
        put = np.zeros((len(block) * TOGETHER, MEMBERS), x.dtype)
        put[slot] = p
        put = put.reshape(-1, TOGETHER, MEMBERS)
        parts = (dealt.transpose(0, 2, 1) @ put).reshape(len(block), -1)
        # The blocks of each group added up.
        parts = ((block == np.arange(GROUPS)[:, None]).astype(x.dtype) @ parts).reshape(GROUPS, d + 1, MEMBERS)
        g["Wc"], g["bc"] = parts[:, :d], parts[:, d]
        down += (put @ weights[:, :d].transpose(0, 2, 1)).reshape(-1, d).take(slot, axis=0)
    dh = np.zeros_like(flat)
    dh[at] = down
    g["Wo"] = o.reshape(-1, d).T @ dh
    do = (dh @ m["Wo"].T).reshape(o.shape)
    ds, di = do @ v.transpose(0, 2, 1), np.empty((*o.shape[:2], 3 * d), x.dtype)
    # What the softmax takes off is the sum of (do @ v.T) * a, which is that of do * o.
    ds -= np.einsum("bnd,bnd->bn", do, o)[:, :, None]
    ds *= a
    back = reach(rows.shape[1], 0)
    seen = back >= 0
    g["R"] = np.bincount(back[seen], ds.sum(axis=0)[seen], WINDOW).astype(x.dtype)
    ds *= x.dtype.type(1 / math.sqrt(d))
    np.matmul(ds, k, out=di[:, :, :d])
    np.matmul(ds.transpose(0, 2, 1), q, out=di[:, :, d:2 * d])
    np.matmul(a.transpose(0, 2, 1), do, out=di[:, :, 2 * d:])
    di = di.reshape(-1, 3 * d)
    g["Wi"] = x.reshape(-1, d).T @ di
    g["E"] = summed(rows.ravel(), dh + di @ m["Wi"].T, m["E"])
    return loss * scale, g


def train(m, rows, cls, batch=BATCH, rate=RATE):
    """One pass of Adam over windows."""
    # All parameters are parts of one array, so that a step is a few operations on it.
    ends = np.cumsum([0, *(m[k].size for k in NAMES)])
    flat = np.concatenate([m[k].ravel() for k in NAMES])
    m = {k: flat[i:j].reshape(m[k].shape) for k, i, j in zip(NAMES, ends, ends[1:])}
    one, two, x, y = (np.zeros_like(flat) for _ in range(4))
    for t, at in enumerate(range(0, len(rows), batch), 1):
        _, g = gradients(m, rows[at:at + batch], cls[at:at + batch])
        np.concatenate([g[k].ravel() for k in NAMES], out=x)
        np.multiply(x, x, out=y)
        for mean, new, rest in ((one, x, 0.1), (two, y, 0.01)):
            new *= np.float32(rest)
            mean *= np.float32(1 - rest)
            mean += new
        # The means' corrections for their start, 1 - 0.9 ** t and 1 - 0.99 ** t, are taken into the numbers.
        root = math.sqrt(1 - 0.99 ** t)
        np.sqrt(two, out=y)
        y += np.float32(1e-6 * root)
        np.divide(one, y, out=x)
        x *= np.float32(rate * root / (1 - 0.9 ** t))
        flat -= x
    return {k: x.copy() for k, x in m.items()}


def packed(m):
    return b"".join(m[k].astype("<f4").tobytes() for k in NAMES)


def unpacked(raw, like):
    out, at = {}, 0
    for k in NAMES:
        out[k] = np.frombuffer(raw, "<f4", like[k].size, at).reshape(like[k].shape).copy()
        at += 4 * like[k].size
    return out


def cut_up(ids, begin):
    """The windows of texts whose ids stand end to end from ``begin`` on, each with the id before it; before a text stands the end."""
    size = np.diff(begin)
    many = -(-size // WINDOW)
    first = np.cumsum(many) - many
    out, after = np.empty((many.sum(), WINDOW + 1), "<u2"), np.full(many.sum() * WINDOW, FILL, "<u2")
    after[np.arange(len(ids)) + np.repeat(first * WINDOW - begin[:-1], size)] = ids
    out[:, 1:] = after.reshape(-1, WINDOW)
    out[1:, 0] = out[:-1, -1]
    out[first, 0] = END_ID
    return out


def windows(docs, turn, folder=None):
    """(deal, ids): the windows of all documents of a round; the last one of a document is filled up with ``FILL``."""

    def cut(batches):
        coder, task, made = Subwords(folder), TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in blocks(batch):
                _, _, ids, begin = coder.encoded(texts(batch, a, b))
                out = cut_up(ids, begin)
                deal = [zlib.crc32(b"%d %d" % (task, made + k)) for k in range(1, len(out) + 1)]
                made += len(out)
                places = np.arange(len(out) + 1, dtype=np.int32) * out.strides[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(deal, pa.int64()), pa.Array.from_buffers(pa.binary(), len(out), [None, *map(pa.py_buffer, (places, out))])],
                    names=["deal", "ids"])

    here = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == turn
    return docs.where(here).select("doc_id", "text").mapInArrow(cut, "deal long, ids binary")


def fit(docs, folder=None):
    """The model: vocabulary, parameters and the table of word counts."""
    spark = docs.sparkSession
    path = new_path(spark, "lm")
    learning = slim(docs).where("not held_out")
    word_counts(learning).write.parquet(f"{path}/words")
    counted = spark.read.schema("word binary, c long").parquet(f"{path}/words")
    total = id_counts(counted, folder)
    vocabulary = Vocabulary(total)
    # Every document's last window may be short, so a round has about so many windows at most.
    n = -(-int(total.sum() // WINDOW + total[END_ID]) // ROUNDS)
    model = start(vocabulary)
    for turn in range(ROUNDS if n else 0):
        model = learned(windows(learning, turn, folder), n, model, vocabulary, f"{path}/round-{turn}")
    return vocabulary, model, counted


def learned(dealt, n, model, vocabulary, path):
    """The weighted mean of the parameters of learners that each train on a share of about ``n`` windows."""
    spark = dealt.sparkSession
    learners = -(-n // LEARNER)
    begin, cls, row = packed(model), vocabulary.cls, vocabulary.row
    # Shapes only: the values travel packed.
    like = {k: np.empty(x.shape, np.float32) for k, x in model.items() if k != "E"} | {"E": np.empty(model["E"].shape, np.float32)}

    def learn(key, rows):
        ids = np.frombuffer(b"".join(rows.sort_values("deal")["ids"]), "<u2").reshape(-1, WINDOW + 1)
        used = ids != FILL
        ids = np.where(used, ids, END_ID)
        x, y = ids[:, :-1], ids[:, 1:]
        done = train(unpacked(begin, like), np.where(used[:, :-1], row[x], 0), np.where(used[:, 1:], cls[y], -1))
        return pd.DataFrame({"i": [key[0]], "weight": [float(len(ids))], "m": [packed(done)]})

    def mean(key, rows):
        w = rows["weight"].to_numpy()
        total = sum(np.frombuffer(m, "<f4").astype(float) * x for m, x in zip(rows["m"], w)) / w.sum()
        return pd.DataFrame({"i": [key[0]], "weight": [w.sum()], "m": [total.astype("<f4").tobytes()]})

    kind = "i long, weight double, m binary"
    sets = dealt.withColumn("i", F.pmod(F.xxhash64("deal"), F.lit(learners))).groupBy("i").applyInPandas(learn, kind)
    step = 0
    while True:
        sets.write.parquet(f"{path}-{step}")
        sets = spark.read.schema(kind).parquet(f"{path}-{step}")
        if learners == 1:
            last = sets.first()
            return unpacked(last["m"], like) if last else model
        sets = sets.withColumn("i", F.floor(F.col("i") / FAN_IN)).groupBy("i").applyInPandas(mean, kind)
        learners, step = -(-learners // FAN_IN), step + 1


def text_scores(m, vocabulary, ids, begin):
    """log10 of the probability of each text; ``ids`` are the texts' ids end to end, each with its end, from ``begin`` on."""
    before = np.concatenate([[END_ID], ids[:-1]])
    before[begin[:-1]] = END_ID
    row, out, at = vocabulary.row.take(before), np.empty(len(begin) - 1), 0
    while at < len(out):
        # So many texts that their vectors stay in a processor's cache.
        z = max(at + 1, int(np.searchsorted(begin, begin[at] + PIECE, "right")) - 1)
        some = slice(begin[at], begin[z])
        logs = class_logs(m, attended(m, row[some], begin[at:z + 1] - begin[at]), vocabulary.cls.take(ids[some])).astype(float)
        # Every text has an id at least, its end.
        out[at:z] = np.add.reduceat(vocabulary.inside.take(ids[some]) + logs / math.log(10), begin[at:z] - begin[at])
        at = z
    return out


def common_words(counted):
    """The most frequent words with their counts: those of at least the power of two that leaves few enough."""
    short = counted.where(F.octet_length("word") <= COMMON_BYTES)
    sizes = short.groupBy(F.floor(F.log2("c")).cast("int").alias("k")).count().collect()
    n, least = 0, 64
    for r in sorted(sizes, key=lambda r: -r["k"]):
        n += r["count"]
        if n > COMMON_WORDS:
            break
        least = r["k"]
    return {bytes(r["word"]): r["c"] for r in short.where(F.floor(F.log2("c")) >= least).collect()}


ROWS = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, known_logs double, score double, word binary, n long"
ROW_KINDS = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64())
ROW_NAMES = [x.split()[0] for x in ROWS.split(", ")]


def score(docs, vocabulary, model, counted, folder=None):
    """Per document the score of the model and of the word counts."""
    spark = docs.sparkSession
    total, kinds = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    shared = spark.sparkContext.broadcast((common_words(counted), packed(model)))
    like = {k: np.empty(x.shape, np.float32) for k, x in model.items()}

    def run(batches):
        common, raw_model = shared.value
        m = unpacked(raw_model, like)
        coder, task, made = Subwords(folder), TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in blocks(batch):
                entries, size, ids, begin = coder.encoded(texts(batch, a, b))
                doc = np.repeat(np.arange(len(size)), size)
                scores = text_scores(m, vocabulary, ids, begin)
                # Counts of common words; the others leave as rows.
                code = np.sort(doc * len(coder.all) + entries)
                first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                times = np.diff(np.concatenate([first, [len(code)]]))
                own, entry = np.divmod(code[first], len(coder.all))
                used = np.unique(entry)
                c = np.array([common.get(coder.all[e], 0) for e in used.tolist()])[np.searchsorted(used, entry)]
                known = c > 0
                logs = np.bincount(own[known], times[known] * np.log10(c[known] + 1.0), len(size))
                n_known = np.bincount(own[known], times[known], len(size)).astype(np.int64)
                row = (task << 40) + made + np.arange(len(size))
                made += len(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(size), pa.array(n_known),
                     pa.array(logs), pa.array(scores), *(pa.nulls(len(size), t) for t in ROW_KINDS[7:])], names=ROW_NAMES)
                rare = np.flatnonzero(~known)
                if len(rare):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row[own[rare]]), *(pa.nulls(len(rare), t) for t in ROW_KINDS[1:7]),
                         pa.array([coder.all[e] for e in entry[rare].tolist()], pa.binary()), pa.array(times[rare])], names=ROW_NAMES)

    path = new_path(spark, "lm-scores")
    slim(docs).mapInArrow(run, ROWS).write.option("compression", "zstd").parquet(path)
    made = spark.read.schema(ROWS).parquet(path)
    rare = made.where("word is not null").select(F.col("row").alias("r"), "word", "n")
    found = rare.join(counted.withColumnRenamed("word", "w"), F.col("word") == F.col("w")).groupBy("r").agg(
        F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs"))
    zero = F.lit(0).cast("long")
    return made.where("word is null").join(found, F.col("row") == F.col("r"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("known_logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * math.log10(total + kinds + 1)).alias("base_score"),
        "score")


def op12_lm_scoring(spark, sf_dir):
    """Every document's log10 probability under word counts and under the attention model."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, *fit(docs))
