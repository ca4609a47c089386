"""Removing byte strings that occur elsewhere, with a logarithmic family of suffix arrays.

A byte is removed if some ``n``-byte string that covers it also starts at another place, in the same or
another document; matches never cross documents and are judged on the input. Candidates are windows whose stand-in
(the smallest hash of the ``SHORT``-byte strings inside) occurs twice. They are dealt by the stand-in into
buckets of bounded size. In each bucket new windows come in batches: a batch gets a suffix array (its windows in
the order of their bytes), is merge-scanned against the arrays of the existing levels for matches of ``n``
bytes, and becomes a level; levels of equal size merge, so there are about log2 of the number of batches.
Stand-ins in very many places, of many documents or of few, are instead decided over 128-bit hashes, so that no bucket
grows with one passage: runs of windows around one place of a stand-in first, of equal ones only one goes on, then the parts of the
runs that are left (``PARTS`` windows), down to single windows.

Text counts as UTF-8; null text as empty. doc_id is the key: repeated rows of one id must be copies, which
count as one document; rows with a null id are returned whole. Other columns are not read. An empty table
gives no rows.
"""

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larkspur.llm import repeats as R
from larkspur.session import new_path

BYTES = 200
SHORT = 64
#: Runs of windows in a bucket on average, and windows in a batch.
BUCKET, BATCH = 3_000, 32_768
SPANS, SPAN = "doc_id long, a long, z long", ("doc_id", "a", "z")
#: Windows of the parts in which runs of hot windows are compared, after the whole runs; the last ones are single windows.
PARTS = (32, 8, 1)
HOT_RUNS = "k1 long, k2 long, doc_id long, a long, z long, o long, n long, piece binary"
HOT_NAMES = [x.split()[0] for x in HOT_RUNS.split(", ")]


class Levels:
    """Suffix arrays of doubling sizes over windows of one text. ``hit`` tells which windows, of those put
    in, have an equal; a level keeps one of equal windows."""

    def __init__(self, text, n):
        self.text, self.n = np.frombuffer(text, np.uint8), n
        self.view = np.lib.stride_tricks.sliding_window_view(self.text, n) if len(text) >= n else None
        self.levels, self.hits = [], []

    def strings(self, starts):
        return np.ascontiguousarray(self.view[starts]).view(f"S{self.n}").ravel()

    def add(self, starts):
        """Index a batch of windows by their starts in the text."""
        s = self.strings(starts)
        order = np.argsort(s, kind="stable")
        starts, s = starts[order], s[order]
        same = s[1:] == s[:-1]
        self.hits += [starts[1:][same], starts[:-1][same]]
        one = np.concatenate([[True], ~same])
        starts, s = starts[one], s[one]
        for level in self.levels:
            old = self.strings(level)
            at = np.minimum(np.searchsorted(old, s), len(old) - 1)
            found = old[at] == s
            self.hits += [starts[found], level[at[found]]]
            starts, s = starts[~found], s[~found]  # its equal is indexed already
        if not len(starts):
            return
        self.levels.append(starts)
        while len(self.levels) > 1 and len(self.levels[-1]) * 2 > len(self.levels[-2]):
            b, a = self.levels.pop(), self.levels.pop()
            at = np.searchsorted(self.strings(a), self.strings(b))
            self.levels.append(np.insert(a, at, b))

    def found(self):
        """The starts of all windows with an equal, but for those a level had left out."""
        return np.unique(np.concatenate(self.hits)) if self.hits else np.zeros(0, np.int64)


def matches(pieces, n):
    """For (text, number of copies) of distinct pieces, each with windows at every start: which windows
    occur twice, as a list of boolean arrays. Windows of a piece with copies all do."""
    lengths = np.array([len(t) for t in pieces], np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    many = lengths - n + 1
    starts = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    index = Levels(b"".join(pieces), n)
    for a in range(0, len(starts), BATCH):
        index.add(starts[a:a + BATCH])
    hit = np.isin(starts, index.found())
    return np.split(hit, np.cumsum(many)[:-1])


def decide(n):
    """Spans of one bucket's runs: windows that occur twice, by the run's stand-in."""

    def run(rows):
        classes, own = {}, []
        for h, text in zip(rows["h"], rows["piece"]):
            own.append(classes.setdefault((h, text), len(classes)))
        own = np.array(own)
        copies = np.bincount(own, minlength=len(classes))
        texts = list(classes)
        groups = {}
        for k, (h, _) in enumerate(texts):
            groups.setdefault(h, []).append(k)
        # A text that is alone with its stand-in matches only its copies, or itself.
        several = [k for g in groups.values() for k in g if len(g) > 1 or copies[k] == 1]
        hit = dict(zip(several, matches([texts[k][1] for k in several], n))) if several else {}
        ids, starts, lengths = [], [], []
        for row, (k, doc, a) in enumerate(zip(own, rows["doc_id"], rows["a"])):
            if copies[k] > 1:
                ids.append(doc), starts.append(a), lengths.append(len(texts[k][1]))
            elif k in hit and (at := np.flatnonzero(hit[k])).size:
                for part in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                    ids.append(doc), starts.append(a + part[0]), lengths.append(part[-1] - part[0] + n)
        i, a, z = R.covered(np.array(ids, np.int64), np.array(starts, np.int64), np.array(lengths, np.int64))
        return pd.DataFrame({"doc_id": i, "a": a, "z": z})

    return run


def window_runs(live, n, short, buckets):
    """Runs of windows with one shared stand-in: the stand-in, document, first byte and bytes."""

    def emit(batches):
        for batch in batches:
            for a, b in R.blocks(batch):
                x, at, h, doc, new = R.live_windows(batch, a, b, "bytes", n, short, False, False)
                if not len(at):
                    continue
                ids, raw = np.asarray(batch.column(0)[a:b]), x.raw.tobytes()
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(at)]]) - 1
                pieces = [raw[at[i]:at[j] + n] for i, j in zip(first, last)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((h[first] % np.uint64(buckets)).astype(np.int32)), pa.array(h[first].view(np.int64)),
                     pa.array(ids[doc[first]]), pa.array((at[first] - x.first[doc[first]]).astype(np.int64)),
                     pa.array(pieces, pa.binary())], names=["bucket", "h", "doc_id", "a", "piece"])

    return live.mapInArrow(emit, "bucket int, h long, doc_id long, a long, piece binary")


def run_rows(raw, starts, ends, ids, begins, offsets, times, keys):
    """Rows of ``HOT_RUNS`` for the bytes from ``starts`` to ``ends``, which begin at ``begins`` of documents ``ids``."""
    text = raw.tobytes()
    return pa.RecordBatch.from_arrays(
        [*(pa.array(k.view(np.int64)) for k in keys), ids, pa.array(begins), pa.array(begins + (ends - starts)), pa.array(offsets),
         pa.array(times), pa.array([text[a:z] for a, z in zip(starts, ends)], pa.binary())], names=HOT_NAMES)


def hot_runs(live, n, short):
    """Runs of windows whose hot stand-in is at one place, with the distance ``o`` of that place from the first window. What is in a
    run alone decides its distance, and equal windows have equal ones. Of equal runs of a block one row leaves, without a document
    and with their number, and what they cover as rows without a key."""

    def emit(batches):
        for batch in batches:
            for a, b in R.blocks(batch):
                x = R.Block(R.texts(batch, a, b), "bytes", True)
                h, place = x.places(n, short)
                hot = np.unique(np.asarray(batch.column(3)[a:b].flatten())).view(np.uint64)
                at = np.flatnonzero(x.whole(n) & np.isin(h, hot)[place])
                if not len(at):
                    continue
                place = place[at].astype(np.int64)
                first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)]))
                last = np.concatenate([first[1:], [len(at)]]) - 1
                starts, ends, doc = at[first], at[last] + n, x.doc[at[first]]
                ids, begins = np.asarray(batch.column(0)[a:b])[doc], starts - x.first[doc]
                k1, k2 = R.ONE.spans(x.values, starts, ends), R.TWO.spans(x.others, starts, ends)
                order = np.lexsort((k2, k1))
                new = np.flatnonzero(np.concatenate(
                    [[True], (k1[order[1:]] != k1[order[:-1]]) | (k2[order[1:]] != k2[order[:-1]])]))
                times = np.diff(np.concatenate([new, [len(order)]]))
                one, again = order[new], order[np.repeat(times > 1, times)]
                yield run_rows(x.raw, starts[one], ends[one], pa.array(ids[one], mask=times > 1), begins[one],
                               place[first][one] - starts[one], times, (k1[one], k2[one]))
                if len(again):
                    found = R.covered(ids[again], begins[again], (ends - starts)[again])
                    none = pa.nulls(len(found[0]), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [none, none, *map(pa.array, found), none, none, pa.nulls(len(none), pa.binary())], names=HOT_NAMES)

    return live.where(F.size("hot") > 0).mapInArrow(emit, HOT_RUNS)


def run_parts(runs, n, size):
    """The parts of runs (doc_id, piece, a, o) between places that are multiples of ``size`` windows from the stand-in."""

    def emit(batches):
        for batch in batches:
            for a, b in R.blocks(batch):
                pieces = R.texts(batch, a, b)
                lengths = np.array([len(x) for x in pieces], np.int64)
                begin, many = np.cumsum(lengths) - lengths, lengths - n + 1
                own = np.repeat(np.arange(len(pieces)), many)
                w = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
                o = np.asarray(batch.column(3)[a:b])[own] - w
                first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (o[1:] // size != o[:-1] // size)]))
                last, at = np.concatenate([first[1:], [len(own)]]) - 1, begin[own] + w
                raw, starts, ends = np.frombuffer(b"".join(pieces), np.uint8), at[first], at[last] + n
                yield run_rows(raw, starts, ends, batch.column(0)[a:b].take(pa.array(own[first])),
                               np.asarray(batch.column(2)[a:b])[own[first]] + w[first], o[first], np.ones(len(first), np.int64),
                               [x.spans(x.table[raw], starts, ends) for x in (R.ONE, R.TWO)])

    return runs.select("doc_id", "piece", "a", "o").mapInArrow(emit, HOT_RUNS)


def hot_spans(live, n, short):
    """Spans of windows with hot stand-ins that occur twice. Of equal runs only one goes on to the parts, without a document, for others to
    be equal to its parts; so rows grow with the runs and with the windows at the ends of what is repeated."""
    spark = live.sparkSession
    path = new_path(spark, "suffix-hot")
    runs, spans = hot_runs(live, n, short), []
    for size in (*PARTS, None):
        runs.write.parquet(f"{path}/before-{size}")
        found = spark.read.schema(HOT_RUNS).parquet(f"{path}/before-{size}")
        runs = found.where("k1 is not null")
        twice = runs.groupBy(F.col("k1").alias("j1"), F.col("k2").alias("j2")).agg(F.sum("n").alias("n")).where("n > 1").drop("n")
        spans.append(runs.where("doc_id is not null").select("k1", "k2", *SPAN).join(
            twice, (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2"))).select(*SPAN))
        if size == PARTS[0]:
            spans.append(found.where("k1 is null").select(*SPAN))
        if size:
            one = runs.groupBy("k1", "k2").agg(F.sum("n").alias("n"), *(F.max(x).alias(x) for x in ("doc_id", "a", "o", "piece")))
            runs = run_parts(one.withColumn("doc_id", F.when(F.col("n") == 1, F.col("doc_id"))), n, size)
    return functools.reduce(DataFrame.unionByName, spans)


def one_of_each_id(rows):
    """One of the copies of each doc_id. Only where ids repeat are texts shuffled; else it is a count of the ids."""
    again = rows.groupBy(F.col("doc_id").alias("d")).agg(F.count("*").alias("copies")).where("d is not null and copies > 1")
    return rows if again.isEmpty() else rows.where("doc_id is not null").dropDuplicates(["doc_id"])


def repeated(docs, n=BYTES, short=SHORT):
    """(doc_id, a, z): bytes a..z-1 are covered by strings that start elsewhere too."""
    spark = docs.sparkSession
    every = one_of_each_id(R.slim(docs))
    path = new_path(spark, "suffix-shared")
    R.common(R.places_rows(every, "bytes", n, min(short, n)), F.sum("n") > 1, F.col("n")).write.parquet(path)
    found = spark.read.schema("doc_id long, hs array<long>, hot array<long>, n long").parquet(path)
    live = every.join(found.withColumnRenamed("doc_id", "d"), F.col("doc_id") == F.col("d")).drop("d", "n")
    size = found.agg(F.sum("n"), F.sum(F.size("hot"))).first()
    buckets = max(1, -(-(size[0] or 0) // BUCKET))
    spans = window_runs(live, n, min(short, n), buckets).groupBy("bucket").applyInPandas(decide(n), SPANS)
    if size[1]:
        spans = spans.unionByName(hot_spans(live, n, min(short, n)))
    return spans


def dedup(docs, n=BYTES, short=SHORT, texts=True):
    """doc_id, n_bytes, n_removed, kept_sha256, removed spans and (``texts``) the remaining bytes."""
    found = R.spans_of(repeated(docs, n, short))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = rows.join(found, F.col("doc_id") == F.col("d"), "left").select("doc_id", "text", "spans")

    def cut(batches):
        for batch in batches:
            out = []
            for i, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode()
                gone = R.merged((s["a"], s["z"]) for s in spans or ())
                ends = [0, *(z for _, z in gone)]
                left = b"".join(raw[a:z] for a, z in zip(ends, [*(a for a, _ in gone), len(raw)]))
                out.append((i, len(raw), sum(z - a for a, z in gone), hashlib.sha256(left).hexdigest(), gone,
                            left if texts else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), KINDS)] if out else [pa.array([], t) for t in KINDS],
                names=["doc_id", "n_bytes", "n_removed", "kept_sha256", "removed", "kept_bytes"])

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, kept_sha256 string, "
                                  "removed array<array<long>>, kept_bytes binary")


KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary())


def op6_suffix_array_dedup(spark, sf_dir):
    """Bytes left of every document without strings of 200 bytes that occur anywhere else."""
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")
