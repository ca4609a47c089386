"""Removing words that repeat a passage of an earlier document, by level-wise doubling.

A passage is ``n`` consecutive words of one document. A word is removed if a passage that covers it also
starts in a document with a smaller doc_id; passages are judged on the input. Windows of a short length
come first: only those found in several documents go on, at twice the length, until the length asked
for is reached or none is left. Only hashes are shuffled (128 bits decide), and of the windows of the
longest length only those that every shorter level has left.

Words are runs of characters other than space and \\t \\n \\v \\f \\r. Null text has no words. doc_id is
the key: repeated rows of one id must be copies, and are no repeats of each other; rows with a null id are
returned as they are. Other columns are not read. An empty table gives no rows.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from larkspur.llm import repeats as R
from larkspur.session import new_path

WORDS = 13
#: The shortest windows looked at have at least so many words.
SHORTEST = 6
BUCKET = 100_000
SPANS = "doc_id long, a long, z long"


def levels(n, shortest=SHORTEST):
    """The lengths gone through before ``n``: each at most twice the one before."""
    out = []
    while n // 2 >= shortest:
        n //= 2
        out.append(n)
    return out[::-1] or [min(n, shortest)]


def repeated(docs, n=WORDS, shortest=SHORTEST):
    """(doc_id, a, z): words a..z-1 are covered by windows that start in an earlier document too."""
    spark = docs.sparkSession
    every = R.slim(docs)
    live = every
    for k, short in enumerate(steps := levels(n, shortest)):
        rows = R.level_rows(live, "words", n, short) if not k else later_rows(live, n, steps[k - 1], short)
        path = new_path(spark, f"substring-{short}")
        R.common(rows, F.min("doc_id") < F.max("doc_id")).write.parquet(path)
        found = spark.read.schema("doc_id long, hs array<long>, hot array<long>").parquet(path)
        live = every.join(found.withColumnRenamed("doc_id", "d"), F.col("doc_id") == F.col("d")).drop("d")
    size = found.agg(F.sum(F.size("hs")), F.sum(F.size("hot"))).first()
    buckets = max(1, -(-(size[0] or 0) // BUCKET))
    runs = window_runs(live, n, steps[-1], buckets).groupBy("bucket").applyInPandas(earlier(n), SPANS)
    if size[1]:
        hot = R.hot_rows(live, "words", n, steps[-1])
        first = hot.groupBy(F.col("k1").alias("j1"), F.col("k2").alias("j2")).agg(F.min("doc_id").alias("first"))
        again = hot.join(first, (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2"))).where(
            "doc_id > first")
        runs = runs.unionByName(again.select("doc_id", "a", (F.col("a") + n).alias("z")))
    return runs


def later_rows(live, n, last, short):
    """Stand-ins of the next length for windows whose stand-in of the last length was shared."""

    def emit(batches):
        for batch in batches:
            for a, b in R.blocks(batch):
                x = R.Block(R.texts(batch, a, b), "words")
                ok = x.whole(n) & np.isin(x.stand_ins(n, last), np.asarray(batch.column(2)[a:b].flatten()).view(np.uint64))
                h, doc = x.stand_ins(n, short)[ok], x.doc[:len(ok)][ok]
                if len(h):
                    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
                    ids = np.asarray(batch.column(0)[a:b])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[new].view(np.int64)), pa.array(ids[doc[new]])], names=["h", "doc_id"])

    return live.mapInArrow(emit, "h long, doc_id long")


def window_runs(live, n, short, buckets):
    """Runs of windows with one shared stand-in: the stand-in, the document, the first word, and the
    windows' own hashes."""

    def emit(batches):
        for batch in batches:
            for a, b in R.blocks(batch):
                x, at, h, doc, new = R.live_windows(batch, a, b, "words", n, short, False, True)
                if not len(at):
                    continue
                ids, keys = np.asarray(batch.column(0)[a:b]), R.TWO.windows(x.others, n)[at]
                first = np.flatnonzero(new)
                cuts = np.concatenate([first, [len(at)]]) * 8
                blob = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(first), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(keys.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((h[first] % np.uint64(buckets)).astype(np.int32)), pa.array(h[first].view(np.int64)),
                     pa.array(ids[doc[first]]), pa.array((at[first] - x.first[doc[first]]).astype(np.int64)),
                     blob.cast(pa.binary())], names=["bucket", "h", "doc_id", "a", "keys"])

    return live.mapInArrow(emit, "bucket int, h long, doc_id long, a long, keys binary")


def earlier(n):
    def decide(rows):
        many = rows["keys"].map(len).to_numpy() // 8
        keys = np.frombuffer(b"".join(rows["keys"]), np.uint64)
        own = np.repeat(np.arange(len(rows)), many)
        inside = np.arange(len(keys)) - np.repeat(np.cumsum(many) - many, many)
        h, doc = rows["h"].to_numpy()[own], rows["doc_id"].to_numpy()[own]
        start = rows["a"].to_numpy()[own] + inside
        order = np.lexsort((doc, keys, h))
        h, keys, doc, start = h[order], keys[order], doc[order], start[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (h[1:] != h[:-1])])
        first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        again = doc > first
        ids, a, z = R.covered(doc[again], start[again], n)
        return pd.DataFrame({"doc_id": ids, "a": a, "z": z})

    return decide


def dedup(docs, n=WORDS, shortest=SHORTEST, texts=True):
    """doc_id, n_words, n_removed, kept_sha256, spans of removed words and (``texts``) the kept text."""
    found = R.spans_of(repeated(docs, n, shortest))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = rows.join(found, F.col("doc_id") == F.col("d"), "left").select("doc_id", "text", "spans")

    def cut(batches):
        for batch in batches:
            out = []
            for i, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or "").encode().split()
                gone = R.merged((s["a"], s["z"]) for s in spans or ())
                kept, at = [], 0
                for a, z in gone:
                    kept += words[at:a]
                    at = z
                left = b" ".join(kept + words[at:])
                out.append((i, len(words), sum(z - a for a, z in gone), hashlib.sha256(left).hexdigest(), gone,
                            left.decode() if texts else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), KINDS)], names=list(NAMES)) if out else empty()

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, "
                                  "removed array<array<long>>, kept_text string")


NAMES = ("doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept_text")
KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.string())


def empty():
    return pa.RecordBatch.from_arrays([pa.array([], t) for t in KINDS], names=list(NAMES))


def op2_substring_dedup(spark, sf_dir):
    """Words left of every document when passages of 13 words stay only where they come first."""
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("removed").alias("n_spans"))
