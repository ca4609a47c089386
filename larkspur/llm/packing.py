"""Best-fit packing of tokenized documents into sequences of bounded size.

Each sequence has three capacities: tokens, documents and attention cost (the sum of squared piece
lengths). Pieces are placed largest first. The best bin for a piece is, of those that it fits under every
capacity, the one whose residuals, as shares of the capacities, score best: the largest weighted dot
product with the piece's demand, or the smallest weighted norm of what would remain (the default).

Tokenizing and packing run in tasks. Only lengths and checksums are shuffled, dealt by a hash of document
and piece into groups of about ``group_pieces``, each packed for itself: a group costs at most about one
half-filled sequence more. Groups grow in number with the data, never in size.

Null text is an empty document: only the end token. Rows repeated in the input are packed repeatedly.
Other columns are not read. An empty table gives no rows.
"""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from larkspur.session import new_path

TOKENIZER = "byte_bpe_50k"
CAPACITY = 1024
END_TOKEN = 2
GROUP_PIECES = 10_000
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encoder(folder=None, name=TOKENIZER):
    """A function from text to ids, equal to those of the `tokenizers` file ``name``.json.

    The same vocabulary as ranks is several times faster; a text it can't take goes to the other library.
    """
    import base64

    import public_tokenizers
    import tiktoken

    path = (lambda x: f"{folder}/{x}") if folder else public_tokenizers.path
    with open(path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = []

    def other(text):
        from tokenizers import Tokenizer

        if not slow:
            slow.append(Tokenizer.from_file(path(f"{name}.json")))
        return slow[0].encode(text, add_special_tokens=False).ids

    def ids(text):
        if SPECIAL in text:
            return other(text)
        try:
            return fast.encode_ordinary(text)
        except BaseException as e:  # the library's panics are no Exceptions
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return other(text)

    return ids


def cut(n, capacity):
    """Start and length of each piece of ``n`` tokens: only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pieces(docs, text="text", capacity=CAPACITY, folder=None, name=TOKENIZER, end_token=END_TOKEN):
    """One row per piece: doc_id, piece, start, length and the CRC-32 of its ids (little-endian, 32 bits)."""

    def tokenize(batches):
        ids = encoder(folder, name)
        for batch in batches:
            rows = []
            for doc, t in zip(batch["doc_id"], batch["t"]):
                x = np.array([*ids(t), end_token], dtype="<u4")
                rows += [(doc, i, a, n, zlib.crc32(x[a:a + n].tobytes())) for i, (a, n) in
                         enumerate(cut(len(x), capacity))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                {"doc_id": "Int64", "piece": "int32"})

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return slim.mapInPandas(tokenize, PIECES)


def place(lengths, tokens, documents, attention, weights=(1.0, 0.05, 0.2), score="norm"):
    """Bin and offset of each piece. Bins of equal residuals are alike, so they are kept by residual:
    there are at most ``tokens`` times ``documents`` kinds, and a piece looks at kinds instead of bins."""
    order = np.argsort(-np.asarray(lengths), kind="stable")
    bin_of, offset_of = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    caps, w = np.array([tokens, documents, attention], float), np.asarray(weights)
    kinds = {}  # residual tokens, documents, attention -> the open bins that have them
    left = np.zeros((0, 3))
    names, stale, bins = [], True, 0
    for i in order:
        n = int(lengths[i])
        need = np.array([n, 1, n * n], float)
        if (need > caps).any():
            raise ValueError(f"a piece of {n} tokens exceeds a capacity")
        if stale:
            names = [k for k, v in kinds.items() if v]
            kinds = {k: kinds[k] for k in names}
            left, stale = np.array(names, float).reshape(-1, 3), False
        best = None
        if len(left):
            fits = (left >= need).all(axis=1)
            if fits.any():
                demand = need / caps
                if score == "dot":
                    value = (left / caps * demand * w).sum(axis=1)
                else:
                    value = -(w * (left / caps - demand) ** 2).sum(axis=1)
                best = names[int(np.where(fits, value, -np.inf).argmax())]
        if best is None:
            here, rest = bins, (tokens, documents, attention)
            bins += 1
        else:
            here, rest = kinds[best].pop(), best
            stale = not kinds[best]
        bin_of[i], offset_of[i] = here, tokens - rest[0]
        rest = (rest[0] - n, rest[1] - 1, rest[2] - n * n)
        if rest[0] > 0 and rest[1] > 0:
            if rest not in kinds or not kinds[rest]:
                stale = True
            kinds.setdefault(rest, []).append(here)
    return bin_of, offset_of


def pack(cut_pieces, capacity=CAPACITY, documents=None, attention=None, weights=(1.0, 0.05, 0.2), score="norm",
         group_pieces=GROUP_PIECES):
    """``cut_pieces`` with sequence_id and offset. By default a sequence may hold as many documents as it
    has tokens, and the attention cost of one full piece."""
    documents, attention = documents or capacity, attention or capacity * capacity
    path = new_path(cut_pieces.sparkSession, "pieces")
    cut_pieces.write.parquet(path)
    spark = cut_pieces.sparkSession
    written = spark.read.schema(PIECES).parquet(path)
    groups = max(1, -(-written.where(F.col("length") < capacity).count() // group_pieces))
    key = F.struct("doc_id", "piece", "start", "length", "ids_crc32")

    def fill(rows):
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = place(rows["length"].to_numpy(), capacity, documents, attention, weights, score)
        return rows.assign(sequence_id=rows["g"].astype("int64") * (1 << 40) + bins, offset=offsets).drop(columns="g")

    short = written.where(F.col("length") < capacity)
    packed = short.withColumn("g", F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")).groupBy("g").applyInPandas(
        fill, PIECES + ", sequence_id long, offset long")
    full = written.where(F.col("length") >= capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def op3_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 1024 tokens."""
    return pack(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")))
