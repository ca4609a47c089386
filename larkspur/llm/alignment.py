"""Aligning the tokens of two tokenizers, with corpus-wide link counts from an inverted index of bitmaps.

Both tokenizers cut the same bytes (a space and the text). Byte offsets where tokens of both end divide the
tokens into groups; every token of one side is linked with every token of the other in its group.

The index has a row per pair of ids and block of ``BLOCK_DOCS`` documents (``doc_id`` without its lowest bits): a compressed
bitmap of the block's documents that hold the pair linked, and planes: bit p of (links - 1), for each document of
the bitmap. Tasks emit such rows for the documents they have; rows of one pair and block are OR-merged. The documents
of a pair are the sum of its bitmaps' bits, its links the sum over bits and planes. Scoring reads the bitmaps
again: each block adds up, per document, the counts of the pairs that hold it.

Only bitmaps, pairs and ids are shuffled. A block is bounded by its number of documents, so a pair that every
document holds is spread over all blocks; a long text is worked on in stretches of groups.

doc_id should be dense, as a bitmap of ids far apart holds one document; results do not depend on it. Rows of one doc_id
are one document of the counts; if their texts differ, a pair has the larger of the numbers of links, and
each row is given its own tokens and groups with the sums of the document. Rows without doc_id are in no bitmap: they
keep their tokens, and their sums are 0. Null and empty texts, and texts that a tokenizer changes, have no tokens.
Other columns are not read. An empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from larkspur.llm.repeats import blocks, texts
from larkspur.session import new_path

LEFT, RIGHT = "byte_bpe_50k", "piece_bpe_32k"
#: Documents of a block: a bitmap has so many bits at most.
BLOCK_BITS = 12
BLOCK_DOCS = 1 << BLOCK_BITS
#: A bitmap with fewer documents is held as a list of 16-bit numbers.
LIST_LIMIT = BLOCK_DOCS // 16
#: Links expanded at a time, and (pair, document) rows held before bitmaps are written.
EXPAND = 1 << 21
HOLD = 1 << 21
#: Chunks of text that a task remembers, and the longest of them.
REMEMBER, LONG = 1 << 18, 100

PARTS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, block long, "
         "docs binary, planes binary")
POSTINGS = "pair long, block long, docs binary, planes binary"


class Side:
    """A tokenizer with the bytes of each of its ids."""

    def __init__(self, encode, table, encode_all=None):
        self.encode, self.table, self.encode_all = encode, table, encode_all
        self.length = np.array([len(x) for x in table], np.int64)

    def ends(self, ids, raw):
        """Where each token ends, or None where the tokens' bytes are not ``raw``."""
        if b"".join(map(self.table.__getitem__, ids)) != raw:
            return None
        return np.cumsum(self.length[ids])


def byte_level(folder, name):
    import base64

    import public_tokenizers
    import tiktoken

    path = f"{folder}/{name}.tiktoken" if folder else public_tokenizers.path(f"{name}.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        table[i] = piece
    slow = []

    def encode(text):
        """``ordinary`` ids; what the faster library can't take goes to the other one."""
        try:
            return fast.encode_ordinary(text)
        except BaseException as e:  # the library's panics are no Exceptions
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(path.replace(".tiktoken", ".json")))
            slow[0].encode_special_tokens = True
        return slow[0].encode(text, add_special_tokens=False).ids

    opens = np.array([x[:1] == b" " for x in table])

    def encode_all(many):
        """Ids of texts without spaces: joined by spaces, each begins with the next id that opens with one."""
        ids = np.array(encode(" " + " ".join(many)), np.int64) if many else np.zeros(0, np.int64)
        begin = np.flatnonzero(opens[ids]).tolist()
        if len(begin) != len(many):
            return [encode(" " + x) for x in many]
        ids = ids.tolist()
        return [ids[x:y] for x, y in zip(begin, [*begin[1:], len(ids)])]

    return Side(lambda text: encode(" " + text), table, encode_all)


def pieces(folder, name):
    import re

    import public_tokenizers
    import sentencepiece

    path = f"{folder}/{name}.model" if folder else public_tokenizers.path(f"{name}.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def raw(i):
        piece = model.id_to_piece(i)
        if model.is_byte(i) and (m := re.fullmatch("<0x([0-9A-F]{2})>", piece)):
            return bytes([int(m.group(1), 16)])
        return piece.replace("▁", " ").encode()

    return Side(lambda text: model.encode(text, num_threads=1), [raw(i) for i in range(model.get_piece_size())],
                lambda many: model.encode(many, num_threads=1))


def group_marks(a_ends, b_ends):
    """The group of each token on both sides, and the number of groups. A token without bytes, which ends where the one
    before it ends, stays in that token's group."""
    common = np.intersect1d(a_ends, b_ends)
    return np.searchsorted(common, a_ends), np.searchsorted(common, b_ends), len(common)


def group_texts(a, b, a_group, b_group, numbers, last):
    """The groups as pieces of text in order: ids joined by commas, sides by |, groups by ;, and nothing after the groups of
    ``last``."""
    both = np.concatenate([a, b])
    place = np.concatenate([2 * a_group, 2 * b_group + 1])
    order = np.argsort(place, kind="stable")
    place, both = place[order], both[order]
    # After a token: a comma within a side, | after a group's left side, ; after its right side.
    mark = np.zeros(len(place), np.int64)
    mark[:-1] = np.where(place[1:] != place[:-1], 1 + (place[:-1] & 1), 0)
    mark[np.searchsorted(place, 2 * np.asarray(last) + 1, "right") - 1] = 3
    return numbers[mark, both].tolist()


def id_texts(n):
    """Each id as text with each of the four marks that may follow."""
    return np.array([[f"{i}{mark}" for i in range(n)] for mark in (",", "|", ";", "")], object)


def links(a, b, a_group, b_group, n_groups, width):
    """Yields the codes a * width + b of linked tokens, as many as there are links, in stretches of about EXPAND."""
    a_count, b_count = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    b_begin = np.cumsum(b_count) - b_count
    many = b_count[a_group]  # links of each left token
    total = np.cumsum(many)
    at = 0
    while at < len(a):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + EXPAND, "right")))
        n, own = many[at:to], np.repeat(np.arange(at, to), many[at:to])
        inside = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        yield a[own].astype(np.int64) * width + b[b_begin[a_group[own]] + inside]
        at = to


def summed(key, n):
    """Equal keys once, with their numbers added up."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], (np.add.reduceat(n, first) if len(first) else n)


def counted(codes):
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.concatenate([first, [len(codes)]]))


def to_postings(pair, block, doc, n):
    """Index rows from rows (pair, block, document in the block, links), which may hold a document twice for a pair: the
    larger number counts. Sorted by block and pair."""
    order = np.lexsort((doc, pair, block))
    pair, block, doc, n = pair[order], block[order], doc[order], n[order]
    if not len(pair):
        return posting_batch(pair, block, [], [])
    run = np.concatenate([[True], (pair[1:] != pair[:-1]) | (block[1:] != block[:-1])])
    same = np.concatenate([[True], run[1:] | (doc[1:] != doc[:-1])])
    kept = np.flatnonzero(same)
    n, pair, block, doc, run = np.maximum.reduceat(n, kept), pair[kept], block[kept], doc[kept], run[kept]
    first = np.flatnonzero(run)
    size = np.diff(np.concatenate([first, [len(doc)]]))
    own = np.repeat(np.arange(len(first)), size)
    rank = np.arange(len(doc)) - first[own]
    # Bitmaps: lists where there are few documents.
    is_list = size < LIST_LIMIT
    width = np.where(is_list, 2 * size, BLOCK_DOCS // 8)
    begin = np.concatenate([[0], np.cumsum(width)])
    flat = np.zeros(begin[-1], np.uint8)
    few = is_list[own]
    at = begin[own[few]] + 2 * rank[few]
    flat[at], flat[at + 1] = doc[few] & 255, doc[few] >> 8
    bit = begin[own[~few]] * 8 + doc[~few]
    np.bitwise_or.at(flat, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
    # Planes of links - 1, lowest first, each as long as the bitmap has documents.
    more = n - 1
    most = np.maximum.reduceat(more, first)
    deep = np.zeros(len(first), np.int64)
    while (left := most >> deep).any():
        deep += left > 0
    row = -(-size // 8)
    plane_begin = np.concatenate([[0], np.cumsum(row * deep)])
    planes = np.zeros(plane_begin[-1], np.uint8)
    for p in range(int(deep.max())):
        on = np.flatnonzero(more >> p & 1)
        bit = (plane_begin[own[on]] + p * row[own[on]]) * 8 + rank[on]
        np.bitwise_or.at(planes, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
    return posting_batch(pair[first], block[first], (begin, flat), (plane_begin, planes))


def posting_batch(pair, block, docs, planes):
    def column(x):
        if not len(pair):
            return pa.array([], pa.binary())
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(pair), [None, pa.py_buffer(x[0].astype(np.int64)), pa.py_buffer(x[1])]).cast(pa.binary())

    return pa.RecordBatch.from_arrays(
        [pa.array(pair, pa.int64()), pa.array(block, pa.int64()), column(docs), column(planes)],
        names=["pair", "block", "docs", "planes"])


def flat_bytes(column):
    """Offsets and bytes of an Arrow binary array."""
    column = column.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw


def from_postings(batch):
    """(row, document, links) of all documents in the index rows of an Arrow batch."""
    begin, flat = flat_bytes(batch.column(batch.schema.get_field_index("docs")))
    width = np.diff(begin)
    is_list = width < BLOCK_DOCS // 8
    lists, maps = np.flatnonzero(is_list), np.flatnonzero(~is_list)
    list_row = np.repeat(lists, width[lists] // 2)
    inside = np.arange(len(list_row)) - np.repeat(np.cumsum(width[lists] // 2) - width[lists] // 2, width[lists] // 2)
    at = begin[list_row] + 2 * inside
    list_doc = flat[at].astype(np.int64) | flat[at + 1].astype(np.int64) << 8
    bits = np.unpackbits(flat[(begin[maps][:, None] + np.arange(BLOCK_DOCS // 8)).ravel()], bitorder="little")
    on = np.flatnonzero(bits)
    row = np.concatenate([list_row, maps[on >> BLOCK_BITS]])
    doc = np.concatenate([list_doc, on & (BLOCK_DOCS - 1)])
    order = np.argsort(row, kind="stable")
    row, doc = row[order], doc[order]
    size = np.bincount(row, minlength=len(width))
    rank = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    plane_begin, planes = flat_bytes(batch.column(batch.schema.get_field_index("planes")))
    length = np.maximum(-(-size // 8), 1)
    deep = np.diff(plane_begin) // length
    n = np.ones(len(row), np.int64)
    for p in range(int(deep.max()) if len(deep) else 0):
        on = np.flatnonzero(deep[row] > p)
        bit = (plane_begin[row[on]] + p * length[row[on]]) * 8 + rank[on]
        n[on] += (planes[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(np.int64) << p
    return row, doc, n


def aligned(a_side, b_side, numbers, text):
    """Numbers of left and right ids and groups, the groups as text and the codes of linked ids, as stretches; None where a
    tokenizer changes the text."""
    raw = b" " + text.encode()
    a, b = a_side.encode(text), b_side.encode(text)
    a_ends, b_ends = a_side.ends(a, raw), b_side.ends(b, raw)
    if a_ends is None or b_ends is None:
        return None
    a, b = np.array(a), np.array(b)
    a_group, b_group, n_groups = group_marks(a_ends, b_ends)
    texts_of = "".join(group_texts(a, b, a_group, b_group, numbers, [n_groups - 1]))
    return len(a), len(b), n_groups, texts_of, links(a, b, a_group, b_group, n_groups, len(b_side.table))


class Chunks:
    """What is between lone spaces, aligned once and remembered.

    Neither tokenizer has an id that holds a space after another character, but for ids of white space alone (else nothing is
    remembered). So a space that has no other white space beside it begins an id on both sides, and the text between two such spaces is tokenized the same anywhere.
    """

    def __init__(self, a_side, b_side, numbers):
        self.a_side, self.b_side, self.numbers = a_side, b_side, numbers
        inner = [x for side in (a_side, b_side) for x in side.table
                 if b" " in x.lstrip(b" ") and not x.decode("utf-8", "replace").isspace()]
        self.usable = not inner
        self.forget()

    def forget(self):
        self.at, self.texts = {}, []
        self.counts = np.zeros((0, 4), np.int64)  # left and right ids, groups, 1 where the chunk can be used
        self.codes, self.begin = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def learn(self, found):
        new = [c for c in found if c not in self.at]
        if not new:
            return
        self.at.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
        raw = [b" " + c.encode() for c in new]
        plain = [k for k, c in enumerate(new) if c and c == c.strip()]
        a_ids, b_ids = [[]] * len(new), [[]] * len(new)
        for ids, side in ((a_ids, self.a_side), (b_ids, self.b_side)):
            for k, x in zip(plain, side.encode_all([new[k] for k in plain])):
                ids[k] = x
        a_get, b_get = self.a_side.table.__getitem__, self.b_side.table.__getitem__
        good = np.array([bool(a) and b"".join(map(a_get, a)) == x == b"".join(map(b_get, b)) for a, b, x in zip(a_ids, b_ids, raw)])
        used = np.flatnonzero(good).tolist()
        n_a, n_b = (np.array([len(ids[k]) for k in used], np.int64) for ids in (a_ids, b_ids))
        counts, texts_of = np.zeros((len(new), 4), np.int64), [""] * len(new)
        n_codes = np.zeros(len(new), np.int64)
        if used:
            a, b = (np.fromiter((i for k in used for i in ids[k]), np.int64) for ids in (a_ids, b_ids))
            a_ends, b_ends = np.cumsum(self.a_side.length[a]), np.cumsum(self.b_side.length[b])
            a_group, b_group, n_groups = group_marks(a_ends, b_ends)
            last = a_group[np.cumsum(n_a) - 1]
            pieces_of = group_texts(a, b, a_group, b_group, self.numbers, last)
            z = np.cumsum(n_a + n_b)
            for k, x, y in zip(used, (z - n_a - n_b).tolist(), z.tolist()):
                texts_of[k] = "".join(pieces_of[x:y])
            many = np.bincount(b_group, minlength=n_groups)[a_group]
            upto = np.concatenate([[0], np.cumsum(many)])[np.cumsum(n_a)]
            n_codes[used] = np.diff(upto, prepend=0)
            counts[used] = np.stack([n_a, n_b, np.diff(last, prepend=-1), np.ones(len(used), np.int64)], 1)
            self.codes = np.concatenate([self.codes, *links(a, b, a_group, b_group, n_groups, len(self.b_side.table))])
        self.texts += texts_of
        self.counts = np.concatenate([self.counts, counts])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(n_codes)])

    def prepare(self, texts_of):
        """Learn what the texts need; a text with a chunk longer than LONG is left to ``aligned``."""
        if len(self.texts) > REMEMBER:
            self.forget()
        if self.usable:
            self.learn({c for t in texts_of for c in t.split(" ") if len(c) <= LONG})

    def aligned(self, text):
        """As the function ``aligned``, or None where the text can't be put together from chunks."""
        own = [self.at.get(c, -1) for c in text.split(" ")] if self.usable else [-1]
        own = np.array(own)
        if own.min() < 0 or not self.counts[own, 3].all():
            return None
        n_a, n_b, n_groups, _ = self.counts[own].sum(axis=0).tolist()
        n = self.begin[own + 1] - self.begin[own]
        at = np.repeat(self.begin[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return n_a, n_b, n_groups, ";".join(map(self.texts.__getitem__, own.tolist())), [self.codes[at]]


def parts(docs, folder=None, left=LEFT, right=RIGHT):
    """Per document its tokens, groups and links, and the index rows of the documents that a task has seen."""

    def run(batches):
        a_side, b_side = byte_level(folder, left), pieces(folder, right)
        numbers = id_texts(max(len(a_side.table), len(b_side.table)))
        chunks = Chunks(a_side, b_side, numbers)
        held, rows = [], 0

        def empty_columns(n, names):
            return [pa.nulls(n, t) for t in names]

        def flush():
            made = to_postings(*(np.concatenate(c) for c in zip(*held)))
            none = empty_columns(len(made), [pa.int64()] * 5 + [pa.string()])
            for at in range(0, max(len(made), 1), 1 << 17):
                part = made.slice(at, 1 << 17)
                yield pa.RecordBatch.from_arrays([*(c.slice(at, 1 << 17) for c in none), *part.columns], names=NAMES)

        for batch in batches:
            for begin, end in blocks(batch):
                done, given = [], [x.decode() for x in texts(batch, begin, end)]
                chunks.prepare(given)
                for i, text in zip(batch.column(0)[begin:end].to_pylist(), given):
                    found = (chunks.aligned(text) or aligned(a_side, b_side, numbers, text)) if text else None
                    if found is None:
                        done.append((i, 0, 0, 0, 0, ""))
                        continue
                    n_a, n_b, n_groups, groups, stretches = found
                    code = n = None
                    for stretch in stretches:
                        new = counted(stretch)
                        code, n = new if code is None else summed(np.concatenate([code, new[0]]), np.concatenate([n, new[1]]))
                    done.append((i, n_a, n_b, n_groups, int(n.sum()), hashlib.sha256(groups.encode()).hexdigest()))
                    if i is None:
                        continue
                    held.append((code, np.full(len(code), i >> BLOCK_BITS), np.full(len(code), i & (BLOCK_DOCS - 1)), n))
                    rows += len(code)
                    if rows >= HOLD:
                        yield from flush()
                        held, rows = [], 0
                columns = [pa.array(c, t) for c, t in zip(zip(*done), [pa.int64()] * 5 + [pa.string()])]
                if done:
                    yield pa.RecordBatch.from_arrays(
                        columns + empty_columns(len(done), [pa.int64(), pa.int64(), pa.binary(), pa.binary()]), names=NAMES)
        if held:
            yield from flush()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, PARTS)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "block", "docs", "planes"]


def merged(postings):
    """The index: rows of one pair and block OR-merged, with the documents and links of each."""

    def merge(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rest = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks().to_batches()[0]
            pair, block = np.asarray(rest.column(0)), np.asarray(rest.column(1))
            # The last pair and block may go on in the next batch.
            open_from = len(pair) - int(np.argmax(((pair != pair[-1]) | (block != block[-1]))[::-1])) if (
                (pair != pair[-1]) | (block != block[-1])).any() else 0
            if open_from:
                yield whole(rest.slice(0, open_from))
                rest = rest.slice(open_from)
            elif rest.num_rows > 1:
                rest = whole(rest).select(["pair", "block", "docs", "planes"])
        if rest is not None:
            yield whole(rest)

    def whole(batch):
        pair, block = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        row, doc, n = from_postings(batch)
        out = to_postings(pair[row], block[row], doc, n)
        new_row, _, links_of = from_postings(out)
        return pa.RecordBatch.from_arrays(
            [*out.columns, pa.array(np.bincount(new_row, minlength=len(out))),
             pa.array(np.bincount(new_row, links_of, len(out)).astype(np.int64))],
            names=[*out.schema.names, "n_docs", "n_links"])

    return postings.repartition("block", "pair").sortWithinPartitions("block", "pair").mapInArrow(
        merge, POSTINGS + ", n_docs long, n_links long")


def pair_counts(index, width):
    """Per pair its documents, links, and whether no pair of its left id has more documents."""
    counts = index.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / width))
    best = counts.groupBy(F.col("a").alias("best_a")).agg(F.max("n_docs").alias("most"))
    return counts.join(best, F.col("a") == F.col("best_a")).select(
        "pair", "a", (F.col("pair") % width).alias("b"), "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("is_best"))


def document_sums(index, counts):
    """(id, n_best, count_sum) per document of the index, each block's documents added up in one task."""

    def add(batches):
        block, sums = None, None
        for batch in batches:
            row, doc, n = from_postings(batch)
            of = np.asarray(batch.column(0))
            per = np.asarray(batch.column(3))[row] * n, n * np.asarray(batch.column(4).cast(pa.int8()))[row]
            edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
            for k, at in enumerate(edges):
                end = edges[k + 1] if k + 1 < len(edges) else len(of)
                if of[at] != block:
                    if block is not None:
                        yield given(block, sums)
                    block, sums = of[at], np.zeros((3, BLOCK_DOCS), np.int64)
                a, z = np.searchsorted(row, [at, end])
                for s, x in zip(sums, (*per, None)):
                    np.add.at(s, doc[a:z], x[a:z] if x is not None else 1)
        if block is not None:
            yield given(block, sums)

    def given(block, sums):
        on = np.flatnonzero(sums[2])
        return pa.RecordBatch.from_arrays(
            [pa.array((int(block) << BLOCK_BITS) + on), pa.array(sums[1][on]), pa.array(sums[0][on])],
            names=["id", "n_best", "count_sum"])

    scored = index.join(counts.select(F.col("pair").alias("p"), F.col("n_docs").alias("count"), "is_best"),
                        F.col("pair") == F.col("p"))
    return scored.select("block", "docs", "planes", "count", "is_best").repartition("block").sortWithinPartitions(
        "block").mapInArrow(add, "id long, n_best long, count_sum long")


def align(docs, folder=None, left=LEFT, right=RIGHT):
    """The rows of the documents, the index and the pairs' counts, all written below the shared folder."""
    import public_tokenizers
    import sentencepiece

    spark = docs.sparkSession
    path = new_path(spark, "alignment")
    parts(docs, folder, left, right).write.option("compression", "zstd").parquet(f"{path}/parts")
    made = spark.read.schema(PARTS).parquet(f"{path}/parts")
    merged(made.where("pair is not null").select("pair", "block", "docs", "planes")).write.option(
        "compression", "zstd").parquet(f"{path}/index")
    index = spark.read.schema(POSTINGS + ", n_docs long, n_links long").parquet(f"{path}/index")
    model = f"{folder}/{right}.model" if folder else public_tokenizers.path(f"{right}.model")
    width = sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size()
    counts = pair_counts(index, width)
    counts.write.parquet(f"{path}/counts")
    counts = spark.read.schema(counts.schema).parquet(f"{path}/counts")
    rows = made.where("pair is null").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    sums = document_sums(index, counts)
    zero = F.lit(0).cast("long")
    rows = rows.join(sums, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.when(F.col("n_a") > 0, F.coalesce("n_best", zero)).otherwise(zero).alias(
            "n_best"), F.when(F.col("n_a") > 0, F.coalesce("count_sum", zero)).otherwise(zero).alias("count_sum"), "groups_sha256")
    return rows, index, counts


def op13_tokenizer_alignment(spark, sf_dir):
    """Every document's aligned tokens, with the corpus-wide counts of its linked pairs."""
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
