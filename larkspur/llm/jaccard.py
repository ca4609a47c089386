"""Jaccard similarity join of documents on word shingles through a token-group matrix.

A document's set holds its distinct 5-word shingles (A-Z lower-cased; a shorter document is one shingle). Two
documents link when their sets' Jaccard similarity is at least ``PERCENT`` / 100; ``classes`` gives every document the
smallest doc_id it reaches by links.

Equal sets are collapsed first. The tokens of a set are ordered rarest first, by a count sketch of fixed size
over all documents; two sets that link share k tokens among their first n - ceil(t n) + k (their heads; k grows
with n, and the smaller one holds). Similar
documents are partitioned into groups: each document is held against the document that most of its head tokens
name as their leader, and those that link form groups. The token-group matrix holds the union of the head
tokens of each group. A document opens a larger group only if as many of its head tokens stand in
the group's union as must where they link, and the sizes in it can match; it is then compared with the
group's members, chunk by chunk, until one links. So a large group of near copies is linked through leaders
and matrix rows, not through all its pairs. Tokens of very many groups, as of near copies that don't link, open no groups one
by one: families of such tokens are opened, and the documents of a family meet chunk by chunk.

A comparison first looks at parities: a set's tokens are dealt over about as many bits, each the parity of its tokens'
number. Two sets' parities differ in no more bits than tokens stand in one set only, so too many bits prove that
the sets don't link. Only documents that pass in a chunk send their sets there, for the exact comparison.

Shingles are compared as 64-bit hashes. Null texts and texts without words are empty and link with nothing. doc_id
is the key: repeated rows of one id must be copies; rows with a null id are returned without a class.
Other columns are not read. An empty table gives no rows.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from larkspur.llm import repeats as R
from larkspur.session import new_path

SHINGLE = 5
PERCENT = 80
#: Counters of the sketch that orders tokens by frequency.
SKETCH = 1 << 20
CHUNK = 1 << 15
#: Bytes of text worked on at a time: what is worked out of them stays in a processor's cache.
BLOCK = 1 << 18
#: A head has one token more for each ``EXTRA`` shingles than must be looked at, so that more than one has to be
#: shared; bits of the filter of documents whose sets are compared.
EXTRA, FILTER = 20, 1 << 23
#: Rounds in which each document opens one group, before all are opened that have to be.
ROUNDS = 2
#: Groups that a token may open one by one; the tokens of a family stand in as many documents as ``SPREAD`` times those of each, at most.
APART, SPREAD = 16, 4
#: Members and askers of a chunk, and the shingles that either may hold where sets are long.
MEMBERS, ASKERS, ROOM = 128, 512, 1 << 20
#: Sizes are put in classes by powers of this; sets that can link are at most one class apart.
STEP = 100 / PERCENT + 0.01


def ranges(doc):
    """Where each run of equal numbers begins and ends."""
    ends = np.concatenate([np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])), [len(doc)]]) if len(doc) else [0]
    return zip(ends, ends[1:])


def shingle_sets(batch, a, b, shingle=SHINGLE):
    """Documents and hashes of the distinct shingles of rows a..b, by document."""
    x = R.Block([t.lower() for t in R.texts(batch, a, b)], "words")
    h, ok = R.ONE.windows(x.values, shingle), x.whole(shingle)
    h, doc = h[ok], x.doc[:len(ok)][ok]
    few = np.flatnonzero((x.count > 0) & (x.count < shingle))
    if len(few):
        # A short document is one shingle of all its words; its length keeps it from longer ones.
        whole = R.ONE.spans(x.values, x.first[few], x.first[few] + x.count[few])
        h, doc = np.concatenate([h, whole]), np.concatenate([doc, few])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    # Each document's by itself, which takes a fraction of the time of ordering all by two keys.
    for i, j in ranges(doc):
        h[i:j].sort()
    one = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, bool)
    return doc[one], h[one]


def ids_of(batch, a, b):
    return np.asarray(batch.column(0)[a:b])


def known(docs):
    return R.slim(docs).where("doc_id is not null and text is not null")


def set_keys(docs, counters=SKETCH):
    """One pass over the texts: rows of doc_id, n and 128 bits that stand for the set, and rows (part, many) of a task's
    counts of its documents' tokens, by hash modulo ``counters``."""

    def emit(batches):
        total = np.zeros(counters, np.int64)
        for batch in batches:
            for a, b in R.blocks(batch, BLOCK):
                doc, h = shingle_sets(batch, a, b)
                if len(h):
                    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                    n = np.diff(np.concatenate([first, [len(h)]]))
                    k1 = np.add.reduceat(R.mixed(h ^ np.uint64(0x1234567)), first)
                    k2 = np.add.reduceat(R.mixed(h + np.uint64(0x7654321)), first)
                    yield row([pa.array(ids_of(batch, a, b)[doc[first]]), pa.array(n.astype(np.int64)), pa.array(k1.view(np.int64)),
                               pa.array(k2.view(np.int64)), *(pa.nulls(len(n), t) for t in kinds[4:])])
                    np.add.at(total, (h % np.uint64(counters)).astype(np.int64), 1)
        for part, many in parts_of(total):
            yield row([*(pa.nulls(1, t) for t in kinds[:4]), pa.array([part], pa.int32()), pa.array([many])])

    def row(columns):
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "k1", "k2", "part", "many"])

    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
    return known(docs).mapInArrow(emit, "doc_id long, n long, k1 long, k2 long, part int, many binary")


def part_size(counters, flags=False):
    return min(CHUNK * (64 if flags else 1), counters)


def packed(x, flags=False):
    return zlib.compress(np.packbits(x > 0).tobytes() if flags else x.astype("<i8").tobytes(), 1)


def unpacked(raw, flags=False):
    raw = zlib.decompress(raw)
    return np.unpackbits(np.frombuffer(raw, np.uint8)) if flags else np.frombuffer(raw, "<i8")


def parts_of(total, flags=False):
    """(part, many): the parts of counts or bits that hold any."""
    size = part_size(len(total), flags)
    for k in range(0, len(total), size):
        if total[k:k + size].any():
            yield k // size, packed(total[k:k + size], flags)


def gathered(rows, counters, flags=False):
    """The counts or bits of all rows (part, many). What is shuffled and gathered are that many of each task, whatever the data's size."""
    part = part_size(counters, flags)

    def add(key, table):
        total = np.zeros(part, np.int64)
        for many in table.column("many").to_pylist():
            total += unpacked(many, flags)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "many": [packed(total, flags)]})

    total = np.zeros(counters, bool if flags else np.int64)
    # At most ``counters`` counts or bits, in one job: an iterator would run a job for each partition.
    for r in rows.groupBy("part").applyInArrow(add, "part int, many binary").collect():
        total[r["part"] * part:][:part] = unpacked(r["many"], flags)
    return total


def tally(df, positions, counters, flags=False):
    """How often each number below ``counters`` is among the ``positions`` of the rows of ``df``, or whether it is
    (``flags``)."""

    def count(batches):
        total = np.zeros(counters, bool if flags else np.int64)
        for batch in batches:
            for a, b in R.blocks(batch, BLOCK):
                at = positions(batch, a, b).astype(np.int64)
                if flags:
                    total[at] = True
                else:
                    np.add.at(total, at, 1)
        for part, many in parts_of(total, flags):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([many])], names=["part", "many"])

    return gathered(df.mapInArrow(count, "part int, many binary"), counters, flags)


def sketch(rows, counters=SKETCH):
    """How far above the mean tokens occur over all documents, by hash modulo ``counters``, as bytes on a
    logarithmic scale, from the counts (part, many) of ``set_keys``."""
    total = gathered(rows, counters)
    above = np.maximum(total - total.mean(), 0) / (2 * np.sqrt(total.mean()) + 2)
    return np.minimum(8 * np.log2(1 + above), 255).astype(np.uint8)


def filter_of(ids, bits=FILTER):
    """A filter of fixed size, as packed bits, that lets pass all ``ids`` (column doc_id) and few others."""
    def places(batch, a, b):
        h = R.mixed(ids_of(batch, a, b).astype(np.int64).view(np.uint64))
        return np.concatenate([h % np.uint64(bits), (h >> np.uint64(32)) % np.uint64(bits)])

    # ``blocks`` measures the second column.
    return np.packbits(tally(ids.select("doc_id", F.lit("").alias("text")), places, bits, flags=True))


def passing(seen, ids):
    h, bits = R.mixed(ids.astype(np.int64).view(np.uint64)), np.uint64(8 * len(seen))

    def holds(at):
        return (seen[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1

    return holds(h % bits) & holds((h >> np.uint64(32)) % bits)


def least_shared(n):
    """Head tokens that a document of ``n`` shingles shares with every other that it links with, at least, as a column:
    the smallest such number of the two."""
    return 1 + F.floor(F.ceil(n * PERCENT / 100) / EXTRA)


def heads(docs, levels):
    """(doc_id, n, hs): the first tokens, rarest first, of every document."""
    held = docs.sparkSession.sparkContext.broadcast(levels)

    def emit(batches):
        for batch in batches:
            for a, b in R.blocks(batch, BLOCK):
                doc, h = shingle_sets(batch, a, b)
                if not len(h):
                    continue
                rare = held.value[(h % np.uint64(len(held.value))).astype(np.int64)]
                # Each document's tokens are in order of their hashes; short numbers are ordered by counting.
                order = np.lexsort((rare, doc.astype(np.uint16) if doc[-1] < 1 << 16 else doc))
                h = h[order]
                first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                n = np.diff(np.concatenate([first, [len(h)]]))
                size = n - (PERCENT * n + 99) // 100 + 1 + n // EXTRA
                use = np.arange(len(h)) - np.repeat(first, n) < np.repeat(size, n)
                ends = np.concatenate([[0], np.cumsum(np.minimum(size, n))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids_of(batch, a, b)[doc[first]]), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h[use].view(np.int64)))], names=["doc_id", "n", "hs"])

    return known(docs).mapInArrow(emit, "doc_id long, n long, hs array<long>")


def written(df, name):
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parities(h):
    """Bits, as bytes, of which each is the parity of the number of tokens that fall on it: as many as there are
    tokens, rounded up to a power of two."""
    bits = max(64, 1 << (len(h) - 1).bit_length())
    at = (R.mixed(h) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").tobytes()


def folded(bits, size):
    """Parities over ``size`` bytes: a token's place is a number modulo the bits, so parts add up."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, size), axis=0)


def most_apart(a, b):
    """Tokens that may stand in one only of two sets of ``a`` and ``b`` tokens that link."""
    return a + b - 2 * -(-PERCENT * (a + b) // (100 + PERCENT))


def may_link(table):
    """The rows of a chunk, members (``own``) and askers, that some row of the other side can link with as far as
    their parities show; rows of one group (``c``) need no link."""
    own = np.asarray(table.column("own").combine_chunks()).astype(bool)
    n, c, sig = np.asarray(table.column("n")), np.asarray(table.column("c")), table.column("sig").to_pylist()
    size = min(map(len, sig))
    words = np.stack([folded(x, size) for x in sig]).view("<u8")
    members, good = np.flatnonzero(own), np.zeros(len(own), bool)
    for q in np.flatnonzero(~own):
        apart = np.bitwise_count(words[members] ^ words[q]).sum(axis=1, dtype=np.int64)
        hit = members[(apart <= most_apart(n[members], n[q])) & (c[members] != c[q])]
        if len(hit):
            good[q] = good[hit] = True
    return table.filter(pa.array(good)).select(["key", "class", "chunk", "part", "own", "d", "c"])


def exact(table):
    """Links of a chunk's askers with its members by their sets: one at most of each who asks with a group."""
    rows = list(zip(table.column("own").to_pylist(), table.column("d").to_pylist(), table.column("c").to_pylist(),
                    (np.frombuffer(x.as_buffer(), "<u8") for x in table.column("s"))))
    members, xs, ys = [row[1:] for row in rows if row[0]], [], []
    for q, own, a in (row[1:] for row in rows if not row[0]):
        done = {own}
        for m, c, b in members:
            if c in done or 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
                continue
            both = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * both >= PERCENT * (len(a) + len(b) - both):
                xs.append(q), ys.append(m), done.add(c)
    return pa.table({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64())})


def meet(asks, members, sets, groups=None):
    """Links (x, y) between the documents that ask a key (q, key) and its members (m, key).

    The members of a key are parted by size class and then by hash into chunks, those who ask likewise, and each
    chunk meets each part. Parities go first; a set is sent only to the chunks in which it may link. With
    ``groups`` (v, c) one link for each who asks, chunk and group is enough, and none inside a group.
    """
    klass = F.floor(F.log("n") / F.lit(float(np.log(STEP)))).cast("int")
    lengths = sets.select("doc_id", "n")

    def sided(df, name, more):
        return df.join(lengths.withColumnRenamed("doc_id", name), name).withColumn("class", more)

    def pieces(count, most):
        per = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(ROOM / F.pow(F.lit(STEP), F.col("class") + 1))))
        return F.ceil(F.col(count) / per).cast("int")

    kept = sided(members, "m", klass)
    asked = sided(asks, "q", F.explode(F.sequence(klass - 1, klass + 1)))
    dims = kept.groupBy("key", "class").agg(F.count("*").alias("k")).join(
        asked.groupBy("key", "class").agg(F.count("*").alias("l")), ["key", "class"]).select(
        "key", "class", pieces("k", MEMBERS).alias("chunks"), pieces("l", ASKERS).alias("parts"))
    dims = written(dims, "jaccard-dims")

    def dealt(name, many):
        return F.pmod(F.xxhash64(name), F.col(many)).cast("int")

    def each(many):
        return F.explode(F.sequence(F.lit(0), F.col(many) - 1))

    kept = kept.join(dims, ["key", "class"]).select(
        "key", "class", dealt("m", "chunks").alias("chunk"), each("parts").alias("part"), F.lit(True).alias("own"), F.col("m").alias("d"))
    asked = asked.join(dims, ["key", "class"]).select(
        "key", "class", each("chunks").alias("chunk"), dealt("q", "parts").alias("part"), F.lit(False).alias("own"), F.col("q").alias("d"))
    place = ["key", "class", "chunk", "part"]
    rows = kept.unionByName(asked).join(sets.select(F.col("doc_id").alias("d"), "n", "sig"), "d")
    rows = rows.withColumn("c", F.col("d")) if groups is None else rows.join(groups.withColumnRenamed("v", "d"), "d")
    rows = written(rows.groupBy(*place).applyInArrow(
        may_link, "key long, class int, chunk int, part int, own boolean, d long, c long"), "jaccard-may")
    seen = rows.sparkSession.sparkContext.broadcast(filter_of(rows.select(F.col("d").alias("doc_id")).distinct()))

    def needed(batches):
        for batch in batches:
            yield batch.filter(pa.array(passing(seen.value, np.asarray(batch.column(0)))))

    some = sets.select(F.col("doc_id").alias("d"), "s").mapInArrow(needed, "d long, s binary")
    return rows.join(some, "d").groupBy(*place).applyInArrow(exact, "x long, y long")


def components(links, nodes):
    """(v, c): the smallest id reachable, for every v of ``nodes`` (column v). Labels move along links and
    then to the labels of labels, so the rounds grow with the logarithm of the longest path."""
    both = written(links.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(
        links.select(F.col("y").alias("a"), F.col("x").alias("b"))).distinct(), "jaccard-links")
    labels = written(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "jaccard-labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v")).agg(
            F.min("c").alias("m"))
        moved = labels.join(near, "v").select("v", "c", F.least("c", "m").alias("m"))
        jump = moved.select(F.col("v").alias("w"), F.col("m").alias("j"))
        after = written(moved.join(jump, F.col("m") == F.col("w")).select(
            "v", F.least("m", "j").alias("c"), (F.least("m", "j") < F.col("c")).alias("changed")), "jaccard-labels")
        labels = after.select("v", "c")
        if after.where("changed").isEmpty():
            break
    return nodes.join(labels, "v", "left").select("v", F.coalesce("c", "v").alias("c"))


def links_of(docs, reps, levels):
    """Links between documents that stand for their sets, enough to join all that link. ``reps``: rep, n."""
    spark = docs.sparkSession
    # Read twice below, so that the texts are read once.
    rows = written(heads(docs, levels), "jaccard-tokens").select("doc_id", "n", F.explode("hs").alias("h"))
    # Tokens that no other document has in its head can't join anything.
    shared = rows.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    held = rows.join(shared, "h", "left_semi").groupBy("doc_id", "n").agg(F.collect_set("h").alias("hs")).where(
        F.size("hs") >= least_shared(F.col("n")))
    held = written(held.join(reps, F.col("doc_id") == F.col("rep"), "left_semi"), "jaccard-heads")
    wanted = held.select(F.col("doc_id").alias("d"))
    seen = spark.sparkContext.broadcast(filter_of(held))

    def sets_of(batches):
        for batch in batches:
            batch = batch.filter(pa.array(passing(seen.value, np.asarray(batch.column(0)))))
            for a, b in R.blocks(batch, BLOCK):
                doc, h = shingle_sets(batch, a, b)
                if len(h):
                    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                    ends = np.concatenate([first, [len(h)]])
                    own = [h[i:j] for i, j in zip(ends, ends[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids_of(batch, a, b)[doc[first]]), pa.array(np.diff(ends).astype(np.int64)),
                         pa.array([parities(x) for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())],
                        names=["doc_id", "n", "sig", "s"])

    sets = written(known(docs).mapInArrow(sets_of, "doc_id long, n long, sig binary, s binary").join(
        wanted, F.col("doc_id") == F.col("d"), "left_semi").dropDuplicates(["doc_id"]), "jaccard-sets")
    groups = written(wanted.select(F.col("d").alias("v"), F.col("d").alias("c")), "jaccard-groups")
    links = written(meet(*leaders(held.select("doc_id", "n", F.explode("hs").alias("h"))), sets), "jaccard-found")
    for k in range(ROUNDS + 1):
        groups = written(components(links, groups.select("v")), "jaccard-groups")
        opens, families = (largest(held, groups), ()) if k < ROUNDS else opened(held, groups)
        asks = opens.select(F.col("doc_id").alias("q"), F.col("g").alias("key"))
        members = groups.join(asks.select(F.col("key").alias("c")).distinct(), "c", "left_semi").select(
            F.col("v").alias("m"), F.col("c").alias("key"))
        if families:
            asks, members = asks.unionByName(families[0]), members.unionByName(families[1])
        links = written(links.unionByName(meet(asks, members, sets, groups)), "jaccard-found")
    return links


def fits(a, b):
    return (100 * F.col(a) >= PERCENT * F.col(b)) & (100 * F.col(b) >= PERCENT * F.col(a))


def leaders(rows):
    """Each document's leader, as (those who ask, members): of the documents that lead its tokens by a random order of
    all, the one that leads most."""
    lead = rows.groupBy("h").agg(F.min(F.struct(F.xxhash64("doc_id").alias("o"), "doc_id", "n")).alias("leader")).select(
        "h", F.col("leader.doc_id").alias("key"), F.col("leader.n").alias("k"))
    votes = rows.join(lead, "h").where(fits("n", "k") & (F.col("doc_id") != F.col("key"))).groupBy(
        F.col("doc_id").alias("m"), "key").agg(F.count("*").alias("many"))
    members = written(votes.groupBy("m").agg(F.max_by("key", F.struct("many", "key")).alias("key")), "jaccard-votes")
    return members.select(F.col("key").alias("q"), "key").distinct(), members


def by_group(held, groups):
    """The head tokens with the group of each document and its size."""
    sized = groups.join(groups.groupBy("c").agg(F.count("*").alias("size")), "c")
    grouped = held.join(sized.withColumnRenamed("v", "doc_id"), "doc_id")
    return written(grouped.select("doc_id", "n", "c", "size", F.explode("hs").alias("h")), "jaccard-grouped")


def largest(held, groups):
    """(doc_id, g): each document opens the group that is most often the largest one with a head token of its own. One
    row per token and group size up what follows, so this grows with the tokens alone."""
    grouped = by_group(held, groups)
    top = grouped.groupBy("h").agg(F.max(F.struct("size", "c")).alias("top")).select("h", F.col("top.size").alias("most"), F.col("top.c").alias("g"))
    votes = grouped.join(top, "h").where(F.col("c") != F.col("g")).groupBy("doc_id", "g", "most").agg(F.count("*").alias("m"))
    return written(votes.groupBy("doc_id").agg(F.max_by("g", F.struct("m", "most", "g")).alias("g")), "jaccard-largest")


def opened(held, groups):
    """(doc_id, g): documents that open a group not smaller than their own, as enough of their head tokens stand in
    the union of its head tokens, and the sizes in it can match; and the ``families`` of tokens in more than ``APART`` groups.

    Tokens within one group open nothing. A document with fewer other tokens than it has to share is left out, and of
    the others' the most common ones are: a document that shares k of s tokens has one of any s - k + 1. Tokens that
    stand in the same groups, as those of one passage do, are one row of the matrix.
    """
    grouped = by_group(held, groups)
    # The matrix: how many groups have a token, and in each the sizes of documents with it.
    matrix = written(grouped.groupBy("h", "c", "size").agg(F.min("n").alias("low"), F.max("n").alias("high")), "jaccard-matrix")
    apart = matrix.groupBy("h").agg(
        F.count("*").alias("k"), F.bit_xor(F.xxhash64("c")).alias("p1"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("p2"))
    apart = written(apart.where("k > 1"), "jaccard-apart")
    mine = grouped.join(apart, "h").withColumnRenamed("size", "own")
    ranked = Window.partitionBy("doc_id").orderBy("k", "p1", "p2", "h")
    mine = mine.withColumn("s", F.count("*").over(Window.partitionBy("doc_id"))).withColumn("place", F.row_number().over(ranked))
    need = least_shared(F.col("n"))
    mine = mine.where((F.col("s") >= need) & (F.col("place") <= F.col("s") - need + 1)).select(
        "doc_id", "n", "c", "own", "k", "p1", "p2").distinct()
    mine, few, many = written(mine, "jaccard-mine"), F.col("k") <= APART, F.col("k") > APART
    unions = matrix.join(apart.where(few), "h").groupBy("p1", "p2", F.col("c").alias("g"), "size").agg(
        F.min("low").alias("low"), F.max("high").alias("high"))
    bound = mine.where(few).join(written(unions, "jaccard-unions"), ["p1", "p2"]).where(
        (F.struct("own", "c") < F.struct("size", "g")) & (100 * F.col("high") >= PERCENT * F.col("n"))
        & (100 * F.col("n") >= PERCENT * F.col("low")))
    spots = grouped.join(apart.where(many), "h").select("doc_id", "c", "size", "p1", "p2").distinct()
    return written(bound.select("doc_id", "g").distinct(), "jaccard-opens"), families(mine.where(many), written(spots, "jaccard-spots"))


def families(mine, spots):
    """(q, key) and (m, key) for tokens of very many groups: ``spots`` are the documents that hold them, ``mine`` those that have to
    open them. Documents that link share a token that one of them opens, whichever family it belongs to.

    Each token joins the one that most of its documents hold as their most common, unless that has far more documents, so that
    near copies, which share many tokens, meet in few families.
    """
    sized = written(spots.groupBy("p1", "p2").agg(F.count("*").alias("many"), F.max(F.struct("size", "c")).alias("most")), "jaccard-sized")
    held = spots.select("doc_id", "p1", "p2").join(sized.select("p1", "p2", "many"), ["p1", "p2"])
    tops = held.groupBy("doc_id").agg(F.max(F.struct("many", "p1", "p2")).alias("top"))
    votes = held.join(tops, "doc_id").where(F.col("top.many") <= SPREAD * F.col("many")).groupBy("p1", "p2", "top").agg(F.count("*").alias("votes"))
    chosen = votes.groupBy("p1", "p2").agg(F.max(F.struct("votes", "top")).alias("best"))
    named = written(sized.join(chosen, ["p1", "p2"], "left").select(
        "p1", "p2", "most", F.xxhash64(F.coalesce("best.top.p1", "p1"), F.coalesce("best.top.p2", "p2")).alias("key")), "jaccard-families")
    asks = mine.join(named, ["p1", "p2"]).where(F.struct(F.col("own").alias("size"), "c") < F.col("most")).select(F.col("doc_id").alias("q"), "key")
    members = spots.join(named, ["p1", "p2"]).select(F.col("doc_id").alias("m"), "key")
    return written(asks.distinct(), "jaccard-asks"), written(members.distinct(), "jaccard-members")


def classes(docs):
    """doc_id, n_shingles and component_id of every row."""
    rows = written(set_keys(docs), "jaccard-rows")
    keys = written(rows.where("doc_id is not null").select("doc_id", "n", "k1", "k2").distinct(), "jaccard-keys")
    same = keys.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    same = written(same, "jaccard-same")
    found = components(links_of(docs, same.select("rep", "n"), sketch(rows.where("part is not null").select("part", "many"))), same.select(F.col("rep").alias("v")))
    # The smallest id of a set's copies is the one that stands for it, so labels are smallest ids of all.
    named = keys.join(same.select("k1", "k2", "n", "rep"), ["k1", "k2", "n"]).join(
        found.withColumnRenamed("v", "rep"), "rep").select(F.col("doc_id").alias("d"), "n", "c")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(
        named, F.col("doc_id") == F.col("d"), "left").select(
        "doc_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"))


def one_of_each(docs):
    """The row of ``docs`` with the smallest doc_id of each class; rows with a null id stay. Repeated rows of
    one id are one document."""
    first = classes(docs).where("doc_id = component_id").select(F.col("doc_id").alias("_first_id")).distinct()
    kept = docs.join(first, F.col("doc_id") == F.col("_first_id"), "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null"))


def op7_ngram_jaccard_join(spark, sf_dir):
    """The class of every document under links of Jaccard similarity 0.8 and more."""
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
