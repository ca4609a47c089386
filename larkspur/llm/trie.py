"""The prefix trie of conversations, with subtree totals rolled up band by band.

Conversations are ordered by turn (null first, then role and the SHA-256 of the text; rows equal in these are
alike) and rebuilt on a shared beginning: the first ``h`` turns of another conversation, then the conversation's own turns
after its first ``h``. Each distinct sequence of the first ``d`` rebuilt turns is a node of depth ``d``.

A turn at depth ``d`` has a 128-bit code of its role, its text and ``d``; the key of a node is the XOR of the codes on its
path, so keys are running aggregates and the parent's key is the key without the last code. Texts are never
shuffled.

Totals over subtrees: depths are cut into bands of ``HEIGHT``. A node adds to its ancestors inside its band
only. The totals of the bands' topmost nodes are then completed by the same method, one depth a band, and
each adds its total to its ancestors in the band above. So a node is repeated at most ``HEIGHT`` times, and the
number of rounds is the logarithm of the depth to the base ``HEIGHT``. The running keys are carried from
band to band in the same way, so that a conversation of any length is spread over tasks.

Null roles and texts are empty; rows without conv_id belong to no conversation and are left out. Repeated
rows are turns of their own. Other columns are not read. An empty table has no root and gives no rows.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Window, functions as F

from larkspur.operators.ranking import row_number_by_range
from larkspur.session import new_path

#: Depths in a band.
HEIGHT = 8
#: Conversation c begins like conversation c - c % FAMILY, with crc32(c) % SHARED turns.
FAMILY, SHARED = 100, 6
#: Members whose ids share all bits but so many lowest are joined to one text first.
MEMBER_BITS = 12
KEY = ["k1", "k2"]


def saved(df, name):
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(convs):
    """(conv_id, i, t1, t2, chars): turns in order, from 1, with two codes and the length of the text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = convs.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("has_turn"), "turn", role.alias("role"),
        F.sha2(text, 256).alias("digest"), F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), text, role).alias("t2"), F.length(text).cast("long").alias("chars"))
    return row_number_by_range(rows, ["conv_id"], ["has_turn", "turn", "role", "digest"], "i").select(
        "conv_id", F.col("i").cast("long").alias("i"), "t1", "t2", "chars")


def rebuilt(turns, family=FAMILY, shared=SHARED):
    """Turns (c, d, t1, t2, chars, last) of the rebuilt conversations, and a row of depth 0 for each."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    family, shared = F.lit(family).cast("long"), F.lit(shared).cast("long")
    convs = sizes.select(F.col("conv_id").alias("c"), "n", (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
                         (F.crc32(F.col("conv_id").cast("string")) % shared).alias("h"))
    lent = sizes.select(F.col("conv_id").alias("base_id"), F.col("n").alias("base_n"))
    convs = convs.join(lent, F.col("base") == F.col("base_id"), "left").select(
        "c", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("borrowed"), "n").withColumn(
        "m", F.col("borrowed") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    # A base lends at most its first SHARED - 1 turns to at most FAMILY conversations.
    first = turns.where(F.col("i") < shared)
    begin = convs.join(first, (F.col("base") == F.col("conv_id")) & (F.col("i") <= F.col("h"))).select(
        "c", F.col("i").alias("d"), "t1", "t2", "chars", (F.col("i") == F.col("m")).alias("last"))
    own = turns.join(convs.select("c", "h", "borrowed", "m"), F.col("conv_id") == F.col("c")).where("i > h").withColumn(
        "d", F.col("i") - F.col("h") + F.col("borrowed")).select(
        "c", "d", "t1", "t2", "chars", (F.col("d") == F.col("m")).alias("last"))
    zero = F.lit(0).cast("long")
    top = convs.select("c", zero.alias("d"), zero.alias("t1"), zero.alias("t2"), zero.alias("chars"),
                       (F.col("m") == 0).alias("last"))
    return begin.unionByName(own).unionByName(top)


def running(rows, top, height):
    """``rows`` (c, i, z1, z2, …) with the XOR of z1 and z2 from the conversation's first row to each, as k1 and k2.

    ``i`` has no gaps. Inside a band by a window; what the bands before hold is the same question with a row a band.
    """
    band = rows.withColumn("band", F.floor(F.col("i") / height))
    inside = Window.partitionBy("c", "band").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    out = band.withColumns({f"k{x}": F.expr(f"bit_xor(z{x})").over(inside) for x in (1, 2)})
    if top < height:
        return out.drop("band")
    sums = band.where(F.col("band") < top // height).groupBy("c", (F.col("band") + 1).alias("i")).agg(
        F.expr("bit_xor(z1)").alias("z1"), F.expr("bit_xor(z2)").alias("z2"))
    before = running(sums, top // height, height).select(
        F.col("c").alias("before_c"), F.col("i").alias("before_i"), F.col("k1").alias("b1"), F.col("k2").alias("b2"))
    out = out.join(before, (F.col("c") == F.col("before_c")) & (F.col("band") == F.col("before_i")), "left")
    return out.withColumns({f"k{x}": F.col(f"k{x}").bitwiseXOR(F.coalesce(f"b{x}", F.lit(0))) for x in (1, 2)}).drop(
        "band", "before_c", "before_i", "b1", "b2")


def paths(convs, family=FAMILY, shared=SHARED, height=HEIGHT):
    """(c, i, k1, k2, q1, q2, chars, last) for each depth i of each rebuilt conversation, q the parent's key; and
    the largest depth."""
    zero = F.lit(0).cast("long")
    rows = saved(rebuilt(numbered(convs), family, shared).select(
        "c", F.col("d").alias("i"), "chars", "last",
        F.when(F.col("d") == 0, zero).otherwise(F.xxhash64("t1", "t2", "d")).alias("z1"),
        F.when(F.col("d") == 0, zero).otherwise(F.xxhash64("d", "t2", "t1")).alias("z2")), "trie-turns")
    top = rows.agg(F.max("i")).first()[0] or 0
    keys = running(rows, top, height)
    return saved(keys.select(
        "c", "i", "k1", "k2", *(F.when(F.col("i") > 0, F.col(f"k{x}").bitwiseXOR(F.col(f"z{x}"))).alias(f"q{x}") for x in (1, 2)),
        "chars", "last"), "trie-paths"), top


def subtree_sums(steps, nodes, values, top, height=HEIGHT):
    """``nodes`` (k1, k2, c, i, values) with their values summed up over subtrees.

    ``steps`` (c, i, k1, k2) are paths, ``c`` a path that passes through the node, ``top`` the largest i.
    """
    steps, nodes = steps.select("c", "i", *KEY), nodes.select(*KEY, "c", "i", *values)
    stretch = steps.groupBy(F.col("c").alias("path_c"), F.floor(F.col("i") / height).alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("i", *KEY))).alias("path"))
    own = nodes.join(stretch, (F.col("c") == F.col("path_c")) & (F.floor(F.col("i") / height) == F.col("band")))
    place = (F.col("i") % height).cast("int")
    is_self = F.col("pos") == place
    parts = own.select("c", "i", *values, F.posexplode(F.slice("path", F.lit(1), place + 1)).alias("pos", "at")).select(
        "at.k1", "at.k2", F.when(is_self, F.col("c")).alias("c"), F.when(is_self, F.col("i")).alias("i"), *values)
    if top >= height:
        inside = own.groupBy(F.col("path")[0]["k1"].alias("r1"), F.col("path")[0]["k2"].alias("r2")).agg(
            *(F.sum(v).alias(v) for v in values))
        heads = nodes.where(F.col("i") % height == 0).drop(*values).join(
            inside, (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2"))).withColumn("i", F.floor(F.col("i") / height))
        whole = subtree_sums(steps.where(F.col("i") % height == 0).withColumn("i", F.floor(F.col("i") / height)),
                             saved(heads.select(*KEY, "c", "i", *values), "trie-heads"), values, top // height, height)
        nothing = F.lit(None).cast("long")
        above = saved(whole, "trie-bands").where("i > 0").join(
            stretch, (F.col("c") == F.col("path_c")) & (F.col("i") - 1 == F.col("band"))).select(
            F.explode("path").alias("at"), *values).select(
            "at.k1", "at.k2", nothing.alias("c"), nothing.alias("i"), *values)
        parts = parts.unionByName(above)
    return parts.groupBy(*KEY).agg(F.max("c").alias("c"), F.max("i").alias("i"), *(F.sum(v).alias(v) for v in values))


def ends(steps):
    """(e1, e2, ends_sha256): SHA-256 of the ascending, comma-joined ids of the conversations that end at a node.

    Ids that share their upper bits are joined first; a task then reads a node's texts one after the other.
    """
    joined = steps.where("last").groupBy(*KEY, F.shiftright("c", MEMBER_BITS).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("c")), ",").alias("ids"))

    def digest(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "ids"))):
                if (k1, k2) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(ids.encode())
            yield rows_of(done)
        if key:
            yield rows_of([(*key, state.hexdigest())])

    def rows_of(done):
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[x] for r in done], t) for x, t in enumerate(kinds)], names=["e1", "e2", "ends_sha256"])

    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "part").mapInArrow(digest, "e1 long, e2 long, ends_sha256 string")


def trie(convs, family=FAMILY, shared=SHARED, height=HEIGHT):
    """A row per node: its smallest member and depth, the parent's smallest member, members, children, leaves
    and characters saved in its subtree, and the digest of the members that end at it."""
    steps, top = paths(convs, family, shared, height)
    found = steps.groupBy("i", *KEY).agg(
        F.min("c").alias("c"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.max("q1").alias("q1"),
        F.max("q2").alias("q2"))
    found = saved(found, "trie-found")
    children = found.where("i > 0").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = saved(found.join(children, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")), "left").select(
        *KEY, "q1", "q2", "c", "i", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "trie-nodes")
    values = ["n_leaves", "saved_tokens"]
    sums = subtree_sums(steps, nodes, values, top, height).select(
        F.col("k1").alias("s1"), F.col("k2").alias("s2"), *values)
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("c").alias("parent_conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.drop(*values)
        .join(sums, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")))
        .join(ends(steps), (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left")
        .join(parents, (F.col("q1") == F.col("p1")) & (F.col("q2") == F.col("p2")), "left")
        .select(F.col("c").alias("conv_id"), F.col("i").alias("depth"), "parent_conv_id", "n_convs", "n_children", *values,
                F.coalesce("ends_sha256", none).alias("ends_sha256")))


def op11_prefix_trie(spark, sf_dir):
    """Every node of the trie of all rebuilt conversations."""
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
