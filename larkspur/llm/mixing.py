"""Mixing sources to target weights by temperature.

The token shares p of the sources are raised to an exponent a between 0 (uniform) and 1 (as they are) and
normalised. ``solve`` bisects for the largest a whose weights have at least the entropy asked for, or, where a repetition limit
is given, for the smallest a at which no source is read more often than that. ``realise`` then draws a budget of
tokens: the documents of a source are dealt into blocks by a hash, each pass over a source takes the blocks
in an order of its own, and the documents inside the block where the budget ends in an order of their own.

Only DataFrame functions are used. The weights are a table with one row per source, worked out from counts
over all documents; cumulative sums run over blocks, and over documents only inside the one block per source
at which the budget ends. No task holds more than a block's documents or a source's list of blocks.

A null source is a source of its own. Null texts and texts without words have no tokens: they carry no
weight and are not drawn (``keep_empty`` takes each once). Rows repeated in the input count as often as
they occur and are drawn alike. An empty table gives no rows.
"""

from pyspark.sql import Window, functions as F

from larkspur.llm.quality import words_of
from larkspur.session import new_path

#: Tokens drawn, as a multiple of those in the corpus (None: the least at which every source is read whole);
#: reads of a document at most.
BUDGET, MAX_REPEATS = 1.0, 4.0
#: The part of the largest possible entropy that weights should have.
ENTROPY = 0.99
BLOCK_TOKENS = 1 << 20
STEPS, ROUNDS = 64, 5
SEED = "mix"


def counted(docs, text="text", source="source", key="doc_id"):
    """key, source and tokens (words) of every document."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"),
                       F.size(words_of(t)).cast("long").alias("tokens"))


def solve(shares, entropy=ENTROPY, max_repeats=MAX_REPEATS, budget=BUDGET):
    """The exponent. Each round looks at ``STEPS`` + 1 exponents at once and keeps the interval in which the
    aim is met, so ``ROUNDS`` small aggregates over the table of sources do what 30 halvings would."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        powers = shares.where("p > 0").select("p", F.explode(F.sequence(F.lit(0), F.lit(STEPS))).alias("k")).select(
            "p", "k", F.pow("p", F.lit(low) + F.col("k") * ((high - low) / STEPS)).alias("x"))
        met = powers.groupBy("k").agg(
            F.sum("x").alias("z"), F.sum(F.col("x") * F.log("x")).alias("xlx"),
            F.max(F.col("x") / F.col("p")).alias("over"), F.min(F.col("x") / F.col("p")).alias("under"),
            F.count("*").alias("n"))
        # entropy of x / z; reads of the most repeated source; both fall as the exponent grows
        met = met.select("k", (F.log("z") - F.col("xlx") / F.col("z")).alias("h"), F.log("n").alias("most"),
                         (F.col("over") / (F.col("under") if budget is None else F.col("z") / budget)).alias("reads"))
        rows = met.orderBy("k").collect()  # one row for each exponent looked at
        if not rows:
            return 1.0
        limited = [r["k"] for r in rows if r["reads"] <= max_repeats]
        if not limited:  # the budget alone repeats the corpus more often
            return 1.0
        least = min(limited)
        wide = [r["k"] for r in rows if r["k"] >= least and r["h"] >= entropy * r["most"]]
        at = max(wide) if wide else least
        if wide and at < STEPS:
            low, high = low + at * (high - low) / STEPS, low + (at + 1) * (high - low) / STEPS
        elif not wide and at > 0:
            low, high = low + (at - 1) * (high - low) / STEPS, low + at * (high - low) / STEPS
        else:
            return low + at * (high - low) / STEPS
    return high if not wide else low


def weights(rows, entropy=ENTROPY, max_repeats=MAX_REPEATS, budget=BUDGET):
    """One row per source: tokens, share, exponent, weight and tokens to draw."""
    per = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))
    path = new_path(rows.sparkSession, "mix-sources")
    per.write.parquet(path)
    per = rows.sparkSession.read.schema(per.schema).parquet(path)
    total = per.agg(F.sum("tokens")).first()[0] or 0
    shares = per.withColumn("p", F.col("tokens") / F.lit(max(total, 1)).cast("double"))
    a = solve(shares, entropy, max_repeats, budget)
    raised = F.when(F.col("p") > 0, F.pow("p", F.lit(a))).otherwise(F.lit(0.0))
    norm = shares.agg(F.sum(raised)).first()[0] or 1.0
    if budget is None:
        budget = shares.where("p > 0").agg(F.max(F.col("p") / raised) * norm).first()[0] or 1.0
    return shares.select(
        "source", "documents", "tokens", F.col("p").alias("share"), F.lit(a).alias("exponent"),
        (raised / norm).alias("weight"), F.floor(raised / norm * (budget * total) + 0.5).cast("long").alias("goal"))


def order(*parts):
    """A repeatable random order: hex digits."""
    return F.md5(F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def realise(rows, plan, block_tokens=BLOCK_TOKENS):
    """doc_id, source, tokens, pass, block and place for each drawing of a document."""
    spark = rows.sparkSession
    rows = rows.withColumn("source", F.coalesce("source", F.lit("\0")))
    plan = plan.withColumn("source", F.coalesce("source", F.lit("\0"))).select(
        "source", "goal", F.col("tokens").alias("have"),
        F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1)).alias("n_blocks"))
    # Ids may repeat, so that the block is a matter of the id and a hot source has many blocks.
    dealt = rows.where("tokens > 0").join(plan, "source").where("goal > 0").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "source"), F.col("n_blocks")))
    path = new_path(spark, "mix-dealt")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    blocks = dealt.groupBy("source", "block").agg(
        F.sum("tokens").alias("size"), F.first("goal").alias("goal"), F.first("have").alias("have"))
    passes = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0), F.floor(F.col("goal") / F.col("have")).cast("int"))))
    passes = passes.withColumn("rest", F.least(F.col("have"), F.col("goal") - F.col("pass") * F.col("have")))
    passes = passes.where("rest > 0").withColumn("o", order(F.col("source"), F.col("pass"), F.col("block")))
    so_far = Window.partitionBy("source", "pass").orderBy("o", "block").rowsBetween(Window.unboundedPreceding, 0)
    passes = passes.withColumn("upto", F.sum("size").over(so_far)).withColumn("place", F.count("*").over(so_far))
    passes = passes.withColumn("before", F.col("upto") - F.col("size")).where("before < rest").select(
        "source", "block", "pass", "place", (F.col("rest") - F.col("before")).alias("room"), "size")
    drawn = dealt.select("doc_id", "source", "tokens", "block").join(passes, ["source", "block"])
    whole = drawn.where("room >= size").drop("room", "size")
    inside = Window.partitionBy("source", "block", "pass").orderBy("o", "doc_id").rowsBetween(
        Window.unboundedPreceding, 0)
    cut = drawn.where("room < size").withColumn("o", order(F.col("source"), F.col("pass"), F.col("doc_id")))
    cut = cut.withColumn("upto", F.sum("tokens").over(inside)).where("upto <= room").drop("room", "size", "o", "upto")
    out = whole.unionByName(cut)
    return out.withColumn("source", F.when(F.col("source") != "\0", F.col("source")))


def mix(docs, entropy=ENTROPY, max_repeats=MAX_REPEATS, budget=BUDGET, block_tokens=BLOCK_TOKENS, key="doc_id"):
    rows = counted(docs, key=key)
    path = new_path(docs.sparkSession, "mix-counts")
    rows.write.parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    return realise(rows, weights(rows, entropy, max_repeats, budget), block_tokens)


def mixed_docs(docs, **settings):
    """The rows of ``docs`` as often as they are drawn. Rows of one doc_id and one text are one document; rows without a
    doc_id are told apart by their texts. Only where there are copies are all texts shuffled to collapse them."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit("")))
    once = docs.withColumn("_mix_key", F.md5(name))
    again = once.groupBy("_mix_key").agg(F.count("*").alias("copies")).where("copies > 1")
    if not again.isEmpty():
        once = once.dropDuplicates(["_mix_key"])
    drawn = mix(once, key="_mix_key", **settings).groupBy(F.col("doc_id").alias("_drawn_key")).agg(
        F.count("*").cast("int").alias("_times"))
    rows = once.join(drawn, F.col("_mix_key") == F.col("_drawn_key"))
    return rows.withColumn("_times", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[once[c] for c in docs.columns])


def op10_temperature_mixing(spark, sf_dir):
    """Every drawing of a document: its source, pass, and place among the source's blocks."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "source", "tokens", F.col("pass").cast("int").alias("pass"), "block", "place")
