"""Nearest neighbours by cosine over balanced posting lists.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors, those with the smallest hashes of their ids):
clusters are halved until none has more than its share, so the lists are balanced. Every vector is put into
the list of its nearest centroid, and boundary vectors also into those of further centroids whose distance is at
most ``REPLICATE`` times the nearest. A query finds centroids by best-first search through a graph of their
neighbours, held in memory, and opens the lists whose centroid is at most ``OPEN`` times as far as the nearest. Only that
ratio ends the search, so the number of open lists grows with the input where vectors are spread evenly.
Lists are gathered or cut into cells of bounded size; a query is sent once to each cell with a list that it opens, and
queries meet the vectors of a cell in blocks: list by list, each with those queries that open it.

Of equal vectors only the ``k`` + 1 with the smallest ids can be among the nearest ``k`` of anything, so the rest
is left out of the lists (not of the queries): a vector that holds a third of all rows fills no list.
Vectors which are null, zero, or hold null or non-finite components take no part, nor do rows without
vec_id or vectors whose length is not the most frequent one. Repeated rows with the same vec_id are one vector.
A query with fewer than ``k`` found is searched again in all lists. An empty table gives no rows.

The index is fitted again by each call; what is broadcast is at most ``MAX_LISTS`` centroids and their graph.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F

from larkspur.session import new_path

SAMPLE = 16_384
MAX_LISTS = 2_048
LIST_SIZE = 256
REPLICAS, REPLICATE = 4, 1.15
OPEN, LEAST_OPEN = 1.5, 12
DEGREE = 24
#: Vectors in a cell, and queries that meet it in one task.
CELL, ASKED = 20_000, 50_000
FOUND = "query_id long, vec_id long, score double"


def unit(x):
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def halve(x, rng):
    """Two halves of equal size along the line between two centres."""
    a, b = x[rng.choice(len(x), 2, replace=False)]
    for _ in range(8):
        side = (x @ (a - b)) > np.median(x @ (a - b))
        if side.all() or not side.any():
            break
        a, b = x[side].mean(0), x[~side].mean(0)
    order = np.argsort(x @ (a - b), kind="stable")
    return order[: len(x) // 2], order[len(x) // 2:]


def fit(sample, lists, seed=7):
    """Balanced centroids: clusters are halved until each holds its share, then drawn to their means."""
    rng = np.random.default_rng(seed)
    share, open_, done = max(1, len(sample) // lists), [np.arange(len(sample))], []
    while open_:
        part = open_.pop()
        if len(part) < 2 * share or len(part) < 2:
            done.append(part)
            continue
        a, b = halve(sample[part], rng)
        open_ += [part[a], part[b]]
    centres = unit(np.array([sample[p].mean(0) for p in done]))
    for _ in range(4):
        nearest = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        full = np.bincount(nearest, minlength=len(centres)) > 0
        centres[full] = unit(sums[full])
    return centres


def graph(centres, degree=DEGREE):
    near = np.argsort(-(centres @ centres.T), axis=1, kind="stable")[:, 1:degree + 1]
    return near


def search_graph(q, centres, links, entries=8):
    """Indices of all centroids found, from a few fixed entries, that are at most ``OPEN`` times as far as the nearest
    or among the ``LEAST_OPEN`` nearest. The search goes on until all of these have been expanded."""
    dist = np.full(len(centres), np.inf)
    expanded = np.zeros(len(centres), bool)
    new = np.arange(0, len(centres), max(1, len(centres) // entries))
    while True:
        dist[new] = np.sqrt(np.maximum(2 - 2 * (centres[new] @ q), 0))
        few = min(LEAST_OPEN, len(centres)) - 1
        use = np.isfinite(dist) & (dist <= max(OPEN * dist.min() + 1e-6, np.partition(dist, few)[few]))
        todo = np.flatnonzero(use & ~expanded)
        if not len(todo):
            return np.flatnonzero(use)
        expanded[todo] = True
        new = np.unique(links[todo])
        new = new[np.isinf(dist[new])]


def cells_of(sizes, lists):
    """The first cell and the number of cells of each list: lists next to each other share a cell up to ``CELL``
    vectors, larger ones have several of their own. Also the number of cells."""
    first, many, cell, held = np.zeros(lists, np.int32), np.ones(lists, np.int32), 0, 0
    for x in range(lists):
        n = sizes.get(x, 0)
        if held and held + n > CELL:
            cell, held = cell + 1, 0
        first[x], many[x] = cell, max(1, -(-n // CELL))
        cell, held = (cell + int(many[x]), 0) if n > CELL else (cell, held + n)
    return first, many, cell + 1


def usable(vectors):
    """Distinct vec_id with vectors that can be compared, as arrays of double."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def best_of(q, qid, c, ids, k):
    """Rows, columns and scores of the ``k`` nearest of each query, and of those that tie with them."""
    sims = unit(q) @ unit(c).T
    sims[qid[:, None] == ids[None, :]] = -np.inf
    kth = np.partition(sims, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(q), -np.inf)
    rows, cols = np.nonzero((sims >= kth[:, None] - 1e-9) & (sims > -np.inf))
    # The same sum for the same two vectors wherever they meet, so that ties are ties.
    x, y = q[rows], c[cols]
    return rows, cols, (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def meetings(held, opens):
    """(queries, vectors) of a cell that are compared, as indices: list by list with those who open it; queries that open every
    list of the cell meet its vectors once, though some stand in several lists. ``opens`` None opens all."""
    there = np.unique(held)
    wide = np.array([o is None or np.isin(there, o).all() for o in opens], bool)
    if wide.any():
        yield np.flatnonzero(wide), None
    narrow = np.flatnonzero(~wide)
    if len(narrow):
        who = np.repeat(narrow, [len(opens[i]) for i in narrow])
        what = np.concatenate([np.asarray(opens[i]) for i in narrow])
        for x in there:
            asked = who[what == x]
            if len(asked):
                yield asked, np.flatnonzero(held == x)


def cell_search(k):
    def search(key, cands, queries):
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(cands) or not len(queries):
            return empty
        ids, one = np.unique(cands["vec_id"].to_numpy(), return_index=True)  # a vector may stand in several lists of a cell
        every, c = cands["vec_id"].to_numpy(), np.stack(cands["v"].to_numpy())
        q, qid, out = np.stack(queries["v"].to_numpy()), queries["query_id"].to_numpy(), [empty]
        for asked, near in meetings(cands["list"].to_numpy(), list(queries["opens"])):
            near = one if near is None else near
            for a in range(0, len(asked), 512):
                part = asked[a:a + 512]
                rows, cols, score = best_of(q[part], qid[part], c[near], every[near], k)
                out.append(pd.DataFrame({"query_id": qid[part][rows], "vec_id": every[near][cols], "score": score}))
        found = pd.concat([x for x in out if len(x)] or [empty]).drop_duplicates(["query_id", "vec_id"]).sort_values(
            ["query_id", "score", "vec_id"], ascending=[True, False, True])
        return found.groupby("query_id").head(k)

    return search


def nearest(vectors, k=5, is_query=None, sample=SAMPLE, list_size=LIST_SIZE, max_lists=MAX_LISTS):
    """query_id, rank, vec_id and score of the ``k`` nearest of each row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    path = new_path(spark, "ann-vectors")
    usable(vectors).write.parquet(path)
    rows = spark.read.schema("vec_id long, v array<double>").parquet(path)
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    dim = lengths[0]["n"] if lengths else 0
    rows = rows.where(F.size("v") == dim)
    same = Window.partitionBy("v").orderBy("vec_id")
    index = new_path(spark, "ann-index")
    rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy").write.parquet(index)
    kept = spark.read.schema("vec_id long, v array<double>").parquet(index)
    count = kept.count()
    taken = kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()  # bounded by `sample`
    points = unit(np.array([r["v"] for r in taken], np.float64)) if taken else np.zeros((1, max(dim, 1)))
    centres = fit(points, max(1, min(max_lists, count // list_size, len(points))))
    held = spark.sparkContext.broadcast((centres.astype(np.float32), graph(centres)))

    def post(batches):
        c = held.value[0]
        for b in batches:
            u = unit(np.stack(b["v"].to_numpy())).astype(np.float32) if len(b) else np.zeros((0, c.shape[1]))
            d = np.sqrt(np.maximum(2 - 2 * (u @ c.T), 0))
            n = min(REPLICAS, c.shape[0])
            near = np.argpartition(d, n - 1, axis=1)[:, :n]
            dist = np.take_along_axis(d, near, 1)
            use = dist <= REPLICATE * dist.min(axis=1, keepdims=True) + 1e-6
            r, j = np.nonzero(use)
            yield pd.DataFrame({"list": near[r, j].astype("int32"), "vec_id": b["vec_id"].to_numpy()[r],
                                "v": b["v"].to_numpy()[r]})

    posted = new_path(spark, "ann-lists")
    kept.mapInPandas(post, "list int, vec_id long, v array<double>").write.parquet(posted)
    lists = spark.read.schema("list int, vec_id long, v array<double>").parquet(posted)
    sizes = {r["list"]: r["n"] for r in lists.groupBy("list").agg(F.count("*").alias("n")).collect()}
    first, many, cells = cells_of(sizes, len(centres))
    table = F.broadcast(spark.createDataFrame(
        [(x, int(a), int(n)) for x, (a, n) in enumerate(zip(first, many))], "list int, first int, cells int"))
    lists = lists.join(table, "list").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("cells"))).cast("int").alias("cell"), "list", "vec_id", "v")

    def choose(batches):
        c, links = held.value
        for b in batches:
            out = []
            for i, v in zip(b["vec_id"], b["v"]):
                use = search_graph((v / np.linalg.norm(v)).astype(np.float32), c, links)
                opens = {}
                for x in use:
                    for part in range(many[x]):
                        opens.setdefault(int(first[x]) + part, []).append(int(x))
                out += [(cell, i, v, of) for cell, of in sorted(opens.items())]
            yield pd.DataFrame(out, columns=["cell", "query_id", "v", "opens"]).astype({"cell": "int32"})

    queries = rows.where(is_query if is_query is not None else F.lit(True))
    blocks = max(1, -(-queries.count() // ASKED))

    def meet(asked):
        asked = asked.select("cell", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), "query_id", "v", "opens")
        return lists.select("cell", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "list", "vec_id", "v").groupBy(
            "cell", "block").cogroup(asked.groupBy("cell", "block")).applyInPandas(cell_search(k), FOUND)

    found = new_path(spark, "ann-found")
    asked = queries.select("vec_id", "v").repartition(F.col("vec_id"))
    meet(asked.mapInPandas(choose, "cell int, query_id long, v array<double>, opens array<int>")).write.parquet(found)
    got = spark.read.schema(FOUND).parquet(found).distinct()
    enough = got.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, max(count - 1, 0)))
    short = queries.select(F.col("vec_id").alias("query_id"), "v").join(enough, "query_id", "left_anti")
    again = new_path(spark, "ann-again")
    meet(short.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))).withColumn(
        "opens", F.lit(None).cast("array<int>"))).write.parquet(again)
    got = got.unionByName(spark.read.schema(FOUND).parquet(again)).distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return got.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op9_nearest_neighbours(spark, sf_dir):
    """The five nearest of every vector whose id is divisible by 50."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), is_query=F.col("vec_id") % 50 == 0)
