"""Packing, WARC, neighbours, mixing, licences and the pipeline."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import licences, mixing, neighbours, packing, queries, warc


def test_packing_pieces_equal_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["", None, "a", "word " * 3000, "<|endoftext|> x <|endoftext|>", "é😀\n\n  \t x" * 200, " " * 5000, "z" * 20000]
    got = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in enumerate(texts):
        ids = np.array([*tokens.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        want += [(i, k, a, z - a, zlib.crc32(ids[a:z].tobytes())) for k, (a, z) in enumerate(zip(bounds, bounds[1:]))]
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("documents, attention", [(64, 64 * 64), (3, 64 * 64), (64, 1500)])
def test_place(documents, attention, score):
    r = random.Random(documents)
    lengths = [r.randint(1, 38) for _ in range(400)]
    bins, offsets = packing.place(lengths, 64, documents, attention, score=score)
    for b in set(bins):
        own = sorted((o, n) for x, o, n in zip(bins, offsets, lengths) if x == b)
        assert sum(n for _, n in own) <= 64 and len(own) <= documents and sum(n * n for _, n in own) <= attention
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
    least = max(sum(lengths) / 64, len(lengths) / documents, sum(n * n for n in lengths) / attention)
    assert len(set(bins)) <= 1.15 * least + 2


def test_packing(spark, sf_dir):
    rows = packing.op3_best_fit_packing(spark, sf_dir).toPandas()
    assert len(rows) == len(rows.drop_duplicates(["doc_id", "piece"]))
    ordered = rows.sort_values(["sequence_id", "offset"])
    assert (ordered["offset"] == ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"]).all()
    assert ordered.groupby("sequence_id")["length"].sum().max() <= 1024
    assert ordered["sequence_id"].nunique() <= 1.02 * rows["length"].sum() / 1024 + 3
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(none)).count() == 0


PAGES = [(1, "u", "x" * 500), (2, "u", "y" * 50), (3, "v", "x" * 500), (4, "v", "y" * 50), (5, None, None), (6, "a\nb", "é" * 100000),
         (None, "u", "x" * 500), (7, "w", ""), (3, "v", "x" * 500)]


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_warc_chunks(spark, tmp_path, chunk):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    pages = pages.where(F.length("html") < 1000) if chunk == 7 else pages
    manifest = warc.write(warc.typed(pages), str(tmp_path), chunk).collect()
    rows = warc.chunks(spark.createDataFrame(manifest), str(tmp_path), chunk).collect()
    bodies = {}
    for r in sorted(rows, key=lambda r: r["chunk"]):
        if r["record_type"] == "response":
            assert len(r["bytes"]) <= chunk
            bodies[r["page_id"]] = bodies.get(r["page_id"], b"") + r["bytes"]
            assert r["digest_so_far"] == hashlib.sha256(bodies[r["page_id"]]).hexdigest()
    html = {i: (h or "").encode() for i, _, h in PAGES}
    assert bodies and all(html[i] == b for i, b in bodies.items() if i is not None)
    revisits = {(r["page_id"], r["refers_to"]) for r in rows if r["record_type"] == "revisit"}
    assert revisits == {(3, 1), (None, 1)}


def test_warc_folders():
    assert warc.arrow_uri("s3a://bucket/a") == "s3://bucket/a" and warc.arrow_uri("hdfs://name:8020/a") == "hdfs://name:8020/a"
    assert warc.arrow_uri("file:/a/b") == warc.arrow_uri("file:///a/b") == "file:///a/b"
    for folder in ("wasb://x/y", "/bare", "odd"):
        with pytest.raises(ValueError, match="can't be written"):
            warc.arrow_uri(folder)


def test_warc_place_and_number_of_records(spark, tmp_path):
    """A path without a scheme is that of the default file system; an archive with fewer records than were written is an error."""
    assert warc.qualified(spark, str(tmp_path)) == f"file:{tmp_path}" and warc.qualified(spark, "s3a://b/x") == "s3a://b/x"
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(20)], "page_id long, url string, html string").coalesce(1)
    manifest = spark.createDataFrame(warc.write(warc.typed(pages), f"file:{tmp_path}/a b").collect(), "archive string, records long")
    assert warc.chunks(manifest, f"{tmp_path}/a b").where("is_last").count() == 20
    with pytest.raises(Exception, match="holds 20 records, 21 were written"):
        warc.chunks(manifest.withColumn("records", F.col("records") + 1), f"{tmp_path}/a b").count()


def test_warc_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, list int")


def brute(rows, asked, k):
    use = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows if i is not None and v and None not in v
           and np.isfinite(v).all() and any(v)}
    out = {}
    for q in asked:
        if q in use:
            scores = {i: float(use[q] @ v / np.linalg.norm(use[q]) / np.linalg.norm(v)) for i, v in use.items() if i != q}
            out[q] = sorted(scores, key=lambda i: (-round(scores[i], 12), i))[:k]
    return out


def test_neighbours_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, [1.0, 0.5]), (9, [1.0, 0.5]), (10, [1.0])]
    got = neighbours.nearest(vectors(spark, [(*r, "x", 1) for r in rows]), 5, F.col("vec_id") % 3 == 0).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == brute([r for r in rows if r[0] != 10], [0, 3, 6, 9], 5)
    assert neighbours.nearest(vectors(spark, []), 5).count() == 0


def test_neighbours_recall(spark):
    r = np.random.default_rng(3)
    points = r.normal(size=(3000, 16)).astype(np.float32)
    points[500:1500] = points[0]  # a third of all rows is one vector
    rows = [(i, [float(x) for x in p], "x", 1) for i, p in enumerate(points)]
    got = neighbours.nearest(vectors(spark, rows), 5, F.col("vec_id") % 50 == 0, list_size=60).collect()
    want = brute(rows, range(0, 3000, 50), 5)
    found = {q: {x["vec_id"] for x in got if x["query_id"] == q} for q in want}
    assert sum(len(found[q] & set(v)) for q, v in want.items()) >= 0.9 * 5 * len(want)
    assert all(len(v) == 5 for v in found.values())


def test_neighbours_compare_opened_lists_only():
    """Each query meets the vectors of the lists that it opens, those who open all of a cell meet each vector once."""
    held = np.array([3, 3, 5, 7, 5])
    opens = [np.array([3]), None, np.array([3, 5, 7, 9]), np.array([5, 3]), np.array([8])]
    met = [(list(a), None if b is None else list(b)) for a, b in neighbours.meetings(held, opens)]
    assert met == [([1, 2], None), ([0, 3], [0, 1]), ([3], [2, 4])]


def test_neighbours_of_clusters_skip_lists(spark, monkeypatch):
    """Clustered vectors: most lists stay closed, also where many share a cell, and the nearest are found."""
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(40, 16))
    rows = [(i, list(map(float, middles[i % 40] + 0.2 * rng.normal(size=16)))) for i in range(4000)]
    asked, plain = [], neighbours.search_graph
    c = neighbours.fit(neighbours.unit(np.array([r[1] for r in rows])), 100)
    for i in range(0, 4000, 50):
        asked.append(len(plain(neighbours.unit(np.array([rows[i][1]]))[0].astype(np.float32), c.astype(np.float32), neighbours.graph(c))))
    assert np.mean(asked) < 0.25 * len(c)
    got = neighbours.nearest(vectors(spark, [(*r, "x", 1) for r in rows]), 5, F.col("vec_id") % 50 == 0, list_size=40).collect()
    u = neighbours.unit(np.array([r[1] for r in rows]))
    hits = 0
    for i in range(0, 4000, 50):
        sims = u @ u[i]
        sims[i] = -2
        hits += len(set(np.argsort(-sims, kind="stable")[:5]) & {r.vec_id for r in got if r.query_id == i})
    assert len(got) == 400 and hits >= 0.9 * 400


def test_neighbours_recall_beyond_64_lists(spark, monkeypatch):
    """Spread-out vectors, where a query's neighbours lie in more lists than a fixed number would open."""
    monkeypatch.setattr(neighbours, "CELL", 60)
    monkeypatch.setattr(neighbours, "ASKED", 20, raising=False)
    points = np.random.default_rng(4).normal(size=(6000, 32)).astype(np.float32)
    rows = [(i, [float(x) for x in p], "x", 1) for i, p in enumerate(points)]
    got = neighbours.nearest(vectors(spark, rows), 5, F.col("vec_id") % 100 == 0, list_size=10).collect()
    want = brute(rows, range(0, 6000, 100), 5)
    found = {q: {x["vec_id"] for x in got if x["query_id"] == q} for q in want}
    assert sum(len(found[q] & set(v)) for q, v in want.items()) >= 0.94 * 5 * len(want)


def mixture(spark):
    rows = [(i, "w " * (i % 7), "hot") for i in range(900)] + [(1000 + i, "a b c", "mid") for i in range(90)]
    rows += [(2000 + i, "a b", None) for i in range(10)] + [(3000, None, "void"), (3001, "", "void"), (None, "x y", "mid")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("goal", F.lit(1))


def test_mixing_weights(spark):
    rows = mixing.counted(mixture(spark))
    got = mixing.weights(rows, entropy=0.8, max_repeats=50.0).collect()
    use = [r for r in got if r["share"] > 0]
    a = use[0]["exponent"]
    norm = sum(r["share"] ** a for r in use)
    assert all(math.isclose(r["weight"], r["share"] ** a / norm) for r in use) and math.isclose(sum(r["weight"] for r in use), 1)
    entropy = -sum(r["weight"] * math.log(r["weight"]) for r in use) / math.log(len(use))
    assert math.isclose(entropy, 0.8, abs_tol=1e-6)
    limited = [r for r in mixing.weights(rows, entropy=1.0, max_repeats=3.0).collect() if r["share"] > 0]
    assert math.isclose(max(r["weight"] / r["share"] for r in limited), 3.0, rel_tol=1e-6)


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_mixing_draws(spark, block):
    docs = mixture(spark)
    rows = mixing.counted(docs)
    plan = {r["source"]: r for r in mixing.weights(rows, 0.8, 50.0).collect()}
    got = mixing.realise(rows, mixing.weights(rows, 0.8, 50.0), block).collect()
    for source, p in plan.items():
        drawn = [r for r in got if r["source"] == source]
        assert p["goal"] - 7 <= sum(r["tokens"] for r in drawn) <= p["goal"]
        times = {}
        for r in drawn:
            times.setdefault(r["pass"], []).append(r["doc_id"])
        full = {r["doc_id"] for r in rows.where("tokens > 0").collect() if r["source"] == source}
        assert all(len(v) == len(set(v)) and (k == max(times) or set(v) == full) for k, v in times.items())
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.realise(rows, mixing.weights(rows, 0.8, 50.0), block).collect()), key=str)


def test_mixing_whole_budget_and_empty(spark):
    out = mixing.mixed_docs(mixture(spark), entropy=0.8, max_repeats=50.0, budget=None)
    assert out.columns == ["doc_id", "text", "source", "goal"]
    had = mixture(spark).where("doc_id is not null and text like '%_%'").where(F.size(mixing.words_of(F.col("text"))) > 0)
    assert out.select("doc_id").distinct().where("doc_id is not null").count() == had.count()
    assert mixing.mix(mixture(spark).limit(0)).count() == 0


def test_mixing_keeps_rows_without_id_and_unlike_texts_of_one(spark):
    rows = [(None, "a b c", "x"), (None, "d e", "x"), (None, "d e", "x"), (1, "f g", "x"), (1, "h", "x"), (1, "h", "x"), (2, "", "x"), (3, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed_docs(docs, entropy=0.9, budget=None).select("doc_id", "text").collect()
    assert sorted(tuple(r) for r in out if r["doc_id"]) == [(1, "f g"), (1, "h")]
    assert sorted(r["text"] for r in out if r["doc_id"] is None) == ["a b c", "d e"]
    assert mixing.mixed_docs(docs.limit(0), entropy=0.9, budget=None).count() == 0


def test_licences(spark):
    rows = [(1, "Some prose.\nReleased under the MIT License.\nMore."), (2, "She lost her driving licence in the public library."), (3, None),
            (4, ""), (5, "Released under the Apache License, Version 2.0"), (6, "All rights reserved."), (6, "All rights reserved.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gram", F.lit(1))
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in licences.scan(docs).collect())
    assert got == [(1, 1, "MIT"), (2, 0, "unknown"), (5, 0, "Apache-2.0"), (6, 0, "All-rights-reserved"), (6, 0, "All-rights-reserved")]
    assert licences.scan(docs.limit(0)).count() == 0


def test_licences_in_any_spelling(spark):
    forms = (str.upper, str.lower, str.title, lambda t: t.replace(" ", "-"))
    rows = [(f, form(t)) for f, texts in licences.TEMPLATES.items() for t in texts for form in forms]
    rows += [("CC-BY", "cc-by 4.0"), ("CC-BY-SA", "CC-BY-SA 4.0"), ("CC-BY", "Creative Commons Attribution 4.0")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["family"] for r in licences.scan(docs).collect()}
    assert len(got) == len(rows)
    wrong = [(f, t, got[i]) for i, (f, t) in enumerate(rows[:-3]) if got[i] != f]
    assert not wrong


def test_licences_without_a_stem(spark):
    rows = [(1, "To the extent possible under law, the author has waived all rights to this work."), (2, "Prose.\n\n \nMore prose, and nothing else."),
            (3, "Any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"),
            (4, "The use in source and binary forms, with or without modification, are provided that the following conditions are met")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert docs.where(licences.has_stem(F.col("text"))).isEmpty()
    got = {r["doc_id"]: r["family"] for r in licences.scan(docs).collect()}
    assert got == {1: "CC0", 3: "MIT", 4: "BSD"}


def test_licences_held_out(spark):
    rows = [(i, t, f) for i, (t, f) in enumerate(licences.examples(seed=77, each=20))]
    got = {r["doc_id"]: r["family"] for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string, f string")).collect()}
    named = [(f, got.get(i, "unknown")) for i, _, f in rows if got.get(i, "unknown") != "unknown"]
    assert sum(a == b for a, b in named) >= 0.95 * len(named)
    of_family = [(f, got.get(i, "unknown")) for i, _, f in rows if f != "unknown"]
    assert sum(a == b for a, b in of_family) >= 0.8 * len(of_family)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert out["length"].max() <= 1024 and out["doc_id"].nunique() > 100
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 and toxic = 0")
    assert set(out["doc_id"]) <= {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert good.where(F.col("doc_id").isin([int(x) for x in out["doc_id"].unique()])).count() > 0.7 * good.count()


def test_pipeline_stages_take_odd_documents(spark, tmp_path):
    import corpus_pipeline

    text = " ".join(f"word{i}" for i in range(60)) + "."
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, None, None, None, None), (None, text + " x.", "en", None, 3), (4, "", "de", "b", 0)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{len(some)}-{k}")
            out = stage(spark, docs, None)
            assert k == 4 or out.columns == docs.columns
            out.write.parquet(path)
            docs = spark.read.schema(out.schema).parquet(path)
        # The row without an id is kept by every stage, mixing too.
        assert docs.count() == (2 if some else 0)


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
