"""Substring and suffix dedup, Jaccard classes, quality counts and personal data against brute force."""

import os
import random
import re
import sys
import textwrap

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import helpers  # noqa: E402
from larkspur.llm import jaccard, pii, quality, repeats, substring, suffix  # noqa: E402

SCHEMA = "doc_id long, text string, n_words string, h string, kept int"


def table(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", None, None) for i, t in rows], SCHEMA)


def prose(seed=1, docs=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(200)]

    def text(n):
        return " ".join(r.choice(vocabulary) + r.choice(["", "", "", "\n", "\t", "."]) for _ in range(n))

    passage, base = text(40), text(150)
    rows = [(i, text(r.choice([1, 3, 20, 60, 200]))) for i in range(docs)]
    for i in range(docs, docs + 15):
        w = base.split(" ")
        w[r.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    rows += [(docs + 20 + k, text(10) + " " + passage + " " + text(10)) for k in range(8)]
    rows += [(docs + 40 + k, base) for k in range(6)] + [(docs + 50, "aa " * 400), (docs + 51, "x" * 3000), (docs + 52, "Aa " * 6),
                                                         (docs + 53, "one two"), (docs + 54, "ONE two"), (docs + 60, "")]
    return rows


ROWS = prose()
ODD = [(None, "no id at all " * 20), (None, None), (900, None)]


@pytest.mark.parametrize("hot", [5000, 2])
@pytest.mark.parametrize("n, shortest", [(13, 6), (26, 3), (5, 6)])
def test_substring(spark, monkeypatch, n, shortest, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    got = substring.dedup(table(spark, ROWS + ODD), n, shortest).collect()
    assert sorted(tuple(r)[:4] for r in got if r["doc_id"] is not None) == helpers.substring(ROWS + ODD[2:], n)
    whole = [r for r in got if r["doc_id"] is None]
    assert sorted(r["n_words"] for r in whole) == [0, 80] and all(r["n_removed"] == 0 for r in whole)


def test_substring_levels_double():
    assert substring.levels(50, 6) == [6, 12, 25] and substring.levels(13, 6) == [6] and substring.levels(5, 6) == [5]


@pytest.mark.parametrize("hot", [5000, 2])
@pytest.mark.parametrize("n, short", [(200, 64), (30, 10)])
def test_suffix(spark, monkeypatch, n, short, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    out = suffix.dedup(table(spark, ROWS + ODD), n, short).withColumn("k", F.size("removed"))
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["k"], r["kept_sha256"]) for r in out.collect()]
    assert sorted(r for r in got if r[0] is not None) == helpers.suffix(ROWS + ODD[2:], n)
    assert sorted(r[2] for r in got if r[0] is None) == [0, 0]


@pytest.mark.parametrize("hot", [5000, 2])
def test_suffix_repeated_rows_are_one_document(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = ROWS + [(901, " ".join(f"alone{k}" for k in range(100)))]
    out = suffix.dedup(table(spark, rows + rows[-1:] * 3 + rows[:70]), 200, 64).withColumn("k", F.size("removed"))
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["k"], r["kept_sha256"]) for r in out.collect()]
    assert sorted(set(got)) == helpers.suffix(rows, 200) and len(got) == len(rows) + 73


def test_suffix_buckets_are_bounded_by_places(spark, monkeypatch):
    """A passage in very many places of two documents is hot, and the rest is dealt by its places."""
    monkeypatch.setattr(repeats, "HOT", 100)
    monkeypatch.setattr(suffix, "BUCKET", 100)
    r, dealt, runs = random.Random(5), [], suffix.window_runs
    parts = ["".join(r.choice("abcdefgh") for _ in range(260)) for _ in range(12)]
    rows = [(d, "".join(parts[0] + f" {d} {k} " for k in range(120))) for d in range(2)]
    rows += [(5 + d, "".join(p + f" {d} {k} " for k in range(20) for p in parts[1:])) for d in range(2)]
    monkeypatch.setattr(suffix, "window_runs", lambda *x: dealt.append(runs(*x)) or dealt[0])
    out = suffix.dedup(table(spark, rows), 200, 64).withColumn("k", F.size("removed"))
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["k"], r["kept_sha256"]) for r in out.collect()) == helpers.suffix(rows, 200)
    assert dealt[0].groupBy("h").count().agg(F.max("count")).first()[0] <= 100
    sizes = [r["count"] for r in dealt[0].groupBy("bucket").count().collect()]
    assert len(sizes) > 5 and max(sizes) <= sum(sizes) / 2


def test_suffix_hot_windows_travel_as_runs(spark, monkeypatch):
    """Copies, near copies and a shared passage, all hot: rows are runs and parts of them, far fewer than windows."""
    monkeypatch.setattr(repeats, "HOT", 10)
    r = random.Random(8)
    base, passage = ("".join(r.choice("abcdefgh ") for _ in range(k)) for k in (900, 300))
    rows = [(i, base) for i in range(30)]
    for i in range(30, 60):
        at = r.randrange(300, 600)
        rows.append((i, base[:at] + f"#{i}#" + base[at:]))
    rows += [(i, f"{i}" * 40 + passage + f"-{i}-" * 40) for i in range(60, 90)]
    docs = table(spark, rows)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["removed"], r["kept_sha256"]) for r in suffix.dedup(docs, 200, 64).collect()]
    assert sorted((*x[:3], len(x[3]), x[4]) for x in got) == helpers.suffix(rows, 200)
    windows = sum(z - a - 199 for x in got for a, z in x[3])
    assert suffix.repeated(docs, 200, 64).count() < windows / 10


def test_levels_grow_geometrically():
    r = random.Random(2)
    text = bytes(r.choice(b"ab") for _ in range(4000))
    index, n = suffix.Levels(text, 12), 12
    for a in range(0, 3989, 100):
        index.add(suffix.np.arange(a, min(a + 100, 3989)))
    starts = index.found()
    every = [text[k:k + n] for k in range(3989)]
    again = {x for x in every if every.count(x) > 1}
    assert {every[k] for k in starts} == again and len(index.levels) <= 8


def test_jaccard(spark):
    rows = ROWS + [(900, None)]
    got = sorted(tuple(r) for r in jaccard.classes(table(spark, rows)).collect())
    assert got == helpers.jaccard(rows)


def test_jaccard_tallies_run_no_job_for_each_partition(spark):
    """64 parts of counts and of bits, each in a partition of its own."""
    ids = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    partitions, part = spark.conf.get("spark.sql.shuffle.partitions"), jaccard.CHUNK
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("tallies", "")
    try:
        jaccard.CHUNK = 64
        counts = jaccard.tally(ids, lambda batch, a, b: jaccard.ids_of(batch, a, b) % 4096, 4096)
        flags = jaccard.tally(ids, lambda batch, a, b: jaccard.ids_of(batch, a, b) * 3, 64 * 4096, flags=True)
    finally:
        jaccard.CHUNK = part
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.sparkContext._jsc.clearJobGroup()
    assert counts.tolist() == [1] * 3000 + [0] * 1096
    assert flags.nonzero()[0].tolist() == list(range(0, 9000, 3))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("tallies"))
    print("jobs of two tallies:", jobs)
    assert jobs <= 4


def test_jaccard_reads_texts_three_times(spark, monkeypatch):
    """Once for keys and counts of tokens, once for heads, once for the sets that are compared."""
    read, known = spark.sparkContext.accumulator(0), jaccard.known

    def counted(docs):
        def run(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        return known(docs).mapInArrow(run, "doc_id long, text string")

    monkeypatch.setattr(jaccard, "known", counted)
    got = sorted(tuple(r) for r in jaccard.classes(table(spark, ROWS)).collect())
    assert got == helpers.jaccard(ROWS)
    assert read.value == 3 * len(ROWS)


@pytest.mark.parametrize("size", [1, 40, 1 << 18])
def test_jaccard_sets_of_blocks(size):
    """Distinct hashes in order, by document, whatever the block; equal to those of a document by itself."""
    texts = [t for _, t in ROWS] + [None, "", "ab", "Z z Z z Z z", "É é É é É É"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    got = {}
    for a, b in repeats.blocks(batch, size):
        doc, h = jaccard.shingle_sets(batch, a, b)
        for k in range(b - a):
            got[a + k] = h[doc == k].tolist()
    for i, t in enumerate(texts):
        w = helpers.words(re.sub("[A-Z]", lambda m: m.group(0).lower(), t or ""))
        assert len(got[i]) == len({tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))}) if w else not got[i]
        assert got[i] == sorted(jaccard.shingle_sets(batch.slice(i, 1), 0, 1)[1].tolist())


def test_jaccard_odd_rows(spark):
    got = jaccard.classes(table(spark, [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f")]))
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got.collect()) == [(0, 0), (2, 2), (3, 2), (3, 2)]
    kept = jaccard.one_of_each(table(spark, [(3, "a b c d e f"), (3, "a b c d e f"), (2, "A b c d e f"), (5, "")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5]


def test_empty_tables(spark):
    none = table(spark, [])
    for out in (substring.dedup(none), suffix.dedup(none), jaccard.classes(none), quality.clean(none), pii.scan(none)):
        assert out.count() == 0


def test_quality_counts(spark):
    got = {r["doc_id"]: r for r in quality.clean(table(spark, ROWS + [(900, None), (901, "a b a b a b | > #\n\n x \n x ")])).collect()}
    for i, text in ROWS + [(900, None), (901, "a b a b a b | > #\n\n x \n x ")]:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == helpers.quality(text)


def test_quality_lines(spark):
    r = random.Random(4)
    prose_ = " ".join("".join(r.choice("abcdefg") for _ in range(5)) for _ in range(80)) + "."
    menu, shout = "Home | News | Sports | Login | Contact | About us", "BUY!! NOW!! THIS!! IS!! CHEAP!!"
    rows = [(1, prose_), (2, prose_ + "\n" + menu), (3, "\n".join([menu] * 3 + [shout] * 40)), (4, prose_ + "\nAll rights reserved.")]
    got = {x["doc_id"]: x for x in quality.clean(table(spark, rows)).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3, 4)] == [True, True, False, True]
    assert got[2]["lost_navigation"] == 1 and got[2]["clean_text"] == prose_ and got[4]["lost_boilerplate"] == 1
    kept = quality.kept_docs(table(spark, rows)).orderBy("doc_id").collect()
    assert [x["text"] for x in kept] == [prose_] * 3 and kept[0]["n_words"] == "x"


def test_quality_separators_at_the_limit(spark):
    """Ten words with three separators are navigation, as in SQL (>=); eleven words are not."""
    rows = [(1, "a | b | c | d e f g."), (2, "a | b | c | d e f g h.")]
    got = {x["doc_id"]: x["lost_navigation"] for x in quality.clean(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 0}


def test_quality_keeps_wrapped_and_other_scripts(spark):
    r, rows = random.Random(6), []
    for width, capitals in ((60, False), (76, False), (70, True)):
        words = []
        for _ in range(12):
            s = ["".join(r.choice("abcdefg") for _ in range(r.randint(2, 8))) for _ in range(20)]
            s = [w.title() if capitals and k % 3 == 0 else w for k, w in enumerate(s)]
            words += [s[0].title(), *s[1:-1], s[-1] + "."]
        rows.append((len(rows), textwrap.fill(" ".join(words), width)))
    for letters, end in (("कखगघचछजट", "।"), ("ابتثجحخد", "۔"), ("ሀለሐመሠረሰ", "።"), ("ကခဂဃင", "။")):
        for lines in ("\n", " "):
            rows.append((len(rows), lines.join(" ".join(
                "".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(12)) + end for _ in range(8))))
    fragments = "\n".join(" ".join("".join(r.choice("abcdefg") for _ in range(5)) for _ in range(4)) for _ in range(30))
    kept = {x["doc_id"]: x["text"] for x in quality.kept_docs(table(spark, [*rows, (len(rows), fragments)])).collect()}
    assert kept == dict(rows)


def test_quality_labels(spark, sf_dir):
    kept = quality.clean(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("not base_failed")
    both = kept.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    wrong = both.where((F.col("kept") != (F.col("quality") == 1))).count()
    assert wrong <= 0.01 * both.count()


PERSONAL = [
    "a@b.co_x@y.zz", "+1 (743) 555-3824 and 1.2.3.4.5.6.7.8 300.1.1.1", "4465758382889437 é 4465 7583 8288 9437", "1 " * 20000,
    "+1" * 3000 + " " * 5000, "x" * 50000 + "@", "a@b.c " * 700, "", None, "000255.1.1.1 +1-2 +12345678901234567890 ", "😀 x@y.z",
]


def test_personal_patterns(spark):
    rows = list(enumerate(PERSONAL))
    out = pii.scan(table(spark, rows))
    fixed = F.concat(*[F.col("pii")[k] for k in pii.KINDS])
    got = out.select("doc_id", *[F.size(F.col("pii")[k]) for k in pii.KINDS], F.sha2(pii.listed(fixed).cast("binary"), 256)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {i: helpers.personal(t) for i, t in rows}


def test_personal_added(spark):
    secret = "24be64439e3e49cf46b2d7c90f3602a3d0b9ffff"
    rows = [(1, f'the token = "{secret}" and phone 212-555-0199'), (2, "Plain words at noon. Then 12 apples in version 2.0."), (3, None)]
    out = {r["doc_id"]: r["text"] for r in pii.redact(table(spark, rows)).collect()}
    assert secret not in out[1] and "212-555-0199" not in out[1] and out[2] == rows[1][1] and out[3] is None


def test_personal_held_out(spark):
    """Accuracy on examples of another seed than the trees were fitted on."""
    score, limits = pii.fitted(spark)
    rows = spark.createDataFrame(pii.examples(seed=99, each=60), "kind string, text string, before string, label int")
    named = pii.features(F.col("kind"), F.col("text"), F.col("before"))
    got = rows.select("kind", "label", *[c.alias(k) for k, c in named.items()]).select("kind", "label", score({k: F.col(k) for k in named}).alias("s"))
    flagged = [(r["label"], r["s"] >= limits[r["kind"]]) for r in got.collect()]
    assert sum(y for y, f in flagged if f) >= 0.9 * sum(f for _, f in flagged) and sum(f for _, f in flagged) > 100


def near_copies(seed, n=260):
    """Families of texts whose members differ by few to many words, so that many pairs lie near the limit, and chains."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []
    for family in range(3):
        base = [r.choice(vocabulary) for _ in range((60, 150, 400)[family])]
        for _ in range(n // 4):
            w = list(base)
            for _ in range(r.randint(0, len(w) // 30)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            rows.append(" ".join(w))
    chain = [r.choice(vocabulary) for _ in range(120)]
    for _ in range(n // 4):
        chain = chain[3:] + [r.choice(vocabulary) for _ in range(3)]
        rows.append(" ".join(chain))
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, members", [(1, 128), (2, 5)])
def test_jaccard_near_the_limit(spark, monkeypatch, seed, members):
    monkeypatch.setattr(jaccard, "MEMBERS", members)
    rows = near_copies(seed)
    got = sorted(tuple(r) for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == helpers.jaccard(rows)
    assert 1 < len({c for _, _, c in got}) < 200


def test_jaccard_near_copies_that_do_not_link_are_no_rows_of_pairs(spark, monkeypatch):
    """Copies changed in so many places that few link: what is asked for grows with them, not with their pairs."""
    r, asked, meet = random.Random(12), [], jaccard.meet
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(150)]

    def changed(words, places):
        words = list(words)
        for k in r.sample(range(len(words)), places):
            words[k] = f"c{r.randrange(10 ** 6)}"
        return words

    texts = [changed(base, r.choice([5, 6, 7])) for _ in range(120)] + [changed(base, 2) for _ in range(30)]
    texts += [changed(t, r.choice([2, 3])) for t in texts[:25]]
    rows = list(enumerate(" ".join(t) for t in texts))
    monkeypatch.setattr(jaccard, "meet", lambda asks, *x, **y: asked.append(asks.count()) or meet(asks, *x, **y))
    got = sorted(tuple(x) for x in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == helpers.jaccard(rows)
    assert 50 < len({c for _, _, c in got}) < 150
    assert asked[-1] < 10 * len(rows)


@pytest.mark.parametrize("n", [1, 3, 60, 400, 1500])
def test_parities_never_part_sets_that_link(n):
    """Bits that differ are at most the tokens of one set only, also between sizes of unlike numbers of bits."""
    r = np.random.default_rng(n)
    for _ in range(200):
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        same = int(r.integers(0, n + 1))
        b = np.concatenate([a[:same], r.integers(0, 1 << 63, int(r.integers(0, n // 3 + 2)), dtype=np.uint64)])
        if not len(b):
            continue
        x, y = jaccard.parities(a), jaccard.parities(b)
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(jaccard.folded(x, size) ^ jaccard.folded(y, size)).sum())
        both, total = same, len(a) + len(b)
        assert apart <= total - 2 * both
        if 100 * both >= 80 * (total - both):
            assert apart <= jaccard.most_apart(len(a), len(b))


def test_size_classes_of_sets_that_link_are_neighbours():
    n = np.arange(1, 200_000)
    k = np.floor(np.log(n) / np.log(jaccard.STEP))
    smallest = -(-80 * n // 100)
    assert (k - k[smallest - 1] <= 1).all()
