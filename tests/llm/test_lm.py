"""Word counts against a dict, the attention model against finite differences, sums to one and held-out text."""

import collections
import cProfile
import math
import pstats
import zlib

import numpy as np
import pytest

from larkspur.llm import lm


def brute(rows):
    out, count = [], collections.Counter()
    cut = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    for i, t in rows:
        if not held(i):
            count.update(cut(t))
    n, v = sum(count.values()), len(count)
    for i, t in rows:
        w = cut(t)
        out.append((i, held(i), len(w), sum(count[x] > 0 for x in w), n,
                    round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
    return sorted(out, key=repr)


def base(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in df.collect()), key=repr)


ODD = [(0, "The cat"), (1, "the CAT sat"), (2, None), (3, ""), (4, " \t\n"), (5, "é É   x y"), (6, "w" * 5000), (7, "z " * 4000),
       (None, "the cat"), (1, "the CAT sat"), (9, "unseen words here"), (16, "the dog"), (21, "the dog \x1c dog"), (-5, "the")]


def test_base_scores_and_odd_rows(spark):
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in ODD], "doc_id long, text string, n long, word string")
    out = lm.score(df, *lm.fit(df))
    assert base(out) == brute(ODD)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out.collect())


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm, "COMMON_WORDS", 2)
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    assert base(lm.score(df, *lm.fit(df))) == brute(ODD)


def test_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(none, *lm.fit(none)).collect() == []


def test_held_out_documents_are_likelier_than_by_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    vocabulary, model, counted = lm.fit(docs)
    rows = lm.score(docs, vocabulary, model, counted).where("held_out").toPandas()
    plain = lm.score(docs, vocabulary, lm.start(vocabulary), counted).where("held_out").toPandas()
    assert base(lm.score(docs, vocabulary, model, counted)) == brute(
        [tuple(r) for r in docs.select("doc_id", "text").collect()])
    print("log10 per document, trained and by counts:", rows["score"].sum(), plain["score"].sum())
    assert rows["score"].sum() > 0.97 * plain["score"].sum()


def test_all_learning_documents_are_trained_on(spark):
    docs = lm.slim(spark.createDataFrame([(i, f"word{i} and more " * (i % 40)) for i in range(300)], "doc_id long, text string"))
    learning = docs.where("not held_out")
    total = lm.id_counts(lm.word_counts(learning))
    seen = np.zeros(lm.FILL + 1, np.int64)
    for turn in range(lm.ROUNDS):
        for r in lm.windows(learning, turn).collect():
            np.add.at(seen, np.frombuffer(r["ids"], "<u2")[1:], 1)
    assert (seen[:lm.IDS] == total).all()


def model_of(seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = lm.Vocabulary(rng.integers(0, 50, lm.IDS))
    m = lm.start(vocabulary)
    return vocabulary, {k: (x + rng.normal(0, 0.2, x.shape)).astype(np.float64) for k, x in m.items()}, rng


def test_gradients():
    _, m, rng = model_of()
    rows, cls = rng.integers(0, lm.INPUTS, (3, 10)), rng.integers(0, lm.GROUPS * lm.MEMBERS, (3, 10))
    cls[2, 4:] = -1
    _, g = lm.gradients(m, rows, cls)
    for name in lm.NAMES:
        place = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        ends = []
        for step in (1e-5, -1e-5):
            other = {k: x.copy() for k, x in m.items()}
            other[name][place] += step
            ends.append(lm.gradients(other, rows, cls)[0])
        assert g[name][place] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=2e-3)


@pytest.mark.parametrize("targets", [0, 1, 15, 16, 17, 33, 48])
def test_gradients_of_groups_of_many_targets(targets):
    """Two groups, of which one has as many targets; against finite differences of their own vectors."""
    _, m, rng = model_of()
    rows, cls = rng.integers(0, lm.INPUTS, (3, 20)), np.full((3, 20), -1)
    cls.ravel()[:targets] = 5 * lm.MEMBERS + rng.integers(0, lm.MEMBERS, targets)
    cls[2, 17:] = 30 * lm.MEMBERS + 3
    _, g = lm.gradients(m, rows, cls)
    for name in ("Wc", "bc"):
        assert not np.delete(g[name], [5, 30], axis=0).any()
        for i in (5, 30):
            place = i, *np.unravel_index(np.abs(g[name][i]).argmax(), g[name][i].shape)
            ends = []
            for step in (1e-5, -1e-5):
                other = {k: x.copy() for k, x in m.items()}
                other[name][place] += step
                ends.append(lm.gradients(other, rows, cls)[0])
            assert g[name][place] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=2e-3)


def test_a_step_of_training_has_no_loop_over_groups():
    """Calls of a step, with targets in all groups and in one of them."""
    vocabulary, m, rng = model_of()
    m, calls = {k: x.astype(np.float32) for k, x in m.items()}, []
    for groups in (1, lm.GROUPS):
        cls = rng.integers(0, groups * lm.MEMBERS, (lm.BATCH, lm.WINDOW))
        profile = cProfile.Profile()
        profile.runcall(lm.train, m, rng.integers(0, lm.INPUTS, cls.shape), cls)
        calls.append(pstats.Stats(profile).total_calls)
    assert calls[1] < 1.1 * calls[0]


@pytest.mark.parametrize("piece", [1, 50, 90])
def test_texts_scored_in_pieces(monkeypatch, piece):
    vocabulary, m, rng = model_of()
    begin = np.concatenate([[0], np.cumsum([1, 40, 40, 10, 200, 1, 1, 50])])
    ids = rng.integers(0, 50000, begin[-1])
    want = lm.text_scores(m, vocabulary, ids, begin)
    monkeypatch.setattr(lm, "PIECE", piece)
    assert lm.text_scores(m, vocabulary, ids, begin) == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("size", [1, 59, 61, 1e4])
def test_softmax_of_large_scores(size):
    """Against 64 bits and the scores less their maxima."""
    rng = np.random.default_rng(5)
    z, which = (rng.uniform(-1, 1, (40, 8)) * size).astype(np.float32), rng.integers(0, 8, 40)
    want = z.astype(float) - z.max(axis=1, keepdims=True)
    p = np.exp(want) / np.exp(want).sum(axis=1, keepdims=True)
    loss, down = lm.softmax_loss(z.copy(), which, np.float32(0.5))
    assert loss == pytest.approx(-(want - np.log(np.exp(want).sum(axis=1, keepdims=True)))[np.arange(40), which].sum(), rel=1e-4)
    assert down == pytest.approx(0.5 * (p - np.eye(8)[which]), abs=1e-5)


@pytest.mark.parametrize("size", [1, 40])
def test_attention_of_large_scores(size):
    _, m, rng = model_of()
    m["Wi"] = m["Wi"] * size
    rows = rng.integers(0, lm.INPUTS, (2, 20))
    got, want = (lm.attend({k: x.astype(t) for k, x in m.items()}, rows)[4] for t in (np.float32, np.float64))
    assert got == pytest.approx(want, abs=2e-3) and got.sum(axis=2) == pytest.approx(1, abs=1e-5)


def test_texts_are_encoded_together(monkeypatch):
    """Ids and windows of each text by itself; new words are learned once for all texts, not once a text."""
    raws, calls, learn = [(f"The w{i}  unseen{i} word " * (i % 25)).encode() for i in range(200)], [], lm.Subwords.learn
    monkeypatch.setattr(lm.Subwords, "learn", lambda self, found: calls.append(1) or learn(self, found))
    coder, plain, windows = lm.Subwords(), lm.Subwords(), []
    _, size, ids, begin = coder.encoded(raws)
    assert len(calls) == 1 and size.tolist() == [len(lm.words(x)) + 1 for x in raws]
    for k, raw in enumerate(raws):
        one = np.append(plain.sequence(plain.entries(lm.words(raw)))[0], lm.END_ID)
        assert ids[begin[k]:begin[k + 1]].tolist() == one.tolist()
        s = [lm.END_ID, *one.tolist()]
        windows += [(s[at:at + lm.WINDOW + 1] + [lm.FILL] * lm.WINDOW)[:lm.WINDOW + 1] for at in range(0, len(s) - 1, lm.WINDOW)]
    assert lm.cut_up(ids, begin).tolist() == windows


def test_probabilities_of_the_next_id_sum_to_one():
    vocabulary, m, rng = model_of()
    h = lm.attend(m, rng.integers(0, lm.INPUTS, (1, 20)))[-1][0, -1:]
    logs = lm.class_logs(m, np.repeat(h, lm.IDS, 0), vocabulary.cls)
    assert (10 ** (logs / math.log(10) + vocabulary.inside)).sum() == pytest.approx(1)


def test_each_id_is_scored_once_with_what_came_before():
    """Windows against one id at a time, and texts together against texts alone."""
    vocabulary, m, rng = model_of()
    texts = [np.append(rng.integers(0, 50000, n), lm.END_ID) for n in (0, 1, 14, 15, 16, 17, 30, 31, 32, 33, 64, 300)]
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = lm.text_scores(m, vocabulary, np.concatenate(texts), begin)
    for t, value in zip(texts, got):
        before, want = np.concatenate([[lm.END_ID], t[:-1]]), 0
        for k in range(len(t)):
            a = max(0, k // (lm.WINDOW // 2) - 1) * (lm.WINDOW // 2)
            h = lm.attend(m, vocabulary.row[before[a:k + 1]][None])[-1][0, -1:]
            want += lm.class_logs(m, h, vocabulary.cls[t[k:k + 1]])[0] / math.log(10) + vocabulary.inside[t[k]]
        assert value == pytest.approx(want)
