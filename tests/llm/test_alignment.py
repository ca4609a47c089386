"""Token alignment against a version that compares every pair of tokens, and against the tokenizers themselves."""

import collections
import hashlib

import numpy as np
import pytest

from larkspur.llm import alignment as al


def tokens(text):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(c): c for c in printable} | {chr(256 + k): c for k, c in enumerate(x for x in range(256) if x not in printable)}
    raw = (" " + text).encode()
    a = left.encode(" " + text, add_special_tokens=False).ids
    b = right.encode(text)
    a_raw = [bytes(back[c] for c in left.id_to_token(i)) for i in a]
    b_raw = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, right.id_to_piece(i)) for i in b)]
    if not text or b"".join(a_raw) != raw or b"".join(b_raw) != raw:
        return [], [], []
    ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_raw, b_raw)]
    groups, at = [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        group = []
        for k, ids in enumerate((a, b)):
            n = sum(e <= end for e in ends[k])
            group.append(ids[at[k]:n])
            at[k] = n
        groups.append(group)
    return a, b, groups


def brute(rows):
    linked = {}
    for k, (i, text) in enumerate(rows):
        a, b, groups = tokens(text or "")
        pairs = collections.Counter((x, y) for g in groups for x in g[0] for y in g[1])
        linked[k] = (i, a, b, groups, pairs)
    held = collections.defaultdict(collections.Counter)
    for i, _, _, _, pairs in linked.values():
        if i is not None:
            held[i] |= pairs
    count = collections.Counter(p for pairs in held.values() for p in pairs)
    most = collections.defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for i, a, b, groups, pairs in linked.values():
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        own = held[i] if i is not None and a else {}
        out.append((i, len(a), len(b), len(groups), sum(pairs.values()), sum(n for p, n in own.items() if count[p] == most[p[0]]),
                    sum(n * count[p] for p, n in own.items()), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


ODD = [
    (0, "The cat sat on the mat."), (1, "the cat sat on the mat, the cat"), (2, None), (3, ""), (4, " "), (5, "  two  spaces\n\n\ttab"),
    (6, "naïve café 東京 😀 ﬁ ½"), (7, "<|endoftext|> </s> <s> <0x41>"), (8, "a▁b"), (9, "x" * 3000), (1, "the cat sat on the mat, the cat"),
    (10, "une même phrase"), (10, "another text of one id, the cat the cat"), (None, "the cat sat"), (4095, "the cat"), (4096, "the cat"),
    (-1, "the cat"), (1 << 40, "the cat"), (11, "\x00\x01 bell"), (12, "ﬀ"), (13, " no break"), (14, "the " * 700),
]


def got(spark, rows, **k):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, pair string, block int")
    return sorted((tuple(r) for r in al.align(df, **k)[0].collect()), key=repr)


def test_alignment_equals_brute_force(spark):
    assert got(spark, ODD) == brute(ODD)


def test_alignment_of_documents_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(spark, rows) == brute(rows)


def test_alignment_in_many_partitions_and_small_steps(spark, monkeypatch):
    monkeypatch.setattr(al, "EXPAND", 5)
    monkeypatch.setattr(al, "HOLD", 7)
    rows = ODD + [(k, "the cat sat on a hot tin roof") for k in range(20, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out, index, counts = al.align(df)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows)
    assert index.groupBy("pair", "block").count().where("count > 1").count() == 0
    per = {r["a"]: 0 for r in counts.select("a").distinct().collect()}
    assert counts.where("is_best").select("a").distinct().count() == len(per)


def test_alignment_of_nothing(spark):
    assert got(spark, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_postings_round_trip(seed):
    r = np.random.default_rng(seed)
    n = 5000
    pair, block, doc = r.integers(0, 6, n) ** 2, r.integers(0, 2, n), r.integers(0, (30, 300, 4096, 2)[seed], n)
    times = r.integers(1, (2, 3, 1000, 70)[seed], n)
    want = {}
    for p, b, d, t in zip(pair.tolist(), block.tolist(), doc.tolist(), times.tolist()):
        want[p, b, d] = max(want.get((p, b, d), 0), t)
    batch = al.to_postings(pair, block, doc, times)
    row, back, number = al.from_postings(batch)
    p, b = (np.asarray(batch.column(k))[row].tolist() for k in (0, 1))
    assert dict(zip(zip(p, b, back.tolist()), number.tolist())) == want and len(row) == len(want)


def test_chunks_give_what_whole_texts_give(monkeypatch):
    """Any text put together from remembered chunks is aligned as if it were read whole."""
    monkeypatch.setattr(al, "REMEMBER", 50)
    r = np.random.default_rng(5)
    parts = ["the", "The", "naïve", "東京", "x" * 99, "x" * 101, "a\nb", "\n", "\t", "", "ﬁ", "'s", "1,000.5", "<0x41>", "▁", " ", "é́", "don't",
             " ", "a ", "​", "😀😀", "</s>", "...", "\r\n"]
    a, b = al.byte_level(None, al.LEFT), al.pieces(None, al.RIGHT)
    numbers = al.id_texts(max(len(a.table), len(b.table)))
    chunks, used = al.Chunks(a, b, numbers), 0
    for _ in range(60):
        made = [" ".join(parts[k] for k in r.integers(0, len(parts) if r.random() < 0.3 else 9, r.integers(1, 12))) for _ in range(20)]
        chunks.prepare(made)
        for t in made:
            got = chunks.aligned(t)
            if got:
                used += 1
                want = al.aligned(a, b, numbers, t)
                assert got[:4] == want[:4] and np.array_equal(np.concatenate(got[4]), np.concatenate(list(want[4]))), t
    assert chunks.usable and used > 100
