"""Removal of repeated strings against brute force over all of them."""

import hashlib
import random

import numpy as np
import pytest

from lexweave.llm import queries, suffix_dedup

SHAPE = "doc_id long, text string, slice long, n long, kind string"


def plain(texts, length=100):
    """(bytes, removed, spans, digest) of each text, the texts in order."""
    seen, out = set(), []
    for t in texts:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            else:
                seen.add(s)
        rest = bytes(b for b, g in zip(data, gone.tolist()) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed, n=120):
    """Copies, near copies, shared passages with all kinds of surroundings, periodic texts, long and empty ones."""
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "é", "日本", "the", "of", "\n", "x"]
    prose = lambda k: " ".join(rng.choices(words, k=k)) + str(rng.random())
    shared = [prose(rng.randrange(8, 60)) for _ in range(4)]
    out = ["", None, "a" * 500, "a" * 99, "a" * 100, "ab" * 300, "x" * 50 + "a" * 120, shared[0] * 3, "\0" * 130, "\0" * 260]
    for _ in range(n):
        kind = rng.randrange(6)
        if kind == 0:
            out.append(prose(rng.randrange(100)))
        elif kind == 1:
            out.append(rng.choice(out))
        elif kind == 2 and (t := rng.choice(out)):
            i = rng.randrange(len(t))
            out.append(t[:i] + rng.choice(["", "Q", "zz"]) + t[i + rng.randrange(2) :])
        elif kind == 3:
            out.append(prose(rng.randrange(20)) + rng.choice(shared) + prose(rng.randrange(20)))
        elif kind == 4 and (t := rng.choice(out)):
            i = rng.randrange(len(t))
            out.append(prose(5) + t[i : i + rng.randrange(90, 130)] + prose(5))
        else:
            out.append(shared[1][: rng.randrange(1, len(shared[1]))] + prose(30) + shared[2])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SHAPE)


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"slice_bytes": 2000, "range_bytes": 3000}), (3, {"slice_bytes": 1, "range_bytes": 500}), (4, {"length": 40, "slice_bytes": 3000}), (5, {"length": 129, "slice_bytes": 3000})])
def test_equals_brute_force(spark, seed, options):
    texts = corpus(seed)
    df = frame(spark, [(3 * i - 50, t) for i, t in enumerate(texts)]).repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup(df, **options).collect()}
    want = plain(texts, options.get("length", 100))
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[3 * i - 50] == w, (i, texts[i])


@pytest.mark.parametrize("most", [64, 1 << 16])
def test_grams_across_ranges(spark, monkeypatch, most):
    """With a sample of all grams the common ones fill several ranges."""
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    found = []
    split = suffix_dedup.splitters
    monkeypatch.setattr(suffix_dedup, "splitters", lambda *a: found.append(split(*a)) or found[-1])
    texts = corpus(7) + [f"{i} {'some passage that many documents hold, ' * 4} {i}" for i in range(300)]
    df = frame(spark, list(enumerate(texts))).repartition(9)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup(df, slice_bytes=500, range_bytes=2000).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts)
    assert most == 64 or found[0][1]


def test_windows_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    texts = corpus(9)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts)


def test_order_is_that_of_bytes():
    rng = random.Random(2)
    strings = [bytes(rng.choices(b"ab\0", k=rng.randrange(20))) for _ in range(500)]
    buffer, size = suffix_dedup.padded(b"".join(strings)), np.array([len(s) for s in strings])
    order, group, _ = suffix_dedup.multikey([*suffix_dedup.tokens(buffer, np.cumsum(size) - size, size, 24), size.astype(np.uint64)])
    padded = [s.ljust(24, b"\0") for s in strings]
    assert [(padded[i], size[i]) for i in order] == sorted(zip(padded, size.tolist()))
    assert all((strings[order[i]] == strings[order[i - 1]]) == (group[i] == group[i - 1]) for i in range(1, len(order)))


def test_odd_tables(spark):
    assert suffix_dedup.dedup(frame(spark, []).limit(0)).count() == 0
    same = "".join(map(str, range(100)))
    rows = [(1, same), (1, same), (None, same), (None, None), (2, same + "!"), (1, "b")]
    got = sorted(map(tuple, suffix_dedup.dedup(frame(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()), key=str)
    assert got == sorted([(1, 190, 190, 1), (1, 190, 190, 1), (None, 190, 0, 0), (None, 0, 0, 0), (2, 191, 190, 1), (1, 1, 0, 0)], key=str)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    ids = sorted(texts)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_suffix_dedup(spark, sf).collect()}
    assert [got[i] for i in ids] == plain([texts[i] for i in ids])
