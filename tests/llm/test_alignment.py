"""Aligned tokens against plain loops over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest

from lexweave.llm import alignment, queries

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokens_of(texts):
    """For each text its tokens (id, from, to) on both sides, each text encoded whole."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    out = []
    for t in texts:
        if not t:
            out.append(([], []))
            continue
        sides = []
        for ids, data in ((x := a.encode(f" {t}", add_special_tokens=False).ids, [bytes(letters[c] for c in a.id_to_token(i)) for i in x]), (y := b.encode(t), [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y])):
            ends = [0]
            for d in data:
                ends.append(ends[-1] + len(d))
            sides.append((b"".join(data), list(zip(ids, ends, ends[1:]))))
        same = all(s[0] == f" {t}".encode() for s in sides)
        out.append((sides[0][1], sides[1][1]) if same else ([], []))
    return out


def plain(texts):
    links, held, rows = [], Counter(), []
    for a, b in tokens_of(texts):
        own = Counter((i, j) for i, s, e in a for j, f, g in b if f < e and s < g) if len(a) < 400 else Counter(swept(a, b))
        links.append(own)
        held.update(own.keys())
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    for (a, b), own in zip(tokens_of(texts), links):
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = ";".join(",".join(str(i) for i, _, e in a if s < e <= c) + "|" + ",".join(str(i) for i, _, e in b if s < e <= c) for s, c in zip([0, *cuts], cuts)) if len(a) < 400 else None
        rows.append((len(a), len(b), len(cuts), sum(own.values()), sum(m for p, m in own.items() if held[p] == best[p[0]]), sum(m * held[p] for p, m in own.items()), (hashlib.sha256(groups.encode()).hexdigest() if groups is not None else None) if a else ""))
    return rows


def swept(a, b):
    j = 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            yield i, b[k][0]
            k += 1


def odd_texts():
    rng = random.Random(5)
    bits = ["a", "the", " ", "  ", "\n", "é", "日本", "\t", "ing", "\U0001f600", "\xa0", "   ", "ß", "%%%", "<|endoftext|>", "</s>", "<0x41>", "12", "'s", "\x85", ".", "\x1f", "\0", " 's", " ", "word", " of"]
    return ["", " ", "   ", "x" * 3000, "word " * 700, None, "▁", "a ▁b", "\n", " \n ", *["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(300)]]


def compare(got, texts):
    want = plain(texts)
    assert len(got) == len(texts)
    for r in got:
        mine, theirs = tuple(r[n] for n in NAMES), want[r["doc_id"]]
        assert mine[: 6 + (theirs[6] is not None)] == theirs[: 6 + (theirs[6] is not None)], texts[r["doc_id"]]


@pytest.mark.parametrize("options", [{}, {"buckets": 3, "block_bytes": 300, "unit_bytes": 200}])
def test_equals_plain_loops(spark, options):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in enumerate(texts)], "doc_id long, text string, block int, n long, pairs string").repartition(3)
    compare(alignment.align(df, A, B, **options).collect(), texts)


def test_words_learned_together_are_those_learned_alone(monkeypatch):
    """Of what stands between cuts of odd texts, in several parts and texts; new words don't go to the tokenizers one by one."""
    monkeypatch.setattr(alignment, "JOINED", 5)
    monkeypatch.setattr(alignment, "AT_ONCE", 300)
    texts, aligner = [t for t in odd_texts() if t and "▁" not in t], alignment.Aligner(A, B)
    words = {w for t in texts for w in aligner.words(t)}
    alone = {w: aligner.aligned(w, aligner.a.encode(f" {w}", add_special_tokens=False).ids, aligner.b.encode(w)) for w in words}
    seen = []
    encode = aligner.b
    aligner.b = type("", (), {"encode": lambda _, t, **kw: seen.append(len(t)) or encode.encode(t, **kw)})()
    aligner.learn(words)
    assert len(words) > 100 and aligner.known.now == alone
    assert sum(seen) < 0.7 * len(words)


def test_odd_tables(spark):
    shape = "doc_id long, text string, unit string"
    assert alignment.align(spark.createDataFrame([], shape), A, B).count() == 0
    rows = [(1, "one two", "x"), (1, "one two", "x"), (None, "two", "y"), (None, None, "y")]
    got = sorted(map(tuple, alignment.align(spark.createDataFrame(rows, shape), A, B).collect()), key=str)
    assert len(got) == 4 and got[0] == got[1] and got[0][6] == 2 + 3 and got[2][-1] == ""


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    ids = sorted(texts)
    got = queries.op11_alignment(spark, sf)
    want = dict(zip(ids, plain([texts[i] for i in ids])))
    rows = got.collect()
    assert len(rows) == len(ids)
    for r in rows:
        assert tuple(r[n] for n in NAMES[:6]) == want[r["doc_id"]][:6]
