"""Each operator against a library, brute force or a hand-made case; odd rows."""

import hashlib
import math
import pickle
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm import bit_sliced, byte_bpe, common, hash_tree, hashing, language, line_crf, main_text, mixing, pq_dedup, set_join, token_count

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, bucket int, label string"
SF = "/root/testdata/sf0.001"


def docs_of(spark, rows):
    """Rows (doc_id, text[, lang, source]) with more columns of clashing names."""
    return spark.createDataFrame([(r[0], r[1], *(r[2:] + ("en", "a")[len(r) - 2 :]), 0, "x", 1, "y") for r in rows], DOCS)


def odd_texts():
    rng = random.Random(3)
    bits = ["a", "the", " ", "  ", "\n", "é", "日本", "\t", "ing", "\U0001f600", " ", "   ", "ß", "%%%", "<|endoftext|>", "</s>", "12", "'s", "▁", "\x85", "."]
    return ["", " ", "x" * 5000, "word " * 3000, None, *["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(150)]]


def test_token_counts(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    texts = odd_texts()
    df = docs_of(spark, list(enumerate(texts)) + [(0, ""), (None, "a b")])
    for options in ({}, {"chunk": 40, "overlap": 4}, {"chunk": 40, "overlap": 4, "keep_bytes": 500}):
        got = token_count.token_counts(df, P.path("piece_bpe_32k.model"), **options).collect()
        assert len(got) == len(texts) + 2
        for r in got:
            if r["doc_id"] is not None:
                t = texts[r["doc_id"]] or ""
                assert (r["n_tokens"], r["n_bytes"]) == (len(sp.encode(t)), len(t.encode())), t[:50]
                assert r["over_limit"] == (r["n_tokens"] > 4096)
    assert token_count.token_counts(df.limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_byte_bpe(spark):
    import tiktoken

    ranks = byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts()
    df = docs_of(spark, list(enumerate(texts)) + [(None, "a b"), (None, "a b")])
    got = byte_bpe.encoding_digests(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = (texts[r["doc_id"]] if r["doc_id"] is not None else "a b") or ""
        ids = np.array(enc.encode_ordinary(t), "<u4").tobytes()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest()), t[:50]
    assert byte_bpe.encoding_digests(df.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
    small = byte_bpe.encoding_digests(df.repartition(2), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep_bytes=2000, block=300).collect()
    assert sorted(map(str, small)) == sorted(map(str, got))  # whatever is remembered
    whole = {r["doc_id"]: r for r in byte_bpe.encode_texts(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).where("doc_id is not null").collect()}
    assert all(bytes(r["decoded"]) == (texts[i] or "").encode() for i, r in whole.items())


def test_both_replays_equal_the_library():
    import tiktoken

    ranks = byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(byte_bpe.Tables(ranks), P.PATTERN)
    rng = random.Random(8)
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 120))) for letters in ("ab", "aeinrst ", "abcdefghijklmnopqrstuvwxyz", "é日 \n\0") for _ in range(100)]
    words = [w.encode() for w in [*words, "a" * 3000, "ing" * 20]]
    want = [np.array(enc.encode_ordinary(w.decode()), "<u4").tobytes() for w in words]
    assert codec.replay(words) == codec.replay_ranges(words) == codec.replay_merges(words) == want
    assert codec.replay([]) == [] and codec.replay([b"q"]) == codec.replay_merges([b"q"])


def test_lower_rank_takes_over():
    """A pair that arises with a lower rank than the merge at hand is joined first, as word by word."""
    ranks = {bytes([i]): i for i in range(256)} | {b"aba": 300, b"ab": 310, b"bb": 305}
    codec = byte_bpe.Codec(byte_bpe.Tables(ranks), P.PATTERN)

    def plain(word):
        parts = [bytes([b]) for b in word]
        while True:
            pairs = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(1)
    words = list({"".join(rng.choices("ab", k=rng.randrange(1, 9))).encode() for _ in range(200)})
    for w, ids in zip(words, codec.replay(words)):
        assert np.frombuffer(ids, "<u4").tolist() == plain(w), w


@pytest.mark.parametrize(
    "html,text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("<body><nav><ul><li><a href='/'>x</a></ul></nav><article><h1>T &amp; U</h1><p>One\n two<br>three <b>four</b>.<p>Fi&eacute;ve</article><footer>f</footer>", "T & U\n\nOne two three four.\n\nFiéve"),
        ("<header><h1>Site</h1></header><div class='sidebar'><p>long, long, long, long text</p></div><div class=content><h2>H</h2><p>A, b.</p><ul><li>x<li>y</ul></div><div id=comments><p>Me, too, and, more</p></div><form>q</form>", "H\n\nA, b.\n\nx\n\ny"),
        ("<article><script>var t='</p>'</script><style>p{}</style><!-- a <p>no</p> --><p>Text", "Text"),
        ("<article><div class='ad'>buy</div><section><p>s1, a</p></section><section><p>s2, b, c</p></section></article>", "s1, a\n\ns2, b, c"),
    ],
)
def test_main_text(html, text):
    assert (main_text.main_text(html) if html else "") == text


@pytest.mark.parametrize(
    "html,text",
    [
        ("<article><h2 id='search'>Search</h2><p>a, b</p><section id='related-work'><h2><a href='#related-work'>Related work</a></h2><p>c, d, e and more of it</p></section><p id='reply-to-x'>f, g</p></article>", "Search\n\na, b\n\nRelated work\n\nc, d, e and more of it\n\nf, g"),
        ("<article><p>a, b</p><section id='comments'><p>me too</p></section><section id='related-posts'><p><a>x</a></p><p><a>y</a> z</p></section><section id='signup-now'><p>Your mail<input name=m></p></section><p class='notice'>n</p><div id='share-this'>s</div></article>", "a, b"),
    ],
)
def test_main_text_slugs(html, text):
    assert main_text.main_text(html) == text


@pytest.mark.parametrize(
    "html,text",
    [
        ("<article><p>a, b</p><div class='post-comments'><p>me, too</p></div><div class='main-nav'>x</div><div class='sponsored-content'>y</div><div class='cookie-notice-text'>z</div><section class='reply-list text comments'><p>q</p></section><p>c</p></article>", "a, b\n\nc"),
        ("<p data-x=it's>one kept</p><p>two kept</p><p>it's end</p>", "one kept\n\ntwo kept\n\nit's end"),
        ("<p>if a <b and c > d then", "if a <b and c > d then"),
        ("<p>if a < b and <i>c</i> >= d", "if a < b and c >= d"),
        ("<article><p>a, b</p><p class='related'>On related work, in words.</p></article>", "a, b\n\nOn related work, in words."),
        ("<main><article><h1>H</h1><p>long, long, long text of it</p></article><article><p>teaser, and more</p></article></main>", "H\n\nlong, long, long text of it"),
        ("<body class='with-sidebar'><div class='has-sidebar'><div class='wrap sidebar-right'><main><p>a, b, c</p></main></div><div class='sidebar'><p>d, e, f, g, h</p></div></div>", "a, b, c"),
        ("<div id=page><div class=x><h1>T</h1></div><div class=y><p>a, b, c, d, e, f</p><p>g, h</p></div></div>", "a, b, c, d, e, f\n\ng, h"),
        ("<article><p>a<a href='x>b</a></p><p>c", "ab\n\nc"),
        ("<body><form action=x><input name=state><div class=menu>m</div><article><h1>H</h1><p>a, b, c</p></article></form>", "H\n\na, b, c"),
        (f"<body><form><input name=state><div><p>{'word, ' * 30}end</p><p>{'more ' * 30}end</p></div></form>", f"{'word, ' * 30}end\n\n{'more ' * 30}end"),
        ("<div class='post comments-open'><p>a, b, c</p></div>", "a, b, c"),
        ("<div class='entry comments-closed'><p>a, b, c</p></div>", "a, b, c"),
        ("<article class='ad-free'><p>a, b</p></article>", "a, b"),
        ("<article><p>a, b</p><div class='related-work'><p>c, d</p></div><div class='modal-logic'><p>e, f</p></div><div class='related-posts'><p>g</p></div><div class='related-links-2024x more'><p><a>h</a></p></div></article>", "a, b\n\nc, d\n\ne, f"),
        ("<article><p>Click <svg><text>no</text><p>x</p></svg> to go, <button>b</button>now <select><option>1</select>and <math><mi>y</mi></math>on</p><p>next</p></article>", "Click to go, now and on\n\nnext"),
        ("<article><textarea>no</textarea><p>yes<table><tr><td>1<td>2<tr><td>3</table></article><script>p", "yes\n\n1\n\n2\n\n3"),
    ],
)
def test_main_text_broken_or_misleading(html, text):
    assert main_text.main_text(html) == text


@pytest.mark.parametrize("bit", ["<a x ", "<b x='", "<div>x", "<li><ul><div>y", "</i>", "<script", "<!-", "<textarea>", "<p><b>t", "<a href=\"", "<td>z", "&amp;<"])
def test_main_text_takes_linear_time(bit):
    def spent(n):
        start = time.process_time()
        main_text.main_text("<article><p>" + bit * n)
        return time.process_time() - start

    assert spent((1 << 20) // len(bit)) < 15 * max(spent((1 << 17) // len(bit)), 0.1)


def test_main_text_by_plain_scores():
    """Sums over the tree against a scorer that walks up from every block."""
    rng = random.Random(8)

    def tree(depth):
        name = rng.choice(["div", "section", "p", "ul", "article"] if depth else ["p", "h2"])
        if name in ("p", "h2"):
            return f"<{name}>{rng.choice(['one, two', 'x', 'a, b, c, ' * 20, '<a>link</a> t'])}</{name}>"
        return f"<{name}>" + "".join(tree(depth - 1) for _ in range(rng.randrange(4))) + f"</{name}>"

    for _ in range(200):
        elements, blocks = main_text.blocks_of(tree(4) + tree(4))
        want = {}
        for element, text, linked in blocks:
            points = (1 + min(text.count(","), 10) + min(len(text) / 100, 3)) * (1 - linked / len(text))
            up, share = (element.parent if element.name in main_text.TEXT_BLOCKS else element), 1.0
            while up is not None:
                want[id(up)] = want.get(id(up), 0) + points * share
                up, share = up.parent, share / 2
        main_text.weighed(elements, blocks)
        assert all(math.isclose(e.received, want.get(id(e), 0), abs_tol=1e-9) for e in elements)
        assert elements[0].length == sum(len(t) for _, t, _ in blocks)


def test_main_text_rows(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>a", 5), (1, "u", "<article><p>a", 5), (None, None, None, None)], "page_id long, url string, html string, text int")
    got = sorted(main_text.extract(df).collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    assert main_text.extract(df.limit(0)).count() == 0


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = line_crf.quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    held = {r["doc_id"]: r["held_out"] for r in line_crf.quality(docs, labels).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items())
    odd = docs_of(spark, [(1, None), (1, ""), (None, "a\nb"), (5, "\n" * 3000)])
    assert line_crf.quality(odd, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    assert line_crf.quality(odd.limit(0), labels).count() == 0 and line_crf.quality(odd.limit(0), labels.limit(0)).count() == 0
    kept = line_crf.quality(odd.withColumn("a`b", F.lit(1)), labels, keep=True)
    assert kept.columns == ["row", "score", "predicted"] and kept.select("row.*").columns == [*odd.columns, "a`b"] and kept.count() == 4


def test_chain_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    lines = np.array([3, 1, 0, 4])
    evidence = rng.normal(size=8)
    chain = line_crf.Chain(np.zeros(1), rng.normal(size=(2, 2)))
    good, moves = chain.marginals(evidence, lines)
    want, want_moves, at = [], np.zeros((2, 2)), 0
    for n in lines:
        total, mass, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n if n else 0):
            y = [code >> i & 1 for i in range(n)]
            w = math.exp(sum(evidence[at + i] * y[i] for i in range(n)) + sum(chain.moves[y[i], y[i + 1]] for i in range(n - 1)))
            total, mass = total + w, mass + w * np.array(y)
            for i in range(n - 1):
                pairs[y[i], y[i + 1]] += w
        if n:
            want.extend(mass / total)
            want_moves += pairs / total
        at += n
    assert np.allclose(good, want) and np.allclose(moves, want_moves)


def plain_components(texts, percent=85, words=4):
    sets = []
    for t in texts:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(sets)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return [len(s) for s in sets], label


def test_jaccard_components(spark):
    rng = random.Random(5)
    base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(30)) for _ in range(60)]
    texts = [None, "", " \n", "one two", "One  TWO", "one two three", "a b c d"] + [" ".join(base)]
    for _ in range(90):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = "x" + str(rng.randrange(5))
        texts.append(" ".join(w[rng.randrange(3) :]))
    texts += [" ".join(rng.choices(base, k=rng.randrange(1, 30))) for _ in range(40)] + texts[:20]
    sizes, label = plain_components(texts)
    df = docs_of(spark, list(enumerate(texts))).repartition(5)
    for block, frequent in ((32, 1 << 17), (4, 3)):
        got = {r["doc_id"]: r for r in set_join.jaccard_components(df, block=block, frequent=frequent, often=2).collect()}
        assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
        assert [got[i]["component_id"] for i in range(len(texts))] == label
    assert set_join.jaccard_components(df.limit(0)).count() == 0
    odd = {(r["doc_id"], r["component_id"]) for r in set_join.jaccard_components(docs_of(spark, [(7, "a b"), (7, "a b"), (None, "a b"), (None, "q")])).collect()}
    assert odd == {(7, 7), (None, 7), (None, None)}


def test_lists_of_frequent_tokens_are_whole(spark):
    """Tokens that most sets share are dealt in parts; each set's posting comes out once, however often it went in."""
    texts = [f"p q r s t u {i} v w x y z" for i in range(300)]
    df = docs_of(spark, [(i, t) for i, t in enumerate(texts * 3)]).repartition(5)
    every = {t for text in texts for t in set_join.shingle_sets([text.encode()], 4)[0].tolist()}
    sets = [set(set_join.shingle_sets([t.encode()], 4)[0].tolist()) for t in texts]
    times = {t: sum(t in s for s in sets) for t in every}
    frequent = np.array(sorted((t for t in every if times[t] > 1), key=times.get), np.int64)
    for hot in (frequent, frequent[:0]):
        got = set_join.met(set_join.postings(df.select(F.col("doc_id").alias("id"), "text"), 4, 10, hot)).collect()
        assert len({(r["token"], r["sig"]) for r in got}) == len(got) and {r["token"] for r in got} <= set(frequent.tolist())
        told = set(hot.tolist())
        prefixes = [sorted(s, key=lambda t: (t in told, times[t] if told else 0, t))[: len(s) - (10 * len(s) + 99) // 100 + 1] for s in sets]
        held = Counter(t for p in prefixes for t in p)
        assert len(got) == sum(m for t, m in held.items() if m > 1 or t in told)


def test_word_hashes():
    text = "A bb\tCCC\n\x0bdd  é".encode()
    start, end, h = hashing.words(np.frombuffer(text, np.uint8))
    assert [text[s:e].decode() for s, e in zip(start, end)] == ["A", "bb", "CCC", "dd", "é"]
    other = hashing.words(np.frombuffer(b"zz a BB ccc DD " + "é".encode(), np.uint8))[2]
    assert (other[1:] == h).all() and len(set(h.tolist())) == 5
    # blocks: more words than one holds, and a word longer than a block
    many = b"one two " * hashing.BLOCK + b"x" * (3 * hashing.BLOCK) + b" one"
    h = hashing.words(np.frombuffer(many, np.uint8))[2]
    alone = [hashing.words(np.frombuffer(w, np.uint8))[2][0] for w in (b"one", b"two", b"x" * (3 * hashing.BLOCK))]
    assert (h[:-2].reshape(-1, 2) == alone[:2]).all() and h[-2:].tolist() == [alone[2], alone[0]]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(140)] + [(i, i + 1) for i in range(300, 360)] + [(500, i) for i in range(501, 900)]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            label[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in label}


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 80)), "en", rng.choices(["big", "Mid", "small", None], [20, 6, 1, 1])[0]) for i in range(3000)]
    rows += [(9000, None, "en", "empty"), (9001, "a b c", "en", "small"), (9001, "a b c", "en", "small")]
    df = docs_of(spark, rows)
    got = mixing.mix(df, group=64).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 3 * got["size"]).all() and (got["taken"] >= 0).all()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:  # water filling, the plain way
        left = sum(sizes.values()) - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    target |= {s: weight[s] * level for s in open_}
    by_id = {r[0]: r[3] for r in rows}
    got["source"] = [by_id[i] for i in got["doc_id"]]
    for s in order:
        part = got[got["source"].map(lambda x: x == s if s is not None else x is None)]
        assert math.isclose(part["target"].iloc[0], target[s], rel_tol=1e-9) and part["source_size"].iloc[0] == sizes[s]
        assert abs(part["taken"].sum() - target[s]) <= 80
    again = mixing.mix(df.repartition(7), group=64).toPandas()
    key = ["doc_id", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    assert mixing.mix(df.limit(0)).count() == 0


def test_rates_against_a_plain_dual(spark):
    """Every row's copies from a bisected lambda, rates in the order of size and id, and their running sums."""
    rng = random.Random(14)
    rows = [(i, " ".join(["w"] * int(rng.lognormvariate(3, 1))), "en", rng.choices(["a", "b", "c", "d"], [30, 9, 3, 1])[0]) for i in range(1500)] + [(2000, "w " * 30_000, "en", "b"), (2001, "", "en", "e")]
    got = {r["doc_id"]: r for r in mixing.mix(docs_of(spark, rows), group=10**6).collect()}
    for source in "abcd":
        part = sorted((got[i]["size"], i) for i, _, _, s in rows if s == source)
        target = got[part[0][1]]["target"]
        rate = lambda x, n: min(3.0, math.exp(min(x * n, 9))) if n else 0.0
        low, high = -10.0, 10.0
        for _ in range(200):
            at = (low + high) / 2
            low, high = (at, high) if sum(n * rate(at, n) for n, _ in part) < target else (low, at)
        up = total = 0.0
        off = 0
        for n, i in part:
            up, before = up + rate(at, n), up
            off += got[i]["copies"] != round(up) - round(before)
            total += got[i]["taken"]
            assert abs(got[i]["copies"] - rate(at, n)) <= 1.001
        assert off <= 0.02 * len(part) and abs(total - target) <= max(part)[0]


def test_tree_by_plain_draws(spark):
    """Every shard against a descent computed one row at a time."""
    root = hash_tree.tree(6, per_region=4, per_rack=2)
    names = []

    def visit(at):
        for c in at.children:
            names.append(c)
            visit(c)

    visit(hash_tree.grown(root, 6))
    frame = spark.range(300).select("id", *[hash_tree.draw(F.col("id"), c).alias(c.name) for c in names], hash_tree.placed(F.col("id"), root).alias("shard"), hash_tree.placed(F.col("id"), hash_tree.grown(root, 6)).alias("more"))
    for r in frame.collect():
        for tree, column in ((root, "shard"), (hash_tree.grown(root, 6), "more")):
            at = tree
            while at.shard is None:
                at = min(at.children, key=lambda c: r[c.name]) if len(at.children) > 1 else at.children[0]
            assert at.shard == r[column]
    assert hash_tree.shard_by_key(docs_of(spark, [(1, "a")]).limit(0), root, hash_tree.grown(root, 6)).count() == 0


def test_shards(spark):
    rows = [(i, f"text {i % 50}") for i in range(4000)] + [(1, "text 1"), (None, None), (None, "")]
    root = hash_tree.tree(16)
    got = hash_tree.shard_by_key(docs_of(spark, rows), root, hash_tree.grown(root, 16), buckets=8).toPandas()
    assert len(got) == len(rows)
    for shard, part in got.groupby("shard"):
        assert 0 <= shard < 16 and sorted(part["slot"]) == list(range(len(part)))
        assert 150 < len(part) < 360
    moved = got[got["shard"] != got["grown_shard"]]
    assert set(moved["grown_shard"]) == {16} and 140 < len(moved) < 340
    texts = dict(rows)
    for r in got.dropna(subset=["doc_id"]).itertuples():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    assert got[got["doc_id"] == 1]["shard"].nunique() == 1
    lopsided = hash_tree.node("root", [hash_tree.Node("x", 3.0, 0), hash_tree.Node("y", 1.0, 1)])
    share = spark.range(8000).select(hash_tree.placed(F.col("id"), lopsided).alias("s")).agg(F.avg("s")).first()[0]
    assert abs(share - 0.25) < 0.03


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])
BAD = [(900, None, "x"), (901, [float("nan")] * 16, "x"), (902, [None, *[1.0] * 15], "x"), (903, [float("inf")] * 16, "x"), (None, [1.0] * 16, "x")]


def test_top_k(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(400, 16)) * 0.2, 1).astype(np.float32)
    x[50:60] = x[40]
    rows = [(i, x[i].tolist(), "x") for i in range(400)] + BAD
    df = spark.createDataFrame(rows, VECTORS)
    q = np.floor(64 * x.astype(float)).astype(int)
    for block_rows, block_queries in ((32768, 8192), (100, 3), (3, 2)):
        got = {}
        for r in bit_sliced.top_k(df, F.col("vec_id") % 20 == 0, block_rows=block_rows, block_queries=block_queries).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert set(got) == set(range(0, 400, 20))
        for i, found in got.items():
            score = q @ q[i]
            order = [j for j in sorted(range(400), key=lambda j: (-score[j], j)) if j != i][:20]
            assert sorted(found) == [(k + 1, j, score[j]) for k, j in enumerate(order)]
    twice = bit_sliced.top_k(spark.createDataFrame([(0, [1.0, 1.0], "x"), (0, [1.0, 0.0], "x"), (1, [1.0], "x"), (1, [1.0], "x"), (2, [], "x")], VECTORS), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [tuple(r) for r in twice] == [(0, 1, 1, 4096), (0, 2, 1, 4096), (0, 3, 2, 0)]  # shorter vectors, repeated ids
    for large in (1e9, -1e30, 1e300):
        with pytest.raises(ValueError, match="64 bits"):
            bit_sliced.top_k(spark.createDataFrame([(0, [large, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0)
    few = bit_sliced.top_k(df.where("vec_id < 5"), F.col("vec_id") == 0).collect()
    assert len(few) == 4
    assert bit_sliced.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_near_duplicates(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 16))
    x[200:500] = x[7] + rng.normal(size=(300, 16)) * 0.16  # a large group, partly beyond the threshold
    x[500:560] = x[100:160] + rng.normal(size=(60, 16)) * 0.05
    x[560:600] = x[8]
    rows = [(i, x[i].tolist(), "x") for i in range(1200)] + BAD + [(904, [0.0] * 16, "x"), (3, x[3].tolist(), "x")]
    rows = [r for r in rows if r[0] is None or r[0] < 900 or r in BAD or r[0] == 904]
    keep = [i for i in range(900)]
    u = x[keep].astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    close = u @ u.T >= 0.95
    np.fill_diagonal(close, False)
    got = {r["vec_id"]: r for r in pq_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), per_list=60, block=40, block_visitors=150).collect()}
    found = np.array([got[i]["n_links"] for i in keep])
    assert (found <= close.sum(1)).all() and found.sum() >= 0.9 * close.sum()
    label = np.arange(900)
    for _ in range(50):
        label = np.minimum(label, np.array([label[c].min(initial=900) for c in close]))
    assert np.mean([got[i]["component_id"] == label[i] for i in keep]) > 0.97
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in (901, 902, 903, 904) if i in got)
    assert None in got and not got[None]["kept"]
    assert pq_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_near_duplicates_of_every_length_and_row(spark):
    """Rows of common and of rare lengths and of repeated ids, against all pairs."""
    rng = np.random.default_rng(9)
    rows = []
    for dims, n in ((16, 400), (12, 300), (5, 40), (1, 1)):
        x = rng.normal(size=(n, dims))
        x[n // 2 :] = x[: n - n // 2] * 2
        rows += [(len(rows) + k, v) for k, v in enumerate(x.astype(np.float32).astype(float).tolist())]
    rows += [(0, rows[3][1]), (0, rows[450][1]), (1, rows[1][1]), (720, rows[705][1]), (10**6, rows[701][1])]
    unit = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    n, label = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}
    pairs = [(a[0], b[0]) for a, x in zip(rows, unit) for b, y in zip(rows, unit) if a[0] != b[0] and len(x) == len(y) and x @ y >= 0.95]
    for a, _ in pairs:
        n[a] += 1
    for _ in range(9):
        for a, b in pairs:
            label[a] = min(label[a], label[b])
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS)
    got = sorted(tuple(r) for r in pq_dedup.near_duplicates(df, per_list=60, block=40, block_visitors=150).collect())
    assert got == sorted((i, n[i], label[i], label[i] == i) for i, _ in rows)


@pytest.mark.parametrize("n", [6, 600])
def test_near_duplicates_of_any_magnitude(spark, n):
    """Norms whose squares leave doubles; ids 0 and 1 link, 2 to none of them."""
    rng = np.random.default_rng(4)
    rows = [(0, [1e-200, 0.0]), (1, [1e-200, 0.0]), (2, [1.0, 1.0]), (3, [1e200, 1e200]), (4, [-1e308, 1e308]), (5, [5e-324, -5e-324])]
    rows += [(k, v) for k, v in zip(range(6, n), (rng.normal(size=(max(0, n - 6), 2)) * [[0.0, -1.0]]).tolist())]
    got = {r["vec_id"]: tuple(r)[1:] for r in pq_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("vec_id < 6").collect()}
    assert got == {0: (1, 0, True), 1: (1, 0, False), 2: (1, 2, True), 3: (1, 2, False), 4: (0, 4, True), 5: (0, 5, True)}


def test_probes_grow_with_the_table():
    """Of pairs at the threshold, at least 0.98 meet in a list, whatever the number of lists."""
    rng = np.random.default_rng(0)
    unit = lambda n: (x := rng.standard_normal((n, 64))) / np.linalg.norm(x, axis=1, keepdims=True)
    sample, a, other = unit(8192), unit(1000), unit(1000)
    other -= (other * a).sum(1, keepdims=True) * a
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * other / np.linalg.norm(other, axis=1, keepdims=True)
    for n in (10**4, 10**6, 10**7):
        q = pq_dedup.fit(sample, min(n // 200, 512 * 512), pq_dedup.probes_for(n, 8), 0.95, 512)
        at, to = q.nearest(a), q.nearest(b)
        assert ((at == to[:, :1]).any(1) | (to == at[:, :1]).any(1)).mean() >= 0.98


def test_near_duplicates_on_two_levels(spark):
    """Lists of coarse and fine centroids, pairs right at the threshold; nothing below it links."""
    rng = np.random.default_rng(10)
    x = rng.normal(size=(1500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(1500, 16))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    unit = np.concatenate([x, 0.952 * x + np.sqrt(1 - 0.952**2) * y])
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(unit.astype(np.float32).astype(float).tolist())], VECTORS)
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    got = {r["vec_id"]: r["n_links"] for r in pq_dedup.near_duplicates(df, per_list=10, sample=256).collect()}
    found = np.array([got[i] for i in range(3000)])
    assert (found <= close.sum(1)).all() and found.sum() >= 0.9 * close.sum()


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.language_of(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.98 and got["score"].between(0, 1).all()
    odd = docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(-1, None, "en"), (-2, "12 !\n", None), (-3, "", "fr"), (None, "the", None)], "a long, b string, c string"))
    got = {r["doc_id"]: r for r in language.language_of(odd).where("doc_id < 0 or doc_id is null").collect()}
    assert [got[i]["lang_pred"] for i in (-1, -2, -3)] == ["und"] * 3 and got[None]["held_out"] and got[None]["lang_pred"] != "und"
    assert language.language_of(odd.limit(0)).count() == 0
    clashing = docs_of(spark, [(1, "the", "en"), (1, "the", "en"), (2, None, None)]).withColumn("lang_pred", F.lit(9)).withColumn("a`b c", F.lit(1))
    kept = language.language_of(clashing, keep=True)
    assert kept.columns == ["row", "lang_pred", "score"] and kept.select("row.*").columns == clashing.columns and kept.count() == 3


def test_learning_is_bounded(spark):
    """Rows that repeat an id or a text, and very long labelled texts, add nothing beyond the parameters."""
    a, b, c = [i for i in range(99) if zlib.crc32(str(i).encode()) % 20 in (1, 3, 7, 9, 11, 13, 17, 19)][:3]
    docs = docs_of(spark, [(a, f"text {i % 3}\n" + "line of it\n" * 3000, "en") for i in range(40)] + [(b, "other\nlines", "fr"), (c, "?!?! %% 12", "fr")])
    labels = spark.createDataFrame([(a, 1, 0), (b, 1, 0), (b, 0, 0), (c, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    chain = line_crf.fit(docs, labels, "doc_id", "text", "quality", 5, 64)
    assert chain is not None and line_crf.windows(6002, 64) == [(0, 16), (1995, 16), (3990, 16), (5986, 16)] and line_crf.windows(64, 64) == [(0, 64)]
    texts, counts = language.labelled_texts(docs, "doc_id", "text", "lang", 5, 48_000, 4000)
    assert counts["en"] == 40 and texts["en"].count("text ") <= 5 and len(texts["en"]) < 3 * 4100


def test_language_learns_from_whole_texts(spark):
    """What follows a foreign preamble is learned from, to the end of the text."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, "qq ww " * 900 + "".join(f" {c}{c}{c}" for c in "abcdefghij" for _ in range(500)), "x") for i in ids], "doc_id long, text string, lang string")
    texts, counts = language.labelled_texts(docs, "doc_id", "text", "lang", 80, 48_000, 4000)
    assert counts == {"x": len(ids)} and set("abcdefghijqw") <= set(texts["x"]) and 40_000 < len(texts["x"]) <= 48_000
    short = docs.select("doc_id", F.expr("concat('start ', repeat('m ', 1990), 'end')").alias("text"), "lang")
    texts, _ = language.labelled_texts(short, "doc_id", "text", "lang", 80, 10_000, 4000)
    assert texts["x"].count("start") == texts["x"].count("end") == 2


def test_suffix_automaton():
    text = [random.Random(1).randrange(3) for _ in range(60)]
    go = language.suffix_automaton(text)
    inside = {tuple(text[i:j]) for i in range(60) for j in range(i, 61)}

    def accepts(s):
        at = 0
        for c in s:
            if c not in go[at]:
                return False
            at = go[at][c]
        return True

    rng = random.Random(2)
    tried = [tuple(rng.choices(range(3), k=rng.randrange(1, 8))) for _ in range(500)] + list(inside)[:300]
    assert all(accepts(s) == (s in inside) for s in tried)


def plain_phrases(symbols, known):
    """Greedy longest matches of symbols in known, over the whole text."""
    inside = {tuple(known[i:j]) for i in range(len(known)) for j in range(i + 1, len(known) + 1)}
    at = n = 0
    while at < len(symbols):
        size = 1
        while at + size < len(symbols) and tuple(symbols[at : at + size + 1]) in inside:
            size += 1
        at, n = at + size, n + 1
    return n


def test_cross_parsing_by_plain_phrases():
    labelled = {"x": "abc abd abcd. bca" + "cab" * 9, "y": "ddca cab. dcab"}
    parser = pickle.loads(pickle.dumps(language.Parser(labelled, {"x": 1, "y": 3})))
    rng = random.Random(7)
    texts = ["abcabd", "d", "zz a", "cab dcab", "", "123", "abcabd " * 300, "zz", "cab" * 40, labelled["x"], *["".join(rng.choices("abcd .z", k=rng.randrange(400))) for _ in range(60)]]
    known = {lang: parser.symbols(t.lower()).tolist() for lang, t in labelled.items()}
    want = []
    for t in texts:
        symbols = parser.symbols(t.lower()).tolist()
        want.append([plain_phrases(symbols, known[lang]) if any(symbols) else 0 for lang in parser.langs])
    for segment in (1, 7, 64, 512):  # seams leave no trace
        counts, foreign, sizes = parser.phrases(texts, segment)
        assert counts.tolist() == want
        assert [f.tolist() for f, n in zip(foreign, sizes) if n] == [[sum(c not in known[x] for c in parser.symbols(t.lower()).tolist()) for x in parser.langs] for t, n in zip(texts, sizes) if n]
    langs, scores = parser.predict(texts)
    bits = [math.log2(len(known[x])) for x in parser.langs]
    for (x, y), (f, g), lang, score, n in zip(want, foreign, langs, scores, sizes):
        cost = [x * bits[0] + f * 21, y * bits[1] + g * 21]
        if not n:
            assert (lang, score) == ("und", 0)
        elif abs(cost[0] - cost[1]) > max(bits) / 2:
            assert lang == parser.langs[cost.index(min(cost))] and math.isclose(score, 1 - min(cost) / max(cost))
        elif cost[1] - min(cost) <= bits[1] / 2:
            assert lang == "y"


def test_language_of_many_letters():
    """Transitions take memory by their number, not by states times letters."""
    rng = random.Random(3)
    parser = language.Parser({"han": "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(8000)), "en": "the cat sat on the mat " * 50}, {"han": 1, "en": 1})
    assert parser.keys.nbytes + parser.values.nbytes < 4 << 20
    assert parser.predict(["the mat", "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(50))])[0] == ["en", "han"]


def test_pipeline_of_odd_rows(spark):
    """Clashing names, nulls, ties, rows that repeat an id with the same and with other texts, an empty table."""
    import corpus_pipeline as pipeline

    good = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").orderBy("doc_id").select("text").limit(30).collect()]
    rows = [(i, t, "en", "a") for i, t in enumerate(good)] + [(3, good[3], "en", "a"), (3, good[3], "en", "a"), (3, good[4] + " more of it", "en", "a"), (None, good[5], "en", None), (None, "quite another text of some words", None, "b"), (50, None, None, "b"), (51, "", "en", "b"), (52, "1 2 3", None, "b"), (51, "", "en", "b")]
    docs = docs_of(spark, rows).selectExpr("*", "7 as copies", "8 as copy", "1 as predicted", "'z' as lang_pred", "2 as id", "3 as component_id", "map(1, 2) as m", "4 as key", "5 as n_shingles")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), SF).count() == 0, name
        got = out.collect()
        assert all((r["copies"], r["copy"], r["predicted"], r["lang_pred"], r["key"]) == (7, 8, 1, "z", 4) for r in got), name
        if stage is pipeline.known_language:
            assert len(got) == len(rows) - 4 and all(r["lang"] for r in got)
        if stage is pipeline.one_of_each:
            kept = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in got)
            _, label = plain_components([r[1] for r in rows])
            assert len(kept) == len(set(label)) and len([k for k in kept if k[1] == 51]) == 2
            assert len([k for k in kept if k[:2] == (True, 3)]) == len({good[3], good[4] + " more of it"} - {t for t in good[:3]})
        if stage is pipeline.mixed:
            want = mixing.mix(docs).agg(F.sum("copies")).first()[0]
            assert len(got) == want and {r["doc_id"] for r in got} >= {r["doc_id"] for r in mixing.mix(docs).where("copies > 0").collect()}
    assert pipeline.encoded(spark, docs, SF).count() == len(rows) and pipeline.encoded(spark, docs.limit(0), SF).count() == 0


def test_pipeline(spark):
    """Stage by stage against plain versions on the driver."""
    import corpus_pipeline as pipeline
    import tiktoken

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = common.staged(pipeline.quality(spark, docs, SF))
    scores = {r["doc_id"]: r["predicted"] for r in line_crf.quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {i for i, p in scores.items() if p}
    told = common.staged(pipeline.known_language(spark, kept, SF))
    assert told.columns == columns
    rows = sorted(told.collect())
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in kept.collect() if any(c.isalpha() for c in r["text"])}
    single = common.staged(pipeline.one_of_each(spark, told, SF))
    _, label = plain_components([r["text"] for r in rows])
    assert {r["doc_id"] for r in single.collect()} == {r["doc_id"] for k, r in enumerate(rows) if label[k] == k}
    mix = pipeline.mixed(spark, single, SF)
    times = {r["doc_id"]: r["n"] for r in mix.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert times == {r["doc_id"]: r["copies"] for r in mixing.mix(single).collect() if r["copies"]}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in rows}
    out = pipeline.run(spark, SF).collect()
    assert len(out) == sum(times.values())
    for r in out:
        assert r["ids_sha256"] == hashlib.sha256(np.array(enc.encode_ordinary(texts[r["doc_id"]]), "<u4").tobytes()).hexdigest()
