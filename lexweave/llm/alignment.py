"""Alignment of the tokens of two tokenizers over whole texts (operator 11).

Two tokens are linked where their byte ranges overlap. A text is cut before
every space that follows anything but white space: there both tokenizers end a
token whatever stands around it (checked on loading), so words are aligned once
for each task's memory and a document is the sum of its words.

How many documents of the corpus hold a pair takes a cogroup of postings. A
block of documents writes, for each bucket of side ids, its pairs with the
documents and multiplicities in which they stand. Counts of pairs add up from
the blocks' own counts; then counts and postings of a bucket meet in one stream
that Spark sorts and may spill, the counts first: maxima are taken there, and a
block's documents get what they count for, which adds up by block at last. A
bucket with many postings, as one frequent id makes it, is dealt in as many
units as it needs, each with the bucket's counts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import Recent, narrow, runs, slices, staged, wide

SPACE = "▁"
#: A space after no white space, before anything: the piece model would take a text of nothing as no token.
CUT = re.compile(r"(?s)(?<=\S) (?=.)")
ODD = re.compile(r"\s ")
HEAD = struct.Struct("<4i")
JOINED = 64  # new words that the tokenizers get as one text
AT_ONCE = 1 << 20  # characters of new words that are aligned at a time, or one longer word


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Aligned words by the word, without the space before it; memory is bounded by bytes."""

    def __init__(self, a_file: str, b_file: str, keep_bytes: int = 48 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=b_file)
        letters = byte_letters()
        self.a_bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        pieces = [sp.id_to_piece(i) for i in range(len(sp))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        with open(a_file, encoding="utf-8") as f:
            made = json.load(f)
        before = made.get("pre_tokenizer") or {}
        a_cuts = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and made.get("normalizer") is None
        probe = "ﬁ ①  x"
        b_cuts = sp.decode(sp.encode(probe)) == probe and sp.encode("a b") == sp.encode("a") + sp.encode("b") and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.cuts = bool(a_cuts and b_cuts)
        a_table = [self.a_bytes.get(i, b"") for i in range(max(self.a_bytes) + 1)]
        self.tables = [(t, np.array(list(map(len, t)), np.int64)) for t in (a_table, self.b_bytes)]
        self.known = Recent(keep_bytes)

    def words(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if "  " in text or text[:1] == " " or text[-1:] == " " or ODD.search(text):
            return CUT.split(text)
        return text.split(" ")

    def learn(self, words: set[str]) -> None:
        self.known.age()
        if new := self.known.unknown(words):
            one = [w for w in new if not self.cuts or not w or w[-1].isspace()]  # after these no cut is sure
            if len(one) < len(new):
                single = set(one)
                several = [w for w in new if w not in single] if single else new
                upto = np.cumsum(list(map(len, several)))
                edges = np.unique(np.r_[0, np.searchsorted(upto, np.arange(AT_ONCE, upto[-1], AT_ONCE)), len(several)]).tolist()
                for s, e in pairwise(edges):
                    one += self.learn_joined(several[s:e])
            if one:
                a = [e.ids for e in self.a.encode_batch([f" {w}" for w in one], add_special_tokens=False)]
                self.known.keep(one, [self.aligned(*x) for x in zip(one, a, self.b.encode(one, num_threads=1), strict=True)])

    def learn_joined(self, words: list[str]) -> list[str]:
        """Learn words that may stand before a cut, many in a text for the tokenizers; the words of texts that either changes are given back."""
        parts = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        texts = list(map(" ".join, parts))
        a = [e.ids for e in self.a.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        (a_bytes, a_sizes), (b_bytes, b_sizes) = self.tables
        same = []
        for text, x, y in zip(texts, a, b, strict=True):
            want = f" {text}".encode()
            same.append(b"".join(map(a_bytes.__getitem__, x)) == want == b"".join(map(b_bytes.__getitem__, y)))
        good, left = list(chain.from_iterable(p for p, s in zip(parts, same, strict=True) if s)), list(chain.from_iterable(p for p, s in zip(parts, same, strict=True) if not s))
        if not good:
            return left
        a, b = (np.array(list(chain.from_iterable(x for x, s in zip(ids, same, strict=True) if s)), np.int64) for ids in (a, b))
        ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in good), np.int64, len(good))) - 1
        a_ends, b_ends = np.cumsum(a_sizes[a]) - 1, np.cumsum(b_sizes[b]) - 1
        in_a, in_b = np.zeros((2, int(ends[-1]) + 1), bool)
        in_a[a_ends], in_b[b_ends] = True, True
        if not (in_a[ends] & in_b[ends]).all() or not a_sizes[a].all() or not b_sizes[b].all():
            return words
        self.known.keep(good, joined_values(a, b, a_ends, b_ends, in_a, in_b, ends))
        return left

    def aligned(self, word: str, a: list[int], b: list[int]) -> bytes:
        """Numbers of tokens, groups and links, the linked pairs and the groups' text; nothing where bytes differ from the word's."""
        ours, theirs = [self.a_bytes.get(i, b"") for i in a], [self.b_bytes[i] for i in b]
        want = f" {word}".encode()
        if b"".join(ours) != want or b"".join(theirs) != want:
            return b""
        pairs, groups = [], []
        i = j = from_i = from_j = 0
        end_a, end_b = len(ours[0]), len(theirs[0])
        while True:
            pairs.append(a[i] << 32 | b[j])
            if end_a == end_b:
                groups.append(f"{','.join(map(str, a[from_i : i + 1]))}|{','.join(map(str, b[from_j : j + 1]))}")
                from_i, from_j = i + 1, j + 1
            step_a, step_b = end_a <= end_b, end_b <= end_a
            if step_a:
                i += 1
                if i == len(a):
                    break
                end_a += len(ours[i])
            if step_b:
                j += 1
                end_b += len(theirs[j])
        return HEAD.pack(len(a), len(b), len(groups), len(pairs)) + np.array(pairs, "<i8").tobytes() + ";".join(groups).encode()


def joined_values(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """What Aligner.aligned() gives, for words one after another: ids, the last bytes of tokens, whether bytes are such, the last bytes of words.

    Between two ends on either side lies one link, as an overlap holds no end.
    """
    cuts = np.flatnonzero(in_a | in_b)
    pairs = (a[np.searchsorted(a_ends, cuts)] << 32 | b[np.searchsorted(b_ends, cuts)]).astype("<i8").tobytes()
    group_ends = np.flatnonzero(in_a & in_b)
    upto = [np.searchsorted(x, ends, "right") for x in (a_ends, b_ends, group_ends, cuts)]
    heads = np.stack([np.diff(u, prepend=0) for u in upto], 1).astype("<i4").tobytes()

    a_group, b_group = np.searchsorted(group_ends, a_ends), np.searchsorted(group_ends, b_ends)
    a_upto, b_upto = np.searchsorted(a_ends, group_ends, "right"), np.searchsorted(b_ends, group_ends, "right")
    a_at, b_at = np.arange(len(a)) + np.r_[0, b_upto][a_group], np.arange(len(b)) + a_upto[b_group]
    number, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    number[a_at], number[b_at] = a, b
    mark[a_at[a_upto - 1]], mark[b_at[b_upto - 1]] = ord("|"), ord(";")
    digits = np.ones(len(number), np.int64)
    tens = [10**k for k in range(1, len(str(int(number.max()))))]
    for ten in tens:
        digits += number >= ten
    stops = np.cumsum(digits + 1) - 1  # where marks stand
    text = np.empty(int(stops[-1]) + 1, np.uint8)
    text[stops] = mark
    text[stops - 1] = 48 + number % 10
    for k, ten in enumerate(tens, 2):
        longer = np.flatnonzero(digits >= k)
        text[stops[longer] - k] = 48 + number[longer] // ten % 10
    groups = text.tobytes()
    last = stops[upto[0] + upto[1] - 1].tolist()
    links = (8 * upto[3]).tolist()
    return [heads[16 * i : 16 * i + 16] + pairs[s:e] + groups[f:g] for i, (s, e, f, g) in enumerate(zip([0, *links[:-1]], links, [0, *(x + 1 for x in last[:-1])], last, strict=True))]


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[start], np.add.reduceat(values, start)


def bucket_of(side: np.ndarray, buckets: int) -> np.ndarray:
    return (side.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % buckets


FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def block_rows(texts: list[str], aligner: Aligner) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Sums of FIELDS and a digest for each text; then postings (pair, text, multiplicity), sorted."""
    words = [aligner.words(t) if t and SPACE not in t else [] for t in texts]
    distinct = set().union(*words)
    aligner.learn(distinct)
    known, distinct = aligner.known.now, list(distinct)
    values = [known[w] for w in distinct]
    bad = {w for w, v in zip(distinct, values, strict=True) if not v}
    if bad:
        words = [[] if not bad.isdisjoint(ws) else ws for ws in words]
    at = {w: k for k, w in enumerate(distinct)}
    head = np.array([HEAD.unpack_from(v) if v else (0, 0, 0, 0) for v in values], np.int64).reshape(-1, 4)
    groups = {w: v[16 + 8 * n :] for w, v, n in zip(distinct, values, head[:, 3].tolist(), strict=True)}
    digests = [hashlib.sha256(b";".join(map(groups.__getitem__, ws))).hexdigest() if ws else "" for ws in words]

    sizes = np.array([len(ws) for ws in words], np.int64)
    flat = np.fromiter(map(at.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    seen, times = np.unique(text * max(1, len(distinct)) + flat, return_counts=True)
    text, word = seen // max(1, len(distinct)), seen % max(1, len(distinct))
    sums = []
    for k in range(4):
        total = np.zeros(len(texts), np.int64)
        np.add.at(total, text, head[word, k] * times)
        sums.append(total)

    all_pairs = np.frombuffer(b"".join(v[16 : 16 + 8 * n] for v, n in zip(values, head[:, 3].tolist(), strict=True)), "<i8")
    first = np.cumsum(head[:, 3]) - head[:, 3]
    pairs, number = np.unique(all_pairs, return_inverse=True)
    n = head[word, 3]
    where = np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    key, times = summed(number[where] * len(texts) + np.repeat(text, n), np.repeat(times, n))
    return sums, digests, pairs[key // len(texts)] if len(key) else key, key % len(texts), times


def encoded(docs: DataFrame, a_file: str, b_file: str, buckets: int, block_bytes: int) -> DataFrame:
    """Rows of two kinds. Documents: (block, at, id, FIELDS, digest). Postings: (block, bucket, pairs, held, postings)."""
    ident = docs.schema["id"].dataType.simpleString()
    shape = f"block long, at int, id {ident}, {', '.join(f'{f} long' for f in FIELDS)}, digest string, bucket int, pairs array<long>, held array<long>, postings binary"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    names = [p.split()[0] for p in shape.split(", ")]
    kinds = to_arrow_schema(_parse_datatype_string(shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_file, b_file)
        block = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", block_bytes, 1 << 16):
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            sums, digests, pair, text, times = block_rows(texts, aligner)
            empty = lambda name, n: pa.nulls(n, kinds.field(name).type)
            n = len(texts)
            told = {"block": pa.array([block] * n, pa.int64()), "at": pa.array(range(n), pa.int32()), "id": ids, "digest": pa.array(digests)} | {f: pa.array(s) for f, s in zip(FIELDS, sums, strict=True)}
            yield pa.RecordBatch.from_arrays([told.get(c, None) if c in told else empty(c, n) for c in names], names)
            bucket = bucket_of(pair >> 32, buckets)
            rows = []
            for b in np.unique(bucket):
                mine = np.flatnonzero(bucket == b)
                start = np.flatnonzero(np.r_[True, pair[mine][1:] != pair[mine][:-1]])
                rows.append((int(b), pair[mine][start], np.diff(np.r_[start, len(mine)]), narrow(text[mine]) + narrow(times[mine])))
            if rows:
                n = len(rows)
                told = {"block": pa.array([block] * n, pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int32()), "pairs": pa.array([r[1] for r in rows], pa.list_(pa.int64())), "held": pa.array([r[2] for r in rows], pa.list_(pa.int64())), "postings": pa.array([r[3] for r in rows], pa.binary())}
                yield pa.RecordBatch.from_arrays([told.get(c, None) if c in told else empty(c, n) for c in names], names)
            block += 1

    return docs.mapInArrow(run, shape)


def contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a unit's counts, then its postings: (block, data) with what documents of the block get."""
    unit, counts, ready = None, [], False
    pairs = n = best = np.empty(0, np.int64)
    for (now, kind), rows in runs(batches, "unit", "kind"):
        if now != unit:
            unit, counts, ready = now, [], False
        if kind == 0:
            counts.append((rows.column("pair").to_numpy(), rows.column("n").to_numpy()))
            continue
        if not ready:
            pairs, n = map(np.concatenate, zip(*counts, strict=True))
            order = np.argsort(pairs)
            pairs, n = pairs[order], n[order]
            start = np.flatnonzero(np.r_[True, (pairs[1:] >> 32) != (pairs[:-1] >> 32)])
            best = n == np.repeat(np.maximum.reduceat(n, start), np.diff(np.r_[start, len(n)]))
            ready = True
        out = []
        for block, own, held, data in zip(rows.column("block").to_pylist(), rows.column("pairs"), rows.column("held"), rows.column("postings"), strict=True):
            at = np.searchsorted(pairs, own.values.to_numpy())
            text, times = wide(data.as_py(), 2)
            at = np.repeat(at, held.values.to_numpy())
            got, which = np.unique(text, return_inverse=True)
            sums = np.zeros((2, len(got)), np.int64)
            np.add.at(sums[0], which, times * best[at])
            np.add.at(sums[1], which, times * n[at])
            out.append((block, got.astype("<i8").tobytes() + sums.astype("<i8").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["block", "data"])


def added(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """From a block's contributions, then its documents: the documents with both sums."""
    block, parts, sums = None, [], np.zeros((2, 0), np.int64)
    for (now, kind), rows in runs(batches, "block", "kind"):
        if now != block:
            block, parts, sums = now, [], np.zeros((2, 0), np.int64)
        if kind == 0:
            for data in rows.column("data").to_pylist():
                got = np.frombuffer(data, "<i8").reshape(3, -1)
                if got[0].max() >= sums.shape[1]:
                    sums = np.pad(sums, ((0, 0), (0, int(got[0].max()) + 1 - sums.shape[1])))
                sums[:, got[0]] += got[1:]
            continue
        at = rows.column("at").to_numpy()
        more = np.zeros((2, len(at)), np.int64)
        inside = at < sums.shape[1]
        more[:, inside] = sums[:, at[inside]]
        told = {"n_best": pa.array(more[0]), "count_sum": pa.array(more[1])}
        yield pa.RecordBatch.from_arrays([told[c] if c in told else rows.column(c) for c in names], names)


def align(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", buckets: int = 64, block_bytes: int = 4 << 20, unit_bytes: int = 16 << 20) -> DataFrame:
    """A row (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each document.

    A reads a space and the text, B the text, before which it puts a space by
    itself; neither adds special tokens, and their strings in a text are plain
    text. Null and empty texts, and texts that either tokenizer changes, have
    no tokens: zeros, and '' as digest. Rows may repeat and ids may be null;
    each row is a document. An empty table gives no rows; other columns are
    left out. A block holds block_bytes of texts or one longer text, which is
    held whole; a unit of postings unit_bytes.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    both = staged(encoded(rows, a_file, b_file, buckets, block_bytes))
    postings = both.where("bucket is not null").select("block", "bucket", "pairs", "held", "postings")
    sizes = {r["bucket"]: r["size"] for r in postings.groupBy("bucket").agg(F.sum(F.octet_length("postings")).alias("size")).collect()}  # a row a bucket
    units = [max(1, -(-sizes.get(b, 0) // unit_bytes)) for b in range(buckets)]
    first = [sum(units[:b]) for b in range(buckets)]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("bucket") + 1)

    held = postings.select("bucket", F.explode(F.arrays_zip("pairs", "held")).alias("p")).groupBy("bucket", F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n"))
    held = held.select(F.explode(F.sequence(of(first), of(first) + of(units) - 1)).alias("unit"), F.lit(0).alias("kind"), "pair", "n")
    dealt = postings.select((of(first) + F.pmod(F.xxhash64("block"), of(units)).cast("int")).alias("unit"), F.lit(1).alias("kind"), "block", "pairs", "held", "postings")
    stream = held.unionByName(dealt, allowMissingColumns=True).repartition("unit").sortWithinPartitions("unit", "kind")
    given = stream.mapInArrow(contributions, "block long, data binary").withColumn("kind", F.lit(0))

    texts = both.where("at is not null").select("block", F.lit(1).alias("kind"), "at", "id", *FIELDS, "digest")
    names = ["id", *FIELDS, "n_best", "count_sum", "digest"]
    shape = f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in names[1:-1])}, digest string"
    stream = given.unionByName(texts, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")
    return stream.mapInArrow(lambda batches: added(batches, names), shape).withColumnsRenamed({"id": "doc_id", "digest": "groups_sha256"})
