"""Exact Jaccard join of word shingles with set-relation skipping (operator 5).

Documents become sets of shingle hashes; equal sets are one node. Frequent
shingles, found by counts over all documents, go last in the order of tokens,
so the prefix of a set, which every partner must meet, holds rare ones. In the
index lists (token to sets) entries meet where their sizes, their positions in
the two sets and the tokens that neither shares with any set allow the asked
overlap, and a bitmap of each set bounds it from above before any set is read.
In a long list the block of entries with the fewest tokens of their own meets
all others first.

Set relations save most of the rest: a set is first compared with the few
candidates most like it; whoever it links to shares its answer (the
component), so of two sets with the same answer nothing else is compared: in a
long list only sets outside the list's largest component still meet the
others. All skips are exact: no link between sets of different components is
lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.llm import hashing
from lexweave.llm.common import components, discard, mapped, slices, staged

SKETCH_BITS = 2048
MARK_BITS = (22, 27)  # least and most: 16 MB
SALTS = 256  # parts that the list of a frequent token is sorted in


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Of each text its distinct shingles as sorted hashes (int64); with fewer words all of them as one."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    start, _, h = hashing.words(raw)
    every = hashing.shingles(h, words)
    upto = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    out = []
    at = 0
    for end in upto.tolist():
        n = end - at
        if n >= words:
            out.append(np.unique(every[at : end - words + 1].view(np.int64)))
        else:
            out.append(hashing.shingles(h[at:end], n).view(np.int64) if n else np.zeros(0, np.int64))
        at = end
    return out


def signature(tokens: np.ndarray) -> int:
    """64 bits of a digest of a whole set; the empty set has 0."""
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True) if len(tokens) else 0


def sketch(tokens: np.ndarray) -> list[int]:
    """A bitmap with a bit for each token, as 64-bit integers."""
    bits = np.zeros(SKETCH_BITS, np.uint8)
    bits[tokens & (SKETCH_BITS - 1)] = 1
    return np.packbits(bits).view(np.int64)


def describe(docs: DataFrame, kind: str, words: int, often: int, batch_tokens: int) -> DataFrame:
    """A row (id, sig, n, sketch) for each document, and rows (token, times) of tokens that occur
    in `often` different sets or more of a stretch of about batch_tokens tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def frequent() -> pa.RecordBatch:
            token, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            token, times = token[times >= often], times[times >= often]
            none = lambda t: pa.nulls(len(token), t)
            return pa.RecordBatch.from_arrays([none(id_type), none(pa.int64()), none(pa.int32()), none(pa.list_(pa.int64())), pa.array(token), pa.array(times, pa.int64())], names)

        names = ["id", "sig", "n", "sketch", "token", "times"]
        id_type = pa.int64()
        for batch in slices(batches, "text", 1 << 20):
            id_type = batch.column("id").type
            sets = shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], words)
            sigs = [signature(s) for s in sets]
            none = lambda t, n=len(sets): pa.nulls(n, t)
            sketches = pa.array([sketch(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sigs, pa.int64()), pa.array([len(s) for s in sets], pa.int32()), sketches, none(pa.int64()), none(pa.int64())], names)
            for s, sig in zip(sets, sigs, strict=True):
                if sig not in seen:
                    seen.add(sig)
                    held.append(s)
                    size += len(s)
            if size > batch_tokens:
                yield frequent()
                held, seen, size = [], set(), 0
        yield frequent()

    return mapped(docs, run, f"id {kind}, sig long, n int, sketch array<long>, token long, times long")


def postings(docs: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Rows (token, sig, n, pos, hot) of the prefixes of all sets. frequent: tokens in the order in which they go last; hot tells whether the token is one."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(sent.value)
        known = sent.value[order]
        seen: set[int] = set()
        for batch in slices(batches, "text", 1 << 20):
            out: list[tuple[np.ndarray, np.ndarray, int, int]] = []
            for s in shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], words):
                sig, n = signature(s), len(s)
                if not n or sig in seen:
                    continue
                seen.add(sig)
                late = np.zeros(n, bool)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    late = known[at] == s
                    s = np.concatenate([s[~late], s[late][np.argsort(order[at[late]])]])
                    late = np.sort(late)
                prefix = n - (percent * n + 99) // 100 + 1
                out.append((s[:prefix], late[:prefix], sig, n))
            sizes = [len(p) for p, *_ in out]
            tokens = np.concatenate([p for p, *_ in out]) if out else np.zeros(0, np.int64)
            hot = np.concatenate([x for _, x, *_ in out]) if out else np.zeros(0, bool)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum([0, *sizes])[:-1], sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), pa.array(np.repeat(np.array([x for *_, x, _ in out], np.int64), sizes)), pa.array(np.repeat(np.array([x for *_, x in out], np.int32), sizes)), pa.array(pos.astype(np.int32)), pa.array(hot)], ["token", "sig", "n", "pos", "hot"]
            )

    return mapped(docs, run, "token long, sig long, n int, pos int, hot boolean")


def met(rows: DataFrame) -> DataFrame:
    """Postings of tokens that several sets have: one pass over each sorted partition, a row ahead at a time.

    Several sets of one stretch have a hot token, so its postings all stay and
    need not lie together: they are dealt by their sets, into SALTS parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, np.ndarray] | None = None  # the row before, and whether it has been met
        names = ["token", "sig", "n", "pos"]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in [*names, "hot"]}
            was_met = False
            if last is not None:
                was_met = last["met"]
                x = {k: np.concatenate([last[k], v]) for k, v in x.items()}
            new = np.ones(len(x["token"]), bool)
            new[1:] = (x["token"][1:] != x["token"][:-1]) | (x["sig"][1:] != x["sig"][:-1])
            x = {k: v[new] for k, v in x.items()}
            same = x["token"][1:] == x["token"][:-1]
            keep = x["hot"].copy()
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= was_met
            last = {k: v[-1:] for k, v in x.items()} | {"met": bool(keep[-1])}
            keep = keep[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(x[k][:-1][keep]) for k in names], names)
        if last is not None and last["met"]:
            yield pa.RecordBatch.from_arrays([pa.array(last[k]) for k in names], names)

    part = F.when(F.col("hot"), F.pmod("sig", F.lit(SALTS))).otherwise(F.lit(0))
    return mapped(rows.repartition("token", part).sortWithinPartitions("token", "sig"), run, "token long, sig long, n int, pos int")


def bits_for(n: int) -> int:
    """Bits of a place such that n marks fill at most a sixteenth of a bitmap, within its bounds."""
    return min(max(MARK_BITS[0], (16 * n).bit_length()), MARK_BITS[1])


def bitmap(places: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of 2 ** bits positions with a mark for each place."""
    marks = places.groupBy(F.shiftright(column, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({column} % 64 as int))")).alias("m")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[marks["w"].to_numpy(np.int64)] = marks["m"].to_numpy(np.int64)
    return out


def sig_place(sig: Column, bits: int) -> Column:
    return sig.bitwiseXOR(F.shiftright(sig, 29)).bitwiseAND(F.lit((1 << bits) - 1))


def id_place(i: Column, bits: int) -> Column:
    return F.xxhash64(i).bitwiseAND(F.lit((1 << bits) - 1))


def marked(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (marks[places >> 6] >> (places & 63) & 1).astype(bool)


def narrowed(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets of the pairs and a few more, so that a join moves no others."""
    ends = staged(pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct())
    bits = bits_for(ends.count())
    sent = sets.sparkSession.sparkContext.broadcast(bitmap(ends.select(sig_place(F.col("sig"), bits).alias("p")), "p", bits))
    discard(ends)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = marked(sent.value, batch.column("p").to_numpy())
            yield batch.select(["sig", "tokens"]).filter(pa.array(keep))

    return mapped(sets.select("sig", "tokens", sig_place(F.col("sig"), bits).alias("p")), run, "sig long, tokens binary")


def allowed(n_a: Column, n_b: Column, most: Column, percent: int) -> Column:
    """Whether sets of these sizes with an intersection of at most `most` may link."""
    return (100 + percent) * most >= percent * (n_a + n_b)


def apart_of(a: str, b: str) -> Column:
    """How many bits two bitmaps differ in: at least so many tokens only one of the sets has."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, x: s + x)


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those that link, by their exact intersections."""
    sets = narrowed(sets, pairs)
    a = sets.select(F.col("sig").alias("a"), F.col("tokens").alias("x"))
    b = sets.select(F.col("sig").alias("b"), F.col("tokens").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return mapped(pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "x", "y"), run, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85, frequent: int = 1 << 17, often: int = 3, block: int = 32, tries: int = 3) -> DataFrame:
    """Rows (id, n_shingles, component_id), one for each input row.

    Two documents link when 100 * intersection >= percent * union of their
    distinct shingles. Documents without words have no shingles and are alone;
    a null id in a group gets the group's smallest id, alone it stays null.
    Repeated rows link with each other. `frequent` bounds how many of the most
    frequent shingles are told to all tasks; it only orders tokens. Shingles
    and whole sets are compared by 64-bit hashes.
    """
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = text.schema["id"].dataType.simpleString()
    both = staged(describe(text, kind, words, often, 2 << 20))
    rows = both.where("sig is not null").select("id", "sig", "n", "sketch")
    counts = both.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    top = counts.orderBy(F.desc("times"), "token").limit(frequent).toPandas()
    late = top.sort_values(["times", "token"])["token"].to_numpy(np.int64)

    nodes = staged(rows.where("n > 0").groupBy("sig").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    index = index_all = staged(met(postings(text, words, percent, late)))
    # tokens of a prefix that no other set has bound what a set can share with any other
    prefix = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    shared = index.groupBy("sig").agg(F.count(F.lit(1)).alias("met"))
    index = index.join(shared, "sig").withColumn("most", (F.col("n") - prefix + F.col("met")).cast("int")).drop("met")
    index = index.where(allowed(F.col("n"), F.floor((percent * F.col("n") + 99) / 100), F.col("most"), percent))
    index = index_fit = staged(index)
    discard(index_all)
    lists = index.groupBy("token").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    index = staged(index.join(lists, "token"))
    discard(index_fit)

    def candidates(a: DataFrame, b: DataFrame, keys: list[str], more: Column, bitmaps: bool = False) -> DataFrame:
        """Pairs that sizes, positions, unshared tokens and bitmaps allow, with the distance of their bitmaps."""
        a = a.select(*keys, F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a"), F.col("most").alias("most_a"), *([F.col("label").alias("label_a")] if "label" in a.columns else []), *([F.col("sketch").alias("early_a")] if bitmaps else []))
        b = b.select(*keys, F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"), F.col("most").alias("most_b"), *([F.col("label").alias("label_b")] if "label" in b.columns else []), *([F.col("sketch").alias("early_b")] if bitmaps else []))
        most = F.least("pos_a", "pos_b") + 1 + F.least(F.col("n_a") - F.col("pos_a") - 1, F.col("n_b") - F.col("pos_b") - 1)
        most = F.least(most, "most_a", "most_b")
        total = F.col("n_a") + F.col("n_b")
        if bitmaps:  # bound within the join, so that it makes few rows
            more = more & allowed(F.col("n_a"), F.col("n_b"), (total - apart_of("early_a", "early_b")) / 2, percent)
        pairs = a.join(b, keys).where(more & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & allowed(F.col("n_a"), F.col("n_b"), most, percent))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for side in ("a", "b"):
            pairs = pairs.join(nodes.select(F.col("sig").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
        pairs = pairs.select("a", "b", "n_a", "n_b", apart_of("sketch_a", "sketch_b").alias("apart"))
        return pairs.where((100 + percent) * (total - F.col("apart")) >= 2 * percent * total).select("a", "b", (F.col("apart") / total).alias("apart"))

    # short lists whole; in long ones all with a few that have the fewest tokens of their own
    short, long = index.where(F.col("length") <= block), index.where(F.col("length") > block)
    own = F.struct((F.col("n") - F.col("most")).alias("own"), "sig", "n", "pos", "most")
    leaders = long.groupBy("token", F.pmod(F.xxhash64("sig"), F.lit(tries)).alias("part")).agg(F.min(own).alias("l")).select("token", "l.*")
    near = staged(candidates(short, short, ["token"], F.col("a") < F.col("b")).union(candidates(leaders, long, ["token"], F.col("a") != F.col("b"))).distinct())
    wanted = near.select(F.explode(F.array("a", "b")).alias("sig")).union(long.select("sig")).distinct()
    wanted = staged(nodes.join(wanted, "sig", "left_semi").select("sig", "rep"))
    sets = sets_of(text, wanted, words)
    discard(wanted)

    # the few most alike of each set
    ends = near.select(F.col("a").alias("node"), "a", "b", "apart").union(near.select(F.col("b").alias("node"), "a", "b", "apart"))
    first = staged(ends.withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy("apart", "a", "b"))).where(F.col("nth") <= tries).select("a", "b").distinct())
    links = staged(linked(first, sets, percent))
    label = components(links)

    def labelled(df: DataFrame, side: str, out: str) -> DataFrame:
        got = label.select(F.col("node").alias(side), F.col("component").alias(out))
        return df.join(got, side, "left").withColumn(out, F.coalesce(out, side))

    # the rest, where answers differ
    rest = labelled(labelled(near.select("a", "b").join(first, ["a", "b"], "left_anti"), "a", "label_a"), "b", "label_b").where("label_a <> label_b").select("a", "b")
    long_listed = staged(labelled(long.select("token", "sig", "n", "pos", "most"), "sig", "label"))
    long = long_listed
    shares = long.groupBy("token", "label").agg(F.count(F.lit(1)).alias("m"))
    largest = shares.groupBy("token").agg(F.max(F.struct("m", "label")).alias("top")).select("token", F.col("top.label").alias("main"))
    long = long.join(nodes.select("sig", "sketch"), "sig")
    outside = long.join(largest, "token").where("label <> main").drop("main")
    across = candidates(outside, long, ["token"], F.col("label_a") != F.col("label_b"), bitmaps=True).select("a", "b")
    rest = staged(rest.union(across).distinct())
    every_link = staged(links.union(linked(rest, sets, percent)))
    discard(links, rest, sets, long_listed, index, near, first)

    parts = components(every_link)
    discard(every_link)
    known = nodes.select("sig", "rep").join(parts, nodes.sig == parts.node, "left").select("sig", "rep", F.coalesce("component", "sig").alias("component"))
    smallest = known.groupBy("component").agg(F.min("rep").alias("smallest"))
    answer = known.join(smallest, "component").select("sig", "smallest")
    out = rows.select("id", "n", "sig").join(answer, "sig", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("id")).alias("component_id"))


def sets_of(text: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Rows (sig, tokens) of wanted rows (sig, rep), and a few more.

    Bitmaps tell tasks which sets to emit, and by which document's id, so that
    of thousands of copies one emits the set. They grow with the wanted sets up
    to a bound, beyond which more sets than those come along. Where none has an
    id, or ids collide, a set may come several times.
    """
    bits = bits_for(wanted.count())
    places = [bitmap(wanted.select(sig_place(F.col("sig"), bits).alias("p")), "p", bits), bitmap(wanted.where("rep is not null").select(id_place(F.col("rep"), bits).alias("p")), "p", bits)]
    marks = text.sparkSession.sparkContext.broadcast(tuple(places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_sig, by_id = marks.value
        seen: set[int] = set()
        for batch in slices(batches, "text", 1 << 20):
            asked = batch.column("p")
            batch = batch.filter(pa.array(asked.is_null().to_numpy(zero_copy_only=False) | marked(by_id, asked.fill_null(0).to_numpy())))
            sigs, sets = [], []
            for s in shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], words):
                sig = signature(s)
                if len(s) and sig not in seen and marked(by_sig, np.array([(sig ^ (sig >> 29)) & ((1 << bits) - 1)]))[0]:
                    seen.add(sig)
                    sigs.append(sig)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(sets, pa.binary())], ["sig", "tokens"])

    return staged(mapped(text.select("text", F.when(F.col("id").isNotNull(), id_place(F.col("id"), bits)).alias("p")), run, "sig long, tokens binary"))
