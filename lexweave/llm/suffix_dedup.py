"""Removal of what stands earlier in the corpus, byte by byte (operator 13).

A byte goes if a string of `length` bytes that covers it also starts earlier.
Not every suffix of the corpus is sorted, but those at anchors: of every window
of `length` bytes the position whose gram (the next `gram` bytes) has the least
hash, the first of equals. Equal windows have their anchor at the same place,
so all copies of a window are found among the suffixes of one gram, read with
the bytes before them.

1. Documents are packed into slices (written once, compressed), and a slice sends the distinct hashes of
   its anchors' grams. What occurs in one place only has no copy and goes.
2. Splitters, quantiles of a sample of the repeated grams, deal the suffixes of
   the others (what is equal within a slice combined) into ranges by their
   leading bytes. A range sorts its suffixes by multikey quicksort on tokens of
   eight bytes: ties alone go on to the next token. Equal suffixes with equal
   bytes before them are copies as a whole; of a gram with several surroundings
   the windows themselves are sorted.
3. A gram that fills more than one range, so that its suffixes would lie across
   boundaries, is compared window by window over all slices, by 128-bit hashes
   and after a slice has sent each window once.
4. The copied windows go back to their slices, which cut them out.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import narrow, runs, slices, staged, wide
from lexweave.llm.mixing import numbered

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
SHIFT = np.uint64(31)
PLACES = 18  # bits of a position within a chunk
CHUNK = 1 << 17
SAMPLE = 64  # of so many grams one is a candidate for a splitter
MOST = 1 << 16  # candidates that the driver reads; the number of ranges stays below
CODEC = pa.Codec("zstd", compression_level=9)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * M1 + b * M2
    x ^= x >> SHIFT
    return x * M3


def words_of(buffer: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight bytes from each position on, as one number; no copy."""
    return np.ndarray(max(0, len(buffer) - 7), kind, buffer.data, 0, (1,)) if len(buffer) >= 8 else np.empty(0, kind)


def gram_hashes(buffer: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the `gram` bytes (a multiple of 8) from each position on."""
    level = words_of(buffer) * M3
    level ^= level >> SHIFT
    out, done, size, left = None, 0, 8, gram // 8
    while left:
        if left & 1:
            out = level if out is None else mixed(out[: len(level) - done], level[done:])
            done += size
        left >>= 1
        if left:
            level = mixed(level[:-size], level[size:])
            size *= 2
    return out[: len(buffer) - gram + 1]


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def anchors(buffer: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, number of windows, hash of the anchor's gram) for texts one after another, which end at `ends`.

    Windows lie within one text; those of an anchor follow one another.
    """
    found: list[list[np.ndarray]] = [[], [], [], []]
    whole = np.ones(len(buffer), bool)
    start = 0
    for end in ends.tolist():
        whole[max(start, end - length + 1) : end] = False
        start = end
    width, mask = length - gram + 1, np.uint64((1 << PLACES) - 1)
    for at in range(0, max(0, len(buffer) - length + 1), CHUNK):
        part = buffer[at : at + CHUNK + length - 1]
        hashes = gram_hashes(part, gram)
        least = least_in((hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64), width)
        windows = np.flatnonzero(whole[at : at + len(least)])
        if len(windows):
            place = (least[windows] & mask).astype(np.int64)
            first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)])
            for kept, new in zip(found, (place[first] + at, windows[first] + at, np.diff(np.r_[first, len(windows)]), hashes[place[first]]), strict=True):
                kept.append(new)
    if not found[0]:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    anchor, window, n, hashes = map(np.concatenate, found)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + n[:-1])])  # joins what the end of a chunk has cut
    return anchor[first], window[first], np.add.reduceat(n, first), hashes[first]


def hashed(buffer: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hashes of the `length` bytes from each of some positions on."""
    words = words_of(buffer)
    out = np.full(len(at), seed, np.uint64)
    for k in [*range(0, length - 7, 8), length - 8]:
        out = mixed(out, words[at + k])
    return out


def multikey(columns: list[np.ndarray], watch: int = -1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the columns, and for each place where the rows equal to it begin; then the same for the first `watch` columns alone.

    Each column is looked at only where all before it are tied.
    """
    n = len(columns[0])
    order, group = np.arange(n), np.zeros(n, np.int64)
    watched = group
    for k, column in enumerate(columns):
        if k == watch:
            watched = group.copy()
        first = np.flatnonzero(group == np.arange(n))
        size = np.diff(np.r_[first, n])
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            break
        rows, of = order[tied], group[tied]
        key = column[rows]
        by = np.lexsort((key, of))
        rows, of, key = rows[by], of[by], key[by]
        new = np.r_[True, (of[1:] != of[:-1]) | (key[1:] != key[:-1])]
        order[tied] = rows
        group[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, group, (watched if watch >= 0 and k >= watch else group)


TOP = np.array([0] + [(1 << 64) - (1 << 64 - 8 * v) for v in range(1, 9)], np.uint64)


def tokens(buffer: np.ndarray, start: np.ndarray, size: np.ndarray, most: int) -> list[np.ndarray]:
    """Strings as columns of eight-byte tokens that sort as bytes do; beyond a string's end there are zeros."""
    words = words_of(buffer, ">u8")
    return [words[start + k].astype(np.uint64) & TOP[np.clip(size - k, 0, 8)] for k in range(0, most, 8)]


def padded(data: bytes) -> np.ndarray:
    return np.frombuffer(data + bytes(136), np.uint8)


def squeezed(data: bytes) -> bytes:
    return struct.pack("<q", len(data)) + CODEC.compress(data, asbytes=True)


def expanded(data: bytes) -> bytes:
    return CODEC.decompress(data[8:], struct.unpack_from("<q", data)[0], asbytes=True)


class Cut:
    """A slice: its texts one after another in order, their anchors, and the distinct hashes of these."""

    def __init__(self, data: bytes, ends: np.ndarray, order: np.ndarray, length: int, gram: int):
        self.data, self.ends, self.order, self.length, self.gram = data, ends, order, length, gram
        plain = np.frombuffer(data, np.uint8)
        self.anchor, self.window, self.n, hashes = anchors(plain, ends, length, gram)
        hashes = (hashes ^ hashes >> SHIFT) * M2  # least ones are small; this spreads them evenly again
        self.distinct, self.which, times = np.unique(hashes, return_inverse=True, return_counts=True)
        self.again = times > 1

    def sampled(self) -> np.ndarray:
        """Of the distinct hashes those whose gram may become a splitter."""
        return np.flatnonzero((self.distinct * M2 >> np.uint64(40)) % np.uint64(SAMPLE) == 0)

    def grams(self, wanted: np.ndarray) -> list[bytes]:
        at = np.zeros(len(self.distinct), np.int64)
        at[self.which] = self.anchor
        return [self.data[i : i + self.gram] for i in at[wanted].tolist()]


def cut_slices(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[pa.RecordBatch]:
    nth = TaskContext.get().partitionId() << 33
    for batch in slices(batches, "text", slice_bytes, 1 << 16):
        order = batch.column("place").to_numpy()
        by = np.argsort(order, kind="stable")
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        texts = [texts[i] for i in by]
        ends = np.cumsum([len(t) for t in texts])
        told = {"slice": pa.array([nth], pa.int64()), "ids": pa.array([batch.column("id").take(pa.array(by)).to_pylist()], pa.list_(pa.int64()))}
        told |= {"places": pa.array([order[by]], pa.list_(pa.int64())), "ends": pa.array([ends], pa.list_(pa.int64())), "texts": pa.array([squeezed(b"".join(texts))], pa.binary())}
        yield pa.RecordBatch.from_arrays(list(told.values()), list(told))
        nth += 1


SLICES = "slice long, ids array<long>, places array<long>, ends array<long>, texts binary"


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of hashes of equal width."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def cut_of(row: dict, length: int, gram: int) -> Cut:
    return Cut(expanded(row["texts"]), np.array(row["ends"], np.int64), np.array(row["places"], np.int64), length, gram)


def dealt_hashes(batches: Iterator[pa.RecordBatch], parts: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
            at, whole = row["slice"], cut_of(row, length, gram)
            hashes, again, some = whole.distinct, whole.again, whole.sampled()
            if not len(hashes):
                continue
            sample, grams = hashes[some], b"".join(whole.grams(some))
            rows, first = np.unique(part_of(hashes, parts), return_index=True)
            edges = np.r_[first, len(hashes)]
            own = np.r_[np.searchsorted(part_of(sample, parts), rows), len(sample)]
            each = list(zip(edges, edges[1:], own, own[1:], strict=False))
            told = {"part": pa.array(rows, pa.int32()), "slice": pa.array([at] * len(rows), pa.int64()), "hashes": pa.array([hashes[s:e].tobytes() for s, e, _, _ in each], pa.binary())}
            told |= {"again": pa.array([np.packbits(again[s:e]).tobytes() for s, e, _, _ in each], pa.binary())}
            told |= {"sample": pa.array([sample[i:j].tobytes() for _, _, i, j in each], pa.binary()), "grams": pa.array([grams[i * gram : j * gram] for _, _, i, j in each], pa.binary())}
            yield pa.RecordBatch.from_arrays(list(told.values()), list(told))


def gathered(batches: Iterator[pa.RecordBatch], column: str, *fields: str) -> Iterator[tuple[int, list[list]]]:
    """For each value of a sorted column the lists of some other columns."""
    now, held = None, [[] for _ in fields]
    for (key,), rows in runs(batches, column):
        if key != now:
            if now is not None:
                yield now, held
            now, held = key, [[] for _ in fields]
        for kept, f in zip(held, fields, strict=True):
            kept += rows.column(f).to_pylist()
    if now is not None:
        yield now, held


def repeated(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Of each part's hashes which occur again: rows (slice, part, flags, n), and sampled grams of these in rows (gram)."""
    for part, (at, hashes, again, sample, grams) in gathered(batches, "part", "slice", "hashes", "again", "sample", "grams"):
        each = [np.frombuffer(h, np.uint64) for h in hashes]
        every = np.sort(np.concatenate(each))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        flags = [np.unpackbits(np.frombuffer(a, np.uint8), count=len(h)).astype(bool) | held_in(h, twice) for h, a in zip(each, again, strict=True)]
        told = {"slice": pa.array(at, pa.int64()), "part": pa.array([part] * len(at), pa.int32()), "flags": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary()), "n": pa.array([int(f.sum()) for f in flags], pa.int64()), "gram": pa.nulls(len(at), pa.binary())}
        yield pa.RecordBatch.from_arrays(list(told.values()), list(told))
        kept = []
        for h, f, s, g in zip(each, flags, sample, grams, strict=True):
            s = np.frombuffer(s, np.uint64)
            kept += [g[i * gram : (i + 1) * gram] for i in np.flatnonzero(held_in(s, h[f])).tolist()]
        told = {"slice": pa.nulls(len(kept), pa.int64()), "part": pa.nulls(len(kept), pa.int32()), "flags": pa.nulls(len(kept), pa.binary()), "n": pa.nulls(len(kept), pa.int64()), "gram": pa.array(kept, pa.binary())}
        yield pa.RecordBatch.from_arrays(list(told.values()), list(told))


def held_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among sorted ones."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def splitters(grams: list[bytes], ranges: int) -> tuple[list[bytes], set[bytes]]:
    """Quantiles of a sample; and those that fill more than one range."""
    grams = sorted(grams)
    at = [grams[len(grams) * i // ranges] for i in range(1, ranges)] if grams else []
    return sorted(set(at)), {a for a, b in zip(at, at[1:]) if a == b}


def positions(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """at, at + 1 ... for each, n of them."""
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def sent(cut: Cut, flags: np.ndarray, split: list[bytes], across: set[bytes], ranges: int) -> Iterator[tuple[int, int, bytes]]:
    """What a slice sends: (unit, kind, data). Kind 0: windows known as copies; 1: suffixes for a range; 2: windows of grams across ranges."""
    wanted = np.flatnonzero(flags[cut.which])
    if not len(wanted):
        return
    anchor, window, n = cut.anchor[wanted], cut.window[wanted], cut.n[wanted]
    buffer, size = padded(cut.data), cut.length
    back = anchor - window
    ends = [hashed(buffer, p, size, seed) for p in (window, window + n - 1) for seed in (1, 2)]
    shape = (back * size + n).astype(np.uint64)
    order, group, _ = multikey([mixed(ends[0], ends[2]), mixed(ends[1], ends[3]), shape])
    order = order[np.lexsort((window[order], group))]
    first = group == np.arange(len(group))
    copies, kept = order[~first], np.sort(order[first])
    known = [(window[copies], n[copies])]

    grams = [cut.data[a : a + cut.gram] for a in anchor[kept].tolist()]
    of = {g: -1 if g in across else bisect_right(split, g) for g in set(grams)}
    place = np.array([of[g] for g in grams], np.int64)
    text = np.searchsorted(cut.ends, window, "right")
    for unit in np.unique(place[place >= 0]):
        some = kept[place == unit]
        w, m = window[some], n[some]
        data = buffer[positions(w, m + size - 1)].tobytes()
        yield int(unit), 1, squeezed(b"".join(map(narrow, (w, m, back[some], cut.order[text[some]]))) + data)
    if (some := kept[place < 0]).size:
        w = np.sort(positions(window[some], n[some]))
        one, two = (hashed(buffer, w, size, seed) for seed in (3, 4))
        order, group, _ = multikey([one, two])
        order = order[np.lexsort((w[order], group))]
        first = group == np.arange(len(group))
        known.append((w[order[~first]], np.ones(int((~first).sum()), np.int64)))
        kept_w = np.sort(order[first])
        w, one, two = w[kept_w], one[kept_w], two[kept_w]
        order = cut.order[np.searchsorted(cut.ends, w, "right")]
        part = part_of(one, ranges)
        for unit in np.unique(part):
            mine = part == unit
            yield ranges + int(unit), 2, narrow(w[mine]) + narrow(order[mine]) + one[mine].tobytes() + two[mine].tobytes()
    at, n = (np.concatenate(x) for x in zip(*known, strict=True))
    if len(at):
        yield -1, 0, narrow(at) + narrow(n)


def sorted_range(data: list[bytes], length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Copies among the suffixes of a range: (which of the data, window, number of windows)."""
    head, texts = [], []
    for k, packed in enumerate(data):
        raw = expanded(packed)
        w, n, back, order = wide(raw, 4)
        texts.append(raw[len(raw) - int((n + length - 1).sum()) :])
        head.append((np.full(len(w), k), w, n, back, order))
    of, window, n, back, order = map(np.concatenate, zip(*head, strict=True))
    buffer = padded(b"".join(texts))
    start = np.cumsum(n + length - 1) - (n + length - 1)
    right = n - 1 + length - back
    columns = tokens(buffer, start + back, right, length) + tokens(buffer, start, back, length - gram) + [(back * 2 * length + n).astype(np.uint64)]
    by, group, same_gram = multikey(columns, gram // 8)
    by = by[np.lexsort((window[by], of[by], order[by], group))]
    first = group == np.arange(len(group))
    out = [(of[by[~first]], window[by[~first]], n[by[~first]])]

    # of grams with several surroundings: the windows
    classes = np.zeros(len(by), np.int64)
    np.add.at(classes, same_gram[first], 1)
    edges = first & (classes[same_gram] > 1)
    if edges.any():
        rows = by[edges]
        each = n[rows]
        at = positions(start[rows], each)
        nth = at - np.repeat(start[rows], each)
        key = np.repeat(same_gram[edges], each) * (2 * length) + np.repeat(back[rows], each) - nth
        row = np.repeat(rows, each)
        hashes = hashed(buffer, at, length, 5) ^ (key.astype(np.uint64) * M2)
        ordered = np.sort(hashes)
        again = held_in(hashes, np.unique(ordered[1:][ordered[1:] == ordered[:-1]]))
        at, nth, key, row = at[again], nth[again], key[again], row[again]
        if len(at):
            by, group, _ = multikey([key.astype(np.uint64), *tokens(buffer, at, np.full(len(at), length), length)])
            by = by[np.lexsort((window[row[by]] + nth[by], of[row[by]], order[row[by]], group))]
            copies = by[group != np.arange(len(group))]
            out.append((of[row[copies]], window[row[copies]] + nth[copies], np.ones(len(copies), np.int64)))
    return out


def sorted_windows(data: list[bytes], length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Copies among windows of grams that lie across ranges."""
    head = []
    for k, packed in enumerate(data):
        w, order = wide(packed, 2)
        one, two = np.frombuffer(packed[-16 * len(w) :], np.uint64).reshape(2, -1)
        head.append((np.full(len(w), k), one, two, w, order))
    of, one, two, window, order = map(np.concatenate, zip(*head, strict=True))
    by, group, _ = multikey([one, two])
    by = by[np.lexsort((window[by], of[by], order[by], group))]
    copies = by[group != np.arange(len(group))]
    return [(of[copies], window[copies], np.ones(len(copies), np.int64))]


def compared(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Rows (slice, data) of copied windows."""
    for unit, (at, kind, data) in gathered(batches, "unit", "slice", "kind", "data"):
        rows = [(s, d) for s, k, d in zip(at, kind, data, strict=True) if k == 0]
        for k, run in ((1, sorted_range), (2, sorted_windows)):
            own = [i for i, x in enumerate(kind) if x == k]
            if own:
                of, window, n = map(np.concatenate, zip(*run([data[i] for i in own], length, gram), strict=True))
                by = np.argsort(of, kind="stable")
                edges = np.searchsorted(of[by], np.arange(len(own) + 1))
                rows += [(at[i], narrow(window[by[s:e]]) + narrow(n[by[s:e]])) for i, s, e in zip(own, edges, edges[1:], strict=False) if e > s]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["slice", "data"])


def kept_bytes(data: bytes, ends: np.ndarray, copied: list[bytes], length: int) -> Iterator[tuple[int, int, int, str]]:
    """(bytes, removed, spans, digest of the rest) for each text."""
    cover = np.zeros(len(data) + 1, np.int32)
    for packed in copied:
        at, n = wide(packed, 2)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + n - 1 + length, -1)
    gone = np.cumsum(cover[:-1]) > 0
    plain, start = np.frombuffer(data, np.uint8), 0
    for end in ends.tolist():
        own = gone[start:end]
        removed = int(own.sum())
        spans = int((own[1:] & ~own[:-1]).sum()) + int(removed and own[0]) if removed else 0
        rest = plain[start:end][~own].tobytes() if removed else data[start:end]
        yield end - start, removed, spans, hashlib.sha256(rest).hexdigest()
        start = end


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, slice_bytes: int = 4 << 20, range_bytes: int = 16 << 20) -> DataFrame:
    """A row (doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each document; null texts are empty.

    Earlier is what has the smaller doc_id (null first), then of equal ids the
    smaller hash of the text, of equal rows any one. `length` is at least 32.
    An empty table gives no rows; other columns are left out. A slice holds
    slice_bytes of texts or one longer text, which is held whole with some 30
    bytes of work for each of its own.
    """
    gram = length // 16 * 8
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    plain = not rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("id is null or n > 1").limit(1).count()
    if plain:
        rows = rows.withColumn("place", F.col("id"))
    else:
        rows = staged(rows.withColumn("row", F.monotonically_increasing_id()))
        keys = rows.select("row", F.col("id").isNotNull().alias("named"), F.coalesce("id", F.lit(0)).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
        rows = rows.join(numbered(keys, "named", "key", "hash", "row").select("row", F.col("nth").alias("place")), "row").drop("row")
    cut = staged(rows.mapInArrow(lambda b: cut_slices(b, slice_bytes), SLICES))

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = cut.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    parts = max(tasks, -(-size * 2 // (length - gram) // (4 << 20)))  # of about 4 million hashes
    by_part = cut.select("slice", "texts", "ends", "places").mapInArrow(lambda b: dealt_hashes(b, parts, length, gram), "part int, slice long, hashes binary, again binary, sample binary, grams binary")
    by_part = by_part.repartition("part").sortWithinPartitions("part", "slice")
    flags = staged(by_part.mapInArrow(lambda b: repeated(b, gram), "slice long, part int, flags binary, n long, gram binary"))
    n, some = flags.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("gram")).first()
    ranges = min(MOST // 8, max(2 * tasks, -(-n * (3 * length // 2) // range_bytes)))
    sample = flags.where("gram is not null").select("gram")
    sample = sample.sample(min(1.0, MOST / some), seed=1) if some > MOST else sample
    split, across = splitters([bytes(r["gram"]) for r in sample.collect()], ranges)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, bytes] = {}
        now = None
        for (at, kind), batch in runs(batches, "slice", "kind"):
            if at != now:
                now, held = at, {}
            if kind == 0:
                held.update(zip(batch.column("part").to_pylist(), batch.column("flags").to_pylist(), strict=True))
                continue
            for row in batch.select(["texts", "ends", "places"]).to_pylist():
                whole = cut_of(row, length, gram)
                part, times = np.unique(part_of(whole.distinct, parts), return_counts=True)
                again = [np.unpackbits(np.frombuffer(held[p], np.uint8), count=k) for p, k in zip(part.tolist(), times.tolist(), strict=True)]
                if again:
                    for unit, what, data in sent(whole, np.concatenate(again).astype(bool), split, across, ranges):
                        yield pa.RecordBatch.from_arrays([pa.array([unit if unit >= 0 else at % ranges], pa.int32()), pa.array([at], pa.int64()), pa.array([what], pa.int32()), pa.array([data], pa.binary())], ["unit", "slice", "kind", "data"])

    texts = cut.select("slice", F.lit(1).alias("kind"), "texts", "ends", "places")
    marks = flags.where("slice is not null").select("slice", F.lit(0).alias("kind"), "part", "flags")
    stream = marks.unionByName(texts, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", "kind")
    units = stream.mapInArrow(send, "unit int, slice long, kind int, data binary").repartition("unit").sortWithinPartitions("unit", "slice")
    copies = staged(units.mapInArrow(lambda b: compared(b, length, gram), "slice long, data binary"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for (at, kind), batch in runs(batches, "slice", "kind"):
            if at != now:
                now, held = at, []
            if kind == 0:
                held += batch.column("data").to_pylist()
                continue
            for row in batch.select(["ids", "texts", "ends"]).to_pylist():
                found = list(kept_bytes(expanded(row["texts"]), np.array(row["ends"], np.int64), held, length))
                columns = [pa.array(row["ids"], pa.int64()), *(pa.array([f[k] for f in found], pa.int64()) for k in range(3)), pa.array([f[3] for f in found])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    texts = cut.select("slice", F.lit(1).alias("kind"), "ids", "texts", "ends")
    stream = copies.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", "kind")
    return stream.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
