"""Byte-level BPE encoding and decoding by corpus-level merge replay (operator 2).

The distinct pieces of a block of texts stand one after another in flat arrays.
An inverted index leads from a merge (the rank of the joined bytes) to the
positions of the token pairs that it would join. Merges are replayed in rank
order; each visits only its own positions and hands the pairs that its
neighbours now form to the index. Order matters only within a word, so a range
of ranks is replayed over all words at once: in each step every word joins the
first of its pairs in the range, and a pair of a lower rank that arises on the
way comes first in the next step. Long words, which would need many steps, go
one merge at a time. Pieces met once are remembered (a bounded memory a worker).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import Recent, mapped, slices


SLICE = 2 << 20  # bytes of text that are encoded at a time
LONG = 48  # bytes of a word beyond which its merges are replayed one at a time
RANGES = 6  # of ranks, with about equally many of the first pairs


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Tables:
    """What the ranks say of tokens and of pairs of them; fixed, so a worker keeps one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token_bytes = np.empty(max(ranks.values()) + 1, object)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.byte_pairs = np.array([[ranks.get(bytes([i, j]), -1) for j in range(256)] for i in range(256)], np.int64)
        #: a << 32 | b: the id of both tokens together, for all pairs that make one
        self.joined = {a << 32 | b: rank for token, rank in ranks.items() for cut in range(1, len(token)) if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None}
        self.pairs = np.array(sorted(self.joined), np.int64)
        self.pair_ranks = np.array([self.joined[p] for p in self.pairs.tolist()], np.int64)

    def join_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of each pair of tokens the id of both together; -1 where there is none or one is no token."""
        if not len(self.pairs):
            return np.full(len(a), -1)
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.pairs[at] == key), self.pair_ranks[at], -1)


class Codec:
    """Encoder and decoder; what it remembers of pieces and units is bounded by bytes."""

    def __init__(self, tables: Tables, pattern: str, keep_bytes: int = 40 << 20, block: int = 1 << 18):
        import regex

        #: White space by its Unicode property, as in the library of the rank files.
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.tables, self.block = tables, block
        self.known = Recent(keep_bytes)  # pieces
        self.units = Recent(keep_bytes)  # what lies between two single spaces
        self.ragged = re.compile(r" (?=\s|\Z)")

    def laid_out(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all words one after another, each word with an end mark; the rank of the pair at each place; the end marks' places."""
        raw = np.frombuffer(b"\n".join(words) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        flat = self.tables.byte_ids[raw]
        flat[ends] = -1
        ranks = np.full(len(flat), -1)
        ranks[:-1] = np.where((flat[:-1] >= 0) & (flat[1:] >= 0), self.tables.byte_pairs[raw[:-1], raw[1:]], -1)
        return flat, ranks, ends

    @staticmethod
    def taken_out(tokens: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """What is left of each word, as little-endian 32-bit integers."""
        upto = np.cumsum(tokens >= 0)[ends] * 4
        blob = tokens[tokens >= 0].astype("<u4").tobytes()
        return [blob[i:j] for i, j in zip([0, *upto[:-1].tolist()], upto.tolist(), strict=True)]

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers, all words at once."""
        out = [b""] * len(words)
        for some, how in (([i for i, w in enumerate(words) if len(w) <= LONG], self.replay_ranges), ([i for i, w in enumerate(words) if len(w) > LONG], self.replay_merges)):
            if some:
                for i, ids in zip(some, how([words[i] for i in some]), strict=True):
                    out[i] = ids
        return out

    def replay_ranges(self, words: list[bytes]) -> list[bytes]:
        """Merges of a range of ranks over all words at once; the index holds rank << 32 | place."""
        tok, pair, ends = self.laid_out(words)
        n = len(tok)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        word = np.repeat(np.arange(len(words)), np.diff(ends, prepend=-1))
        first = np.zeros(len(words), np.int64)
        places = np.flatnonzero(pair >= 0)
        index = np.sort(pair[places] << 32 | places)
        bounds = [*(index[len(index) * i // RANGES] >> 32 << 32 for i in range(1, RANGES) if len(index)), 1 << 62]
        later: list[np.ndarray] = [index]
        for bound in bounds:
            index = np.sort(np.concatenate(later))
            cut = np.searchsorted(index, bound)
            now, later = index[:cut], [index[cut:]]
            while len(now):
                rank, at = now >> 32, now & 0xFFFFFFFF
                held = pair[at] == rank  # not taken by a merge beside it
                rank, at, now = rank[held], at[held], now[held]
                mine = word[at]
                order = np.arange(len(at))
                first[mine[::-1]] = order[::-1]
                chosen = first[mine] == order
                p, r = at[chosen], rank[chosen]
                q = nxt[p]
                after, before = nxt[q], prv[p]
                tok[p], tok[q], pair[q] = r, -2, -1
                nxt[p], prv[after] = after, p
                left = np.where(before >= 0, tok[before], -1)
                joins, has = self.tables.join_all(left, r), left >= 0
                pair[before[has]] = joins[has]
                pair[p] = follows = self.tables.join_all(r, tok[after])
                new = np.concatenate([(joins << 32 | before)[joins >= 0], (follows << 32 | p)[follows >= 0]])
                later.append(new[new >= bound])
                now = np.sort(np.concatenate([now[~chosen], new[new < bound]]))
        return self.taken_out(tok, ends)

    def replay_merges(self, words: list[bytes]) -> list[bytes]:
        """One merge at a time, over all words."""
        flat, ranks, ends = self.laid_out(words)
        places = np.argsort(ranks, kind="stable")
        places = places[np.searchsorted(ranks[places], 0) :]
        cuts = np.flatnonzero(np.diff(ranks[places], prepend=-1))
        index = {int(ranks[g[0]]): g.tolist() for g in np.split(places, cuts[1:])} if len(places) else {}
        tok, pair, n = flat.tolist(), ranks.tolist(), len(flat)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = list(index)
        heapq.heapify(heap)
        push, pop, joined = heapq.heappush, heapq.heappop, self.tables.joined.get
        while heap:
            rank = pop(heap)
            places = index.pop(rank, None)
            if not places:
                continue
            places.sort()
            for k, p in enumerate(places):
                if pair[p] != rank:
                    continue
                q = nxt[p]
                tok[p], tok[q] = rank, -2
                pair[q] = -1
                after = nxt[p] = nxt[q]
                before = prv[p]
                prv[after] = p
                lower = False
                if before >= 0 and (a := tok[before]) >= 0:
                    r = pair[before] = joined(a << 32 | rank, -1)
                    if r >= 0:
                        if r in index:
                            index[r].append(before)
                        else:
                            index[r] = [before]
                            push(heap, r)
                        lower = r <= rank
                if (b := tok[after]) >= 0:
                    r = pair[p] = joined(rank << 32 | b, -1)
                    if r >= 0:
                        if r in index:
                            index[r].append(p)
                        else:
                            index[r] = [p]
                            push(heap, r)
                        lower = lower or r <= rank
                else:
                    pair[p] = -1
                if lower:  # it takes over; the rest of this rank's positions wait
                    index.setdefault(rank, []).extend(places[k + 1 :])
                    push(heap, rank)
                    break
        return self.taken_out(np.array(tok, np.int32), ends)

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def split(self, text: str) -> list[str]:
        """Units that no piece crosses: cut at single spaces, each followed by anything but white space.

        All but the first are meant with a space before them.
        """
        return [text] if self.ragged.search(text) else text.split(" ")

    def remember(self, words: set[str]) -> None:
        """Have the ids of all these pieces in `known.now`."""
        held: list[bytes] = []
        ids: list[bytes] = []
        size = 0
        new = self.known.unknown(words)
        for word in map(str.encode, new):  # in blocks, as a replay's arrays take many times its bytes
            if held and size + len(word) > self.block:
                ids += self.replay(held)
                held, size = [], 0
            held.append(word)
            size += len(word)
        ids += self.replay(held)
        self.known.keep(new, ids)

    def learn_first(self, texts: list[str]) -> list[bytes]:
        """Ids of units that stand at the start of a text."""
        cut = [self.pieces(t) for t in texts]
        self.remember(set().union(*cut))
        piece = self.known.now.__getitem__
        return [b"".join(map(piece, ws)) for ws in cut]

    def learn(self, units: list[str]) -> list[bytes]:
        """Ids of units, each with the space before it; in one row they are cut as they would be alone."""
        if not units:
            return []
        cut = self.pieces(" " + " ".join(units))
        self.remember(set(cut))
        ids = list(map(self.known.now.__getitem__, cut))
        if len(cut) == len(units):
            return ids
        starts = [i for i, w in enumerate(cut) if w[0] == " "]
        return [ids[i] if j - i == 1 else b"".join(ids[i:j]) for i, j in zip(starts, [*starts[1:], len(cut)], strict=True)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Of each text its ids as little-endian unsigned 32-bit integers."""
        self.units.age()
        self.known.age()
        split = [self.split(t) for t in texts]
        first = [us.pop(0) for us in split]
        heads = self.learn_first(first)
        new = self.units.unknown(set().union(*split))
        self.units.keep(new, self.learn(new))
        get = self.units.now.__getitem__
        return [head + b"".join(map(get, us)) for head, us in zip(heads, split, strict=True)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tables.token_bytes[np.frombuffer(ids, "<u4")].tolist())


_tables: dict[str, Tables] = {}


def codec(rank_file: str, pattern: str, **options: int) -> Codec:
    """A new codec; a worker keeps the tables of one rank file, while pieces are remembered for a task only."""
    if rank_file not in _tables:
        _tables.clear()
        _tables[rank_file] = Tables(load_ranks(rank_file))
    return Codec(_tables[rank_file], pattern, **options)


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """Rows (id, ids binary, decoded binary): the ids of every whole text and what they decode to.

    A null or empty text has no ids. A row for each input row: repeated rows
    stay repeated, null ids stay null, other columns don't come along. No
    shuffle; a slice of a few MB of texts is held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(rank_file, pattern, **options)
        for batch in slices(batches, "text", SLICE):
            ids = bpe.encode_batch([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.binary())], ["id", "ids", "decoded"])

    narrow = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return mapped(narrow, run, f"id {kind}, ids binary, decoded binary").withColumnRenamed("id", id_col)


def encoding_digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """Rows (id, n_tokens, ids_sha256, decoded_sha256) of encode_texts(), whose defined results hold here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(rank_file, pattern, **options)
        for batch in slices(batches, "text", SLICE):
            ids = bpe.encode_batch([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    narrow = docs.select(docs[id_col].alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return mapped(narrow, run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
