"""Language identification by cross-parsing entropy (operator 10).

A suffix automaton of labelled text of each language accepts exactly the
substrings of that text. Another text is parsed against it greedily into its
longest matches, a symbol without any being a phrase of its own; the fewer
phrases, weighed by the logarithm of the labelled text's length, the closer the
language. The transitions of all automata stand in one hash table of their
number's size. Texts are parsed in step, long ones in segments at a time: a
segment is first parsed as if a phrase began with it, then again from the state
that the one before it ends in, up to a place where a phrase begins in both
parses; from there on they agree, so the phrases are those of the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from lexweave.llm.common import mapped, packed, slices

SEGMENT = 512
STRETCHES = 8
FACTOR = np.uint64(0x9E3779B97F4A7C15)
CODE_POINT = 21.0  # bits
GAP, OTHER = 0, 1  # classes of anything but letters, and of letters that no labelled text has


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


class Parser:
    """Phrases of texts under the labelled texts of each language. Made once, sent to the workers."""

    def __init__(self, labelled: dict[str, str], documents: dict[str, int]):
        self.langs = sorted(labelled)
        self.documents = np.array([documents[x] for x in self.langs])
        lowered = {k: v.lower() for k, v in labelled.items()}
        letters = sorted({c for t in lowered.values() for c in t if c.isalpha()})
        self.letters, self.codes = len(letters) + 2, np.array([ord(c) for c in letters], np.int64)
        weights, keys, values, base = [], [], [], 0
        # states, as multiples of letters, after the first symbol of a phrase; a negative one has no transitions
        start = np.full((len(self.langs), self.letters), -2 * self.letters, np.int64)
        for k, lang in enumerate(self.langs):
            symbols = self.symbols(lowered[lang])
            go = suffix_automaton(symbols.tolist())
            state = np.repeat(np.arange(len(go)), [len(g) for g in go])
            symbol = np.fromiter((c for g in go for c in g), np.int64, len(state))
            to = np.fromiter((q for g in go for q in g.values()), np.int64, len(state)) + base
            keys.append((state + base) * self.letters + symbol)
            values.append(to * self.letters)
            start[k, symbol[state == 0]] = to[state == 0] * self.letters
            base += len(go)
            weights.append(math.log2(max(2, len(symbols))))
        self.weights, self.start = np.array(weights), start.ravel()
        self.store(np.concatenate(keys), np.concatenate(values))

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "_classes"}

    @property
    def classes(self) -> np.ndarray:
        """The class of each code point."""
        if not hasattr(self, "_classes"):
            self._classes = np.where(is_letter(), OTHER, GAP).astype(np.uint16)
            self._classes[self.codes] = np.arange(2, self.letters)
        return self._classes

    def store(self, keys: np.ndarray, values: np.ndarray) -> None:
        """A hash table with linear probing, half full at most."""
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        place = self.places(keys)
        left = np.arange(len(keys))
        while len(left):
            place[left] = np.where(self.keys[place[left]] >= 0, (place[left] + 1) & mask, place[left])
            free = left[self.keys[place[left]] < 0]
            _, first = np.unique(place[free], return_index=True)
            put = free[first]
            self.keys[place[put]], self.values[place[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)

    def places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * FACTOR) >> self.shift).view(np.int64)

    def advance(self, of: np.ndarray, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and whether a phrase begins with the symbol. of: where each language's start states are."""
        key = state + symbol
        place = self.places(key)
        found = self.keys[place]
        to = self.values[place]
        begins = found != key
        left = np.flatnonzero(begins & (found >= 0))  # another key is there: look on
        if len(left):
            place, key, found, ahead = place.ravel()[left], key.ravel()[left], found.ravel()[left], np.arange(len(left))
            while len(ahead):
                place[ahead] = (place[ahead] + 1) & (len(self.keys) - 1)
                found[ahead] = self.keys[place[ahead]]
                ahead = ahead[(found[ahead] != key[ahead]) & (found[ahead] >= 0)]
            hit = found == key
            begins.ravel()[left[hit]] = False
            to.ravel()[left[hit]] = self.values[place[hit]]
        at = np.nonzero(begins)
        to[at] = self.start[np.broadcast_to(of, begins.shape)[at] + np.broadcast_to(symbol, begins.shape)[at]]
        return to, begins

    def symbols(self, lowered: str) -> np.ndarray:
        """Classes of characters, runs of anything but letters as one gap."""
        found = self.classes[np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), "<u4")]
        keep = found != GAP
        keep[1:] |= found[:-1] != GAP
        return found[keep]

    def phrases(self, texts: list[str], segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of each text and language; those of a symbol that the language hasn't; symbols of each text (0: it has no letter)."""
        found = [self.symbols(t.lower()) for t in texts]
        sizes = np.array([len(s) if (s != GAP).any() else 0 for s in found], np.int64)
        base = np.cumsum([0, *map(len, found)])[:-1]
        stream = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
        parts = -(-sizes // segment)
        owner = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        start, size = base[owner] + nth * segment, np.minimum(segment, sizes[owner] - nth * segment)
        langs, many = len(self.langs), len(owner)
        begins = np.zeros((langs, len(stream)), bool)
        # each segment on its own; a row of work is a language and a segment, longest segments first
        order = np.argsort(-size, kind="stable")
        active = many - np.searchsorted(size[order][::-1], np.arange(segment), "right")
        state = np.full((langs, many), -2 * self.letters, np.int64)
        of = (np.arange(langs) * self.letters)[:, None]
        held, first = np.full((langs, many), -2 * self.letters, np.int64), start[order]
        for t, n in enumerate(active.tolist()):
            if not n:
                break
            at = first[:n] + t
            held[:, :n], begins[:, at] = self.advance(of, held[:, :n], stream[at])
        state[:, order] = held
        # then from where the segment before ends, until both parses begin a phrase at the same place
        lang, seg = (x.ravel() for x in np.meshgrid(np.arange(langs), np.flatnonzero(nth), indexing="ij"))
        while len(seg):
            row, now = np.arange(len(seg)), state[lang, seg - 1]
            after = state[lang, seg]
            t = 0
            while len(row):
                at = start[seg[row]] + t
                to, new = self.advance(of[lang[row], 0], now[row], stream[at])
                met = new & begins[lang[row], at]
                begins[lang[row], at] = new
                now[row] = to
                t += 1
                ended = ~met & (t == size[seg[row]])
                after[row[ended]] = to[ended]
                row = row[~met & ~ended]
            changed = after != state[lang, seg]
            state[lang, seg] = after
            again = changed & (seg + 1 < many)
            again[again] = nth[seg[again] + 1] > 0
            lang, seg = lang[again], seg[again] + 1
        out, foreign = np.zeros((len(texts), langs), np.int64), np.zeros((len(texts), langs), np.int64)
        known = self.start.reshape(langs, -1) >= 0
        some = np.flatnonzero(sizes)
        if len(some):
            cut = np.stack([base[some], base[some] + sizes[some]], 1).ravel()
            for k in range(langs):
                out[some, k] = np.add.reduceat(np.append(begins[k], False), cut, dtype=np.int64)[::2]
                foreign[some, k] = np.add.reduceat(np.append(~known[k, stream], False), cut, dtype=np.int64)[::2]
        return out, foreign, sizes

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score: by what share of the runner-up's bits the winner's are fewer.

        A phrase costs the bits of a place in the labelled text, one of a symbol
        that isn't there also those of a code point. Of languages within half a phrase of the least, which need equally many, the one
        with the most labelled documents wins, then the first by code point.
        """
        phrases, foreign, sizes = self.phrases(texts)
        cost = phrases * self.weights + foreign * CODE_POINT
        level = cost <= cost.min(1, keepdims=True) + self.weights / 2
        best = np.where(level, self.documents, -1).argmax(1) if len(texts) else np.zeros(0, int)
        own = np.take_along_axis(cost, best[:, None], 1)[:, 0]
        others = cost.copy()
        np.put_along_axis(others, best[:, None], np.inf, 1)
        score = 1 - own / np.maximum(others.min(1), 1e-9) if len(self.langs) > 1 else np.ones(len(texts))
        return [self.langs[b] if n else "und" for b, n in zip(best, sizes, strict=True)], np.where(sizes > 0, np.clip(score, 0, 1), 0.0)


@lru_cache(1)
def is_letter() -> np.ndarray:
    """Of each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def held_out(id_col: Column) -> Column:
    """Documents that nothing is learned from; a null id counts as one of them."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(True))


def stretches(text: Column, id_col: Column, size: int) -> Column:
    """The text, or of a longer one stretches of together at most `size` characters: one from each equal part, where its id's hash says."""
    parts = STRETCHES if size >= 8 * STRETCHES else 1
    width = (size - parts + 1) // parts
    n = F.length(text)

    def stretch(i: Column) -> Column:
        start, end = F.floor(i * n / parts), F.floor((i + 1) * n / parts)
        at = start + F.pmod(F.xxhash64(id_col, F.lit("stretch"), i), end - start - width + 1)
        return F.substring(text, (at + 1).cast("int"), F.lit(width))

    return F.when(n <= size, text).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), stretch), "\n"))


def labelled_texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, texts: int, chars: int, longest: int) -> tuple[dict[str, str], dict[str, int]]:
    """Up to `chars` characters of about `texts` documents of each language that are not held out.

    Which documents: those of the smallest hashes of their ids and texts, so
    what comes to the driver is bounded: languages x `texts` texts of at most
    `longest` characters; longer documents come as stretches from all over
    them, a text that several rows of an id repeat comes once. The last one is
    left out where it doesn't fit. Also returns how many documents each
    language has.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null").where(~held_out(F.col("id")))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}, {}
    draw = F.pmod(F.xxhash64("id", "text", F.lit("language")), F.lit(1 << 40))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1 << 40, (2 * texts << 40) // n + 1))])
    drawn = known.withColumn("draw", draw).where(F.col("draw") < share[F.col("lang")]).select("lang", "draw", stretches(F.col("text"), F.col("id"), min(longest, chars)).alias("text")).distinct()
    drawn = drawn.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))).where(F.col("nth") <= texts)
    out: dict[str, list[str]] = {lang: [] for lang in counts}
    full: set[str] = set()
    for r in sorted(drawn.collect(), key=lambda r: (r["lang"], r["draw"], r["text"])):
        if len("\n".join([*out[r["lang"]], r["text"]])) > chars:
            full.add(r["lang"])
        if r["lang"] not in full:
            out[r["lang"]].append(r["text"])
    return {lang: "\n".join(ts) for lang, ts in out.items() if any(c.isalpha() for t in ts for c in t)}, counts


def language_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts: int = 80, chars: int = 48_000, longest: int = 4000, keep: bool = False) -> DataFrame:
    """Rows (id, held_out, lang_pred, score), one for each input row; with keep: (row, lang_pred, score), row being the input's.

    Learned from a bounded sample (texts, chars, longest) of the documents
    whose crc32(id) mod 4 is not 2. lang_pred is `und` with score 0 for a null
    text, one without a letter, and wherever nothing could be learned. Ties go
    to the commoner language. Repeated rows stay repeated. An empty table gives
    no rows. No shuffle of the texts.
    """
    labelled, counts = labelled_texts(docs, id_col, text_col, lang_col, texts, chars, longest)
    # a few MB: transitions of at most 2 x chars states a language
    sent = docs.sparkSession.sparkContext.broadcast(Parser(labelled, counts) if labelled else None)
    rows = packed(docs, text_col) if keep else docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches, "text", 2 << 20, 1 << 16):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            langs, scores = known.predict(texts) if known else (["und"] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    out = mapped(rows, run, StructType([*rows.schema, *StructType().add("lang_pred", StringType()).add("score", DoubleType())]))
    return out.drop("text") if keep else out.select(id_col, "held_out", "lang_pred", "score")
