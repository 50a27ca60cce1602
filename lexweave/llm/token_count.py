"""Token counts of whole texts under a SentencePiece BPE model (operator 1).

A position between two characters that stand next to each other in no piece of
the vocabulary is a *stable boundary*: every merge yields a piece, so no merge
ever crosses it, whatever stands around it. The encoding of a text is then the
concatenation of the encodings of the parts between stable boundaries. Two
consequences carry the operator:

* a huge document is encoded in overlapping chunks with byte offsets. Two
  neighbouring chunks are spliced at a token boundary that both have in their
  overlap and that is stable; where the overlap has none, it is doubled, at
  last up to the end of the document;
* in a chunk, a space after anything but a space starts a new part (checked
  against the vocabulary on loading), and the ids of a part are kept for its
  next occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lexweave.llm.common import Recent, mapped, slices

SPACE = "▁"


class Encoder:
    """Ids and byte offsets of texts; chunk, overlap and memory are parameters."""

    def __init__(self, model_file: str, chunk: int = 8192, overlap: int = 256, keep_bytes: int = 40 << 20):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.chunk, self.overlap = chunk, overlap
        self.known = Recent(keep_bytes)
        pieces = [sp.id_to_piece(i) for i in range(len(sp))]
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) for i in range(len(sp))]
        self.pairs = {p[j : j + 2] for p, ok in zip(pieces, plain, strict=True) if ok for j in range(len(p) - 1)}
        self.width = np.array([len(p.replace(SPACE, " ").encode()) if ok else 1 for p, ok in zip(pieces, plain, strict=True)], np.int64)
        #: Parts may be cut at spaces if no piece runs into one and the model leaves texts as they are.
        probe = "ﬁ ①  x"
        as_is = sp.decode(sp.encode(probe)) == probe and sp.encode("a b") == sp.encode("a") + sp.encode("b")
        self.cut_at_spaces = as_is and not any(p[0] != SPACE and p[1] == SPACE for p in self.pairs)
        #: Whether the model takes the sign for a space in a text as a space, so that offsets can count spaces instead.
        self.sign_is_space = all(sp.encode(x) == sp.encode(x.replace(SPACE, " ")) for x in (f"{SPACE}a", f"a{SPACE}b{SPACE} c {SPACE}", SPACE, f"{SPACE}{SPACE}"))
        self.byte_fallback = all(sp.is_byte(i) for i in sp.encode("\U000f1234")[1:])

    def parts(self, text: str) -> list[str]:
        """Parts between stable boundaries at spaces, each without its first space, which the model puts before a text."""
        if "  " in text or text[:1] == " ":
            return [p[1:] for p in re.findall(" +[^ ]*", f" {text}")]
        return text.split(" ")

    def encode_part(self, text: str) -> bytes:
        """Ids of a text of any length as little-endian 32-bit integers."""
        if not text:
            return b""
        if not self.cut_at_spaces or SPACE in text:
            return np.array(self.sp.encode(text), "<i4").tobytes()
        parts = self.parts(text)
        self.learn([parts])
        return b"".join(map(self.known.now.__getitem__, parts))

    def learn(self, texts: list[list[str]]) -> None:
        """Encode parts that aren't remembered, all at once."""
        self.known.age()
        if new := self.known.unknown(set().union(*texts)):
            self.known.keep(new, [np.array(ids if part else self.lone, "<i4").tobytes() for part, ids in zip(new, self.sp.encode(new, num_threads=1), strict=True)])

    @property
    def lone(self) -> list[int]:
        """What a lone space (with nothing after it) becomes."""
        return [self.sp.piece_to_id(SPACE)]

    def stable(self, raw: bytes, at: int) -> bool:
        """Whether no piece holds the two characters around byte offset at."""
        if at <= 0 or at >= len(raw) or raw[at] & 0xC0 == 0x80:
            return False
        start = at - 1
        while raw[start] & 0xC0 == 0x80:
            start -= 1
        pair = raw[start : at + 4].decode(errors="ignore")[:2].replace(" ", SPACE)
        return pair not in self.pairs

    def spaced(self, text: str) -> str:
        """The text with spaces for the signs that the model takes as such; it has the same ids."""
        return text.replace(SPACE, " ") if self.sign_is_space else text

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; longer than a chunk: from overlapping chunks."""
        text = self.spaced(text)
        if len(text) <= self.chunk or not self.cut_at_spaces or SPACE in text or not self.byte_fallback:
            return self.encode_part(text)
        raw = text.encode()
        out: list[bytes] = []
        done, start, end = 0, 0, self.snap(raw, self.chunk)  # done: bytes that out covers
        ids, ends = self.offsets(raw, start, end)
        while end < len(raw):
            first = np.searchsorted(ends, done, "right") if out else 0  # a lone first token may end at 0
            overlap = self.overlap
            while True:
                begin = self.snap(raw, max(done, end - overlap))
                until = self.snap(raw, min(len(raw), begin + self.chunk + overlap))
                if until <= end:
                    until = len(raw)
                more, more_ends = self.offsets(raw, begin, until)
                at = self.common(raw, ends, more_ends, begin, end)
                if at is not None:
                    break
                if begin <= done and until == len(raw):
                    at = done  # the new chunk holds all that is left
                    break
                overlap *= 2
            out.append(ids[first : np.searchsorted(ends, at, "right")].tobytes())
            done, ids, ends, end = at, more, more_ends, until
        out.append(ids[np.searchsorted(ends, done, "right") if out else 0 :].tobytes())
        return b"".join(out)

    @staticmethod
    def snap(raw: bytes, at: int) -> int:
        at = min(at, len(raw))
        while at < len(raw) and raw[at] & 0xC0 == 0x80:
            at += 1
        return at

    def offsets(self, raw: bytes, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of raw[start:end] and the offsets in raw at which their tokens end."""
        part = raw[start:end].decode()
        # A part that starts with a space brings its own; the model would put another before it.
        ids = np.frombuffer(self.encode_part(part[1:] if start and part[:1] == " " else part), "<i4")
        shift = start if start and part[:1] == " " else start - 1
        ends = np.cumsum(self.width[ids]) + shift
        return ids, ends

    def common(self, raw: bytes, ends: np.ndarray, more: np.ndarray, begin: int, end: int) -> int | None:
        """The middlemost stable boundary that both chunks have between begin and end."""
        both = np.intersect1d(ends[np.searchsorted(ends, begin, "right") : np.searchsorted(ends, end)], more[: np.searchsorted(more, end)])
        for at in sorted(both.tolist(), key=lambda x: abs(2 * x - begin - end)):
            if self.stable(raw, at):
                return at
        return None


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, **options: int) -> DataFrame:
    """Bytes, tokens and over_limit of every whole text; a row for each input row.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows stay
    repeated, null ids stay null; other columns don't come along. No shuffle:
    each row is handled where it was read, a slice of a few MB at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(model_file, **options)  # parts are remembered for a task only
        for batch in slices(batches, "text"):
            texts = [enc.spaced(t or "") for t in batch.column("text").to_pylist()]
            if enc.cut_at_spaces:
                enc.learn([enc.parts(t) for t in texts if t and len(t) <= enc.chunk and SPACE not in t])
            counts = pa.array([enc.count(t) for t in texts], pa.int64())
            sizes = pc.cast(pc.fill_null(pc.binary_length(batch.column("text")), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sizes, counts, pc.greater(counts, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    narrow = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return mapped(narrow, run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
