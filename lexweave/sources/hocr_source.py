"""Volumes of OCR markup as a table: a data source whose partitions are ranges of page tags and which reads only wanted volumes and leaves."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

PAGE = re.compile(rb"<div[^>]*ocr_page[^>]*>")
LEAF = re.compile(r"id=[\"'][A-Za-z_]*0*(\d+)[\"']")
PARAGRAPH = re.compile(r"<p[^>]*ocr_par[^>]*>")
LETTER = re.compile(r"<span[^>]*>([^<])</span>")
SCHEMA = "vol string, leaf int, par_no int, text string"
BLOCK, LEAST = 4 << 20, 64 << 10
ROWS = 4096
RANGES = 512


@dataclass
class Range(InputPartition):
    """The pages of a file whose tag begins from `start` on and before `end`."""

    path: str
    vol: str
    start: int
    end: int


def pages(blocks: Iterable[bytes], start: int, end: int) -> Iterator[tuple[bytes, bool]]:
    """(page, whether it is the file's last) of pages that begin in the range; blocks are the file's bytes from `start` on."""
    held, base, at = b"", start, None  # at: where in `held` the open page begins
    for block in blocks:
        held += block
        look = 0 if at is None else at + 1
        for tag in PAGE.finditer(held, look):
            if at is not None:
                yield held[at : tag.start()], False
            if base + tag.start() >= end:
                return
            at = tag.start()
        keep = at if at is not None else max(0, held.rfind(b"<"))
        held, base, at = held[keep:], base + keep, None if at is None else 0
    if at is not None:
        yield held[at:], True


def paragraphs(page: str, flush: bool) -> Iterator[tuple[int, str]]:
    """(number, text) of a page's paragraphs with a letter; with `flush` off not of a last one that isn't closed."""
    parts = PARAGRAPH.split(page)
    for nth, part in enumerate(parts[1:], 1):
        body, closed, _ = part.partition("</p>")
        text = "".join(LETTER.findall(body))
        if text and (flush or closed or nth < len(parts) - 1):
            yield nth, text


class HocrReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.vol_of = options["path"], re.compile(options.get("vol", r"(\d{2})[^/]*$"))
        self.split, self.flush = int(options.get("split", 64 << 20)), options.get("flush", "true") == "true"
        self.vols: set | None = None
        self.leaves: set | None = None
        self.low, self.high = None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Takes equality and lists of vol and leaf, and bounds of leaf; gives back the others."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if isinstance(f, EqualTo | In) and column in (("vol",), ("leaf",)):
                given = {value} if isinstance(f, EqualTo) else set(value)
                name = "vols" if column == ("vol",) else "leaves"
                old = getattr(self, name)
                setattr(self, name, given if old is None else old & given)
            elif column == ("leaf",) and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.low = max(value + isinstance(f, GreaterThan), self.low if self.low is not None else value)
            elif column == ("leaf",) and isinstance(f, LessThan | LessThanOrEqual):
                self.high = min(value - isinstance(f, LessThan), self.high if self.high is not None else value)
            else:
                yield f

    def wanted(self, leaf: int) -> bool:
        return (self.leaves is None or leaf in self.leaves) and (self.low is None or leaf >= self.low) and (self.high is None or leaf <= self.high)

    def partitions(self) -> list[Range]:
        """Ranges of `split` bytes of plain files, longer where there were more than RANGES; compressed ones can't be entered in the middle and are one range each."""
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")
        info = system.get_file_info(root)
        found = system.get_file_info(fs.FileSelector(root, recursive=True)) if info.type == fs.FileType.Directory else [info]
        out, split = [], max(self.split, -(-sum(f.size for f in found if f.type == fs.FileType.File) // RANGES))
        for f in sorted((f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))), key=lambda f: f.path):
            vol = self.vol_of.search(f.path)
            vol = vol[1] if vol else ""
            if self.vols is not None and vol not in self.vols:
                continue
            step = f.size if f.path.endswith(".gz") else split
            out += [Range(f.path, vol, s, min(s + step, f.size) if s + step < f.size else 1 << 62) for s in range(0, f.size, max(1, step))]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")[0]
        columns: list[list] = [[], [], [], []]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.string()), strict=True)], ["vol", "leaf", "par_no", "text"])

        zipped = partition.path.endswith(".gz")
        with system.open_input_stream(partition.path, compression="gzip") if zipped else system.open_input_file(partition.path) as f:
            if not zipped:
                f.seek(partition.start)
            size = min(BLOCK, max(partition.end - partition.start, LEAST))  # a short range reads little beyond its end
            for raw, last in pages(iter(lambda: f.read(size), b""), partition.start, partition.end):
                leaf = LEAF.search(raw[: raw.index(b">") + 1].decode())
                if not leaf or not self.wanted(int(leaf[1])):
                    continue
                for nth, text in paragraphs(raw.decode(), self.flush or not last):
                    for column, value in zip(columns, (partition.vol, int(leaf[1]), nth, text), strict=True):
                        column.append(value)
                if len(columns[0]) >= ROWS:
                    yield batch()
                    columns = [[], [], [], []]
        yield batch()


class HocrSource(DataSource):
    """spark.read.format("hocr"): path, vol (a pattern whose group 1 is the volume), split (bytes), flush ("false" leaves out what the end of a file cuts off)."""

    @classmethod
    def name(cls) -> str:
        return "hocr"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return HocrReader(self.options)
