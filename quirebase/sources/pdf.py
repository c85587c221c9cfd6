"""Pages of PDF files as a Spark data source.

``spark.dataSource.register(PdfPages)``, then
``spark.read.format("pdf_pages").option("extractor", "module:function").load(folder)``.
An extractor gets a file's path and yields (text, number of images) a page; the
default needs pypdf and fails with a clear message where that is missing. Each
file is a partition of its own, so a large file delays no other. The source
walks a folder that driver and executors share; ``extract_pages`` and
``document_info`` take files that Spark reads, from any file system.
"""

from __future__ import annotations

import importlib
import io
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def read_with_pypdf(path: str) -> Iterator[tuple[str, int]]:
    try:
        from pypdf import PdfReader
    except ImportError as missing:
        raise RuntimeError("reading PDF files needs pypdf, or an own extractor") from missing
    for page in PdfReader(path).pages:
        yield page.extract_text() or "", len(page.images)


def read_text_pages(path: str) -> Iterator[tuple[str, int]]:
    """Pages of a text file that form feeds divide, as converters of PDF files write it."""
    with open(path, encoding="utf-8", errors="replace") as lines:
        for page in lines.read().split("\f"):
            yield page, 0


def pages_of_bytes(content: bytes) -> Iterator[tuple[str, int]]:
    """Pages of a PDF file's content."""
    try:
        from pypdf import PdfReader
    except ImportError as missing:
        raise RuntimeError("reading PDF files needs pypdf, or an own extractor") from missing
    for page in PdfReader(io.BytesIO(content)).pages:
        yield page.extract_text() or "", len(page.images)


def info_of_bytes(content: bytes) -> tuple[str | None, str | None, str | None, int]:
    """Title, dates of creation and change, and number of pages of a PDF file's content."""
    try:
        from pypdf import PdfReader
    except ImportError as missing:
        raise RuntimeError("reading PDF files needs pypdf, or an own extractor") from missing
    reader = PdfReader(io.BytesIO(content))
    info = reader.metadata or {}
    return info.get("/Title"), info.get("/CreationDate"), info.get("/ModDate"), len(reader.pages)


def extract_pages(files: DataFrame, extract: Callable[[bytes], Iterable[tuple[str, int]]] = pages_of_bytes) -> DataFrame:
    """path, page_no, text, n_images, error of files whose content is a column (see ``files.scan_files``), from any file system.

    A row for each page; one with an error, and no page, for a file that can't
    be read. Null contents count as unreadable.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                try:
                    if content is None:
                        raise ValueError("no content")
                    rows = [(path, n, text, images, None) for n, (text, images) in enumerate(extract(content), 1)]
                except RuntimeError:
                    raise
                except Exception as broken:
                    rows = [(path, None, None, None, f"{type(broken).__name__}: {broken}")]
                columns = list(zip(*rows)) or [[]] * 5
                kinds = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "page_no", "text", "n_images", "error"])

    return files.select("path", "content").mapInArrow(run, PdfPages.SCHEMA)


def document_info(files: DataFrame, extract: Callable[[bytes], tuple] = info_of_bytes) -> DataFrame:
    """path, title, created, modified, pages of files whose content is a column; blank values, and all of a broken file, are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                try:
                    rows.append((path, *extract(content)))
                except RuntimeError:
                    raise
                except Exception:  # what can't be read has no information
                    rows.append((path, None, None, None, None))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "title", "created", "modified", "pages"])

    raw = files.select("path", "content").mapInArrow(run, "path string, title string, created string, modified string, pages int")
    return raw.select("path", *[F.nullif(F.trim(c), F.lit("")).alias(c) for c in ("title", "created", "modified")], "pages")


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].removeprefix("file://").removeprefix("file:")
        self.extractor = options.get("extractor", f"{__name__}:read_with_pypdf")
        self.suffix = options.get("suffix", ".pdf").lower()

    def partitions(self) -> list[InputPartition]:
        found = []
        for folder, inner, names in os.walk(self.root):
            inner[:] = [d for d in inner if not d.startswith(".")]
            found += [os.path.join(folder, n) for n in names if n.lower().endswith(self.suffix) and not n.startswith(".")]
        return [_File(p) for p in sorted(found)]

    def read(self, partition: _File) -> Iterator[tuple]:
        module, _, function = self.extractor.partition(":")
        extract = getattr(importlib.import_module(module), function)
        try:
            for number, (text, images) in enumerate(extract(partition.path), 1):
                yield partition.path, number, text, images, None
        except RuntimeError:
            raise
        except Exception as broken:  # a broken file is a row with its error and stops no other
            yield partition.path, None, None, None, f"{type(broken).__name__}: {broken}"


class PdfPages(DataSource):
    """path, page_no, text, n_images, error: a row for each page, one with an error for an unreadable file."""

    SCHEMA = "path string, page_no int, text string, n_images int, error string"

    @classmethod
    def name(cls) -> str:
        return "pdf_pages"

    def schema(self) -> str:
        return self.SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
