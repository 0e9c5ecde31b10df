"""[A1, A2, A4-A6] Corpora as data sources of Spark: ``spark.read.format("weft-entries" | "weft-docx").load(path)``.

A partition is a run of files, ``FILES`` at most, so tasks are few where files are many, or, for word-processor files,
such a run and one of their parts; filters on the work and on the part are pushed down: files are still listed, but
rows of other works are dropped where they are read, and other parts are never parsed.  Files are listed and opened through Arrow's file systems, as in ``stores``; where only
Spark knows a store, the readers in ``files`` do the same through Spark's own sources.

Defined results: files without a header fail, or give nulls with the option ``strict`` set to false; a folder
without files gives no rows; hidden files are left out; names sort files, so that partitions have an order.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from weftline.sources import files
from weftline.sources.stores import located, open_file

#: The parts of a word-processor file, in order.
PARTS = ("body", "table", "header", "footer", "footnote", "endnote")
#: Files of one partition at most; a listing of fewer than ``PARTITIONS`` times as many is dealt out to that many.
FILES, PARTITIONS = 1_024, 12


def listed(path: str, ending: str) -> list[str]:
    """Addresses of the files below a path, or of that file, sorted."""
    store, root = located(path if "://" in path or path.startswith("file:") else f"file://{path}")
    prefix = path[: len(path) - len(root)] if path.endswith(root) else "file://"
    info = store.get_file_info(root)
    found = [info] if info.type == arrow_fs.FileType.File else store.get_file_info(arrow_fs.FileSelector(root, recursive=True))
    names = (f.path if f.path.startswith("/") or prefix else f"/{f.path}" for f in found if f.type == arrow_fs.FileType.File and f.base_name.endswith(ending) and f.base_name[:1] not in "._")
    return sorted(prefix + n for n in names)


class _Files(InputPartition):
    def __init__(self, uris: list[str], part: str | None = None):
        super().__init__((tuple(uris), part))
        self.uris, self.part = uris, part


def _dealt(uris: list[str], part: str | None = None) -> list[InputPartition]:
    """Runs of files in order."""
    size = min(FILES, -(-len(uris) // PARTITIONS) or 1)
    return [_Files(uris[i : i + size], part) for i in range(0, len(uris), size)]


def _wanted(filters: list[Filter], column: str) -> tuple[set | None, list[Filter]]:
    """(values that ``column`` may have, filters that are not such)."""
    values, rest = None, []
    for f in filters:
        if isinstance(f, EqualTo | In) and f.attribute == (column,):
            some = {f.value} if isinstance(f, EqualTo) else set(f.value)
            values = some if values is None else values & some
        else:
            rest.append(f)
    return values, rest


class _Entries(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.strict, self.works = options["path"], options.get("strict", "true").lower() != "false", None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.works, rest = _wanted(filters, "workSlug")
        yield from rest

    def partitions(self) -> list[InputPartition]:
        return _dealt(listed(self.path, ".md"))

    def read(self, partition: _Files) -> Iterator[tuple]:
        for uri in partition.uris:
            with open_file(uri) as f:
                text = f.read().decode("utf-8")
            row = files.entry_of(uri.rpartition("/")[2].removesuffix(".md"), text, self.strict)
            if self.works is None or row["workSlug"] in self.works:
                yield tuple(row[c] for c in files.ENTRY_COLUMNS)


class EntrySource(DataSource):
    """Markdown files with a header, a row each."""

    @classmethod
    def name(cls) -> str:
        return "weft-entries"

    def schema(self) -> str:
        return files.ENTRY

    def reader(self, schema) -> DataSourceReader:
        return _Entries(self.options)


class _Docx(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.parts = options["path"], None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.parts, rest = _wanted(filters, "part")
        yield from rest

    def partitions(self) -> list[InputPartition]:
        uris = listed(self.path, ".docx")
        return [run for p in PARTS if self.parts is None or p in self.parts for run in _dealt(uris, p)]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for uri in partition.uris:
            with open_file(uri) as f:
                for i, (part, runs) in enumerate(files.docx_paragraphs(f, {partition.part})):
                    if part == partition.part:
                        yield uri, i, part, [tuple(r.values()) for r in runs]


class DocxSource(DataSource):
    """Paragraphs of word-processor files in their fixed order."""

    @classmethod
    def name(cls) -> str:
        return "weft-docx"

    def schema(self) -> str:
        return files.PARAGRAPH

    def reader(self, schema) -> DataSourceReader:
        return _Docx(self.options)


def register(spark: SparkSession) -> None:
    """Make both formats known to a session, with their filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(EntrySource)
    spark.dataSource.register(DocxSource)
