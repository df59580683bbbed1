"""A data source of landed page chains: folders of JSON pages, each of which names the next.

A chain is a folder under `path` with a `_SUCCESS` marker; its first page is
`page-1.json` (option `first`), and a page is `{"results": [...], "next": "name" or
null}`.  Each chain is a partition, read page by page, so a long one never lies in
memory whole.  As a stream, chains come in the order of their names, which therefore
have to ascend as they land (timestamps do); the offset is the last name.

A page that is missing, is no such object, or leads back, fails by its name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

MARKER, FIRST = "_SUCCESS", "page-1.json"


class BrokenChain(ValueError):
    """A chain whose pages do not lead to its end."""


class Chain(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path in it."""
    return fs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (fs.LocalFileSystem(), path)


def landed(path: str, after: str = "", upto: str | None = None) -> list[str]:
    """Names of the complete chains, in order, behind one name and up to another."""
    files, root = opened(path)
    dirs = [f.base_name for f in files.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.type == fs.FileType.Directory]
    names = sorted(d for d in dirs if d > after and (upto is None or d <= upto))
    marks = files.get_file_info([f"{root}/{d}/{MARKER}" for d in names]) if names else []
    return [d for d, m in zip(names, marks, strict=True) if m.type == fs.FileType.File]


def pages(path: str, chain: str, first: str = FIRST) -> Iterator[list[dict]]:
    """The items of each page, in order."""
    files, root = opened(path)
    name, seen = first, set()
    while name is not None:
        where = f"{chain}/{name}"
        if name in seen:
            raise BrokenChain(f"{where} was read before: the chain leads back")
        seen.add(name)
        try:
            with files.open_input_stream(f"{root}/{where}") as f:
                page = json.loads(f.read())
        except FileNotFoundError as e:
            raise BrokenChain(f"{where} is missing") from e
        except ValueError as e:
            raise BrokenChain(f"{where} is no JSON: {e}") from e
        if not isinstance(page, dict) or not isinstance(page.get("results"), list):
            raise BrokenChain(f"{where} has no results")
        yield page["results"]
        name = page.get("next")


class _Pages:
    def __init__(self, options: dict, schema: StructType):
        self.path, self.first, self.schema = options["path"], options.get("first", FIRST), schema

    def read(self, partition: Chain) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where there is no chain
            return
        arrow = to_arrow_schema(self.schema)
        for n, items in enumerate(pages(self.path, partition.value, self.first), 1):
            try:
                yield pa.RecordBatch.from_pylist(items, schema=arrow)
            except (pa.ArrowInvalid, pa.ArrowTypeError, AttributeError) as e:
                raise BrokenChain(f"page {n} of {partition.value} does not fit the schema: {e}") from e


class PageReader(_Pages, DataSourceReader):
    def partitions(self) -> list[Chain]:
        return [Chain(n) for n in landed(self.path)]


class PageStream(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        return {"after": (landed(self.path) or [""])[-1]}

    def partitions(self, start: dict, end: dict) -> list[Chain]:
        return [Chain(n) for n in landed(self.path, start["after"], end["after"])]

    def commit(self, end: dict) -> None:
        """Chains stay where they are."""


class PageChains(DataSource):
    """spark.read.format("page_chains").schema(item).load(path), or readStream."""

    @classmethod
    def name(cls) -> str:
        return "page_chains"

    def schema(self) -> str:
        raise ValueError("give the schema of an item")

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(self.options, schema)

    def streamReader(self, schema: StructType) -> PageStream:
        return PageStream(self.options, schema)


def write_chain(path: str, chain: str, items: list[dict], page_size: int = 100) -> None:
    """Land items as a chain, its marker last."""
    files, root = opened(path)
    files.create_dir(f"{root}/{chain}", recursive=True)
    n = max(1, -(-len(items) // page_size))
    for k in range(1, n + 1):
        page = {"results": items[(k - 1) * page_size : k * page_size], "next": f"page-{k + 1}.json" if k < n else None}
        with files.open_output_stream(f"{root}/{chain}/page-{k}.json") as f:
            f.write(json.dumps(page).encode())
    with files.open_output_stream(f"{root}/{chain}/{MARKER}") as f:
        f.write(b"")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageChains)
