"""The catalogue's boards as a Spark data source, `board`, for batches and for streams.

`spark.read.format("board")` plans a partition for each page of each source. `spark.readStream.format("board")` polls: at every
poll the first pages of all sources are read again, one partition a host. A poll's number is the time by `every` seconds,
so it needs no memory of its own: a query that starts again after a poll was done goes on with the next one, one that died
during a poll reads that poll again, and polls that were missed meanwhile are not made up for.

Options: `config` (a source's catalogue entry as JSON, or a list of them), `pages` (how many), `as_of` (YYYY-MM-DD), `transport`
(the dotted name of a callable that maps an address to an `Answer`); for streams also `every` (seconds, 900), `hosts` (at most so
many hosts a poll, in turns; all by default) and `clock` (the dotted name of a callable that gives the time).
"""

from __future__ import annotations

import importlib
import json
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidings.sources.boards import BOARDS
from tidings.sources.fetching import Retrying

FIELDS = ("articleNo", "title", "category", "author", "date", "views", "detailPath")


class Pages(InputPartition):
    """Pages (source, number) that one task reads, one after another."""

    def __init__(self, pages: list[tuple[dict, int]], poll: int = 0):
        super().__init__(0)
        self.pages, self.poll = pages, poll


class BoardDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "board"

    def schema(self) -> str:
        return "sourceId string, page int, articleNo long, title string, category string, author string, date string, views long, detailPath string, poll long"

    def reader(self, schema) -> BoardReader:
        return BoardReader(self.options)

    def streamReader(self, schema) -> BoardStreamReader:
        return BoardStreamReader(self.options)


def _named(dotted: str):
    module, _, name = dotted.rpartition(".")
    return getattr(importlib.import_module(module), name)


class BoardReader(DataSourceReader):
    def __init__(self, options):
        found = json.loads(options["config"])
        self.configs = found if isinstance(found, list) else [found]
        self.pages, self.as_of, self.transport = int(options.get("pages", "1")), options.get("as_of", "1970-01-01"), options["transport"]

    def partitions(self):
        return [Pages([(c, p)]) for c in self.configs for p in range(self.pages)]

    def read(self, partition):
        transport = Retrying(_named(self.transport))
        for config, page in partition.pages:
            board = BOARDS[config["strategy"]]
            answer = transport(board.list_url(config, page))
            if answer.status != 200:
                continue
            try:
                found = list(board.items(answer.body.decode(board.encoding, "replace"), config, page, self.as_of))
            except (ValueError, KeyError, TypeError, AttributeError):
                continue  # a page that can't be read has no items
            for x in found:
                yield (config["id"], page, *(x[k] for k in FIELDS), partition.poll)


class BoardStreamReader(BoardReader, DataSourceStreamReader):
    def __init__(self, options):
        super().__init__(options)
        self.every, self.hosts, self.clock = float(options.get("every", "900")), int(options.get("hosts", "0")), options.get("clock", "time.time")

    def initialOffset(self) -> dict:
        return {"poll": self.latestOffset()["poll"] - 1}

    def latestOffset(self) -> dict:
        return {"poll": int(_named(self.clock)() // self.every)}

    def partitions(self, start: dict, end: dict):
        """The poll `end`, a partition for each of its hosts; nothing if it was made before."""
        poll = end["poll"]
        if poll <= start["poll"]:
            return []
        by_host: dict[str, list[tuple[dict, int]]] = {}
        for c in self.configs:
            by_host.setdefault(urlsplit(c["baseUrl"]).netloc, []).extend((c, p) for p in range(self.pages))
        names = sorted(by_host)
        if 0 < self.hosts < len(names):
            first = poll * self.hosts
            names = [names[(first + k) % len(names)] for k in range(self.hosts)]
        return [Pages(by_host[n], poll) for n in names]

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass
