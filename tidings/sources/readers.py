"""Fetched pages to observations and details, and scans of stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidings.functions.dom import parse
from tidings.schemas import ATTACHMENTS, DETAIL, LIST_ITEM
from tidings.session import small
from tidings.sources import cells, json_boards
from tidings.sources.boards import BOARDS, WordPress


AT_ONCE = 2000  # rows that Python holds before it hands them on


def config_of(row) -> dict:
    """A catalogue row as the plain dict that boards read."""

    def plain(x):
        if hasattr(x, "asDict"):
            return {k: plain(v) for k, v in x.asDict().items() if v is not None}
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items() if v is not None}
        return x

    return plain(row) if not isinstance(row, dict) else {k: plain(v) for k, v in row.items() if v is not None}


class Catalogue:
    """What page readers need of the sources, counted, collected and broadcast once for a whole flow."""

    def __init__(self, sources: DataFrame):
        self.sources = sources
        self.configs = sources.sparkSession.sparkContext.broadcast(_parsers(sources))


def _configs(sources: DataFrame | Catalogue):
    return (sources if isinstance(sources, Catalogue) else Catalogue(sources)).configs


def page_plan(sources: DataFrame, pages: int, first: int = 0, known: Catalogue | None = None) -> DataFrame:
    """(sourceId, page, url) of the list pages first .. pages - 1 of each source; one row for each request, dealt across tasks.

    `known`: the catalogue, if it was read before.
    """
    plan = sources.where(F.col("strategy").isin(*BOARDS)).select("id", F.explode(F.sequence(F.lit(first), F.lit(pages - 1))).alias("page"))

    configs = _configs(known or sources)

    @F.pandas_udf(T.StringType())
    def url(ids: pd.Series, pages: pd.Series) -> pd.Series:
        each = ((configs.value[i], int(p)) for i, p in zip(ids, pages))
        return pd.Series([BOARDS[c["strategy"]].list_url(c, p) for c, p in each], dtype=object)

    return plan.select(F.col("id").alias("sourceId"), "page", url("id", "page").alias("url"))


def detail_plan(refs: DataFrame, sources: DataFrame | Catalogue) -> DataFrame:
    """`refs` (sourceId, articleNo, detailPath, ...) with the address of each detail page; unknown sources get none."""

    configs = _configs(sources)

    @F.pandas_udf(T.StringType())
    def url(ids: pd.Series, paths: pd.Series, numbers: pd.Series) -> pd.Series:
        def one(c, path, no):
            return BOARDS[c["strategy"]].detail_url(c, path, int(no)) if c is not None and c["strategy"] in BOARDS else None

        return pd.Series([one(configs.value.get(i), p, n) for i, p, n in zip(ids, paths, numbers)], dtype=object)

    return refs.withColumn("url", url("sourceId", F.coalesce("detailPath", F.lit("")), "articleNo"))


def _parsers(sources: DataFrame) -> dict[str, dict]:
    """The catalogue by id: a few kilobytes a source, counted before it is taken."""
    if sources.limit(100_001).count() > 100_000:
        raise ValueError("the catalogue has over 100,000 sources; read it in parts")
    return {r["id"]: config_of(r) for r in sources.collect()}


ITEM = T.StructType([*LIST_ITEM.fields, T.StructField("listDetail", DETAIL), T.StructField("listAttachments", ATTACHMENTS)])


def read_lists(fetched: DataFrame, sources: DataFrame | Catalogue, as_of: str) -> DataFrame:
    """List items of fetched pages (sourceId, page, status, body): pages without a good answer have none.

    Of HTML boards that are told in columns (`cells.item_columns`) Python only finds the cells; JSON boards are decoded
    without it. Kinds that were registered from outside read their items themselves.
    """
    configs = _configs(sources)
    found = _page_items(fetched, configs, as_of)
    for kind, read in JSON_KINDS.items():
        if own := [c for c in configs.value.values() if type(BOARDS.get(c["strategy"])).__name__ == kind]:
            found = found.unionByName(read(_bodies(fetched, own)))
    return found


def _bodies(fetched: DataFrame, configs: list[dict]) -> DataFrame:
    """Good answers of some sources, with what their addresses are made of."""
    names = ("baseUrl", "frontendBase", "attachmentBase", "imageBase")
    rows = [(c["id"], *(c.get(n) or None for n in names), (c.get("pagination") or {}).get("limit")) for c in configs]
    known = fetched.sparkSession.createDataFrame(rows, ", ".join(f"{n} string" for n in ("sourceId", *names)) + ", pageSize int")
    good = fetched.where((F.col("status") == 200) & F.col("body").isNotNull()).select("sourceId", "page", F.col("body").cast("string").alias("body"))
    return good.join(small(known), "sourceId")


def _bulletin_items(pages: DataFrame) -> DataFrame:
    total = F.coalesce(F.try_variant_get(F.try_parse_json("body"), "$.data.totalCount", "long"), F.lit(0))
    found = json_boards.bulletins(pages.where(F.col("page") * F.col("pageSize") < total))
    files = F.when(F.size("attachments") > 0, F.col("attachments"))
    return found.select("sourceId", "page", *LIST_ITEM.names, F.lit(None).cast(DETAIL).alias("listDetail"), files.alias("listAttachments")).where(F.col("articleNo") >= 0)


def _post_items(pages: DataFrame) -> DataFrame:
    @F.pandas_udf(DETAIL)
    def held(html: pd.Series, base: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([WordPress()._detail(h, {"baseUrl": b}) for h, b in zip(html, base)], columns=DETAIL.names)

    found = json_boards.posts(pages)
    own = F.when(F.col("content").isNotNull(), held(F.coalesce("content", F.lit("")), "baseUrl"))
    none = {"category": F.lit(""), "author": F.lit(""), "views": F.lit(0).cast("long")}
    return found.withColumns(none).select("sourceId", "page", *LIST_ITEM.names, own.alias("listDetail"), F.lit(None).cast(ATTACHMENTS).alias("listAttachments")).where(F.col("articleNo") >= 0)


JSON_KINDS = {"Pyxis": _bulletin_items, "WordPress": _post_items}


def _page_items(fetched: DataFrame, configs, as_of: str) -> DataFrame:
    """The items of all boards but the JSON ones."""
    kinds = cells.item_columns(as_of, F.col("page"))
    names = tuple(kinds)

    def found_on(source_id: str, page: int, body: bytes, c: dict) -> Iterator[tuple]:
        board, source = BOARDS[c["strategy"]], {"skinType": c.get("skinType"), "infoParser": c.get("infoParser")}
        if type(board).__name__ in JSON_KINDS:
            return
        try:
            text = body.decode(board.encoding, "replace")
            if type(board).__name__ in names and type(board).read.__qualname__.split(".")[0] in names:
                for row in cells.rows_of(text, c["selectors"], board.row):
                    yield source_id, page, type(board).__name__, source, row, None
            else:
                for x in board.items(text, c, page, as_of):
                    held = {"listDetail": x.get("detail"), "listAttachments": x.get("attachments")}
                    yield source_id, page, "own", source, None, {k: x[k] for k in LIST_ITEM.names} | held
        except (ValueError, KeyError, TypeError, AttributeError):
            return  # a page that can't be read has no items but those before

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema)

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            held = [cells.arrow_cells(x) if f.name == "cells" else pa.array(x, f.type) for x, f in zip(columns, types)]
            return pa.RecordBatch.from_arrays(held, types.names)

        rows: list[tuple] = []
        for b in batches:
            for k in range(b.num_rows):
                source_id, page, status, body = (b.column(i)[k].as_py() for i in range(4))
                c = configs.value.get(source_id)
                if c is None or status != 200 or body is None:
                    continue
                for row in found_on(source_id, page, body, c):
                    rows.append(row)
                    if len(rows) == AT_ONCE:
                        yield made(rows)
                        rows = []
        if rows:
            yield made(rows)

    schema = T.StructType([
        T.StructField("sourceId", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("source", T.StructType([T.StructField("skinType", T.StringType()), T.StructField("infoParser", T.StringType())])),
        T.StructField("cells", T._parse_datatype_string(cells.CELLS)), T.StructField("item", ITEM)])
    rows = spread(fetched.select("sourceId", "page", "status", "body"), "sourceId", "page").mapInArrow(run, schema)

    def told(field: T.StructField) -> Column:
        value = F.lit(None).cast(field.dataType)
        own = F.when(F.col("kind") == "own", F.col("item")[field.name])
        for kind, columns in kinds.items():
            if field.name in columns:
                own = own.when(F.col("kind") == kind, columns[field.name].cast(field.dataType))
        return own.otherwise(value)

    keep = F.when(F.col("kind") == "own", F.lit(True))
    for kind, columns in kinds.items():
        keep = keep.when(F.col("kind") == kind, columns["keep"])
    return rows.where(keep).select("sourceId", "page", *(told(f).alias(f.name) for f in ITEM)).where(F.col("articleNo") >= 0)


def read_details(fetched: DataFrame, sources: DataFrame | Catalogue) -> DataFrame:
    """(sourceId, articleNo, status, detail) of fetched detail pages; detail is null without a good answer.

    Python finds a page's content, title and links; which links are files, and their names and addresses, is said in columns.
    """
    configs, files, names = _configs(sources), cells.file_columns(), tuple(cells.FILES)
    schema = T._parse_datatype_string(f"sourceId string, articleNo long, status int, kind string, base string, onclick boolean, pageUrl string, content string, text string, title string, links {cells.LINKS}")
    schema = T.StructType([*schema.fields, T.StructField("own", DETAIL)])
    empty = (None,) * 8

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                c, found = configs.value.get(r.sourceId), empty
                if c is not None and r.status == 200 and r.body is not None:
                    board = BOARDS[c["strategy"]]
                    kind, path = type(board).__name__, r.detailPath or ""
                    try:
                        text = bytes(r.body).decode(board.encoding, "replace")
                        if kind in names:
                            root = parse(text)
                            links = cells.links_of(root, kind, c["selectors"])
                            title = board.title(root, c)
                            found = (kind, c["baseUrl"], c.get("attachmentParser") == "onclick", board.detail_url(c, path, r.articleNo), *board.content(root, c), title, links, None)
                        else:
                            own = board.detail(text, c, path, r.articleNo)
                            found = ("own", None, None, None, None, None, None, None, own)
                    except (ValueError, KeyError, TypeError, AttributeError):
                        found = empty  # a page that can't be read counts as one without content
                rows.append((r.sourceId, r.articleNo, r.status, *found, *([None] if found is empty else [])))
            yield pd.DataFrame(rows, columns=schema.names)

    rows = spread(fetched.select("sourceId", "articleNo", "detailPath", "status", "body"), "sourceId", "articleNo").mapInPandas(run, schema)
    detail = F.when(F.col("kind") == "own", F.col("own"))
    for kind, found in files.items():
        whole = F.struct("content", F.col("text").alias("contentText"), found.cast(ATTACHMENTS).alias("attachments"), "title")
        detail = detail.when(F.col("kind") == kind, whole.cast(DETAIL))
    return rows.select("sourceId", "articleNo", "status", detail.alias("detail"))


def spread(fetched: DataFrame, *key: str) -> DataFrame:
    """Pages dealt by their key: a host's pages are fetched by one task, but parsed by all."""
    return fetched.repartition(max(1, int(fetched.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *key)


def details_with_list(details: DataFrame, items: DataFrame) -> DataFrame:
    """What the list already held comes first: its whole detail, or its attachments."""
    held = items.select(F.col("sourceId").alias("_s"), F.col("articleNo").alias("_a"), "listDetail", "listAttachments")
    joined = details.join(held, (F.col("sourceId") == F.col("_s")) & (F.col("articleNo") == F.col("_a")), "left")
    own = F.when(F.col("listAttachments").isNull() | F.col("detail").isNull(), F.col("detail")).otherwise(F.col("detail").withField("attachments", F.col("listAttachments")))
    return joined.withColumn("detail", F.coalesce("listDetail", own)).drop("_s", "_a", "listDetail", "listAttachments")


def decode_korean(body):
    """Bytes in the old Korean encoding as text, bad ones replaced (no built-in knows it)."""

    @F.pandas_udf(T.StringType())
    def decoded(x: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else bytes(b).decode("cp949", "replace") for b in x], dtype=object)

    return decoded(body)


def image_size(data: bytes | None) -> tuple[int, int] | None:
    """Width and height from the head of a PNG, GIF, BMP, WebP or JPEG file."""
    if not data:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return int.from_bytes(data[16:20]), int.from_bytes(data[20:24])
    if data[:4] == b"GIF8" and len(data) >= 10:
        return int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    if data[:2] == b"BM" and len(data) >= 26:
        return int.from_bytes(data[18:22], "little"), abs(int.from_bytes(data[22:26], "little", signed=True))
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP" and len(data) >= 30:
        if data[12:16] == b"VP8X":
            return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
        if data[12:16] == b"VP8 ":
            return int.from_bytes(data[26:28], "little") & 0x3FFF, int.from_bytes(data[28:30], "little") & 0x3FFF
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data) and data[at] == 0xFF:
            if data[at + 1] in (*range(0xC0, 0xC4), *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                return int.from_bytes(data[at + 7 : at + 9]), int.from_bytes(data[at + 5 : at + 7])
            at += 2 + int.from_bytes(data[at + 2 : at + 4])
    return None


@F.pandas_udf(T.StructType([T.StructField("w", T.IntegerType()), T.StructField("h", T.IntegerType())]))
def image_size_udf(data: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([image_size(None if d is None else bytes(d)) or (None, None) for d in data], columns=["w", "h"]).astype("Int32")
