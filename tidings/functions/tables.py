"""Table functions for SQL: the elements of a page as rows, and runs of equal values of a sorted table.

`register(spark)` makes them known as `page_elements` and `first_of_each`.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Found(HTMLParser):
    """The wanted elements of a page, in the order in which they start."""

    def __init__(self, tags: set[str]):
        super().__init__(convert_charrefs=True)
        self.tags, self.rows, self.open = tags, [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.tags:
            row = [len(self.rows), tag, dict(attrs), []]
            self.rows.append(row)
            if tag not in VOID:
                self.open.append(row)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][1] == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        for row in self.open:
            row[3].append(data)


class PageElements:
    """page_elements(html, 'a td ...'[, 'href']): pos, tag, the asked attribute (column named after it, `value` by default) and text.

    Elements left open end with the one around them that is closed; a null page has none.
    """

    @staticmethod
    def analyze(html: AnalyzeArgument, tags: AnalyzeArgument, attribute: AnalyzeArgument | None = None) -> AnalyzeResult:
        if tags.value is None:
            raise ValueError("page_elements: the tags must be a constant")
        name = attribute.value if attribute is not None and attribute.value else "value"
        return AnalyzeResult(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("tag", T.StringType()), T.StructField(name, T.StringType()), T.StructField("text", T.StringType())]))

    def eval(self, html, tags, attribute=None):
        if html is None:
            return
        found = _Found(set(tags.split()))
        found.feed(html)
        found.close()
        for pos, tag, attrs, text in found.rows:
            yield pos, tag, attrs.get(attribute or "value"), " ".join("".join(text).split())


class FirstOfEach:
    """first_of_each(TABLE(...), 'group', 'value', 'order'): of each value of a group the row that comes first, and how many there are.

    It asks Spark to deal the rows by group and to sort them by value and order, and so holds one row at a time.
    """

    def __init__(self, analyzed: AnalyzeResult | None = None):
        self.last, self.n = None, 0

    @staticmethod
    def analyze(rows: AnalyzeArgument, group: AnalyzeArgument, value: AnalyzeArgument, order: AnalyzeArgument) -> AnalyzeResult:
        names = [group.value, value.value, order.value]
        fields = {f.name: f for f in rows.dataType.fields}
        if missing := [n for n in names if n not in fields]:
            raise ValueError(f"first_of_each: no such column: {', '.join(map(str, missing))}")
        schema = T.StructType([*(fields[n] for n in names), T.StructField("n", T.LongType())])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(names[0])], orderBy=[OrderingColumn(names[1]), OrderingColumn(names[2])])

    def eval(self, row, group, value, order):
        here = (row[group], row[value])
        if self.last is not None and self.last[:2] == here:
            self.n += 1
            return
        if self.last is not None:
            yield (*self.last, self.n)
        self.last, self.n = (*here, row[order]), 1

    def terminate(self):
        if self.last is not None:
            yield (*self.last, self.n)


def register(spark: SparkSession) -> None:
    from pyspark.sql.functions import udtf

    spark.udtf.register("page_elements", udtf(PageElements))
    spark.udtf.register("first_of_each", udtf(FirstOfEach))
