"""Other stores: a subset of one's columns, what columns there are, and a paged source with its transport left open."""

from __future__ import annotations

import importlib
import io
import json
from datetime import date

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import DateType, IntegerType, LongType, StructType


def subset(spark: SparkSession, path: str, keep: list[str]) -> DataFrame:
    """Of a second store's table the columns named that it has, in its order: only these are read."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in keep])


def catalogue(df: DataFrame) -> DataFrame:
    """(place, name, type) of the columns, from the schema alone."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "place int, name string, type string")


def year_of(path: Column | str) -> Column:
    """The year in the name of a yearly store, works_YYYY; null for other names."""
    text = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(text, r"(?:^|/)works_(\d{4})(?:[./]|$)", 1), F.lit("")).cast("int")


# --- a paged store whose filters, columns and rows are asked for


def _sent(value) -> str | None:
    """A value as the store's filters write it; None for what they can't say: a separator in it would be read as one."""
    if isinstance(value, bool):
        return str(value).lower()
    text = value.isoformat() if hasattr(value, "isoformat") else str(value)
    return text if text and not set(text) & set(",|:<>!\"\\") else None


def clause(f: Filter, names: dict[str, str]) -> str | None:
    """A filter in the store's words (name:value, name:a|b, name:>value), or None if it has no words for it. names: the store's name of each column it can filter by."""
    if not hasattr(f, "attribute") or len(f.attribute) != 1 or f.attribute[0] not in names:
        return None
    name, whole = names[f.attribute[0]], isinstance(getattr(f, "value", None), int) and not isinstance(getattr(f, "value", None), bool)
    if isinstance(f, EqualTo):
        said = _sent(f.value)
    elif isinstance(f, In):
        each = {_sent(v) for v in f.value if v is not None}
        said = "|".join(sorted(each)) if each and None not in each else None
    elif not whole:
        said = None
    elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
        said = f">{f.value - isinstance(f, GreaterThanOrEqual)}"
    elif isinstance(f, (LessThan, LessThanOrEqual)):
        said = f"<{f.value + isinstance(f, LessThanOrEqual)}"
    else:
        said = None
    return said and f"{name}:{said}"


def _meets(value, f: Filter) -> bool:
    """Whether a chain of records that all have this value may have records that a filter passes."""
    tests = {EqualTo: lambda x: value == x, In: lambda x: value in x, GreaterThan: lambda x: value > x, GreaterThanOrEqual: lambda x: value >= x, LessThan: lambda x: value < x, LessThanOrEqual: lambda x: value <= x}
    return type(f) not in tests or tests[type(f)](f.value)


class StoreChain(InputPartition):
    """One chain of pages: the clauses to send along."""

    def __init__(self, asked: str):
        self.asked = asked


def condition(f: Filter) -> Column:
    """What a filter is to Spark."""
    column = F.col(f"`{f.attribute[0]}`")
    if isinstance(f, In):
        return column.isin([v for v in f.value if v is not None])
    tests = {EqualTo: column == f.value, GreaterThan: column > f.value, GreaterThanOrEqual: column >= f.value, LessThan: column < f.value, LessThanOrEqual: column <= f.value}
    return tests[type(f)]


class StoreReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.schema = dict(options), schema
        self.names, self.asked, self.said = (json.loads(options[k]) for k in ("filters", "asked", "said"))
        self.most = int(options.get("most", 0))

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        """The filters that Spark has to test: all but those that the chains are asked for with.

        What is asked for was settled when the frame was made, and this only tells Spark what that covers. A frame's scan keeps one reader for
        all its queries, so a reader that took each query's filters would give one query the rows of another.
        """
        met = {f.attribute for f in filters if clause(f, self.names) in self.said}
        return [f for f in filters if not (clause(f, self.names) in self.said or isinstance(f, IsNotNull) and f.attribute in met)]

    def partitions(self) -> list[InputPartition]:
        return [StoreChain(x) for x in self.asked]

    def read(self, partition: StoreChain | None):
        """Rows of one chain, page by page; ``most`` of them at most, for which no further page is asked."""
        if partition is None:
            return
        module, _, name = self.options["transport"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        fields, left, cursor = self.schema.fieldNames(), self.most or None, "*"
        typed = [_typed(f.dataType) for f in self.schema.fields]
        while cursor and left != 0:
            rows, cursor = fetch(self.options.get("store", ""), partition.asked, fields, cursor, left)
            if not rows:
                return
            for r in rows[:left]:
                yield tuple(to(r.get(c)) for c, to in zip(fields, typed, strict=True))
            left = left and max(0, left - len(rows))


def _typed(kind):
    """What makes a JSON value one of a column's type."""
    if isinstance(kind, (IntegerType, LongType)):
        return lambda v: None if v is None else int(v)
    if isinstance(kind, DateType):
        return lambda v: None if v is None else date.fromisoformat(v)
    return lambda v: v


class Store(DataSource):
    """Records of a remote store that is read by cursor, as a table.

    Options: ``transport``, as module:function, gives (records, next cursor or None) for (store, asked, columns, cursor, most), the first cursor being ``*``;
    asked is a conjunction of clauses name:value. ``store``: passed on. ``columns``: the table's schema, which is what is asked for. ``asked``: JSON list, the conjunction
    of each chain of pages; chains are read at the same time. ``filters``: the store's name of each column it can filter by; ``said``: the clauses that all chains meet.
    ``most``: rows of a chain that are asked for at most.
    """

    @classmethod
    def name(cls) -> str:
        return "store"

    def schema(self) -> str:
        return self.options["columns"]

    def reader(self, schema: StructType) -> StoreReader:
        return StoreReader(self.options, schema)


def read_store(spark: SparkSession, transport: str, columns: str, filters: dict[str, str], where: list[Filter] | None = None, store: str = "", by: str | None = None, chains: list | None = None, base: str = "", keep: list[str] | None = None, most: int | None = None) -> DataFrame:
    """A store's records that pass the filters of ``where``, as a table.

    Filters that the store has words for are sent along (the scan's PushedFilters), the others Spark tests. filters: the store's name of each column it can filter by. by, chains: a column of these
    and its values; each is a chain of pages of its own, read at the same time, and those that no filter lets pass aren't read. base: clauses always sent. keep: the columns to ask for, as
    a Python source isn't told which are used; those of ``where`` have to be among them. most: how many rows are wanted at all.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Store)
    wanted = StructType([f for f in StructType.fromDDL(columns).fields if keep is None or f.name in keep])
    where = where or []
    said = [c for c in (clause(f, filters) for f in where) if c]
    own = [f for f in where if f.attribute == (by,)]
    values = [c for c in sorted(set(chains or [])) if all(_meets(c, f) for f in own)]
    sent = [*([base] if base else []), *(c for f in where if f not in own and (c := clause(f, filters)))]
    asked = [",".join(sent)] if by is None else [",".join([*sent, f"{filters[by]}:{_sent(c)}"]) for c in values]
    options = {"transport": transport, "columns": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields), "filters": json.dumps(filters), "said": json.dumps(said), "asked": json.dumps(asked), "store": store}
    # rows of all chains are needed where Spark has filters left to test
    if most is not None and all(clause(f, filters) for f in where):
        options["most"] = str(most)
    rows = spark.read.format("store").options(**options).load()
    for f in where:
        rows = rows.where(condition(f))
    return rows if most is None else rows.limit(most)


def land(works: DataFrame, path: str, by: str) -> None:
    """Writes a table as a store of pages that ``fetch_landed`` serves: JSON lines, one folder for each value of a column. For tests, and for stores that are mirrored to a folder."""
    works.withColumn("_by", F.col(by)).write.partitionBy("_by").option("ignoreNullFields", "false").json(path)


#: Records of a page that a landed store serves.
PAGE_ROWS = 1000


def fetch_landed(store: str, asked: str, columns: list[str], cursor: str, most: int | None):
    """A transport: a page of a store that ``land`` wrote, in a folder that all executors share. The clause of its own column is ``by:value``; the store filters by the other clauses itself."""
    said = dict(c.split(":", 1) for c in asked.split(",") if c)
    fs, root = pafs.FileSystem.from_uri(store)
    files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(f"{root}/_by={said.pop('by')}", allow_not_found=True)) if f.path.endswith(".json"))
    at, skip = (0, 0) if cursor == "*" else map(int, cursor.split(":"))
    rows, size = [], min(PAGE_ROWS, most or PAGE_ROWS)
    for k in range(at, len(files)):
        with io.BufferedReader(fs.open_input_file(files[k])) as f:
            f.seek(skip if k == at else 0)
            while line := f.readline():
                record = json.loads(line)
                if all(_passes(record.get(name), test) for name, test in said.items()):
                    rows.append({c: record.get(c) for c in columns})
                    if len(rows) == size:
                        return rows, f"{k}:{f.tell()}"
    return rows, None


def _passes(value, test: str) -> bool:
    if value is None:
        return False
    if test[0] in "<>":
        return int(value) > int(test[1:]) if test[0] == ">" else int(value) < int(test[1:])
    return (_sent(value) or "") in test.split("|")


# --- a paged source of raw records


class Chain(InputPartition):
    """One chain of pages: the filter to send along."""

    def __init__(self, ask: str):
        self.ask = ask


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        module, _, name = options["transport"].partition(":")
        self.module, self.name, self.asks = module, name, json.loads(options.get("asks", '[""]'))

    def partitions(self) -> list[InputPartition]:
        return [Chain(ask) for ask in self.asks]

    def read(self, partition: Chain | None):
        """Pages of one chain, each asked for with the cursor that came with the one before, until a page is empty or names no cursor."""
        if partition is None:  # nothing is asked for
            return
        fetch, cursor = getattr(importlib.import_module(self.module), self.name), "*"
        while cursor:
            rows, cursor = fetch(partition.ask, cursor)
            if not rows:
                return
            for r in rows:
                yield partition.ask, json.dumps(r)


class Paged(DataSource):
    """Records of a remote store that is read by cursor.

    Options: ``transport``, as module:function, gives (records, next cursor or None) for (ask, cursor), the first
    cursor being ``*``; ``asks``, a JSON list of filters that the store applies itself, each of which is a
    partition. Columns: ask, record (JSON text).
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "ask string, record string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)


def read_paged(spark: SparkSession, transport: str, asks: list[str]) -> DataFrame:
    spark.dataSource.register(Paged)
    return spark.read.format("paged").option("transport", transport).option("asks", json.dumps(asks)).load()
