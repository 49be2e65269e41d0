"""Tables from files by their ending, statistics documents, and sources with fallbacks."""

from __future__ import annotations

import json
import logging
import time
import unicodedata
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"
#: A statistics document: column descriptions, and rows of keys and values.
STATISTICS = "columns array<struct<code:string,text:string,type:string>>, data array<struct<key:array<string>,values:array<string>>>"

log = logging.getLogger(__name__)


def read(spark: SparkSession, path: str, schema: StructType | str | None = None, strict: bool = True) -> DataFrame:
    """Read .parquet, .orc, .csv, .json (an array) or .jsonl; other endings are an error.

    With a schema, strict fails on a bad row, and otherwise bad rows are left out.
    """
    ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ending not in ("parquet", "orc", "csv", "json", "jsonl"):
        raise ValueError(f"no reader for {path}")
    reader = spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    if schema is not None:
        reader = reader.schema(schema)
    if ending == "csv":
        return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if ending in ("json", "jsonl"):
        return reader.option("multiLine", ending == "json").json(path)
    return reader.format(ending).load(path)


def with_corrupt(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows of a JSON Lines file, and the lines that could not be read."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    return parsed.where(f"r.{CORRUPT} is null").select("r.*").drop(CORRUPT), parsed.where(f"r.{CORRUPT} is not null").select("value")


def statistics(doc: DataFrame, dimension: str, labels: Mapping[str, str] | None = None) -> DataFrame:
    """(category, n, p) of one dimension of a statistics document, summed over all others.

    Values that are no whole numbers are skipped, codes get their labels, an
    unknown dimension is an error.
    """
    codes = F.transform(F.filter("columns", lambda c: c["type"] != "c"), lambda c: c["code"])
    at = F.array_position(codes, dimension)
    if not (first := doc.select(at.alias("at"), codes.alias("codes")).head()) or not first["at"]:
        raise ValueError(f"Dimension {dimension!r} not found in {list(first['codes']) if first else []}")
    rows = doc.select(at.cast("int").alias("at"), F.explode("data").alias("d"))
    code = F.element_at("d.key", F.col("at"))
    names = F.create_map(*[F.lit(x) for kv in (labels or {"": ""}).items() for x in kv])
    value = F.get("d.values", F.lit(0)).try_cast("long")
    counts = rows.select(F.coalesce(F.try_element_at(names, code), code).alias("category"), value.alias("v")).where("v is not null").groupBy("category").agg(F.sum("v").alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    return counts.crossJoin(F.broadcast(total)).select("category", "n", (F.col("n") / F.col("t")).alias("p"))


def read_statistics(spark: SparkSession, path: str, dimension: str, labels: Mapping[str, str] | None = None) -> DataFrame:
    return statistics(spark.read.schema(STATISTICS).option("multiLine", True).json(path), dimension, labels)


def single_ages(spark: SparkSession, path: str) -> DataFrame:
    """(age, count) of a document with by_single_age; bad rows are skipped, repeated ages summed."""
    doc = spark.read.schema("by_single_age array<struct<age:string,count:string>>").option("multiLine", True).json(path)
    rows = doc.select(F.explode("by_single_age").alias("r")).select(F.col("r.age").try_cast("int").alias("age"), F.col("r.count").try_cast("long").alias("count"))
    return rows.where("age is not null and count is not null").groupBy("age").agg(F.sum("count").alias("count"))


def counts_any_shape(spark: SparkSession, text: str, names: Sequence[str] = ("district", "raion", "name"), values: Sequence[str] = ("count", "population", "value")) -> DataFrame:
    """(category, n) of a JSON document that is a map, has one under a key, or lists records with any of the names."""
    body = json.loads(text)
    if isinstance(body, dict):
        nested = next((v for v in body.values() if isinstance(v, (dict, list))), None)
        body = nested if nested is not None and not all(isinstance(v, (int, float)) for v in body.values()) else body
    if isinstance(body, dict):
        body = [{names[0]: k, values[0]: v} for k, v in body.items()]
    pick = lambda r, keys: next((r[k] for k in keys if r.get(k) is not None), None)
    rows = [(pick(r, names), pick(r, values)) for r in body]
    rows = [(str(k), int(v)) for k, v in rows if k is not None and isinstance(v, (int, float))]
    return spark.createDataFrame(rows, "category string, n long")


def localities(spark: SparkSession, path: str) -> DataFrame:
    """(region, name, settlement_type, implied_residence, is_capital) of a document by region."""
    place = "struct<name:string,settlement_type:string,implied_residence:string,is_capital:boolean>"
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,struct<localities:array<{place}>>>").alias("m"))
    return doc.select(F.explode("m").alias("region", "r")).where(~F.col("region").startswith("_")).select("region", F.inline("r.localities"))


def first_available(loaders: Sequence[tuple[str, Callable[[], DataFrame]]]) -> tuple[str, DataFrame]:
    """The first of (provenance, loader) that loads rows; cache, service, built-in table in this order."""
    failures: dict[str, str] = {}
    for name, load in loaders:
        try:
            df = load()
            if df.head(1):
                return name, df
        except Exception as e:  # noqa: BLE001  the next source is the answer to any failure
            failures[name] = f"{type(e).__name__}: {e}"
            log.warning("%s: %s", name, failures[name])
    raise ValueError(f"no source of {[n for n, _ in loaders]} has rows: {failures}")


def query_body(variables: Sequence[Mapping], target: str, year: str | None = None) -> dict:
    """A query for all values of the target, the year given, and the total of every other variable."""
    out = []
    for v in variables:
        if v["code"] == target:
            chosen = {"filter": "all", "values": ["*"]}
        elif year and year in v["values"]:
            chosen = {"filter": "item", "values": [year]}
        else:
            texts = v.get("valueTexts", v["values"])
            total = [x for x, t in zip(v["values"], texts, strict=True) if "total" in t.lower()]
            chosen = {"filter": "item", "values": total} if total else {"filter": "all", "values": ["*"]}
        out.append({"code": v["code"], "selection": chosen})
    return {"query": out, "response": {"format": "json"}}


def find_variable(variables: Sequence[Mapping], part: str) -> Mapping | None:
    """Of the variables whose text holds part, marks and punctuation aside, the one with most values."""
    bare = lambda x: " ".join("".join(c if c.isalnum() else " " for c in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(c)).split())
    hits = [v for v in variables if bare(part) in bare(v.get("text") or v["code"])]
    return max(hits, key=lambda v: len(v["values"]), default=None)


def fetch(url: str, body: dict | None = None, retries: int = 3, backoff: float = 2.0, open_: Callable = urllib.request.urlopen) -> bytes:
    """GET, or POST of a JSON body, tried again after network faults, 429 and 5xx."""
    data = None if body is None else json.dumps(body).encode()
    for attempt in range(retries):
        try:
            with open_(urllib.request.Request(url, data, {"Content-Type": "application/json"}), timeout=30) as r:
                return r.read()
        except urllib.error.HTTPError as e:
            if (e.code < 500 and e.code != 429) or attempt == retries - 1:
                raise
        except urllib.error.URLError:
            if attempt == retries - 1:
                raise
        time.sleep(backoff**attempt)
    raise ValueError("retries must be positive")


class _Part(InputPartition):
    def __init__(self, url: str):
        self.url = url


class StatisticsSource(DataSource):
    """format("statistics"): one row (url, body) for each of the comma-separated urls, fetched by tasks."""

    @classmethod
    def name(cls) -> str:
        return "statistics"

    def schema(self) -> str:
        return "url string, body string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _StatisticsReader(self.options)


class _StatisticsReader(DataSourceReader):
    def __init__(self, options: Mapping):
        self.urls = [u for u in options.get("urls", "").split(",") if u]
        self.retries = int(options.get("retries", 3))

    def partitions(self) -> Sequence[InputPartition]:
        return [_Part(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if isinstance(partition, _Part):
            yield partition.url, fetch(partition.url, retries=self.retries).decode()


def fresh(cached: DataFrame, ts: str, days: int = 30) -> DataFrame:
    """Cache rows no older than so many days."""
    return cached.where(F.col(ts) >= F.current_timestamp() - F.expr(f"make_dt_interval({days})"))
