"""Documents from files, object stores, web pages and tables, in one shape (see schemas.DOCUMENT)."""

from __future__ import annotations

import html.parser
import io
import json
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.request import urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions import text as T
from siltwork.schemas import BENCHMARK

#: Extensions that are read, and files that belong to the pipeline itself.
EXTENSIONS = ("txt", "pdf", "md", "html", "json")
EXCLUDED = ("benchmark_queries.json", "urls_to_scrape.txt")
COLUMNS = ("content", "source", "source_uri", "filename", "metadata")


def _extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def _basename(path: Column) -> Column:
    return F.url_decode(F.element_at(F.split(path, "/"), -1))


class _Visible(html.parser.HTMLParser):
    """Text outside the stripped elements, a line for each piece."""

    def __init__(self, strip: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.strip, self.depth, self.parts = strip, 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.strip

    def handle_endtag(self, tag):
        self.depth -= tag in self.strip and self.depth > 0

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.parts.append(data.strip())


def decoded(content: bytes | None, filename: str, pdf: Callable[[bytes], list[str]] | None = None) -> str:
    """A file's text: PDF pages by line, HTML without scripts and styles, JSON indented by 2, else UTF-8 without what is invalid. Failures are ''."""
    try:
        suffix = filename.lower().rsplit(".", 1)[-1]
        if suffix == "pdf":
            if pdf is None:
                from pypdf import PdfReader  # where it is installed

                return "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages)
            return "\n".join(pdf(content))
        words = content.decode("utf-8", "ignore")
        if suffix == "html":
            page = _Visible(T.FILE_STRIP)
            page.feed(words)
            return "\n".join(page.parts)
        if suffix == "json":
            return json.dumps(json.loads(words), indent=2)
        return words.strip() if suffix in ("txt", "md") else words
    except Exception:  # noqa: BLE001  a file that cannot be read is skipped
        return ""


def from_files(spark: SparkSession, path: str, source: str = "filesystem", pdf: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """Files below ``path`` (any file system Spark reads, s3a:// included) with a known extension and some text.

    Names are filtered before contents are read. A missing path raises; a file that vanishes, or cannot be read or decoded, is skipped.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").load(path)
    name = _basename(F.col("path"))
    chosen = files.filter(_extension(F.col("path")).isin(*EXTENSIONS) & ~name.isin(*EXCLUDED)).select("path", name.alias("filename"), "length", "modificationTime", "content")

    @F.pandas_udf("string")
    def decode(content: pd.Series, filename: pd.Series) -> pd.Series:
        return pd.Series([decoded(c, f, pdf) for c, f in zip(content, filename, strict=True)])

    rows = chosen.select(
        decode("content", "filename").alias("content"), F.lit(source).alias("source"), F.col("path").alias("source_uri"), "filename",
        F.create_map(F.lit("path"), F.col("path"), F.lit("size"), F.col("length").cast("string"), F.lit("modified"), F.col("modificationTime").cast("string")).alias("metadata"))
    return rows.filter(F.length("content") > 0)


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """URLs of a list with one a line; blank lines and lines that begin with # are dropped."""
    return spark.read.text(path).select(F.trim("value").alias("url")).filter("url <> '' and not startswith(url, '#')")


def fetched(urls: DataFrame, timeout: float = 30.0, get: Callable[[str], str] | None = None) -> DataFrame:
    """(url, html) of URLs that answer; others are skipped. ``get`` replaces the fetch, for tests or a client of one's own."""

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for url in frame["url"]:
                try:
                    rows.append((url, get(url) if get else urlopen(url, timeout=timeout).read().decode("utf-8", "ignore")))
                except Exception:  # noqa: BLE001
                    continue
            yield pd.DataFrame(rows, columns=["url", "html"])

    return urls.select("url").mapInPandas(fetch, "url string, html string")


def from_pages(pages: DataFrame, source: str = "url") -> DataFrame:
    """Documents of pages (url, html): text without navigation, named by title or else by URL; pages without text are dropped."""
    rows = pages.select(T.html_text(F.col("html")).alias("content"), F.lit(source).alias("source"), F.col("url").alias("source_uri"), T.html_title(F.col("html"), F.col("url")).alias("filename"), F.create_map(F.lit("url"), F.col("url")).alias("metadata"))
    return rows.filter(F.length("content") > 0)


def from_table(docs: DataFrame) -> DataFrame:
    """The table of documents in this shape."""
    return docs.select(
        "doc_id", F.col("text").alias("content"), F.coalesce("source", F.lit("unknown")).alias("source"), F.concat(F.coalesce("source", F.lit("unknown")), F.lit("://"), F.col("doc_id")).alias("source_uri"),
        F.concat(F.lit("doc_"), F.col("doc_id")).alias("filename"), F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"))


def union(*sources: DataFrame) -> DataFrame:
    """All sources one after another; no documents at all is an error."""
    out = reduce(lambda a, b: a.unionByName(b), [s.select(*COLUMNS) for s in sources])
    if out.isEmpty():
        raise ValueError("no source has documents")
    return out


def benchmark(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark queries of a JSON list of {query, expected_docs}."""
    return spark.read.schema(BENCHMARK).json(path, multiLine=True)


def metric_range(metrics: DataFrame, name: str, days: int = 30) -> DataFrame:
    """Samples (ts, cost) of a metric (name, ts, value) in the ``days`` before its latest."""
    rows = metrics.filter(F.col("name") == name).select("ts", F.col("value").cast("double").alias("cost"))
    last = rows.agg(F.max("ts").alias("last"))
    return rows.join(F.broadcast(last), F.col("ts") >= F.col("last") - F.make_dt_interval(F.lit(days))).drop("last")


def range_reply(replies: DataFrame) -> DataFrame:
    """Samples (ts, cost) of a range query's JSON reply: the first series' values."""
    shape = "data struct<result: array<struct<values: array<array<string>>>>>"
    values = replies.select(F.from_json("value", shape).alias("r")).select(F.explode(F.get("r.data.result", 0)["values"]).alias("v"))
    return values.select(F.try_element_at("v", F.lit(1)).cast("double").alias("ts"), F.try_element_at("v", F.lit(2)).try_cast("double").alias("cost")).filter("ts is not null and cost is not null")
