"""URL filters by a temporal join: captures against list entries as of the day of fetching.

A list is a history of dated entries (key, action, day): ``add`` lists a host or a domain with all its hosts, and
``remove`` ends that. Histories become validity intervals [since, until) per key, and a capture is blocked if an
interval of its host or of one of its parent domains holds the day it was fetched.

Captures are first reduced to distinct (host, day), so a host of any size is looked up once a day; verdicts are joined
back on (host, day), a join that is split when skewed. Of several entries of a key and day the last action counts,
``remove`` over ``add``; an ``add`` within an interval and a ``remove`` outside one change nothing.

Defined results: a URL that is null, has no scheme or no host, and a capture without a day, are never blocked; a host that
is a number address has no parents; hosts compare without case, port, user and closing dots; entries with a null
key, action or day are ignored; empty tables block nothing; repeated captures are judged each; extra columns of the
captures are returned only through their page_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwork.llm._store import stage

#: The host of a URL, without user and port.
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
#: Hosts that are number addresses.
NUMBERS = r"^[0-9.]+$|^\["
#: Lists of up to this many intervals are broadcast; larger ones join by shuffle.
MOST_BROADCAST = 100_000


def host_of(url: Column) -> Column:
    return F.nullif(F.rtrim(F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), HOST, 1), F.lit(".")), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, since, until): the days on which a key is listed; until is null where the listing is open."""
    daily = entries.filter("key is not null and action in ('add', 'remove') and day is not null").groupBy(F.lower("key").alias("key"), "day").agg(F.max("action").alias("action"))
    by_key = Window.partitionBy("key").orderBy("day")  # a row a day at most
    turns = daily.withColumn("last", F.lag("action").over(by_key)).filter("last is null or last <> action").drop("last")
    return turns.withColumn("until", F.lead("day").over(by_key)).filter("action = 'add'").select("key", F.col("day").alias("since"), "until")


def parents(host: Column) -> Column:
    """The host and its parent domains of two labels or more, the longest first; of a number address itself."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(host.rlike(NUMBERS), F.array(host)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), ".")))


def filtered(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture (page_id, url, day): page_id, host, day, blocked, n_active, and the longest active key with its start."""
    rows = captures.select("page_id", host_of(F.col("url")).alias("host"), "day")
    seen = rows.filter("host is not null and day is not null").select("host", "day").distinct()
    listed = stage(intervals(entries).select("key", "since", "until"), "intervals")
    small = F.broadcast(listed) if listed.count() <= MOST_BROADCAST else listed
    keys = seen.select("host", "day", F.explode(parents(F.col("host"))).alias("_key"))
    active = keys.join(small, (F.col("_key") == F.col("key")) & (F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until"))))
    verdict = active.groupBy("host", "day").agg(F.count(F.lit(1)).alias("n_active"), F.max(F.struct(F.length("key").alias("n"), "key", "since")).alias("best"))
    # A key that the planner does not know as grouped is shuffled again, and a host of many captures can be split.
    verdict = verdict.select(F.concat("host", F.lit("")).alias("_host"), F.col("day").alias("_day"), "n_active", "best")
    return rows.join(verdict, (F.col("host") == F.col("_host")) & (F.col("day") == F.col("_day")), "left").select(
        "page_id", "host", "day", F.col("n_active").isNotNull().alias("blocked"), F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.col("best.key").alias("entry"), F.col("best.since").alias("since"))


def _hex(column: str, i: int) -> str:
    return f"(instr('0123456789abcdef', substr(md5({column}), {i}, 1)) - 1)"


#: The tables have no list and no days of fetching: both are made from hosts and page_ids, here and in the oracle alike.
#: Half of all hosts and domains are listed for a time; half of these are removed, and some are listed again.
_LISTED = f"{_hex('key', 1)} < 8"
_REMOVED = f"{_hex('key', 3)} < 8"
_AGAIN = f"{_hex('key', 5)} < 6"
_ADD, _REMOVE = f"45 * {_hex('key', 2)}", f"(45 * {_hex('key', 2)} + 20 * ({_hex('key', 4)} + 1))"


def listed_hosts(pages: DataFrame) -> DataFrame:
    """Entries (key, action, day) made from the hosts of the pages and their parent domains."""
    keys = pages.select(host_of(F.col("url")).alias("host")).filter("host is not null").distinct().select(F.explode(F.expr("array(host, substring(host, instr(host, '.') + 1))")).alias("key")).filter("instr(key, '.') > 0").distinct()
    start = "date_add(date'2024-01-01', cast({} as int))"
    made = [(_LISTED, "add", _ADD), (f"{_LISTED} and {_REMOVED}", "remove", _REMOVE), (f"{_LISTED} and {_REMOVED} and {_AGAIN}", "add", f"({_REMOVE} + 30)")]
    out = [keys.filter(when).selectExpr("key", f"'{action}' as action", f"{start.format(day)} as day") for when, action, day in made]
    return out[0].unionByName(out[1]).unionByName(out[2])


def op8_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filtered(pages.withColumn("day", F.expr("date_add(date'2024-01-01', cast(page_id * 7919 % 730 as int))")), listed_hosts(pages))


OP8_SQL = rf"""
WITH p AS (SELECT page_id, nullif(rtrim(regexp_extract(lower(url), '{HOST}', 1), '.'), '') AS host, DATE '2024-01-01' + (page_id * 7919 % 730)::INTEGER AS day FROM pages),
k AS (SELECT DISTINCT key FROM (SELECT host AS key FROM p WHERE host IS NOT NULL UNION ALL SELECT substr(host, instr(host, '.') + 1) FROM p WHERE host IS NOT NULL) WHERE instr(key, '.') > 0),
x AS (SELECT key, {_ADD} AS a, {_REMOVE} AS r, {_REMOVED} AS removed, {_REMOVED} AND {_AGAIN} AS again FROM k WHERE {_LISTED}),
v AS (SELECT key, DATE '2024-01-01' + a::INTEGER AS since, CASE WHEN removed THEN DATE '2024-01-01' + r::INTEGER END AS until FROM x
  UNION ALL SELECT key, DATE '2024-01-01' + (r + 30)::INTEGER, NULL FROM x WHERE again),
m AS (SELECT p.page_id, v.key, v.since FROM p JOIN v ON (p.host = v.key OR (NOT regexp_matches(p.host, '{NUMBERS}') AND ends_with(p.host, '.' || v.key))) AND v.since <= p.day AND (v.until IS NULL OR p.day < v.until)),
b AS (SELECT page_id, count(*) AS n, max(struct_pack(n := length(key), key := key, since := since)) AS best FROM m GROUP BY page_id)
SELECT p.page_id, p.host, p.day::DATE AS day, b.n IS NOT NULL AS blocked, coalesce(b.n, 0)::BIGINT AS n_active, b.best.key AS entry, b.best.since::DATE AS since
FROM p LEFT JOIN b ON b.page_id = p.page_id
"""

QUERIES = {"op8_temporal_url_filter": op8_temporal_url_filter}
ORACLES = {"op8_temporal_url_filter": OP8_SQL}
