"""MinHash near-duplicates by an LSH forest, with links confirmed on full shingle sets.

Words are lower-cased in A-Z; a document's set holds its distinct 5-word shingles (the whole sequence if it has
fewer words). Equal sets are one class, and from there on only classes work.

The forest has one signature of 40 minima in 20 sorted orders: order t begins at minimum 2t. The classes of all orders
are sorted by range over the cluster and read in that order, each beside its neighbours of longest common prefix.
Classes that share a prefix of two minima form a region; at a similarity of 0.75 or more two classes share none with a
chance of (1 - 0.75^2)^20 < 1e-7. The depth is adaptive: a region of more than ``rows`` classes (or ``weight`` shingles)
is cut where neighbours share the shortest prefixes, until every run of neighbours is small enough. All classes of a
run are candidates of each other. Runs are named by their smallest class, so runs that several orders agree on meet once.

Each class's set is computed again from its text and sent to its runs. In a run all sets are compared exactly, by their
shared shingles only: rare ones as pairs, frequent ones by products of matrices in blocks. A run answers with one link
for each class at most, so no step emits the pairs of a group.

What cutting may have lost is made good: a cut region (or one that ends at a partition's edge) whose classes are not all
in one component is compared whole, in pairs of blocks dealt over tasks. So no region is dropped or sampled; the only
chance of losing a link is the 1e-7 above. Links: 100 * intersection >= 75 * union.

Defined results: a text that is null or without words has an empty set, is linked with nothing and kept; in
``near_duplicates`` a doc_id is one node, so texts of rows that share it link each other's groups, and a row whose doc_id
is null is linked with nothing and kept, with a null component; the pipeline stage instead takes every row for a node, so
it removes a row only for a near copy that stays; an empty table gives an empty result; extra columns are ignored (the
stage returns them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._graph import components, roots
from siltwork.llm._store import stage
from siltwork.llm._text import grams, mix, pieces, small_batches, tokenised

SHINGLE, MINIMA, TREES = 5, 40, 20
#: Most classes and shingles (8 bytes each) of a run, about.
RUN_ROWS, RUN_WEIGHT = 4096, 1 << 20
#: A shingle that more sets of a run share is counted by products of matrices, others pair by pair.
RARE = 16

_SALT = mix(np.arange(1, MINIMA + 1, dtype=np.uint64))
_ODD = mix(np.arange(1001, MINIMA + 1001, dtype=np.uint64)) | np.uint64(1)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the texts one after another, repeats included, and each text's number of them."""
    h, n = tokenised(texts)
    if not len(h):
        return h, n * 0
    starts = np.cumsum(n) - n
    out = np.zeros(len(h), np.uint64)
    g = grams(h, SHINGLE)
    out[: len(g)] = g
    for k in range(1, SHINGLE):
        if len(at := starts[n == k]):
            out[at] = grams(h, k)[at]
    place = np.arange(len(h)) - np.repeat(starts, n)
    keep = place <= np.maximum(np.repeat(n, n) - SHINGLE, 0)
    return out[keep], np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))


def _digests(u: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Two sums that name a set."""
    return mix(u).sum(dtype=np.uint64), mix(u ^ _SALT[0]).sum(dtype=np.uint64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "text", 1_000_000):
        v, n = shingles(b.column("text").to_pylist())
        ends = np.cumsum(n)
        size, d0, d1 = (np.zeros(len(n), t) for t in (np.int64, np.uint64, np.uint64))
        for i in np.flatnonzero(n):
            u = np.unique(v[ends[i] - n[i] : ends[i]])
            size[i], (d0[i], d1[i]) = len(u), _digests(u)
        sig = np.zeros((len(n), MINIMA), np.uint32)
        if len(v):
            full = np.flatnonzero(n)
            at = (ends - n)[full]
            for k in range(MINIMA):
                sig[full, k] = np.minimum.reduceat(((v ^ _SALT[k]) * _ODD[k]) >> np.uint64(32), at)
        yield pa.RecordBatch.from_arrays([
            b.column("node"), b.column("doc_id"), pa.array(size), pa.array(d0.view(np.int64)), pa.array(d1.view(np.int64)),
            pa.ListArray.from_arrays(np.arange(0, len(n) * MINIMA + 1, MINIMA, dtype=np.int32), pa.array(sig.view(np.int32).ravel())),
        ], names=["node", "doc_id", "n_shingles", "d0", "d1", "sig"])


def sorted_orders(classes: DataFrame) -> DataFrame:
    """Every class in every order t, sorted over the cluster by its next six minima, packed in a, b and c."""
    part = lambda j: F.element_at("sig", ((2 * F.col("t") + j) % MINIMA + 1).cast("int")).cast("long")
    packed = lambda j: F.shiftleft(part(j), 32).bitwiseOR(part(j + 1).bitwiseAND(F.lit(0xFFFFFFFF)))
    rows = classes.select("cid", "rep", F.col("n_shingles").alias("w"), "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t"))
    rows = rows.select("t", packed(0).alias("a"), packed(2).alias("b"), packed(4).alias("c"), "cid", "rep", "w")
    return rows.repartitionByRange("t", "a", "b", "c", "cid").sortWithinPartitions("t", "a", "b", "c", "cid")


def common_prefixes(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """For each row the number of leading minima, six at most, that it shares with the row before; 0 for the first."""
    depth, same = np.zeros(len(a), np.int64), np.ones(max(0, len(a) - 1), bool)
    for x in (a, b, c):
        for y in (x >> 32, x & 0xFFFFFFFF):
            same &= y[1:] == y[:-1]
            depth[1:] += same
    return depth


def cut(lcp: np.ndarray, w: np.ndarray, rows: int, weight: int) -> list[tuple[int, int]]:
    """Runs of a sorted region: cut where neighbours share least, nearest the middle, until each is small enough."""
    out, todo, total = [], [(0, len(w))], np.concatenate([[0], np.cumsum(w)])
    while todo:
        lo, hi = todo.pop()
        if hi - lo == 1 or (hi - lo <= rows and total[hi] - total[lo] <= weight):
            out.append((lo, hi))
            continue
        quarter = (hi - lo) // 4
        at = np.arange(lo + max(1, quarter), max(lo + 1, hi - quarter - 1) + 1)
        at = at[lcp[at] == lcp[at].min()]
        middle = int(at[np.argmin(np.abs(at - (lo + hi) // 2))])
        todo += [(lo, middle), (middle, hi)]
    return out


def _runs(rows: int, weight: int):
    """Reads a partition of the sorted orders; gives (run, cid, rep, w, region): the runs of two classes or more, and the region of classes whose region was cut."""
    names = ("t", "a", "b", "c", "cid", "rep", "w")

    def regions(x: dict[str, np.ndarray], lo: int, hi: int, open_: bool) -> list[np.ndarray]:
        part = {k: v[lo:hi] for k, v in x.items()}
        open_ = open_ or hi - lo > rows or part["w"].sum() > weight
        spans = cut(common_prefixes(part["a"], part["b"], part["c"]), part["w"], rows, weight) if open_ else [(0, hi - lo)]
        key = mix(mix(part["t"][:1].astype(np.uint64)) ^ part["a"][:1].astype(np.uint64)).astype(np.int64)[0]
        return [np.stack([np.full(b - a, part["cid"][a:b].min()), part["cid"][a:b], part["rep"][a:b], part["w"][a:b], np.full(b - a, key), np.full(b - a, b - a > 1), np.full(b - a, open_)]) for a, b in spans]

    def batch(found: list[np.ndarray]) -> pa.RecordBatch:
        run, cid, rep, w, key, several, open_ = np.concatenate(found, axis=1) if found else np.empty((7, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(run, mask=several == 0), pa.array(cid), pa.array(rep), pa.array(w), pa.array(key, mask=open_ == 0)], names=["run", "cid", "rep", "w", "region"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, edge = None, True  # the region that may go on, and whether it is the partition's first or goes on from before
        for b in batches:
            x = {k: b.column(k).to_numpy().astype(np.int64) for k in names}
            if held is not None:
                x = {k: np.concatenate([held[k], x[k]]) for k in names}
            if not len(x["t"]):
                continue
            starts = np.flatnonzero(np.concatenate([[True], (x["t"][1:] != x["t"][:-1]) | (x["a"][1:] != x["a"][:-1])]))
            ends, found = np.append(starts[1:], len(x["t"])), []
            for lo, hi in zip(starts[:-1].tolist(), ends[:-1].tolist(), strict=True):
                if edge or hi - lo > 1:
                    found += regions(x, lo, hi, edge)
                edge = False
            held = {k: v[starts[-1] :] for k, v in x.items()}
            if len(held["t"]) > 4 * rows:  # a large region is cut as it comes
                found, held, edge = found + regions(held, 0, len(held["t"]), True), None, True
            if found:
                yield batch(found)
        if held is not None:
            yield batch(regions(held, 0, len(held["t"]), True))

    return read


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, cid, rep, set) for the runs of each row's class; rows of a doc_id whose text is of another class give none."""
    for b in pieces(batches, "text", 1_000_000):
        v, n = shingles(b.column("text").to_pylist())
        ends, cids, reps, runs = np.cumsum(n), b.column("cid").to_pylist(), b.column("node"), b.column("runs").to_pylist()
        at, run, blobs = [], [], []
        for i in np.flatnonzero(n).tolist():
            u = np.unique(v[ends[i] - n[i] : ends[i]])
            if int(_digests(u)[0].astype(np.int64)) == cids[i]:
                at += [i] * len(runs[i])
                run += runs[i]
                blobs += [u.tobytes()] * len(runs[i])
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(run, pa.int64()), b.column("cid").take(rows), reps.take(rows), pa.array(blobs, pa.binary())], names=["run", "cid", "rep", "set"])


def similar(sets: list[np.ndarray], block: int = 1 << 24) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of all sets with 100 * intersection >= 75 * union; memory of about ``block`` numbers whatever the number of sets."""
    k, n = len(sets), np.array([len(s) for s in sets])
    _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    who = np.repeat(np.arange(k), n)[shared := df[token] > 1]
    order = np.argsort(token := token[shared], kind="stable")
    who, df = who[order], df[df > 1]
    starts, codes = np.cumsum(df) - df, [np.empty(0, np.int64)]
    for d in range(2, RARE + 1):
        if len(at := starts[df == d]):
            m = who[at[:, None] + np.arange(d)]
            codes += [m[:, i] * k + m[:, j] for i in range(d) for j in range(i + 1, d)]
    pair, times = np.unique(np.concatenate(codes), return_counts=True)
    often = np.flatnonzero(df > RARE)
    rows, width = max(1, block // k), max(1, block // (4 * k))
    for lo in range(0, k, rows):
        hi = min(k, lo + rows)
        common = np.zeros((hi - lo, k), np.float32)
        for s in range(0, len(often), width):
            part = often[s : s + width]
            x = np.zeros((k, len(part)), np.float32)
            many = df[part]
            x[who[np.arange(many.sum()) + np.repeat(starts[part] - np.cumsum(many) + many, many)], np.repeat(np.arange(len(part)), many)] = 1
            common += x[lo:hi] @ x.T
        a, b = np.searchsorted(pair, (lo * k, hi * k))
        common.ravel()[pair[a:b] - lo * k] += times[a:b].astype(np.float32)
        i, j = np.nonzero(100 * common >= 75 * (n[lo:hi, None] + n[None, :] - common))
        yield (i + lo)[j > i + lo], j[j > i + lo]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v): for each run of rows sorted by run, its links as stars on the least rep of each of its components."""

    def links(cid: list, rep: list, blobs: list) -> tuple[np.ndarray, np.ndarray]:
        first = np.unique(np.array(cid), return_index=True)[1]
        if len(first) < 2:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        sets, rep = [np.frombuffer(blobs[i], np.uint64) for i in first], np.array(rep)[first]
        if len(sets) == 2:
            a, b = sets
            common = len(np.intersect1d(a, b, assume_unique=True)) if 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) else 0
            linked = common and 100 * common >= 75 * (len(a) + len(b) - common)
            return (rep[:1], rep[1:]) if linked else (rep[:0], rep[:0])
        stars = []
        for i, j in similar(sets):
            node, root = roots(i, j)
            stars.append((node[node != root], root[node != root]))
        node, root = roots(np.concatenate([i for i, _ in stars]), np.concatenate([j for _, j in stars]))
        least = np.full(len(sets), np.iinfo(np.int64).max)
        np.minimum.at(least, root, rep[node])
        return rep[node], least[root]

    def batch(found: list) -> pa.RecordBatch:
        u, v = (np.concatenate([x[i] for x in found]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["u", "v"])

    held: tuple[list, list, list] = ([], [], [])
    now = None
    for b in batches:
        run, rest = b.column("run").to_numpy(), [b.column(k).to_pylist() for k in ("cid", "rep", "set")]
        starts, found = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.empty(0, int), []
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(run)], strict=False):
            if held[0] and run[lo] != now:
                found.append(links(*held))
                held = ([], [], [])
            now = run[lo]
            for kept, more in zip(held, rest, strict=True):
                kept += more[lo:hi]
        if found:
            yield batch(found)
    if held[0]:
        yield batch([links(*held)])


def _linked(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """Links (u, v) between reps; needed: cid, rep, run, several rows a class."""
    of = needed.groupBy("cid", "rep").agg(F.collect_set("run").alias("runs"))
    texts = rows.select("node", "text").join(of.hint("shuffle_hash"), F.col("node") == F.col("rep")).select("node", "text", "cid", "runs")
    sets = texts.mapInArrow(_sets, "run long, cid long, rep long, set binary")
    return sets.repartition("run").sortWithinPartitions("run").mapInArrow(_compared, "u long, v long")


def _across(rows: DataFrame, runs: DataFrame, found: DataFrame, most: int, weight: int) -> DataFrame | None:
    """Links inside regions that were cut and hold several components; None if there are no such regions."""
    cuts = runs.filter("region is not null").select("region", "cid", "rep", "w").distinct()
    if not cuts.groupBy("region").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        return None
    named = cuts.join(found, F.col("rep") == F.col("node"), "left").withColumn("c", F.coalesce("component", "rep"))
    wide = named.groupBy("region").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("cid").alias("hub")).filter("c0 < c1").select(F.col("region").alias("_region"), "hub")
    members = stage(cuts.join(wide, F.col("region") == F.col("_region")).select("hub", "cid", "rep", "w").distinct(), "cuts")
    size = members.groupBy("hub").agg(F.ceil(F.greatest(F.count(F.lit(1)) / most, F.sum("w") / weight)).cast("int").alias("n")).select(F.col("hub").alias("_hub"), "n")
    dealt = members.join(size, F.col("hub") == F.col("_hub")).withColumn("i", F.pmod(F.xxhash64("cid"), F.col("n")).cast("int"))
    # Every class goes to the pairs of blocks that its own block is in; together they hold every pair of classes.
    needed = dealt.select("cid", "rep", "hub", "i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
    needed = needed.select("cid", "rep", F.xxhash64("hub", F.least("i", "j"), F.greatest("i", "j")).alias("run"))
    return _linked(rows, needed) if members.limit(1).count() else None


def grouped(rows: DataFrame, unique: bool = False, run_rows: int = RUN_ROWS, run_weight: int = RUN_WEIGHT) -> DataFrame:
    """Per row (node, doc_id, text): node, doc_id, n_shingles, class_id (least node of an equal set), component (least node reachable).

    ``unique`` says that no two rows share a node. Null nodes have no class and no component.
    """
    with small_batches(rows.sparkSession):
        signed = stage(rows.select("node", "doc_id", "text").mapInArrow(_signed, "node long, doc_id long, n_shingles long, d0 long, d1 long, sig array<int>"), "signed")
        full = signed.filter("n_shingles > 0 and node is not null")
        classes = stage(full.groupBy("n_shingles", "d0", "d1").agg(F.min("node").alias("rep"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("n")).withColumn("cid", F.col("d0")), "classes")
        runs = stage(sorted_orders(classes).mapInArrow(_runs(run_rows, run_weight), "run long, cid long, rep long, w long, region long"), "runs")
        links = stage(_linked(rows, runs.filter("run is not null").select("cid", "rep", "run")), "links")
        if not unique:
            # A node with texts of several classes joins their groups.
            several = full.groupBy("node").agg(F.min("d0").alias("x"), F.max("d0").alias("y")).filter("x < y").select(F.col("node").alias("u"))
            texts = full.join(several, F.col("node") == F.col("u")).select("u", "d0", "d1").distinct()
            own = classes.select("rep", F.col("d0").alias("_d0"), F.col("d1").alias("_d1"))
            more = texts.join(own, (F.col("d0") == F.col("_d0")) & (F.col("d1") == F.col("_d1"))).select("u", F.col("rep").alias("v"))
            links = links.unionByName(more)
        found = components(links)
        if (more := _across(rows, runs, found, max(1, run_rows // 2), max(1, run_weight // 2))) is not None:
            found = components(links.unionByName(stage(more, "links")))
    # Only classes of several rows and linked ones name their rows otherwise than by themselves.
    named = classes.join(found.select(F.col("node").alias("_node"), "component"), F.col("rep") == F.col("_node"), "left").filter("n > 1 or component is not null")
    named = named.select(F.col("d0").alias("_d0"), F.col("d1").alias("_d1"), "rep", "component")
    known = (F.col("d0") == F.col("_d0")) & (F.col("d1") == F.col("_d1")) & F.col("node").isNotNull() & (F.col("n_shingles") > 0)
    out = signed.drop("sig").join(named, known, "left").withColumn("class_id", F.coalesce("rep", "node"))
    return out.select("node", "doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component"))


def near_duplicates(docs: DataFrame, run_rows: int = RUN_ROWS, run_weight: int = RUN_WEIGHT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, class_id (smallest doc_id of an equal set), component_id, kept."""
    out = grouped(docs.select(F.col("doc_id").alias("node"), "doc_id", "text"), run_rows=run_rows, run_weight=run_weight)
    return out.select("doc_id", "n_shingles", "class_id", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def op1_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("class_id")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the corpus pipeline: of each component the row with the smallest doc_id stays (of equal ones the first; null last).

    Rows are numbered in a written copy, so rows that share a doc_id, or have none, are documents of their own.
    """
    rows = stage(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("at")), "numbered")
    found = stage(grouped(rows.select(F.col("at").alias("node"), "row.doc_id", "row.text"), unique=True).filter("n_shingles > 0").select("node", "doc_id", "component"), "found")
    groups = found.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("best")).filter("n > 1")
    groups = groups.select(F.col("component").bitwiseXOR(F.lit(0).cast("long")).alias("_component"), "best.node")
    gone = found.join(groups.withColumnRenamed("node", "_stays"), F.col("component") == F.col("_component")).filter("node <> _stays").select(F.col("node").alias("_gone"))
    return rows.join(gone.hint("shuffle_hash"), F.col("at") == F.col("_gone"), "left_anti").select("row.*")


#: Exact: all pairs with a common shingle, components by recursion.
OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.m AS component_id, d.doc_id = m.m AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.a = d.doc_id
"""

QUERIES = {"op1_minhash_forest": op1_minhash_forest}
ORACLES = {"op1_minhash_forest": OP1_SQL}
