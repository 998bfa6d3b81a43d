"""Substring dedup by suffix trees, partitioned by prefixes of variable length.

Repeats of ``n`` words or more are what is sought, so of a suffix its first n words matter: they are a window. Suffixes
are indexed sparsely: of the grams of n - 4 words in a window, the first one of least hash is the window's anchor, so
equal windows have equal anchors, about one position in three is an anchor, and a suffix that begins at an anchor, with
the four words before it, stands for the windows around it.

1. A count of suffixes by the cells of their first and of their first two words (2^16 counters, however large the table)
   plans the groups: cells become units of about equal count by prefixes of one word, of two where one is too frequent,
   and of six where two are. Units are packed into groups that fit in memory.
2. Most suffixes are leaves that no deep node is above. They are found before any words travel: only windows whose
   anchor occurs in two or more pieces of text may branch.
3. Suffixes that may branch go to the group of their prefix, each word as 16 bits of its hash. There the windows are
   sorted by words into a suffix array, the common prefixes of neighbours give the internal nodes, and a node of depth n
   is accepted only if 64-bit hashes of its windows agree too, so that two windows which differ in one word are held
   apart by 80 bits. Each node's smallest doc_id says which of its windows are repeats.
4. Words covered by a window whose node has a smaller document are removed; neighbouring windows join into spans.

Texts are read in pieces of ``piece`` bytes. A piece sends each distinct window once, with the smallest doc_id that has
it in the piece (so a passage of a third of all documents costs a record per piece, not one per document), packed and
compressed by group; a group answers with the windows that a smaller document elsewhere has. Pieces grow with the number
of groups, up to four times, and a piece and a group share a record only where the piece has such suffixes. A piece's
number is a checksum of its rows, and an answer that finds no piece fails the query rather than being lost.

Defined results: a null text has no words; a null doc_id is larger than all others; rows that share a doc_id remove
nothing from each other; windows inside one document never remove each other; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._store import stage
from siltwork.llm._text import grams, mix, pieces, tokenised

WINDOW, SLACK = 13, 4
FIRST_BITS, SECOND_BITS, LONG_PREFIX = 10, 6, 6
#: Suffixes of a group, about; and the least number of groups.
GROUP, LEAST_GROUPS = 500_000, 64
#: Bits of an anchor that travel; anchors that agree in them by chance cost a suffix's words, no more.
ANCHOR_BITS = 48
_LAST = np.iinfo(np.int64).max


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


class Piece:
    """The words and windows of some documents."""

    def __init__(self, doc_ids: pa.Array, texts: list[str | None], n: int):
        self.ids = np.where(doc_ids.is_null().to_numpy(zero_copy_only=False), _LAST, doc_ids.fill_null(0).to_numpy(zero_copy_only=False))
        self.h, self.counts = tokenised(texts, lower=False)
        self.n, self.starts = n, np.cumsum(self.counts) - self.counts
        place = np.arange(len(self.h)) - np.repeat(self.starts, self.counts)
        self.at = np.flatnonzero(place <= np.repeat(self.counts, self.counts) - n)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)[self.at]

    def cells(self, at: np.ndarray) -> np.ndarray:
        """The cell of the first two words at these places; its high bits are the first word's cell."""
        first = mix(self.h[at]) >> np.uint64(64 - FIRST_BITS)
        second = grams(self.h, 2)[at] >> np.uint64(64 - SECOND_BITS) if len(at) else first
        return ((first << np.uint64(SECOND_BITS)) | second).astype(np.int64)

    def groups(self, at: np.ndarray, plan: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """The group of the suffixes at these places, by their prefixes."""
        units, splits, of = plan
        cell = self.cells(at)
        longer = grams(self.h, min(LONG_PREFIX, self.n))[at] if len(at) else np.empty(0, np.uint64)
        return of[units[cell] + (longer % splits[cell].astype(np.uint64)).astype(np.int64)]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Each window's anchor, and how many words it stands after the window's start."""
        if not len(self.at):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        width = max(1, self.n - SLACK)
        g = grams(self.h, width) >> np.uint64(64 - ANCHOR_BITS)
        least, off = g[self.at], np.zeros(len(self.at), np.int64)
        for j in range(1, self.n - width + 1):
            less = (other := g[self.at + j]) < least
            least[less], off[less] = other[less], j
        return least, off

    def names(self) -> np.ndarray:
        """Hashes that name windows inside this piece; equal names of different words raise."""
        if not len(self.at):
            return np.empty(0, np.uint64)
        name = grams(self.h, self.n)[self.at]
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        a, b = self.at[order][1:][same], self.at[order][:-1][same]
        if any((self.h[a + j] != self.h[b + j]).any() for j in range(self.n)):
            raise RuntimeError("two windows of a piece have one hash: choose another piece size")
        return name

    def checksum(self) -> int:
        """A number for the piece that depends on its rows alone."""
        x = mix(mix(self.ids.view(np.uint64)) + self.counts.astype(np.uint64) + np.arange(len(self.ids), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        y = mix(self.h + np.arange(len(self.h), dtype=np.uint64))
        return int(np.array([3 * int(x.sum(dtype=np.uint64)) + int(y.sum(dtype=np.uint64)) & (1 << 64) - 1], np.uint64).view(np.int64)[0])


def _planes(x: np.ndarray) -> bytes:
    """Byte planes, so that high bytes that hardly vary compress away."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unplaned(data: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, n).T).view(kind).ravel()


def sorted_blob(keys: np.ndarray) -> bytes:
    """Ascending numbers, by their gaps."""
    return zstandard.compress(_planes(np.diff(keys, prepend=keys.dtype.type(0))), 1)


def sorted_keys(blob: bytes, kind, n: int) -> np.ndarray:
    return np.cumsum(_unplaned(zstandard.decompress(blob), kind, n), dtype=kind)


def codes_around(h: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray, before: int, width: int) -> np.ndarray:
    """16 bits of each word from ``before`` words before a place on, ``width`` of them; 0 outside of first to last."""
    place = at[:, None] + np.arange(-before, width - before)
    inside = (place >= first[:, None]) & (place < last[:, None])
    return np.where(inside, (mix(h) >> np.uint64(48)).astype(np.uint16)[np.clip(place, 0, len(h) - 1)], np.uint16(0))


def packed(codes: np.ndarray, masks: np.ndarray, ids: np.ndarray, names: np.ndarray) -> bytes:
    """Suffixes: codes of words, a bit for each window that they stand for, a doc_id, and the names of these windows."""
    docs, doc = np.unique(ids, return_inverse=True)
    head = struct.pack("<IIII", *codes.shape, len(docs), len(names))
    return zstandard.compress(head + _planes(codes.T.ravel()) + masks.astype(np.uint8).tobytes() + _planes(docs) + _planes(doc.astype(np.uint32)) + names.tobytes(), 1)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.decompress(blob)
    n, width, docs, names = struct.unpack_from("<IIII", data)
    out, at = [], 16
    for kind, many in ((np.uint16, n * width), (np.uint8, n), (np.int64, docs), (np.uint32, n), (None, names)):
        size = many * np.dtype(kind or np.uint64).itemsize
        out.append(_unplaned(data[at : at + size], kind, many) if kind else np.frombuffer(data, np.uint64, many, at))
        at += size
    return out[0].reshape(width, n).T, out[1], out[2][out[3]] if n else np.empty(0, np.int64), out[4]


def windows_of(codes: np.ndarray, masks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes of each window that the suffixes stand for, in order, and its suffix."""
    slack = codes.shape[1] - n
    suffix, off = np.nonzero((masks[:, None] >> np.arange(slack + 1)) & 1)
    return codes[suffix[:, None], slack - off[:, None] + np.arange(n)], suffix


def planned(counts: np.ndarray, groups: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First unit and number of units of each cell, and each unit's group; units hold about ``most`` suffixes or fewer.

    Units go to the least full group, largest first.
    """
    units, splits, sizes = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), []
    width = 1 << SECOND_BITS
    for first in range(0, len(counts), width):
        part = counts[first : first + width]
        if part.sum() <= most:  # one word is prefix enough
            units[first : first + width] = len(sizes)
            sizes.append(int(part.sum()))
            continue
        for c in range(first, first + width):
            splits[c] = max(1, -(-int(counts[c]) // most))
            units[c] = len(sizes)
            sizes += [int(counts[c]) // int(splits[c])] * int(splits[c])
    of, full = np.zeros(len(sizes), np.int64), [(0, g) for g in range(groups)]
    for u in sorted(range(len(sizes)), key=lambda u: -sizes[u]):
        size, g = heapq.heappop(full)
        of[u] = g
        heapq.heappush(full, (size + sizes[u], g))
    return units, splits, of


def subtree(words: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of windows as rows of codes, and the common prefix of each with the one before it; rows that agree in all codes are sorted and told apart by name, and have one word less in common."""
    order = np.lexsort((names, *words.T[::-1]))
    words, names = words[order], names[order]
    lcp, alike = np.zeros(len(words), np.int64), np.ones(max(0, len(words) - 1), bool)
    for j in range(words.shape[1]):
        if j == words.shape[1] - 1:
            alike &= names[1:] == names[:-1]
        alike &= words[1:, j] == words[:-1, j]
        lcp[1:] += alike
    return order, lcp


def _branching(table: pa.Table) -> pa.Table:
    """For each piece, the places of its anchors that another piece has too."""
    n = table["n"].to_pylist()
    keys = [sorted_keys(b, np.uint64, k) for b, k in zip(table["blob"].to_pylist(), n, strict=True)]
    every, places = np.unique(np.concatenate(keys), return_counts=True)
    every = every[places > 1]
    found = [np.flatnonzero(np.isin(k, every, assume_unique=True)).astype(np.uint32) for k in keys]
    keep = [i for i, f in enumerate(found) if len(f)]
    return pa.table({"piece": table["piece"].take(pa.array(keep, pa.int64())), "g": table["g"].take(pa.array(keep, pa.int64())),
                     "blob": pa.array([sorted_blob(found[i]) for i in keep], pa.binary()), "n": pa.array([len(found[i]) for i in keep], pa.int32())})


def _repeats(n: int):
    """For each piece, the names of its windows whose node has a smaller document in another piece."""

    def found(table: pa.Table) -> pa.Table:
        blobs = [unpacked(b) for b in table["blob"].to_pylist()]
        made = [windows_of(codes, masks, n) for codes, masks, _, _ in blobs]
        words, names = np.concatenate([w for w, _ in made]), np.concatenate([b[3] for b in blobs])
        doc = np.concatenate([b[2][suffix] for b, (_, suffix) in zip(blobs, made, strict=True)])
        order, lcp = subtree(words, names)
        # A window that shares all its words with the one before belongs to the same node.
        first = np.flatnonzero(lcp < n)
        least = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(order))))
        repeat = np.zeros(len(words), bool)
        repeat[order] = doc[order] > least
        out, start = [], 0
        for piece, (w, _) in zip(table["piece"].to_pylist(), made, strict=True):
            if len(hit := np.sort(names[start : start + len(w)][repeat[start : start + len(w)]])):
                out.append((piece, table["g"][0].as_py(), sorted_blob(hit), len(hit)))
            start += len(w)
        return pa.table({k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate((("piece", pa.int64()), ("g", pa.int32()), ("blob", pa.binary()), ("n", pa.int32())))})

    return found


def substring_dedup(docs: DataFrame, n: int = WINDOW, group: int = GROUP, piece: int = 4_000_000) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, spans (removed words, as array of start and end), kept (the text left)."""
    docs, spark = docs.select("doc_id", "text"), docs.sparkSession
    cells = 1 << (FIRST_BITS + SECOND_BITS)
    answer, slack = "piece long, g int, blob binary, n int", n - max(1, n - SLACK)

    def read(batch: pa.RecordBatch) -> Piece:
        return Piece(batch.column("doc_id"), batch.column("text").to_pylist(), n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for b in pieces(batches, "text", 4_000_000):
            p = read(b)
            total += np.bincount(p.cells(p.at), minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])

    found = docs.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # 2^16 rows at most
    counts = np.zeros(cells, np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    groups = max(LEAST_GROUPS, -(-int(counts.sum()) // group))
    piece = max(piece, min(4 * piece, groups * 4000))
    plan = spark.sparkContext.broadcast(planned(counts, groups, max(1, int(counts.sum()) // (4 * groups))))

    def anchored(p: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The piece's anchors, ascending, the place of each window's there and in the text, and where each bucket's begin."""
        least, off = p.anchors()
        every, at = np.unique(least, return_inverse=True)
        edges = -(-(np.arange(groups + 1, dtype=object) << ANCHOR_BITS) // groups)
        return every, at, p.at + off, np.searchsorted(every, edges[:-1].astype(np.uint64))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", piece):
            p = read(b)
            every, _, _, starts = anchored(p)
            ends = np.append(starts[1:], len(every))
            some = np.flatnonzero(ends > starts)
            yield pa.RecordBatch.from_arrays([pa.array([p.checksum()] * len(some), pa.int64()), pa.array(some.astype(np.int32)),
                                              pa.array([sorted_blob(every[starts[g] : ends[g]]) for g in some], pa.binary()), pa.array((ends - starts)[some].astype(np.int32))], names=["piece", "g", "blob", "n"])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", piece):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema) as out:
                out.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([read(b).checksum()], pa.int64()), pa.array([zstandard.compress(sink.getvalue(), 3)], pa.binary())], names=["piece", "rows"])

    def rows_of(texts: pa.Table) -> Iterator[pa.RecordBatch]:
        if not texts.num_rows:
            raise RuntimeError("the input's rows came in another order when read again; write the input to a table first")
        for rows in texts["rows"].to_pylist():
            yield pa.ipc.open_stream(zstandard.decompress(rows)).read_all().combine_chunks().to_batches()[0]

    def answers_of(answers: pa.Table, kind) -> Iterator[tuple[int, np.ndarray]]:
        for g, blob, many in zip(answers["g"].to_pylist(), answers["blob"].to_pylist(), answers["n"].to_pylist(), strict=True):
            yield g, sorted_keys(blob, kind, many)

    def suffixes(texts: pa.Table, answers: pa.Table) -> pa.Table:
        """The distinct suffixes that may branch, with their words and smallest document, by group."""
        out = []
        for b in rows_of(texts) if answers.num_rows else ():
            p = read(b)
            every, at, place, starts = anchored(p)
            open_ = np.zeros(len(every), bool)
            for g, places in answers_of(answers, np.uint32):
                open_[starts[g] + places.astype(np.int64)] = True
            mine = np.flatnonzero(open_[at])
            names = p.names()
            name, doc = names[mine], p.ids[p.doc[mine]]
            order = np.lexsort((doc, name))
            mine = np.sort(mine[order[_runs(name[order])]])  # a window of each name, in the smallest document
            # Windows of one anchor are neighbours in the text: one suffix stands for them.
            order = np.lexsort((-p.at[mine], place[mine]))  # by how far the anchor is from the start
            mine, off = mine[order], (place - p.at)[mine[order]]
            first = _runs(place[mine])
            if not len(first):
                continue
            ends = np.append(first[1:], len(mine))
            suffix, masks = place[mine[first]], np.bitwise_or.reduceat(1 << off, first)
            codes = codes_around(p.h, p.at[mine[ends - 1]], p.at[mine[first]] + n, suffix, slack, n + slack)
            group_, doc, name = p.groups(suffix, plan.value), p.ids[p.doc[mine[first]]], names[mine]
            order = np.argsort(group_, kind="stable")
            run = _runs(group_[order])
            for lo, hi in zip(run.tolist(), [*run[1:].tolist(), len(order)], strict=True):
                part = order[lo:hi]
                many = (ends - first)[part]
                own = np.repeat(first[part] - np.cumsum(many) + many, many) + np.arange(many.sum())
                out.append((texts["piece"][0].as_py(), int(group_[part[0]]), packed(codes[part], masks[part], doc[part], name[own])))
        return pa.table({k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate((("piece", pa.int64()), ("g", pa.int32()), ("blob", pa.binary())))})

    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        ids, counts, removed, spans, kept = [], [], [], [], []
        gone = np.sort(np.concatenate([np.empty(0, np.uint64), *[names for _, names in answers_of(answers, np.uint64)]]))
        for b in rows_of(texts):
            p, text = read(b), b.column("text").to_pylist()
            name, doc = p.names(), p.ids[p.doc]
            order = np.lexsort((doc, name))
            first = _runs(name[order])
            least = np.empty(len(order), np.int64)
            least[order] = np.repeat(doc[order][first], np.diff(np.append(first, len(order))))
            there = np.searchsorted(gone, name)
            hit = p.at[(doc > least) | (gone[np.minimum(there, max(0, len(gone) - 1))] == name if len(gone) else np.zeros(len(name), bool))]
            edge = np.zeros(len(p.h) + 1, np.int32)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + n, -1)
            covered = np.cumsum(edge[:-1]) > 0
            for i, (start, many, t) in enumerate(zip(p.starts, p.counts, text, strict=True)):
                mine = covered[start : start + many]
                step = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                words = (t or "").encode().split()
                ids.append(b.column("doc_id")[i].as_py())
                counts.append(int(many))
                removed.append(int(mine.sum()))
                spans.append([{"start": int(a), "end": int(z)} for a, z in step])
                if len(step):
                    words = [x for a, z in zip([0, *step[:, 1]], [*step[:, 0], many], strict=True) for x in words[a:z]]
                kept.append(b" ".join(words).decode())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), "kept": pa.array(kept, pa.string())})

    texts = docs.mapInArrow(written, "piece long, rows binary").groupBy("piece")
    open_ = stage(docs.mapInArrow(sent, answer).groupBy("g").applyInArrow(_branching, answer), "branching")
    trees = texts.cogroup(open_.groupBy("piece")).applyInArrow(suffixes, "piece long, g int, blob binary")
    gone = stage(trees.groupBy("g").applyInArrow(_repeats(n), answer), "repeats")
    return texts.cogroup(gone.groupBy("piece")).applyInArrow(cut, schema)


def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: all documents, windows of 13 words."""
    found = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Exact: each window's smallest document, and the words that windows of larger ones cover.
OP6_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS m FROM g GROUP BY g HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS i FROM g JOIN f USING (g) WHERE g.doc_id > f.m),
w AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT w.doc_id, count(*) AS n, string_agg(w.x, ' ' ORDER BY w.i) AS kept FROM w LEFT JOIN c ON c.doc_id = w.doc_id AND c.i = w.i WHERE c.i IS NULL GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

QUERIES = {"op6_suffix_repeats": op6_suffix_repeats}
ORACLES = {"op6_suffix_repeats": OP6_SQL}
