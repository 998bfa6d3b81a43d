"""Benchmark decontamination by latent semantic retrieval, with subsequence and answer checks.

Benchmark texts are cut into passages of about 48 words (lower-cased in A-Z, punctuation dropped).
Their TF-IDF matrix, with document frequencies counted over all documents, is factored by a randomised SVD: power
iterations multiply by the partitioned matrix in Spark, and only vocabulary-by-rank factors meet on the driver. Windows
of 64 words at every 16th word of every document are folded into the latent space. A window is a candidate for a
passage if it holds a share of the passage's latent weight (the length of its projection on the passage, over the
passage's: half, or 0.3 for passages of 16 different words or more) at a cosine of 0.1 or more. The rank is that of the
passages of a block, up to 256, so the space holds them whole; a block has 200 items.

A candidate is a hit if the longest common subsequence of the passage and the words in and around the window covers 0.6
of the passage, and the answer is there: the words of the benchmark's column ``answer`` or, without one, half of the
rarer half of the passage's words. A passage of 16 different words or more that was reworded or moved about is a hit too
if 0.3 of it stands in order, 0.35 of its rarer half is there (or the answer), and the words there carry 0.4 of its
squared weight; the latent search alone finds these. Passages of fewer than five words must stand word for word.

Beside the latent candidates, every passage is checked of whose words a stretch of four windows holds as many as a hit
of the first kind cannot lack (found from the rarest of them), so that none of these depends on the projection. The
column ``found_by`` says which way led to a hit: ``latent``, or ``words`` where only the second did.

The benchmark is worked off in blocks of at most ``block`` items and about ``block_bytes`` of text, so that what is
broadcast (vocabulary by rank) has a bound; ``at_once`` blocks share one reading of the documents. Words in more than a
fiftieth of the documents carry no weight there, unless they are in the rarer half of some passage: so each passage has
weight, also one that stands in most documents.

Defined results: null and empty texts have no hits; items that are null or without words are skipped; repeated rows are
judged each; an empty table of either kind gives no hits; extra columns are ignored (the pipeline stage returns them).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._store import stage
from siltwork.llm._text import hashes, pieces, small_batches

PUNCTUATION = b".,;:!?\"'()[]{}"
PASSAGE, SHORTEST, STRIDE, SPAN = 48, 5, 16, 4
RANK, OVERSAMPLE, POWER = 256, 16, 2
COSINE, WEIGHT, SUBSEQUENCE, COMMON = 0.1, 0.5, 0.6, 0.02
#: Of passages of LONG different words or more: latent weight of a candidate; and share in order, of the answer's words, and of squared weight of a hit that was reworded.
LONG, FAINT, ORDER, ANSWERED, MASS = 16, 0.3, 0.3, 0.35, 0.4
#: Passages whose projection keeps less of their length are left to the exact way; their latent weight is noise.
HELD = 0.9


def plain_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().lower().translate(None, PUNCTUATION).split()


def passages(words: list) -> list[list]:
    """Cuts of about PASSAGE words, a short rest kept with the last one."""
    n = max(1, round(len(words) / PASSAGE))
    ends = [round(len(words) * i / n) for i in range(n + 1)]
    return [words[a:b] for a, b in zip(ends, ends[1:], strict=False) if b > a]


@dataclass
class Probes:
    """What no stretch of text with a hit lacks: of each passage, ``least[i]`` of its words in the lists i = 0, 1, and one of its keys.

    List 0 holds the rarer words and the keys are its rarest; list 1 holds all words. Words are numbers in
    ``vocabulary``; flat lists with starts hold the passages of each key and the words of each passage.
    """

    vocabulary: np.ndarray
    of_key: np.ndarray
    key_starts: np.ndarray
    words: list[np.ndarray]
    word_starts: list[np.ndarray]
    least: list[np.ndarray]
    reach: int

    def met(self, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first window, passage) where SPAN windows on end and ``reach`` words around them hold enough of the passage."""
        size, items, out = len(self.vocabulary), len(self.least[0]), [np.empty(0, np.int64)]
        v = np.minimum(np.searchsorted(self.vocabulary, h), size - 1)
        at = np.flatnonzero(self.vocabulary[v] == h)
        jump = SPAN * STRIDE
        length = jump + (SPAN - 1) * STRIDE + self.reach
        stretches = -(-n // jump)
        base = np.cumsum(stretches) - stretches
        text = np.repeat(np.arange(len(n)), n)[at]
        place = at - (np.cumsum(n) - n)[text]
        low = np.maximum(0, -(-(place - length + 1) // jump))
        many = np.minimum(stretches[text] - 1, (place + self.reach) // jump) - low + 1
        stretch, v = _runs(base[text] + low, many), np.repeat(v[at], many)
        order = np.argsort(stretch, kind="stable")
        stretch, v = stretch[order], v[order]
        step = max(1, (1 << 22) // max(size, items))  # stretches at a time, so that memory stays bounded
        ends = np.searchsorted(stretch, np.arange(0, int(stretches.sum()) + step, step))
        for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            if a == b:
                continue
            seen = np.zeros(step * size, bool)
            seen[(stretch[a:b] - i * step) * size + v[a:b]] = True
            held = np.flatnonzero(seen)
            d, w = held // size, held % size
            many = self.key_starts[w + 1] - self.key_starts[w]
            pairs = np.unique(np.repeat(d, many) * items + self.of_key[_runs(self.key_starts[w], many)])
            for part in np.array_split(pairs, -(-len(pairs) // 65536)) if len(pairs) else []:
                for words, starts, least in zip(self.words, self.word_starts, self.least, strict=True):
                    if len(part):
                        d, p = part // items, part % items
                        many = starts[p + 1] - starts[p]
                        there = seen[np.repeat(d, many) * size + words[_runs(starts[p], many)]]
                        part = part[np.add.reduceat(there, np.cumsum(many) - many, dtype=np.int64) >= least[p]]
                out.append(part + i * step * items)
        pairs = np.concatenate(out)
        stretch, p = pairs // items, pairs % items
        text = np.searchsorted(base, stretch, side="right") - 1
        return text, (stretch - base[text]) * SPAN, p


def _runs(starts: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``many`` of them, one run after another."""
    return np.arange(int(many.sum())) + np.repeat(starts - np.cumsum(many) + many, many)


def _probes(index: Index, answered: list[bool], every: np.ndarray) -> Probes:
    """The probes of the passages, whose vocabulary has the inverse frequencies ``every``."""
    rare, full, keys, least = [], [], [], ([], [])
    for p, answer, needed, own in zip(index.words, index.answers, index.needed, answered, strict=True):
        u, n = np.unique(p, return_counts=True)
        # The fewest different words that SUBSEQUENCE of the passage can have.
        most = len(u) if len(p) < SHORTEST else 1 + int(np.searchsorted(np.cumsum(np.sort(n)[::-1]), SUBSEQUENCE * len(p) - 1e-9))
        full.append(index.places(u)[1])
        v = full[-1] if own else index.places(answer)[1]  # an answer of its own may lie outside the passage
        v = v[np.argsort(-every[v], kind="stable")]
        least[0].append(most if own else needed)
        least[1].append(most)
        rare.append(v)
        keys.append(v[: len(v) - least[0][-1] + 1])
    of, flat = np.repeat(np.arange(len(keys)), [len(k) for k in keys]), np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[order], np.arange(len(index.vocabulary) + 1))
    return Probes(index.vocabulary, of[order], starts, [np.concatenate(x) for x in (rare, full)],
                  [np.cumsum([0, *map(len, x)]) for x in (rare, full)], [np.array(x) for x in least], max(map(len, index.words)) // 2)


@dataclass
class Index:
    """One block of the benchmark: vocabulary, its fold into the latent space, and the passages."""

    items: list = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    answers: list[np.ndarray] = field(default_factory=list)
    needed: list[int] = field(default_factory=list)
    fewest: list[int] = field(default_factory=list)
    mass: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    probes: dict = None
    vocabulary: np.ndarray = None
    idf: np.ndarray = None
    fold: np.ndarray = None
    latent: np.ndarray = None
    held: np.ndarray = None

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are in the vocabulary, and their numbers there."""
        if not len(self.vocabulary):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        v = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        at = np.flatnonzero(self.vocabulary[v] == h)
        return at, v[at]


def subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, with one bit for each word of ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full, v = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b.tolist():
        if m := masks.get(x):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def verbatim(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether ``b`` holds ``a`` word for word."""
    at = np.flatnonzero(b[: len(b) - len(a) + 1] == a[0]) if len(b) >= len(a) else np.empty(0, np.int64)
    return any(np.array_equal(b[i : i + len(a)], a) for i in at.tolist())


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    words = [plain_words(t) for t in texts]
    return hashes(list(chain.from_iterable(words))), np.fromiter(map(len, words), np.int64, len(words))


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """Documents in all, and with each word of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, rows = Index(vocabulary=shared.value), 0
        total = np.zeros(len(ix.vocabulary), np.int64)
        for b in pieces(batches, "text"):
            h, n = _word_hashes(b.column("text").to_pylist())
            at, v = ix.places(h)
            doc = np.repeat(np.arange(len(n)), n)[at]
            seen = np.unique(doc * len(total) + v) % max(1, len(total))
            total += np.bincount(seen, minlength=len(total))
            rows += len(n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], rows))], names=["v", "n"])

    with small_batches(docs.sparkSession):
        found = docs.select("text").mapInArrow(count, "v long, n long").groupBy("v").agg(F.sum("n").alias("n")).toArrow()  # the vocabulary's size at most
    v, n = found["v"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(vocabulary), np.int64)
    df[v[v >= 0]] = n[v >= 0]
    shared.destroy()
    return int(n[v < 0].sum()), df


def _rows(index: Index, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A passage's TF-IDF row: numbers and values."""
    _, v = index.places(passage)
    u, n = np.unique(v, return_counts=True)
    return u, n * index.idf[u]


def _svd(bench: DataFrame, index: Index, rank: int) -> np.ndarray:
    """Right singular vectors (vocabulary by rank) of the passages' TF-IDF matrix by a randomised range finder."""
    spark, size = bench.sparkSession, len(index.vocabulary)
    width = min(rank + OVERSAMPLE, size, max(1, len(index.words)))
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((size, width)))[0]
    for last in [*[False] * POWER, True]:
        shared = spark.sparkContext.broadcast((vars(index), q))

        def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix, z = Index(**shared.value[0]), shared.value[1]  # noqa: B023
            total = np.zeros((z.shape[1],) * 2 if last else z.shape)  # noqa: B023
            for b in batches:
                for t in b.column("text").to_pylist():
                    for p in passages(plain_words(t)):
                        u, x = _rows(ix, hashes(p))
                        y = x @ z[u]
                        if last:  # noqa: B023
                            total += np.outer(y, y)
                        else:
                            total[u] += np.outer(x, y)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

        total = sum(np.frombuffer(r["sum"]).reshape(-1, width) for r in bench.select("text").coalesce(8).mapInArrow(product, "sum binary").toLocalIterator())
        if last:
            values, vectors = np.linalg.eigh(total)
            keep = np.argsort(values)[::-1][:rank]
            return q @ vectors[:, keep[values[keep] > 1e-9]]
        q = np.linalg.qr(total)[0]


def _read(bench: DataFrame) -> tuple[Index, list]:
    """The passages of one block of the benchmark (item_id, text, and answer if there is one), and their answers."""
    index, answers = Index(), []
    columns = ["item_id", "text", *[c for c in bench.columns if c == "answer"]]
    for r in bench.select(*columns).collect():  # a block
        for p in passages(plain_words(r.text)):
            index.items.append(r.item_id)
            index.words.append(hashes(p))
            answers.append(plain_words(r.answer) if "answer" in columns and r.answer else None)
    index.vocabulary = np.unique(np.concatenate(index.words)) if index.words else np.empty(0, np.uint64)
    return index, answers


def _fit(index: Index, found: list, bench: DataFrame, every: np.ndarray, df: np.ndarray, rows: int, rank: int) -> Index:
    """The index of a block; every, df: inverse and plain document frequencies of its vocabulary; rows: documents in all."""
    # The answer of a passage without one: the rarer half of its words.
    for p, a in zip(index.words, found, strict=True):
        u, v = np.unique(p), index.places(np.unique(p))[1]
        index.answers.append(np.unique(hashes(a)) if a else u[np.argsort(-every[v], kind="stable")[: -(-len(u) // 2)]])
        index.needed.append(len(index.answers[-1]) if a else -(-len(index.answers[-1]) // 2))
        index.fewest.append(len(index.answers[-1]) if a else math.ceil(ANSWERED * len(index.answers[-1]) - 1e-9))
        square = every[v] ** 2
        index.mass.append((u, square / square.sum()))
    index.probes = vars(_probes(index, [bool(a) for a in found], every))  # plain, as what is broadcast
    # Frequent words leave the vocabulary, but never those of a passage's rarer half: it keeps its weight however many documents hold it.
    kept = df <= max(COMMON * rows, 1)
    for p in index.words:
        v = index.places(np.unique(p))[1]
        kept[v[np.argsort(-every[v], kind="stable")[: -(-len(v) // 2)]]] = True
    index.vocabulary, index.idf = index.vocabulary[kept], every[kept]
    v = _svd(bench, index, rank)
    index.fold = (v * index.idf[:, None]).astype(np.float32)
    own = [_rows(index, p) for p in index.words]
    index.latent = np.stack([v[u].T @ x for u, x in own]).astype(np.float32)
    index.held = np.flatnonzero(np.linalg.norm(index.latent, axis=1) >= HELD * np.array([np.linalg.norm(x) for _, x in own]))
    return index


def fit(docs: DataFrame, parts: list[DataFrame], rank: int = RANK) -> list[Index]:
    """The indexes of these blocks of the benchmark; the documents are read once for all of them."""
    read = [_read(part) for part in parts]
    if not (full := [index.vocabulary for index, _ in read if index.words]):
        return []
    vocabulary = np.unique(np.concatenate(full))
    rows, df = _frequencies(docs, vocabulary)
    every, out = np.log((rows + 1) / (df + 1)) + 1, []
    for part, (index, answers) in zip(parts, read, strict=True):
        if index.words:
            at = np.searchsorted(vocabulary, index.vocabulary)
            out.append(_fit(index, answers, part, every[at], df[at], rows, rank))
    return out


def hits(h: np.ndarray, n: np.ndarray, index: Index) -> list[tuple[int, object, float, float, int, str]]:
    """(row, item_id, cosine, share of the passage in order, first word of the window, way), the best of each row and item, of texts as hashes of words and numbers of words."""
    if not len(h):
        return []
    at, v = index.places(h)
    starts = np.cumsum(n) - n
    doc = np.repeat(np.arange(len(n)), n)
    blocks = -(-n // STRIDE) + SPAN - 1  # empty ones stand between documents
    base = np.cumsum(blocks) - blocks
    block = base[doc[at]] + (at - starts[doc[at]]) // STRIDE
    first = np.flatnonzero(np.diff(block, prepend=-1))
    dense = np.zeros((int(blocks.sum()) + SPAN, index.fold.shape[1]), np.float32)
    if len(at):
        dense[block[first]] = np.add.reduceat(index.fold[v], first, axis=0)
    window = sum(dense[i : len(dense) - SPAN + 1 + i] for i in range(SPAN))
    size, own = np.linalg.norm(window, axis=1), np.linalg.norm(index.latent, axis=1)
    latent, long = index.latent[index.held], own[index.held]
    wide = np.array([len(u) >= LONG for u, _ in index.mass], bool)
    gate = np.where(wide, FAINT, WEIGHT)[index.held]
    live = np.flatnonzero(size > (gate * long).min() if len(long) else size > np.inf)
    best: dict[tuple[int, object], tuple[float, float, int, str]] = {}

    def judge(d: int, p: int, start: int, cosine: float, way: str) -> None:
        passage, margin = index.words[p], len(index.words[p]) // 2
        near = h[starts[d] + max(0, start - margin) : starts[d] + min(n[d], start + SPAN * STRIDE + margin)]
        there = np.isin(index.answers[p], near).sum()
        reworded = way == "latent" and wide[p]
        if there < (index.fewest if reworded else index.needed)[p]:
            return
        share = float(verbatim(passage, near)) if len(passage) < SHORTEST else subsequence(passage, near) / len(passage)
        if share < SUBSEQUENCE or there < index.needed[p]:
            u, square = index.mass[p]
            if not reworded or share < ORDER or square[np.isin(u, near)].sum() < MASS:
                return
        key = (d, index.items[p])
        if key not in best or (share, cosine) > best[key][1::-1]:
            best[key] = (cosine, share, start, best[key][3] if key in best else way)

    for part in np.array_split(live, -(-len(live) // 4096)) if len(live) else []:
        dot = window[part] @ latent.T
        cosine = dot / np.maximum(size[part][:, None] * long[None, :], 1e-9)
        weight = dot / np.maximum(long[None, :] ** 2, 1e-9)
        w, p = np.nonzero((weight >= gate) & (cosine >= COSINE))
        for w_, p_ in zip(w.tolist(), p.tolist(), strict=True):
            d = int(np.searchsorted(base, part[w_], side="right")) - 1
            judge(d, int(index.held[p_]), int(part[w_] - base[d]) * STRIDE, float(cosine[w_, p_]), "latent")
    # The exact way: whatever the projections lose, no hit lacks its probes.
    for d, w, p in zip(*(x.tolist() for x in Probes(**index.probes).met(h, n)), strict=True):
        for k in range(w, min(w + SPAN, -(-int(n[d]) // STRIDE))):
            dot = float(window[base[d] + k] @ index.latent[p])
            judge(d, p, k * STRIDE, dot / max(float(size[base[d] + k] * own[p]), 1e-9), "words")
    return [(d, item, *x) for (d, item), x in best.items()]


def blocks_of(docs: DataFrame, bench: DataFrame, block: int = 200, block_bytes: int = 256_000, at_once: int = 8) -> Iterator[list[Index]]:
    """The indexes of the benchmark's blocks, ``at_once`` together."""
    bench = bench.filter("text is not null and item_id is not null")
    r = bench.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = max(1, -(-r.n // block), -(-r.bytes // block_bytes))
    parts = [bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) for b in range(n)]
    for i in range(0, n, at_once):
        if indexes := fit(docs, parts[i : i + at_once]):
            yield indexes


def _met(texts: list[str | None], indexes: list[Index]) -> list[tuple[int, object, float, float, int, str]]:
    h, n = _word_hashes(texts)
    return [x for index in indexes for x in hits(h, n, index)]


def contaminated(docs: DataFrame, bench: DataFrame, block: int = 200, block_bytes: int = 256_000) -> DataFrame:
    """(doc_id, item_id, cosine, in_order, first_word, found_by) of every document and item that meet."""
    docs, spark = docs.select("doc_id", "text"), docs.sparkSession
    kind = bench.schema["item_id"].dataType.simpleString()
    schema, found = f"doc_id long, item_id {kind}, cosine double, in_order double, first_word long, found_by string", []
    for indexes in blocks_of(docs, bench, block, block_bytes):
        shared = spark.sparkContext.broadcast([vars(ix) for ix in indexes])

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = [Index(**x) for x in shared.value]
            for b in pieces(batches, "text"):
                got = _met(b.column("text").to_pylist(), own)
                at = pa.array([x[0] for x in got], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(at), pa.array([x[1] for x in got], pa.int64() if kind == "bigint" else None), pa.array([x[2] for x in got], pa.float64()),
                                                  pa.array([x[3] for x in got], pa.float64()), pa.array([x[4] for x in got], pa.int64()), pa.array([x[5] for x in got], pa.string())], names=["doc_id", "item_id", "cosine", "in_order", "first_word", "found_by"])

        with small_batches(spark):
            found.append(stage(docs.mapInArrow(search, schema), "hits"))
        shared.destroy()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def op7_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all documents against all benchmark items; a row for each document and item that meet."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the corpus pipeline: documents with a hit go."""
    out = docs
    for indexes in blocks_of(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")):
        shared = spark.sparkContext.broadcast([vars(ix) for ix in indexes])

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = [Index(**x) for x in shared.value]
            for b in pieces(batches, "text"):
                keep = np.ones(b.num_rows, bool)
                keep[[x[0] for x in _met(b.column("text").to_pylist(), own)]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(clean, docs.schema)
    return out


QUERIES = {"op7_latent_decontamination": op7_latent_decontamination}
ORACLES: dict[str, str] = {}
