"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of linked ids.

A text with one space before it is encoded by tokenizer A and by tokenizer B. Offsets where tokens of both end cut the
bytes into groups; two tokens are linked where their bytes overlap, so the links of a document are the stretches between
neighbouring ends of either side.

1. Documents are read in pieces of about ``piece`` bytes. A piece's documents are laid end to end; the ends of A's and of
   B's tokens are counted by byte offset once for all of them, a cut is where both counts hold an end, and prefix sums of
   the counts, read at the documents' own offsets, give each document's tokens, groups and links.
2. A piece sends each pair of linked ids once, with the number of its documents that link it; the sums are the pairs'
   counts, and the largest of an A id is its best. Counts go back to the pieces by a join on the pair, and prefix sums
   over the documents' pairs give the totals of each document. Texts are read and encoded once.

Encoding is by words: neither tokenizer has a token that spans a single space between two characters that are not white
space, so a task encodes each distinct word that it meets once. That this holds of the vocabulary of B is checked when
it is loaded; the pre-tokenisation of A has the property by its pattern.

Defined results: texts that are null or empty, and texts that either side's tokens do not spell byte for byte, have no
tokens, no groups and no links; the strings of special tokens are ordinary text; rows count as documents each, also with
repeated or null doc_ids; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._graph import apart
from siltwork.llm._store import stage
from siltwork.llm._text import pieces, small_batches

TOKENIZERS = "/opt/tokenizers"
#: Bits of a B id in a pair of ids.
B_BITS = 15
#: Words whose tokens a task keeps; it starts anew beyond them.
KEPT = 400_000
ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
SCHEMA = f"{ROW.replace(', groups string', '')}, n_best long, count_sum long, groups string"

Encoder = Callable[[list[str]], list[list[int]]]
#: Makes, inside a task, the encoder of words (each is encoded with a space before it) and the bytes of every id.
Tokenizer = Callable[[], tuple[Encoder, list[bytes]]]


#: What no word that is encoded with others may begin or end with: white space, characters that some readings count as such, and nothing.
BLANK = frozenset(["", "\u180e", "\u200b", "\ufeff", *[chr(c) for c in range(0x3001) if chr(c).isspace()]])


def byte_level(path: str) -> Tokenizer:
    """Tokenizer A from the JSON file of a byte-level BPE; the file is read on the driver and travels with the function."""
    with open(path, encoding="utf-8") as f:
        described = f.read()

    def make() -> tuple[Encoder, list[bytes]]:
        from tokenizers import Tokenizer as Model

        model = Model.from_str(described)
        model.encode_special_tokens = True
        # Printable bytes stand for themselves, the others for the code points from 256 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        entries = json.loads(described)
        vocabulary = entries["model"]["vocab"] | {x["content"]: x["id"] for x in entries["added_tokens"]}
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            spelled[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        width = np.array([len(x) for x in spelled])

        def ids(text: str) -> list[int]:
            return model.encode(text, add_special_tokens=False).ids

        def encode(words: list[str]) -> list[list[int]]:
            """Words without white space at their ends are encoded as one text and told apart by the bytes of their tokens."""
            plain = [w for w in words if w[:1] not in BLANK and w[-1:] not in BLANK]
            every = ids(" " + " ".join(plain)) if plain else []
            ends, wanted = np.cumsum(width[every]) if every else np.empty(0, np.int64), np.cumsum([1 + len(w.encode()) for w in plain])
            at = np.searchsorted(ends, wanted) if len(ends) else np.empty(0, np.int64)
            if len(plain) and len(ends) and at[-1] == len(ends) - 1 and (ends[at] == wanted).all():
                cut = [0, *(at + 1).tolist()]
                found = [every[a:b] for a, b in zip(cut, cut[1:], strict=False)]
            else:
                found = [ids(" " + w) for w in plain]
            if len(plain) == len(words):
                return found
            known = dict(zip(plain, found, strict=True))
            return [known[w] if w in known else ids(" " + w) for w in words]

        return encode, spelled

    return make


def pieced(path: str) -> Tokenizer:
    """Tokenizer B from a model file of pieces with byte fallback, which puts a space before each text itself."""
    with open(path, "rb") as f:
        proto = f.read()

    def make() -> tuple[Encoder, list[bytes]]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=proto)
        entries = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any("▁" in x.lstrip("▁") for x in entries):
            raise ValueError("a piece spans a space after another character, so texts cannot be encoded by words")
        spelled = [bytes([int(x[3:5], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(entries)]
        return lambda words: model.encode(words, num_threads=1), spelled

    return make


def words_of(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The texts as words that either tokenizer can encode alone: the code of each word, the distinct words, each text's number of words.

    Texts are split at every space, and put together again where a space stands beside other white space.
    """
    split = [t.split(" ") for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = list(chain.from_iterable(split))
    coded = pa.array(flat, pa.string()).dictionary_encode()
    code, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
    begins = np.array([w[:1] in BLANK for w in distinct], bool)
    finishes = np.array([w[-1:] in BLANK for w in distinct], bool)
    joined = begins[code]
    joined[1:] |= finishes[code[:-1]]
    joined[(np.cumsum(counts) - counts)] = False
    if not joined.any():
        return code, distinct, counts
    starts = np.flatnonzero(~joined)
    many = np.diff(np.append(starts, len(code)))
    place, out = {}, code[starts]
    for c in np.flatnonzero(many > 1).tolist():
        word = " ".join(flat[starts[c] : starts[c] + many[c]])
        out[c] = place.setdefault(word, len(distinct) + len(place))
    doc = np.repeat(np.arange(len(counts)), counts)[starts]
    used, out = np.unique(out, return_inverse=True)
    distinct += place
    return out, [distinct[i] for i in used.tolist()], np.bincount(doc, minlength=len(counts))


class Side:
    """One tokenizer inside a task: the tokens of all words met so far."""

    def __init__(self, make: Tokenizer):
        self.encode, self.spelled = make()
        self.width = np.array([len(x) for x in self.spelled], np.int64)
        self.forget()

    def forget(self) -> None:
        self.ids, self.many, self.sound = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, bool)

    def learn(self, words: list[str]) -> None:
        found = self.encode(words)
        new = np.fromiter(chain.from_iterable(found), np.int32)
        many = np.fromiter(map(len, found), np.int64, len(found))
        wanted = [b" " + w.encode() for w in words]
        ends = np.append(0, np.cumsum(self.width[new]))[np.cumsum(many)]
        # Tokens that spell all words on end, each word in as many bytes as it has, spell each of them.
        whole = (ends == np.cumsum(np.fromiter(map(len, wanted), np.int64, len(wanted)))).all() and b"".join(map(self.spelled.__getitem__, new.tolist())) == b"".join(wanted)
        sound = [whole or b"".join([self.spelled[i] for i in ids]) == w for ids, w in zip(found, wanted, strict=True)]
        self.ids, self.many, self.sound = np.concatenate([self.ids, new]), np.concatenate([self.many, many]), np.concatenate([self.sound, np.array(sound, bool)])
        self.starts = np.cumsum(self.many) - self.many

    def tokens(self, known: np.ndarray) -> np.ndarray:
        """The ids of the tokens of these words, in order."""
        many = self.many[known]
        return self.ids[np.repeat(self.starts[known] - np.cumsum(many) + many, many) + np.arange(many.sum())]


class Aligner:
    """Both tokenizers inside a task."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.a, self.b, self.known = Side(a), Side(b), {}
        if len(self.b.spelled) > 1 << B_BITS or len(self.a.spelled) << B_BITS > 1 << 31:
            raise ValueError("ids of both tokenizers do not fit in a pair")
        digits = np.char.ljust(np.arange(max(len(self.a.spelled), len(self.b.spelled))).astype(bytes), 10).view(np.uint8).reshape(-1, 10)
        self.wide = (digits != 32).sum(1)
        self.digits = np.ascontiguousarray(digits[:, : self.wide.max()].T)

    def aligned(self, texts: list[str | None]) -> Aligned:
        code, distinct, counts = words_of([t or "" for t in texts])
        if len(self.known) > KEPT:
            self.known = {}
            self.a.forget()
            self.b.forget()
        new = [w for w in distinct if w not in self.known]
        if new:
            self.known |= {w: i for i, w in enumerate(new, len(self.known))}
            self.a.learn(new)
            self.b.learn(new)
        word = np.fromiter((self.known[w] for w in distinct), np.int64, len(distinct))[code]
        doc = np.repeat(np.arange(len(texts)), counts)
        good = np.array([bool(t) for t in texts])
        good[doc[~(self.a.sound & self.b.sound)[word]]] = False
        return Aligned(self, self.a.tokens(word[good[doc]]), self.b.tokens(word[good[doc]]), np.array([1 + len(t.encode()) if g else 0 for t, g in zip(texts, good, strict=True)], np.int64))


class Aligned:
    """The tokens of a batch of documents laid end to end. ``sizes``: bytes of each document; those without tokens have none."""

    def __init__(self, by: Aligner, a: np.ndarray, b: np.ndarray, sizes: np.ndarray):
        self.by, self.a, self.b = by, a, b
        last = np.cumsum(sizes)
        self.bounds = np.append(0, last)
        total = int(self.bounds[-1])
        ends_a = np.bincount(np.cumsum(by.a.width[a]), minlength=total + 1).astype(bool)
        ends_b = np.bincount(np.cumsum(by.b.width[b]), minlength=total + 1).astype(bool)
        if len(ends_a) != total + 1 or len(ends_b) != total + 1:
            raise RuntimeError("tokens and texts differ in length")
        # Prefix sums: how many tokens end at or before an offset.
        self.sum_a, self.sum_b = np.cumsum(ends_a, dtype=np.int32), np.cumsum(ends_b, dtype=np.int32)
        self.cuts = np.flatnonzero(ends_a & ends_b)
        self.ends = np.flatnonzero(ends_a | ends_b)

    def per_document(self, sums: np.ndarray) -> np.ndarray:
        """Differences of prefix sums at the documents' offsets."""
        return np.diff(sums[self.bounds]).astype(np.int64)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each document's tokens of A and of B, groups and links."""
        of = lambda places: np.diff(np.searchsorted(places, self.bounds, side="right"))
        return self.per_document(self.sum_a), self.per_document(self.sum_b), of(self.cuts), of(self.ends)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, how often) of linked ids, by document and pair. The stretch that ends at an offset is linked to the tokens that the byte before it is in."""
        before = self.ends - 1
        pair = (self.a[self.sum_a[before]].astype(np.int64) << B_BITS) | self.b[self.sum_b[before]]
        many = np.diff(np.searchsorted(self.ends, self.bounds, side="right"))
        every, often = np.unique((np.repeat(np.arange(len(many)), many) << 31) | pair, return_counts=True)
        return every >> 31, every & ((1 << 31) - 1), often

    def groups(self) -> Iterator[bytes]:
        """Each document's groups: ids of A, a bar, ids of B; groups are joined by semicolons."""
        a_end, b_end = self.sum_a[self.cuts].astype(np.int64), self.sum_b[self.cuts].astype(np.int64)
        many_a, many_b = np.diff(a_end, prepend=0), np.diff(b_end, prepend=0)
        ids = np.empty(len(self.a) + len(self.b), np.int32)
        mark = np.full(len(ids), ord(","), np.uint8)
        ids[np.arange(len(self.a)) + np.repeat(b_end - many_b, many_a)] = self.a
        ids[np.arange(len(self.b)) + np.repeat(a_end, many_b)] = self.b
        mark[a_end + b_end - many_b - 1] = ord("|")
        mark[a_end + b_end - 1] = ord(";")
        wide = self.by.wide[ids]
        stop = np.cumsum(wide + 1)
        start = stop - wide - 1
        out = np.empty(int(stop[-1]) + 10 if len(stop) else 0, np.uint8)
        # Digits beyond an id's own fall on later ids, whose digits there have a lower place and are put down afterwards.
        for place in range(len(self.by.digits) - 1, -1, -1):
            out[start + place] = self.by.digits[place][ids]
        out[stop - 1] = mark
        tokens = (self.sum_a[self.bounds] + self.sum_b[self.bounds]).astype(np.int64)
        at = np.append(0, stop)[tokens]
        whole = memoryview(out)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield bytes(whole[lo : hi - 1]) if hi > lo else b""


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x.astype(np.int32)).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def alignment(docs: DataFrame, a: Tokenizer, b: Tokenizer, groups: Callable[[bytes], str] = bytes.decode, piece: int = 3_000_000) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, and what ``groups`` makes of its groups (see Aligned.groups), their text by default.

    n_best counts the links whose pair of ids is linked in as many documents as any pair of its A id; count_sum sums the
    links' numbers of documents.
    """
    docs, spark = docs.select("doc_id", "text"), docs.sparkSession
    names = [x.split()[0] for x in ROW.split(", ")]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, part, seq = None, TaskContext.get().partitionId(), 0
        for batch in pieces(batches, "text", piece):
            by = by or Aligner(a, b)
            got = by.aligned(batch.column("text").to_pylist())
            doc, pair, often = got.pairs()
            distinct, at, held = np.unique(pair, return_inverse=True, return_counts=True)
            own = np.bincount(doc, minlength=batch.num_rows)
            first = np.zeros(len(doc), bool)
            first[(np.cumsum(own) - own)[own > 0]] = True
            links = _packed(own), _packed(np.where(first, at, np.diff(at, prepend=0))), _packed(often)
            text = pa.array([groups(x) for x in got.groups()], pa.string())
            rows = pa.StructArray.from_arrays([batch.column("doc_id").cast(pa.int64()), *[pa.array(x, pa.int64()) for x in got.counts()], text], names)
            listed = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 33) + seq], pa.int64()), listed(rows), listed(pa.array(distinct, pa.int32())), listed(pa.array(held, pa.int32())), *[pa.array([x], pa.binary()) for x in links]],
                names=["piece", "rows", "pair", "held", "own", "at", "often"])
            seq += 1

    def summed(mine: pa.Table, counts: pa.Table) -> pa.Table:
        counts = counts.sort_by("pair")
        n, best = counts["n"].to_numpy(), counts["best"].to_numpy()
        own, at, often = (_unpacked(mine[c][0].as_py()).astype(np.int64) for c in ("own", "at", "often"))
        bounds = np.append(0, np.cumsum(own))
        step = np.append(0, np.cumsum(at))
        # Places are gaps within a document and absolute at its start, so the sum up to its start is taken off.
        at = step[1:] - np.repeat(step[bounds[:-1]], own)
        total = lambda x: np.diff(np.append(0, np.cumsum(x))[bounds])
        rows = mine["rows"].combine_chunks().flatten()
        out = dict(zip(names, rows.flatten(), strict=True))
        out |= {"n_best": pa.array(total(often * best[at] if len(at) else at), pa.int64()), "count_sum": pa.array(total(often * n[at] if len(at) else at), pa.int64())}
        return pa.table({x.split()[0]: out[x.split()[0]] for x in SCHEMA.split(", ")})

    with small_batches(spark):
        schema = f"piece long, rows array<struct<{', '.join(f'{x.split()[0]}:{x.split()[1]}' for x in ROW.split(', '))}>>, pair array<int>, held array<int>, own binary, at binary, often binary"
        made = stage(docs.mapInArrow(aligned, schema), "aligned")
    each = made.select("piece", F.explode(F.arrays_zip("pair", "held")).alias("x")).select("piece", "x.pair", "x.held")
    sums = stage(each.groupBy("pair").agg(F.sum("held").alias("n")), "pairs")
    of_a = F.shiftright("pair", B_BITS)
    most = sums.groupBy(of_a.alias("a")).agg(F.max("n").alias("most")).select(apart(F.col("a").cast("long")).alias("a"), "most")
    best = sums.join(most, of_a.cast("long") == F.col("a")).select(apart(F.col("pair").cast("long")).alias("_pair"), "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    back = each.join(best, F.col("pair").cast("long") == F.col("_pair")).select(F.col("piece").alias("_piece"), "pair", "n", "best")
    return made.select("piece", "rows", "own", "at", "often").groupBy("piece").cogroup(back.groupBy("_piece")).applyInArrow(summed, SCHEMA)


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: all documents, the byte-level BPE against the pieces."""
    found = alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"), byte_level(f"{TOKENIZERS}/byte_bpe_50k.json"), pieced(f"{TOKENIZERS}/piece_bpe_32k.model"), lambda x: sha256(x).hexdigest() if x else "")
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES = {"op11_cross_tokenizer": op11_cross_tokenizer}
ORACLES: dict[str, str] = {}
