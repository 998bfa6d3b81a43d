"""Cross-tokenizer alignment against a plain walk over both token lists."""

import json
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from siltwork.llm import alignment as al

A, B = f"{al.TOKENIZERS}/byte_bpe_50k.json", f"{al.TOKENIZERS}/piece_bpe_32k.model"
ODD = ["", " ", "  two  spaces ", "\n\nnew\n lines \n", "tab\t and\x0bothers\x0c\r\n", "a b   c　d e", "it's we'll 'tis  's", "<|endoftext|> <s> </s> <unk> <0x41>", "▁lower block", "nul \x00 byte",
       "\U0001f600 emoji \U0001f468‍\U0001f469‍\U0001f467", "é combining", "1234567 12,345.678", "​ zero ​width", "﻿mark", "x" * 3000, "many " * 500, "a", " a", "᠎ mongolian \u0085 next", "中文 字", "a  b", "trailing "]


def brute(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups of each text."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    spelled = {i: bytes(byte[c] for c in k) for k, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items() if all(c in byte for c in k)}
    docs = []
    for t in texts:
        whole = b" " + (t or "").encode()
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        bx = [spelled[i] for i in x]
        by = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in y)]
        if not t or b"".join(bx) != whole or b"".join(by) != whole:
            docs.append(([], []))
            continue
        groups, links, i, j, ea, eb, ga, gb = [], [], 0, 0, len(bx[0]), len(by[0]), [x[0]], [y[0]]
        while True:
            links.append((x[i], y[j]))
            if ea == eb:
                groups.append((ga, gb))
                i, j = i + 1, j + 1
                if i == len(x):
                    break
                ga, gb, ea, eb = [x[i]], [y[j]], ea + len(bx[i]), eb + len(by[j])
            elif ea < eb:
                i += 1
                ga.append(x[i])
                ea += len(bx[i])
            else:
                j += 1
                gb.append(y[j])
                eb += len(by[j])
        docs.append((groups, links))
    held = Counter(p for _, links in docs for p in set(links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(n, best.get(x, 0))
    text = lambda groups: ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
    return [(sum(len(g) for g, _ in gs), sum(len(h) for _, h in gs), len(gs), len(ls), sum(held[p] == best[p[0]] for p in ls), sum(held[p] for p in ls), text(gs)) for gs, ls in docs]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("piece", [3_000_000, 700])
def test_equals_a_plain_walk(spark, rows, piece):
    texts = [r[1] if r[1] is None else r[1][:20_000] for r in rows] + ODD + [None, ODD[2], ODD[2]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = al.alignment(docs, al.byte_level(A), al.pieced(B), piece=piece).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == dict(enumerate(brute(texts)))


def test_query_gives_digests(spark, table):
    made = [(1, "the same words"), (1, "the same words"), (None, "the words"), (2, None), (3, "")]
    folder = table(spark.createDataFrame(made, "doc_id long, text string").withColumns({"piece": F.lit("x"), "pair": F.lit(1), "groups": F.lit(2)}))
    got = sorted(map(tuple, al.op11_cross_tokenizer(spark, folder).select("doc_id", *COLUMNS[:-1], "groups_sha256").collect()), key=str)
    want = brute([t for _, t in made])
    assert got == sorted(((i, *w[:-1], sha256(w[-1].encode()).hexdigest() if w[-1] else "") for (i, _), w in zip(made, want, strict=True)), key=str)


def test_words_join_where_spaces_meet_white_space():
    code, distinct, counts = al.words_of(["a b", "", "a  b", "b \nc a", "a b "])
    at, out = 0, []
    for n in counts:
        out.append([distinct[c] for c in code[at : at + n]])
        at += n
    assert out == [["a", "b"], [""], ["a  b"], ["b \nc", "a"], ["a", "b "]]
