"""Alignment of two tokenizers against whole texts encoded by their own libraries and all pairs of intervals."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caseledger.llm import alignment
from caseledger.llm.alignment import align_tokens, pieces
from caseledger.llm.bpe import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  ", "\n", "a", " lead", "trail ", "two  spaces", "tab\tand\r\nlines\n\nmore", "x\u00a0y \u2003z", "caf\u00e9 na\u00efve \u4f60\u597d \U0001f600 end", "<|endoftext|> <s> </s> <unk> <0x0A>",
    "it's we'll I'd", "mark \u2581 here", "\u2581", "1234567 89", "new\n line", "\x1c odd\x1f \x85 sep", "\u180e x \u180ey", "a" * 3000, "word " * 3000, "{\r\n\t}\r ;\r", "\u0000 nul", "!!! ??? ...",
]


def tokens(a, b, text):
    led = (" " + text).encode()
    code = {c: i for i, c in enumerate(byte_alphabet())}
    e = a.encode(" " + text, add_special_tokens=False)
    ta = [(i, bytes(code[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
    names = [(i, b.id_to_piece(i)) for i in b.encode(text)]
    tb = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("\u2581", " ").encode()) for i, p in names]
    if not text or b"".join(x for _, x in ta) != led or b"".join(x for _, x in tb) != led:
        return None
    out = []
    for t in (ta, tb):
        at, spans = 0, []
        for i, x in t:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(both, rows):
    found = [tokens(*both, t or "") for _, t in rows]
    links = [[(x[0], y[0]) for x in f[0] for y in f[1] if x[1] < y[2] and y[1] < x[2]] if f else [] for f in found]
    count = Counter(p for x in links for p in set(x))
    top = {}
    for (i, _), c in count.items():
        top[i] = max(top.get(i, 0), c)
    out = []
    for (ident, _), f, ls in zip(rows, found, links, strict=True):
        if not f:
            out.append((ident, 0, 0, 0, 0, 0, 0, ""))
            continue
        ends = sorted({x[2] for x in f[0]} & {x[2] for x in f[1]})
        groups, lo = [], 0
        for hi in ends:
            groups.append("|".join(",".join(str(i) for i, _, e in t if lo < e <= hi) for t in f))
            lo = hi
        best = sum(count[p] == top[p[0]] for p in ls)
        out.append((ident, len(f[0]), len(f[1]), len(groups), len(ls), best, sum(count[p] for p in ls), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(seed, n=120):
    r = random.Random(seed)
    letters = ["the", "ing", "er", "\u00e9", "\u00df", "x", "Q", "7", ".", ",", "!", "'s", " ", " ", " ", "\n", "  ", "\t", "\u4e2d", "\U0001f525", "tion", "_", "-"]
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randint(0, 60)))) for i in range(n)]
    return rows + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no name"), (5, "again"), (5, "again")]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_equals_all_pairs_of_whole_texts(spark, both, limit, monkeypatch):
    rows = rows_of(1)
    monkeypatch.setattr(alignment, "GROUP_CHARS", 500)
    monkeypatch.setattr(alignment, "PARTIAL_PAIRS", 50)
    monkeypatch.setattr(alignment, "CACHE_PIECES", 100)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, pairs string").repartition(3)
    got = align_tokens(df, A, B, broadcast_pairs=limit)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == brute(both, rows)


def test_pieces_hold_for_whole_texts(both):
    a, b = both
    space = [b.piece_to_id("\u2581")]
    for _, t in rows_of(2, 1500):
        if t and "\u2581" not in t:
            cut = pieces(t)
            assert "".join(cut) == " " + t
            assert [i for p in cut for i in a.encode(p, add_special_tokens=False).ids] == a.encode(" " + t, add_special_tokens=False).ids
            assert [i for p in cut for i in (space if p == " " else b.encode(p[1:]) if p[0] == " " else b.encode(p)[1:])] == b.encode(t)


def test_empty_table(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_real_texts(spark, both):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(12)
    rows = [tuple(r) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if len(t or "") < 4000]
    assert sorted(map(tuple, align_tokens(spark.createDataFrame(rows, docs.schema), A, B).collect()), key=repr) == brute(both, rows)
