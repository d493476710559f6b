"""Stages of the corpus pipeline against plain brute force."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from caseledger.llm import near, repeats

RNG = random.Random(11)
WORDS = [f"w{i}" for i in range(500)]


def prose(n: int) -> str:
    return " ".join(RNG.choices(WORDS, k=n))


def changed(text: str, edits: int) -> str:
    w = text.split()
    for i in RNG.sample(range(len(w)), edits):
        w[i] = f"new{RNG.random()}".replace(".", "")
    return " ".join(w)


def shingles(text: str) -> set:
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_keepers(texts: list[str]) -> set[int]:
    """The first document of each component of texts of similarity 0.8 or more."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {top(i) for i in range(len(texts))}


def test_bit_sliced_distances_are_those_of_popcounts():
    rng = np.random.default_rng(2)
    for m in (1, 63, 64, 65, 200, 512):
        base = rng.integers(0, 1 << 63, (4, near.WORDS), dtype=np.uint64)
        few = lambda: rng.integers(0, 1 << 63, (m, near.WORDS), dtype=np.uint64)
        fp = base[rng.integers(0, 4, m)] ^ (few() & few() & few())
        for radius in (0, 3, 22, 63, 90):
            want = [[sum((int(x) ^ int(y)).bit_count() for x, y in zip(a, b, strict=True)) <= radius for b in fp] for a in fp[:30]]
            assert near.close(fp[:30], fp, radius).tolist() == want


def test_forests_span_the_graph():
    rng = np.random.default_rng(5)
    for _ in range(60):
        m = int(rng.integers(2, 40))
        hit = rng.random((m, m)) < 0.05
        both = np.arange(m)
        if rng.random() < 0.5:
            hit = (hit | hit.T) & ~np.eye(m, dtype=bool)
            left = right = both
        else:
            left, right = both, both + m
        edges = [(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(hit), strict=True)]

        def parts(edges):
            root = {k: k for k in range(2 * m)}
            for a, b in edges:
                a, b = root[a], root[b]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
            return root

        got = list(near.forest(left, right, hit))
        assert set(got) <= set(edges) and parts(got) == parts(edges) and len(got) == sum(k != r for k, r in parts(edges).items())


@pytest.mark.parametrize("dense", [near.DENSE, 0])
def test_hot_groups_are_dealt_by_tiles(spark, monkeypatch, dense):
    monkeypatch.setattr(near, "GROUP_TILE", 8)
    monkeypatch.setattr(near, "TILE", 8)
    monkeypatch.setattr(near, "DENSE", dense)
    base = prose(150)
    texts = [changed(base, k % 8) for k in range(90)] + [prose(80) for _ in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, "").collect()} == brute_keepers(texts)


def test_near_duplicates_are_all_pairs_of_similarity(spark):
    texts = [prose(RNG.randint(1, 200)) for _ in range(40)]
    for n in (6, 9, 30, 100, 300, 600):
        base = prose(n)
        texts += [base, base.upper() + "!", base + " tail", *(changed(base, min(n, k)) for k in (1, 2, 4, 7, 9, 14, 20))]
    texts += ["", "...", "one two", "One, two", *(f"{prose(60)} {' '.join(WORDS[:50])}" for _ in range(30))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, "").collect()}
    assert got == brute_keepers(texts)


def test_repeats_of_more_than_fifty_words_go(spark):
    short = ["".join(RNG.choices("abcdefgh", k=3)) for _ in range(300)]
    some = lambda n: " ".join(RNG.choices(short, k=n))
    passages = [some(n) for n in (49, 50, 51, 52, 80, 130)]
    cjk = "".join(chr(0x4E00 + RNG.randrange(3000)) for _ in range(140))
    copy = some(51)
    texts = [f"{some(RNG.randint(1, 30))}\n{p}  {some(RNG.randint(1, 30))}" for p in passages for _ in range(3)]
    texts += [some(300) for _ in range(5)] + [f"A{cjk}B", f"C{cjk}D " + some(9), copy, copy, some(50), "", "q " * 52, "z " * 51]
    found = [t.split() for t in texts]
    seen = {}
    for i, w in enumerate(found):
        for j in range(len(w) - 50):
            seen.setdefault(tuple(w[j : j + 51]), []).append((i, j))
    gone = {(i, k) for places in seen.values() if len(places) > 1 for i, j in places for k in range(j, j + 51)}
    want = [[x for k, x in enumerate(w) if (i, k) not in gone] for i, w in enumerate(found)]
    want = [[x.replace(cjk, "") for x in w] for w in want]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long").repartition(4)
    got = {r["doc_id"]: r for r in corpus_pipeline.repeats(spark, df, "").collect()}
    assert [got[i]["text"].split() for i in range(len(texts))] == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_word_hashes_are_of_the_words_alone():
    texts = [b"a b a", b" \t", b"", b"x" * 9000 + b" y\n" + b"x" * 9000, "é ü\u00a0é".encode(), bytes(RNG.choices(b"abcdefg \n\t", k=3000))]
    known: dict[bytes, int] = {}
    for t in texts:
        h, w = repeats.word_hashes(t).tolist(), t.split()
        assert len(h) == len(w)
        assert all(known.setdefault(x, y) == y for x, y in zip(w, h, strict=True))
    assert len(set(known.values())) == len(known) > 100


def test_shared_passages_of_more_than_fifty_words_are_told(spark):
    short = ["".join(RNG.choices("abcdefgh", k=3)) for _ in range(300)]
    some = lambda n: " ".join(RNG.choices(short, k=n))
    texts = [f"{some(RNG.randint(0, 30))} {p}\t {some(RNG.randint(0, 30))}" for p in [some(n) for n in (20, 35, 51, 51, 52, 55, 60, 130)] for _ in range(2)]
    copy, under, twice = some(51), some(35), some(51)
    texts += [some(300), copy, copy, under, under, f"{twice} {twice}", "", None, " ".join(["z"] * 52), " ".join(["z"] * 60), " ".join(["y"] * 51)]
    words = [(t or "").split() for t in texts]
    grams = lambda n: [{tuple(w[j : j + n]) for j in range(len(w) - n + 1)} for w in words]

    def shares(n):
        g = grams(n)
        return [any(a & b for j, b in enumerate(g) if j != i) for i, a in enumerate(g)]

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_shared > 0 for r in repeats.repeat_digests(df, words=51).collect()}
    got = [got[i] for i in range(len(texts))]
    assert all(got[i] for i, x in enumerate(shares(51)) if x) and sum(shares(51)) >= 14
    assert not any(got[i] for i, x in enumerate(shares(36)) if not x)


def test_run_from_tables_to_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    from caseledger.llm.queries import tokenizer_path

    texts = [prose(140) for _ in range(30)]
    texts += [changed(texts[0], 3), texts[1], texts[2] + " tail", changed(texts[3], 90)]
    item, passage = prose(40), prose(70)
    leaks, shared = [len(texts), len(texts) + 1], [len(texts) + 2, len(texts) + 3]
    texts += [f"{prose(60)} {item} {prose(20)}", f"{item} {prose(90)}", f"{prose(80)} {passage} {prose(50)}", f"{passage} {prose(90)}"]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(25)), (3, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == brute_keepers(texts) - set(leaks)
    whole = {i: len(e.ids) for i, e in enumerate(Tokenizer.from_file(tokenizer_path()).encode_batch(texts, add_special_tokens=False))}
    gone = len(Tokenizer.from_file(tokenizer_path()).encode(" " + passage).ids)
    assert all(got[i] == whole[i] for i in got if i not in shared)
    assert all(abs(got[i] - (whole[i] - gone)) <= 2 for i in shared)
