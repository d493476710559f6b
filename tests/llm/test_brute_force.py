"""Operators against plain brute force on small fixtures with planted cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from caseledger.llm import bpe, decontam, html, media, quality, repeats, sharding, simhash, toxicity
from caseledger.llm.graph import connected_components
from caseledger.llm.queries import tokenizer_path

RNG = random.Random(5)
SYLLABLES = "ba ke lo mi nu pra ste vo zu an er ti on re la".split()
WORDS = ["".join(RNG.choices(SYLLABLES, k=RNG.randint(1, 3))) for _ in range(400)]


def prose(n: int) -> str:
    return " ".join(RNG.choices(WORDS, k=n))


def planted() -> list[str]:
    texts = [prose(RNG.randint(5, 300)) for _ in range(60)]
    base = prose(400)
    texts += [base, base, base + " more", base.upper()]
    passage = prose(70)
    texts += [f"{prose(RNG.randint(0, 20))} {passage} {prose(RNG.randint(0, 20))}" for _ in range(14)]
    a = prose(200)
    texts += [prose(5) + a[100 : 100 + n] + prose(5) for n in (390, 398, 399, 400, 401, 410)] + [a]
    return texts + ["ab" * 600, "x" * 900, "", "é" * 500]


def brute_repeats(texts, length=400):
    raw = [t.encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    for b in raw:
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        yield len(b), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [repeats.HOT, 3])
def test_repeats(spark, hot):
    texts = planted()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = repeats.repeat_digests(df, hot=hot).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == list(brute_repeats(texts))


def test_class_strings_pairs_and_classes_agree():
    for _ in range(30):
        members = [(bytes(RNG.choices(b"ab", k=RNG.choice([repeats.SIDE, 20]))), bytes(RNG.choices(b"ab", k=RNG.choice([repeats.SIDE, 30])))) for _ in range(RNG.randint(2, 6))]
        core = bytes(RNG.choices(b"ab", k=repeats.SIDE))
        members += [(core, core[:k] + b"z" * (repeats.SIDE - k)) for k in (0, 40, repeats.SIDE, 100)]
        members.sort()
        right = [0] + [repeats.shared(a[0], b[0]) for a, b in zip(members, members[1:], strict=False)]

        def covered(m, r):
            out = {(i, o) for i, low, high in repeats.class_strings(r, [x[1] for x in m]) for o in range(low, high + 1)}
            return out

        brute = {(i, o) for i, (ri, li) in enumerate(members) for j, (rj, lj) in enumerate(members) if i != j for o in range(repeats.SIDE + 1)
                 if repeats.shared(li, lj) >= o and repeats.shared(ri, rj) >= repeats.SIDE - o}
        assert covered(members, right) == brute


def test_merge_is_a_sort():
    runs, every = [], []
    for k in range(5):
        items = [(bytes(RNG.choices(b"ab", k=20)), b"l%d" % k, bytes([k]) * 16, i) for i in range(RNG.randint(0, 40))]
        every += items
        if items:
            runs.append(repeats.Run(**repeats.encode_run(list(items))))
    got = list(repeats.merge_runs(runs))
    keys = sorted(x[0] for x in every)
    place = {(x[2], x[3]): x[0] for x in every}
    assert [place[w] for *_, w in got] == keys
    assert [n for n, *_ in got][1:] == [repeats.shared(a, b) for a, b in zip(keys, keys[1:], strict=False)]


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    texts = planted()
    texts += [texts[0][:-1] + "q", " ".join(prose(2000).split()[:1999] + ["one"])]
    long = prose(3000)
    texts += [long, long + " tail", long.replace(" ", "\t"), "É È"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    fps = [brute_fingerprint(t) for t in texts]
    parent = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    got = simhash.near_duplicate_classes(df).orderBy("doc_id").collect()
    assert [r.fp & (1 << 64) - 1 for r in got] == fps
    assert [r.component_id for r in got] == parent


def test_hot_bands_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    base = RNG.getrandbits(48)
    fps = sorted({base | (RNG.getrandbits(6) << 48) for _ in range(60)} | {RNG.getrandbits(64) for _ in range(50)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    root = {x: x for x in signed}
    for r in connected_components(links).collect():
        root[r.node] = r.root
    label = {}
    for i, x in enumerate(fps):
        label.setdefault(x, i)
    for x in fps:
        for y in fps:
            if (x ^ y).bit_count() <= 3 and label[x] != label[y]:
                a, b = label[x], label[y]
                label = {k: min(a, b) if v in (a, b) else v for k, v in label.items()}
    pairs = lambda m: {(a, b) for a in range(len(fps)) for b in range(a) if m[a] == m[b]}
    assert pairs([root[s] for s in signed]) == pairs([label[x] for x in fps])


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1100)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(301)}) == 1 and len({got[i] for i in range(1000, 1100)}) == 1 and got[0] != got[1000]


def test_decontamination(spark):
    items = [prose(n) for n in (3, 15, 20, 40, 60)]
    docs = [prose(300) for _ in range(30)]
    for k, it in enumerate(items):
        w = it.split()
        docs += [f"{prose(50)} {it} {prose(50)}", f"{prose(9)}, {it.upper()}! {prose(9)}", " ".join(w[: int(len(w) * (0.75 + 0.03 * k))]), " ".join(w[:2] + ["zz"] + w[3:])]
    word = lambda t: re.findall(r"[^\W_]+", t.lower())
    gram = lambda w, k: {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}
    want = set()
    for j, it in enumerate(items):
        k = min(5, len(word(it)))
        s = gram(word(it), k)
        want |= {(i, j) for i, d in enumerate(docs) if len(s & gram(word(d), k)) >= 0.8 * len(s)}
    got = decontam.contained_items(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) >= 10


def test_sketches_are_minimum_hashes_and_lose_no_match(spark):
    items = [" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate([1, 3, 5, 6, 8, 9, 12, 19, 20, 36, 67, 68, 131, 400])]
    rows = decontam.item_sketches(spark.createDataFrame([(t,) for t in items], "text string"), "text").collect()
    assert len(rows) == len(items)
    for r in rows:
        hashes = sorted(g.h for g in r.grams)
        assert r.n == len(hashes) and r.need == -(-4 * r.n // 5) and r.sketch == hashes[: len(r.sketch)]
        largest = 2 ** r.n.bit_length() - 1
        assert len(r.sketch) == min(r.n, largest - -(-4 * largest // 5) + decontam.SPARE)
        # Whatever n - need shingles a document lacks, it has this many of the sketch.
        assert r.hits == len(r.sketch) - (r.n - r.need) >= min(decontam.SPARE, r.need)


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_sharding(spark, law):
    rows = [(i, prose(RNG.randint(1, 60))) for i in range(900)] + [(1000 + i, "the same hot text") for i in range(500)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 16, law).collect()
    text = dict(rows)
    key = lambda i: (int(hashlib.md5(text[i].encode()).hexdigest()[:9], 16) << 24) | int(hashlib.md5(str(i).encode()).hexdigest()[:6], 16)
    weight = {i: len(text[i].encode()) + 1 if law == "bytes" else 1 for i in text}
    total, below = sum(weight.values()), 0
    want, slots = {}, Counter()
    for i in sorted(text, key=key):
        s = min(15, 16 * below // total)
        want[i] = (s, slots[s])
        slots[s] += 1
        below += weight[i]
    assert {r.doc_id: (r.shard, r.slot) for r in got} == want
    loads = Counter()
    for r in got:
        loads[r.shard] += weight[r.doc_id]
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
    assert max(loads.values()) - min(loads.values()) <= 2 * max(weight.values())


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_sharding_cuts_repeated_rows(spark, law, monkeypatch):
    monkeypatch.setattr(sharding, "BIN_ROWS", 200)
    rows = [(i, prose(RNG.randint(1, 60))) for i in range(1000)] + [(7777, "the same row again and again")] * 4000
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 16, law).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    loads, slots = Counter(), {}
    for r in got:
        loads[r.shard] += r.size if law == "bytes" else 1
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert len(loads) == 16 and max(loads.values()) - min(loads.values()) <= (2 * max(r.size for r in got) if law == "bytes" else 1)


def test_media(spark, tmp_path):
    long = prose(9000)
    texts = planted() + [long, "z" + long, long[3000:], "\0" * 100]
    path = str(tmp_path / "store")
    got = {r.doc_id: r for r in media.media_features(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), path=path).collect()}
    stored = {(len(r.media), hashlib.sha256(r.media).hexdigest()) for r in spark.read.parquet(path).collect()}
    assert {(r.media_bytes, r.media_sha256) for r in got.values()} == stored and len(stored) == len(set(texts))
    for i, t in enumerate(texts):
        p = media.payload(t)
        parts = media.chunks(p)
        assert b"".join(parts) == p and all(len(c) <= media.MOST for c in parts)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(t.encode()), len(p), hashlib.sha256(p).hexdigest())
        assert r.tail_crc32 == zlib.crc32(p[-64:])
    assert sum(r.n_foreign for r in got.values()) > 5  # shared chunks are stored once


def test_gear_hash_is_the_rolling_sum():
    data = bytes(RNG.choices(range(256), k=3000))
    h, ends, start = 0, [], 0
    for i in range(len(data)):
        h = sum(int(media.GEAR[data[i - k]]) << k for k in range(min(32, i + 1))) & 0xFFFFFFFF
        if h & int(media.MASK) == 0 and i + 1 - start >= media.LEAST:
            ends.append(i + 1)
            start = i + 1
    if not ends or ends[-1] != len(data):
        ends.append(len(data))
    assert media.cuts(data) == ends


def test_bpe_long_and_short_trees_agree():
    t = bpe.load(tokenizer_path())
    words = [prose(3).replace(" ", "")[: RNG.randint(2, 60)] for _ in range(60)]
    many = t.encode_words(words)
    for w, ids in zip(words, many, strict=True):
        assert ids.tolist() == t._merge_one(t.base[np.frombuffer(w.encode(), np.uint8)].tolist())


def test_toxicity_held_out(spark):
    bad = ["dolt", "knave", "scoundrel"]
    rows = []
    for i in range(600):
        w = prose(RNG.randint(5, 60)).split()
        y = int(RNG.random() < 0.4)
        if y:
            w.insert(RNG.randrange(len(w) + 1), RNG.choice(bad) + RNG.choice(["", "ish", "s", "!"]))
        rows.append((i, " ".join(w), y))
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_scores(d.select("doc_id", "text"), d.select("doc_id", "toxic")).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert {r[0] for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([got[i].predicted == y for i, _, y in held]) > 0.95


def test_quality_is_ordinal(spark):
    rows = []
    for i in range(600):
        y = RNG.randrange(3)
        w = prose(RNG.randint(20, 80)).split()
        for k in range(len(w)):
            if RNG.random() < (0.8, 0.3, 0.0)[y]:
                w[k] += "###"
        rows.append((i, " ".join(w), y))
    d = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = {r.doc_id: r for r in quality.quality_scores(d.select("doc_id", "text"), d.select("doc_id", "quality"), keep_grade=2).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert np.mean([round(got[i].expected_grade) == y for i, _, y in held]) > 0.9
    assert np.mean([got[i].keep == (y == 2) for i, _, y in held]) > 0.95


def test_html_on_composed_pages():
    rng = np.random.default_rng(3)
    made = [html.composed_page(rng, WORDS) for _ in range(120)]
    made = [x for x in made if x[0]]
    model = html.train(["<article><p>" + prose(30) + "</p></article><footer>" + prose(4) + "</footer>" for _ in range(40)])
    labels = html.Reader(model).labels([b for b, _ in made])
    wrong = sum(int((l != np.array(y)).sum()) for l, (_, y) in zip(labels, made, strict=True))
    assert wrong / sum(len(y) for _, y in made) < 0.05


def test_html_quoted_attributes_are_markup():
    texts = lambda page: [t for _, t, _ in html.blocks(page)]
    assert texts('<p title="a > b">q') == ["q"]
    assert texts('<p data-x="<nav>">hello</p>') == ["hello"]
    assert texts("<p title='x>\"y'>a</p><script type=\"a>b\">no</script><p title=it's>b</p>") == ["a", "b"]
    assert texts('<p class="open>a quote that never closes ends with its tag') == ["a quote that never closes ends with its tag"]
    assert texts("1 < 2 and <b>3</b> > 2<br>") == ["1 < 2 and 3 > 2"]


#: Layouts written by hand; text of the article, in order.
HAND = [
    ("<html><head><title>T</title></head><body><div class='top-nav'><a href='/'>Home</a> <a href='/b'>Blog</a></div><article><h1>Bread at home</h1><p>Flour &amp; water make a dough.</p>"
     "<blockquote>It rises</blockquote></article><section id='comments'><div class='comment'><p>Great recipe, thank you!</p></div></section><footer>Copyright 2020</footer></body></html>", ["Bread at home", "Flour & water make a dough.", "It rises"]),
    ("<body><header><p>The Daily</p></header><main><h2>Harbour opens</h2><p>The harbour was opened on Monday by the mayor.<p>Boats came from all sides.</main><aside><p>Most read this week</p></aside>"
     "<form><label>Mail</label><button>Join</button></form></body>", ["Harbour opens", "The harbour was opened on Monday by the mayor.", "Boats came from all sides."]),
    ("<body><ul class='menu'><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul><div id='content'><h1>On moss</h1><p>Moss grows in the shade.</p><div class='advert'>Buy boots now</div>"
     "<p>It needs little light.</p></div><div class='cookie-notice'>We use cookies</div></body>", ["On moss", "Moss grows in the shade.", "It needs little light."]),
]


def test_html_on_pages_written_by_hand(spark):
    rows = [(i, "u", h) for i, (h, _) in enumerate(HAND)]
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(len(HAND))] == [" ".join(t) for _, t in HAND]


def test_html_blocks():
    page = "<title>t</title><nav><li><a href=x>m</a></nav><article><p>a\n <b>b</b>c<p>d&nbsp;&amp;</article><script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no -->tail"
    assert [t for _, t, _ in html.blocks(page)] == ["t", "m", "a bc", "d &", "tail"]


def test_quality_reads_unspaced_texts_to_the_end():
    rng = random.Random(8)
    head = "\u4e00" * 60
    good, bad = ("".join(chr(a + rng.randrange(300)) for _ in range(60)) for a in (0x5000, 0x6000))
    model = quality.fit([head + good, head + bad] * 20, [1, 0] * 20)
    _, grades, _ = quality.Scorer(model).rows([head + good, head + bad], 1)
    assert grades[0] > 0.9 and grades[1] < 0.1
