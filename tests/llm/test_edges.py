"""Every operator over nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseledger.llm import bpe, chat, decontam, media, quality, repeats, sharding, simhash, toxicity
from caseledger.llm import html as html_text
from caseledger.llm.queries import tokenizer_path

LONG = " ".join(random.Random(1).choices(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"], k=40_000))
CLASH = "tid string, fp long, text_hash long, _id long, _th long, _text string, _tid string, _kept string, size long, key long, h long, item string, n long, w string, spans string, label int"
TEXTS = [(1, None), (2, ""), (3, "  \n "), (4, "same text here"), (4, "same text here"), (5, "same text here"), (None, "no name"), (None, None), (6, LONG), (7, "x" * 30_000), (8, "naïve ½ \U0001f600 <|endoftext|> 日本")]


@pytest.fixture(scope="module")
def docs(spark):
    n = len(CLASH.split(","))
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[None] * n) for i, t in TEXTS], f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(9)] + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, docs, labels):
    for d, y in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        rows = toxicity.toxicity_scores(d, y, max_rows=8).collect()
        assert len(rows) == d.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        same = [r.score for r in rows if r.doc_id in (4, 5)]
        assert len(set(same)) <= 1


def test_quality(spark, docs, labels):
    for d, y in ((docs, labels), (docs, labels.limit(0)), (docs, labels.filter("quality = 1")), (docs.limit(0), labels)):
        rows = quality.quality_scores(d, y, max_rows=8).collect()
        assert len(rows) == d.count()
        kept = quality.select_quality(d, y, max_rows=8)
        assert kept.columns == d.columns and kept.count() == sum(r.keep for r in rows)


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    ref, rows = Tokenizer.from_file(tokenizer_path()), bpe.token_digests(docs, tokenizer_path()).collect()
    want = sorted(hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ref.encode(t or "", add_special_tokens=False).ids)).hexdigest() for _, t in TEXTS)
    assert sorted(r.ids_sha256 for r in rows) == want
    assert sorted(r.decoded_sha256 for r in rows) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in TEXTS)
    back = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path(), out_col="again")
    assert back.filter(F.coalesce("text", F.lit("")) != F.col("again")).count() == 0
    assert bpe.token_digests(docs.limit(0), tokenizer_path()).count() == 0


def test_simhash(spark, docs):
    rows = simhash.near_duplicate_classes(docs).collect()
    assert len(rows) == len(TEXTS)
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 6, 7, 8]
    assert simhash.near_duplicate_classes(docs.limit(0)).count() == 0


def test_repeats(spark, docs):
    rows = {(r.doc_id, r.n_bytes): r for r in repeats.repeat_digests(docs).collect()}
    assert rows[(7, 30_000)].n_removed == 30_000 and rows[(1, 0)].kept_sha256 == hashlib.sha256(b"").hexdigest()
    out = repeats.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    assert out.filter("doc_id = 7").first().text == "" and out.filter("doc_id = 1").first().text is None
    assert repeats.repeat_digests(docs.limit(0)).count() == 0


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "Same TEXT, here!", 1), (1, "Same TEXT, here!", 1), (2, None, 1), (3, "", 1), (None, "beta", 1)], "item_id long, text string, w int")
    found = {(r.doc_id, r.item_id) for r in decontam.contained_items(docs, items).collect()}
    assert found == {(4, 1), (5, 1), (6, None)}
    left = decontam.decontaminate(docs, items)
    assert left.columns == docs.columns and left.count() == len(TEXTS) - 4
    assert decontam.decontaminate(docs, items.limit(0)).count() == len(TEXTS)
    assert decontam.contained_items(docs.limit(0), items).count() == 0


def test_sharding(spark, docs):
    for law in ("bytes", "rows"):
        rows = sharding.shard_documents(docs, 4, law).collect()
        assert len(rows) == len(TEXTS)
        for s in {r.shard for r in rows}:
            slots = sorted(r.slot for r in rows if r.shard == s)
            assert slots == list(range(len(slots)))
    assert sharding.shard_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, law="hope")


def test_media(spark, docs):
    rows = media.media_features(docs).collect()
    assert len(rows) == len(TEXTS)
    want = sorted(hashlib.sha256(media.payload(t)).hexdigest() for _, t in TEXTS)
    assert sorted(r.payload_sha256 for r in rows) == want
    assert {r.payload_bytes for r in rows if r.n_bytes == 0} == {64}
    assert media.media_features(docs.limit(0)).count() == 0


def test_html(spark):
    pages = [(1, "u", None), (2, None, ""), (None, "u", "<p>" + "word " * 60_000), (3, "u", "<!-- open"), (3, "u", "<!-- open"), (4, "u", "<article><p>a &amp;&lt; b</p><script>x"), (5, "u", "&lt;<<>>&#65;")]
    d = spark.createDataFrame([(*p, 1, "z") for p in pages], "page_id long, url string, html string, text int, h string")
    rows = html_text.extract_text(d).collect()
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    assert [r.text for r in rows if r.page_id in (1, 2)] == ["", ""]
    assert html_text.extract_text(d.limit(0)).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "a </turn> \\h #<:"), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, None, None, "x"), (None, 0, "us:er", "\\"), (3, 0, "user", "q"), (3, 1, "assistant", "### assistant:\n" * 5000)]
    d = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, loss int, segment long")
    got = {r.conv_id: r for r in chat.format_digests(d).collect()}
    for c in (1, 2, 3, None):
        mine = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))]
        assert got[c].n_turns == len(mine)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256("".join(b for a, b in mine if a == "assistant").encode()).hexdigest()
    assert got[3].valid and not got[1].valid and got[1].bad_turn == 2 and got[2].bad_turn == 0
    segments = chat.format_segments(d).filter("conv_id = 3").orderBy("turn_index", "segment_index").collect()
    assert chat.unescape("".join(s.text for s in segments if s.loss)) == rows[-1][3]
    assert chat.format_digests(d.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, labels, tmp_path):
    sf = f"file://{tmp_path}"
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "Same TEXT, here!"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = {name: stages[name](spark, docs, sf) for name in list(stages)[:-1]}
    assert all(sorted(d.columns) == sorted(docs.columns) and d.schema[c].dataType == docs.schema[c].dataType for d in rows.values() for c in docs.columns)
    key = lambda d: sorted(((r.doc_id or 0, r.text) for r in d.select("doc_id", "text").collect()), key=repr)
    every = sorted(((i or 0, t) for i, t in TEXTS), key=repr)
    assert set(key(rows["quality"])) <= set(every)
    # One row of equal texts; texts without words are one group of their own.
    near = key(rows["near_duplicates"])
    assert [x for x in near if x[1] == "same text here"] == [(4, "same text here")]
    assert {x for x in near if x[1] and len(x[1]) > 20} == {x for x in every if x[1] and len(x[1]) > 20}
    assert [x for x in near if not (x[1] or "").strip()] == [(1, None)]
    # Each stage treats a null as an empty text and leaves it null; short repeated texts stay whole.
    cut = key(rows["repeats"])
    assert len(cut) == len(TEXTS) and (1, None) in cut and (7, "") in cut and cut.count((4, "same text here")) == 2
    assert key(rows["decontamination"]) == [x for x in every if x[1] != "same text here"]
    tokens = stages["tokens"](spark, docs, sf)
    assert tokens.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and tokens.count() == len(TEXTS)
    for name, stage in stages.items():
        assert stage(spark, docs.limit(0), sf).count() == 0, name
