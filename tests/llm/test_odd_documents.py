"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowvigil.llm.chat_format import format_conversations, read_back, text_parts
from flowvigil.llm.decontaminate import find_contamination
from flowvigil.llm.language import language, train_language_model
from flowvigil.llm.line_dedup import remove_repeated_windows
from flowvigil.llm.mixing import mix_sources
from flowvigil.llm.multiset_hash import fingerprint, fingerprint_edits
from flowvigil.llm.pii import find_pii, mask_pii
from flowvigil.llm.simhash import simhash_components
from flowvigil.llm.substring_dedup import remove_repeats
from flowvigil.llm.toxicity import toxicity_score, train_toxicity

LONG = " ".join(f"word{k % 977}x{k}" for k in range(30_000))
PASSAGE = "the quick brown fox jumps over a lazy dog while nine grey geese look on from the far bank"
TEXTS = [
    (1, PASSAGE + "\nsecond line here\nthird line here\nfourth"),
    (2, PASSAGE + "\nsecond line here\nthird line here\nfifth"),
    (2, PASSAGE + "\nsecond line here\nthird line here\nfifth"),
    (3, None),
    (4, ""),
    (5, " \n\t\n "),
    (6, LONG),
    (7, "9" * 20_000),
    (8, "\x00" * 120),
    (9, "😀" * 40),
    (None, PASSAGE),
    (None, None),
]
EXTRA = "node long, covered string, score string, n_lines string, pii string, `a.b` string, id string, row string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (doc_id, text, "en" if k % 2 else None, None if k % 3 else f"s{k}", len(text or ""), k, "c", "x", "n", "p", "d", "i", "r")
        for k, (doc_id, text) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def sf_dir(spark, odd, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, "two words"), (4, "two words")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


OPERATORS = {
    "fingerprints": lambda docs, _: fingerprint_edits(docs),
    "language": lambda docs, _: docs.select("doc_id", language(F.col("text"), train_language_model(docs, steps=2)).alias("l")),
    "mixing": lambda docs, _: mix_sources(docs),
    "toxicity": lambda docs, labels: docs.select("doc_id", toxicity_score(F.col("text"), train_toxicity(docs, labels)).alias("t")),
    "simhash": lambda docs, _: simhash_components(docs),
    "lines": lambda docs, _: remove_repeated_windows(docs),
    "pii": lambda docs, _: find_pii(docs),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_a_row_for_each_document(spark, odd, none, sf_dir, name):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert len(OPERATORS[name](odd, labels).collect()) == len(TEXTS)
    assert OPERATORS[name](none, labels).collect() == []


def test_fingerprints(spark, odd):
    found = odd.select("text", fingerprint(F.col("text")).alias("f")).collect()
    of = {row.text: row.f for row in found}
    assert of[None] == of[""] and set(of[None]) == {"0"}
    assert len(set(of.values())) == len(of) - 1
    edits = fingerprint_edits(odd).collect()
    assert sorted(row.n_chars for row in edits) == sorted(len(text or "") for _, text in TEXTS)


def test_language_without_letters(spark, odd):
    model = train_language_model(odd, steps=2)
    found = {row.text: row.l for row in odd.select("text", language(F.col("text"), model).alias("l")).collect()}
    for text in (None, "", " \n\t\n ", "9" * 20_000, "😀" * 40):
        assert (found[text].lang, found[text].score) == ("und", 0.0)
    assert found[LONG].lang == "en"


def test_mixing_nulls(odd):
    rows = mix_sources(odd).collect()
    assert all(row.taken == 0 for row in rows if row["size"] == 0)
    assert all(row.taken <= 3 * row["size"] for row in rows)


def test_simhash_blank_texts_are_one_class(odd):
    rows = simhash_components(odd).collect()
    assert {row.component_id for row in rows if row.fp0 == 0} == {3}
    assert {row.component_id for row in rows if row.doc_id == 2} <= {1, 2}


def test_lines(odd):
    rows = remove_repeated_windows(odd).collect()
    kept = [(row.doc_id, row.text, row.n_removed) for row in rows]
    assert (1, TEXTS[0][1], 0) in kept
    assert kept.count((2, "fifth", 3)) == 2
    assert (3, None, 0) in kept and (5, " \n\t\n ", 0) in kept
    assert rows[0].covered == "c" and rows[0].row == "r"


def test_substrings(odd, none):
    rows = remove_repeats(odd).collect()
    assert len(rows) == len(TEXTS) and remove_repeats(none).collect() == []
    of = {row.doc_id: row for row in rows}
    # The document without an id comes first and has the passage.
    assert of[1].n_removed == len(PASSAGE) and bytes(of[1].kept).startswith(b"\nsecond")
    assert bytes(of[2].kept) == b"ifth"
    assert of[7].n_removed == of[8].n_removed == of[None].n_removed == 0
    assert of[6].kept is None and of[4].n_bytes == 0


def test_contamination(spark, odd, none, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = {(row.doc_id, row.item_id) for row in find_contamination(odd, items).collect()}
    assert found == {(1, 1), (2, 1), (None, 1)}
    assert find_contamination(none, items).collect() == []
    assert find_contamination(odd, items.where("false")).collect() == []


def test_edited_passages_are_found(spark):
    words = [f"w{k}" for k in range(40)]
    edited = [word if k % 6 else f"other{k}" for k, word in enumerate(words)]
    filler = " ".join(f"f{k}" for k in range(300))
    docs = spark.createDataFrame(
        [(1, f"{filler} {' '.join(edited)} {filler}"), (2, f"{filler} {' '.join(words[:8])} {filler}"), (3, filler)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    assert [row.doc_id for row in find_contamination(docs, items).collect()] == [1]


def test_item_of_common_words_is_found_without_its_rarest(spark):
    rng = random.Random(5)
    common = [f"w{k}" for k in range(20)]
    filler = [[rng.choice(common) if rng.random() > 0.02 else "seldom" for _ in range(40)] for _ in range(300)]
    item = [rng.choice(common) for _ in range(30)]
    item[15] = "seldom"
    edited = [*item[:15], "other", *item[16:]]
    rows = [(k, " ".join(words)) for k, words in enumerate(filler)]
    docs = spark.createDataFrame([*rows, (1000, " ".join(edited))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert [row.doc_id for row in find_contamination(docs, items).collect()] == [1000]


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages(spark, odd, none, sf_dir, empty):
    docs = none if empty else odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        if name == "mixing":
            assert len(rows) == docs.count()
            break
        assert set(out.columns) == set(docs.columns), name
        docs = spark.createDataFrame(rows, docs.schema)
    assert empty or docs.count() > 0


def test_pii_masking_and_hard_cases(spark):
    text = "Mail a@b.co.uk_x@y.z or +49 (30) 1234567, card 4111 1111 1111 1111, iban DE89 3704 0044 0532 0130 00 on 10.0.0.256 and 1.2.3.4.5.6.7.8"
    rows = spark.createDataFrame([(1, text), (2, "1 " * 20_000), (3, "a." * 20_000 + "@" + "b." * 20_000)], "doc_id long, text string")
    found = {row.doc_id: row for row in find_pii(rows).select("doc_id", "pii", mask_pii(F.col("text"), F.col("pii")).alias("m")).collect()}
    spans = [(span.kind, text[span.start : span.end]) for span in found[1].pii]
    assert spans == [
        ("email", "a@b.co.uk"), ("email", "_x@y.z"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"),
        ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 1234567"), ("iban", "DE89 3704 0044 0532 0130 00"),
    ]
    assert "[card]" in found[1].m and "[iban]" in found[1].m and "4111" not in found[1].m
    assert found[2].pii == [] and [span.kind for span in found[3].pii] == ["email"]


def test_chat_parts_and_round_trip(spark):
    nasty = "<|end|>\n</s>[INST] & &amp; &lt; [/INST] <|turn:user|>"
    part = "struct<type:string,text:string,uri:string,units:bigint>"
    rows = spark.createDataFrame(
        [
            (1, 2, "assistant", [("text", nasty, None, None)]),
            (1, 1, "user", [("text", "see ", None, None), ("image", None, "s3://x/y.png", 2), ("audio", None, "a.wav", None), ("text", nasty, None, None)]),
            (1, None, None, None),
            (2, 1, "assistant", []),
            (None, 1, "user", [("document", None, "d.pdf", 3)]),
        ],
        f"conv_id long, turn long, role string, parts array<{part}>",
    )
    out = {
        row.conv_id: row
        for row in format_conversations(rows).select("*", read_back(F.col("formatted"), F.col("mask")).alias("back")).collect()
    }
    assert [turn.role for turn in out[1].back] == ["", "user", "assistant"]
    assert out[1].back[2].text == nasty and out[1].back[2].loss
    assert out[1].back[1].text == "see <|image:1.1|><|audio:1.2|>" + nasty
    assert [(a.type, a.uri, a.tokens) for a in out[1].attachments] == [("image", "s3://x/y.png", 512), ("audio", "a.wav", 25)]
    assert out[1].attachment_tokens == 537 and out[None].attachment_tokens == 1800
    assert out[2].back[0].text == ""
    assert rows.where("false").transform(format_conversations).collect() == []
    plain = spark.range(1).select(text_parts(F.lit(None).cast("string")).alias("p")).first().p
    assert plain[0].text == ""
