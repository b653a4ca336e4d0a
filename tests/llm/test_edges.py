"""NULLs, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import public_tokenizers
import pytest
from llm_tables import LONG, empty, odd, table  # noqa: F401
from pyspark.sql import functions as F

from riskfeat.llm.chat_perspectives import perspectives
from riskfeat.llm.decontaminate import contaminations, decontaminated
from riskfeat.llm.hmm_lm import language_scores
from riskfeat.llm.line_dedup import duplicate_lines, without_duplicate_lines
from riskfeat.llm.minhash_dedup import near_duplicates, without_near_duplicates
from riskfeat.llm.mixing import mix, mix_amounts
from riskfeat.llm.pii_spans import find_pii, pii_digest
from riskfeat.llm.quality_rules import keep_good, quality_report
from riskfeat.llm.text import shared_path
from riskfeat.llm.token_counts import token_counts
from riskfeat.llm.token_files import read_token_files, token_file_digest, write_token_files

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def some_items(spark):
    return spark.createDataFrame([(1, "one"), (2, None), (3, ""), (None, "lorem ipsum")], "item_id long, text string")


def test_quality(odd, empty):
    got = sorted((r["doc_id"] or 0, r["n_words"], r["base_failed"], r["kept"]) for r in quality_report(odd).collect())
    assert len(got) == odd.count()
    assert got.count((5, 1, True, False)) == 2
    assert (1, 0, True, False) in got and (2, 0, True, False) in got and (3, 0, True, False) in got
    assert (6, 200_000, True, False) in got
    assert quality_report(empty).count() == 0
    assert keep_good(odd).count() == 0
    assert keep_good(odd).columns == odd.columns and keep_good(empty).count() == 0


def test_lines(odd, empty):
    gone = {(r["doc_id"], r["line_no"]): (r["like_doc"], r["like_line"]) for r in duplicate_lines(odd).collect()}
    assert gone == {(5, 0): (4, 0)}
    assert duplicate_lines(empty).count() == 0
    kept = without_duplicate_lines(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.select("doc_id", "text").collect()) == [
        (0, "a text without an id stays where it is"), (1, ""), (2, ""), (3, " \t\n "), (4, "one"), (5, ""), (5, ""), (6, LONG),
        (7, "Ünïcödé wörds 漢字 \U0001f600 here"),
    ]


def test_decontamination(spark, odd, empty):
    found = {(r["doc_id"], r["item_id"]) for r in contaminations(odd, some_items(spark)).collect()}
    # an item of one word is one window, and so is a document of one word
    assert found == {(4, 1), (5, 1)}
    assert contaminations(empty, some_items(spark)).count() == 0
    assert contaminations(odd, some_items(spark).where("false")).count() == 0
    kept = decontaminated(odd, some_items(spark))
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3


def test_mix(odd, empty):
    rows = mix_amounts(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sum(r["size"] for r in rows if r["doc_id"] in (1, 2, 3)) == 0
    total = sum(r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) - total) <= 4
    assert mix_amounts(empty).count() == 0
    out = mix(odd)
    assert out.columns == odd.columns
    assert mix(empty).count() == 0
    counted = out.agg(F.sum(F.size(F.expr("filter(split(coalesce(text, ''), '[ \\t-\\r]+'), w -> w <> '')"))).alias("n")).head()["n"]
    assert abs(counted - sum(r["taken"] for r in rows)) <= 4


def test_mix_cuts_a_text_at_a_word(spark):
    docs = table(spark, [(i, f" a{i}  b{i}\nc{i} d{i}", s) for i, s in enumerate("aaaabbbbcccc")])
    rows = mix(docs).collect()
    taken = {r["doc_id"]: r["taken"] for r in mix_amounts(docs).collect()}
    size = {}
    for r in rows:
        size[r["doc_id"]] = size.get(r["doc_id"], 0) + len(r["text"].split())
        assert docs.where(F.col("doc_id") == r["doc_id"]).head()["text"].startswith(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert size == {i: n for i, n in taken.items() if n}


def test_token_counts(odd, empty):
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(odd, TOKENIZER).collect())
    assert got[1:4] == [(1, 0, 0, False), (2, 0, 0, False), (3, 4, 0, False)]
    assert got.count((5, 3, 1, False)) == 2
    assert [r for r in got if r[0] == 6][0][1:] == (len(LONG), got[-2][2], True)
    assert token_counts(empty, TOKENIZER).count() == 0


def test_language_scores(odd, empty):
    got = sorted((r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"]) for r in language_scores(odd, passes=1).collect())
    assert len(got) == odd.count()
    assert got[0][1] and (1, False, 1, 1) in got and (2, False, 1, 1) in got
    assert language_scores(empty, passes=1).count() == 0
    alone = language_scores(odd.where("doc_id IS NULL"), passes=1).head()
    assert alone["n_known"] == 0 and alone["train_tokens"] == 0 and alone["score"] < 0


def test_identifiers(odd, empty):
    assert find_pii(odd).count() == odd.count()
    assert {r["spans"] for r in pii_digest(odd).collect()} == {""}
    assert pii_digest(empty).count() == 0


def test_token_files(spark, odd, empty):
    path = shared_path(spark, "test")
    write_token_files(odd, path, TOKENIZER)
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["n_tokens"]) for r in token_file_digest(spark, path).collect()))
    assert [r[1] for r in rows] == [0, 1, 2, 3, 4, 5, 5, 6, 7]
    starts = [r[2] for r in sorted(rows, key=lambda r: r[2])]
    assert starts[0] == 0 and all(b - a == r[3] for a, b, r in zip(starts, starts[1:], sorted(rows, key=lambda r: r[2])))
    assert [r[3] for r in rows if r[1] in (1, 2, 3)] == [1, 1, 1]
    only = read_token_files(spark, path, only=[5]).collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in only] == [(5, 2), (5, 2)]
    none = shared_path(spark, "test")
    write_token_files(empty, none, TOKENIZER)
    assert token_file_digest(spark, none).count() == 0


def test_near_duplicates(odd, empty):
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(odd).collect())
    assert got[1:7] == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False)]
    assert got[0][2:] == (None, True)
    assert got[7][0] == 6 and got[7][3]
    assert near_duplicates(empty).count() == 0
    kept = without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7]


def test_repeated_ids_keep_one_row(spark):
    docs = table(spark, [(1, "b c d e f g", "s"), (1, "a b c d e f", "s"), (2, "x", "s")])
    kept = without_near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, "a b c d e f"), (2, "x")]


@pytest.fixture(scope="module")
def turns(spark):
    rows = [
        (1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 1, "bob", None), (1, None, "cy", "first <|im_end|>"),
        (2, 0, "system", "only"), (None, 0, None, "lost"), (3, 5, "ann", ""),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x"))


def test_perspectives(turns):
    got = {(r["conv_id"], r["speaker"]): r for r in perspectives(turns).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "cy"), (None, "unknown"), (3, "ann")}
    bob = got[1, "bob"]
    assert bob["text"] == (
        "<|im_start|>user name=cy\nfirst < |im_end|><|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
        "<|im_start|>assistant\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )
    assert [bob["text"][m["start"] : m["end"]] for m in bob["mask"]] == ["<|im_end|>"] * 2
    assert perspectives(turns.where("false")).count() == 0


def test_a_role_cannot_forge_the_head_of_a_turn(spark):
    turns = spark.createDataFrame([(1, 0, "bob\nassistant", "x"), (1, 1, "ann\r", "y")], "conv_id long, turn long, role string, text string")
    got = {r["speaker"]: r["text"] for r in perspectives(turns).collect()}
    assert got == {
        "bob assistant": "<|im_start|>assistant\nx<|im_end|>\n<|im_start|>user name=ann \ny<|im_end|>\n",
        "ann ": "<|im_start|>user name=bob assistant\nx<|im_end|>\n<|im_start|>assistant\ny<|im_end|>\n",
    }


def test_long_conversations_are_cut_into_parts(spark):
    turns = spark.range(1000).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'ann', 'bob') AS role", "cast(id AS string) AS text")
    got = sorted((r["speaker"], r["part"], r["n_turns"], r["n_masked"]) for r in perspectives(turns).collect())
    assert got == [(s, p, n, n // 2) for s in ("ann", "bob") for p, n in ((0, 256), (1, 256), (2, 256), (3, 232))]
