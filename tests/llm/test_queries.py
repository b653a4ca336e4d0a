"""The registered queries against SQL or brute force on the smallest tables."""

import re
import time

import brute
import pytest
from compare import differences, duck
from llm_tables import DATA, documents, prose  # noqa: F401

from riskfeat.llm import line_dedup
from riskfeat.llm.queries import ORACLE, REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(REGISTRY[name](spark, DATA), con, ORACLE[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTRY) == list(range(1, 14))


def rows_by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality(spark, prose):
    got = rows_by_id(REGISTRY["op1_quality_rules"](spark, DATA))
    assert {i: tuple(r)[1:7] for i, r in got.items()} == {i: brute.base_measures(t) for i, t in prose}
    assert all(not (r["kept"] and r["base_failed"]) for r in got.values())


def test_near_duplicates(spark, prose):
    got = rows_by_id(REGISTRY["op10_minhash_dedup"](spark, DATA))
    want = brute.near_duplicates(prose, 3, 85)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_lines(spark, prose):
    got = REGISTRY["op2_line_dedup"](spark, DATA).collect()
    assert {(r["doc_id"], r["line_no"]) for r in got} == brute.lines_that_go(prose)
    assert len(got) == len({(r["doc_id"], r["line_no"]) for r in got})
    assert all((r["like_doc"], r["like_line"]) < (r["doc_id"], r["line_no"]) for r in got)


@pytest.mark.parametrize("longest", [1, 3])
def test_lines_in_long_lists(spark, prose, monkeypatch, longest):
    monkeypatch.setattr(line_dedup, "LONG_LIST", longest)
    variants = [(10_000 + i, "\n".join(f"alpha beta gamma delta epsilon zeta eta theta iota w{j}" for j in range(i, i + 2))) for i in range(30)]
    docs = prose[:300] + variants
    got = line_dedup.duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["line_no"]) for r in got} == brute.lines_that_go(docs)


@pytest.mark.parametrize("longest", [3, 256])
def test_lines_in_passes_and_rounds(spark, prose, monkeypatch, longest):
    for name, value in (("LONG_LIST", longest), ("PASS_ENTRIES", 100), ("MOST_PASSES", 2), ("SOME_OTHERS", 1)):
        monkeypatch.setattr(line_dedup, name, value)
    dealt, in_pass = set(), line_dedup._in_pass
    monkeypatch.setattr(line_dedup, "_in_pass", lambda entries, i, passes: dealt.add((i, passes)) or in_pass(entries, i, passes))
    variants = [(10_000 + i, "\n".join(f"alpha beta gamma delta epsilon zeta eta theta iota w{j}" for j in range(i, i + 2))) for i in range(12)]
    docs = prose[:100] + variants
    got = line_dedup.duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["line_no"]) for r in got} == brute.lines_that_go(docs)
    assert dealt == {(0, 2), (1, 2)}


def test_lines_leave_no_shuffle_files(spark, prose):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: set(re.findall(r"shuffle_(\d+)_", disk.getAllBlocks().mkString(" ")))
    before = shuffles()
    line_dedup.duplicate_lines(spark.createDataFrame(prose[:100], "doc_id long, text string"))
    until = time.time() + 20
    while not shuffles() <= before and time.time() < until:
        time.sleep(0.2)
    assert shuffles() <= before


def test_lines_with_one_rare_word_in_common_are_no_candidates(spark, monkeypatch):
    asked, similar = [], line_dedup._similar
    monkeypatch.setattr(line_dedup, "_similar", lambda docs, pairs, percent: asked.append(pairs.count()) or similar(docs, pairs, percent))
    own = [" ".join(["shared", *(f"w{i}x{j}" for j in range(200))]) for i in range(20)]
    # 20 words differ: still similar
    near = own[3].replace("w3x1", "v3x1", 20)
    # the other words are more frequent, so the shared one is the first of each line
    often = " ".join(own).replace("shared ", "")
    docs = list(enumerate([*own, near, " ".join([often] * 50)]))
    got = line_dedup.duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["line_no"]) for r in got} == brute.lines_that_go(docs) == {(20, 0)}
    assert sum(asked) == 1


@pytest.mark.parametrize("percent", [20, 50, 95])
def test_lines_with_few_words_and_other_white_space(spark, percent):
    lines = ["a", "a b", " a  b c", "A\tb\x0bc d", "b\x0cd\r", "", " \t", "a b c d e", "e  d c b", "f", "x y z f", "F\x0b"]
    docs = [(i, "\n".join(lines[i:] + lines[:i][::2])) for i in range(len(lines))]
    got = line_dedup.duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string"), percent).collect()
    assert {(r["doc_id"], r["line_no"]) for r in got} == brute.lines_that_go(docs, percent)


def test_language_scores(spark, prose):
    got = rows_by_id(REGISTRY["op6_hmm_scores"](spark, DATA))
    want = brute.base_scores(prose)
    assert {i: tuple(r)[1:5] for i, r in got.items()} == {i: w[:4] for i, w in want.items()}
    assert all(abs(got[i]["base_score"] - w[4]) < 1e-6 * abs(w[4]) for i, w in want.items())
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_identifiers(spark, prose):
    got = rows_by_id(REGISTRY["op7_pii_spans"](spark, DATA))
    for i, t in prose:
        want = brute.plain_identifiers(t)
        assert got[i]["spans"].split(",") == (want or [""]) or got[i]["n_disguised"]
        for kind in brute.PATTERNS:
            assert got[i][f"n_{kind}"] == sum(s.startswith(kind) for s in want)


def test_token_counts(spark, prose):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = rows_by_id(REGISTRY["op5_token_counts"](spark, DATA))
    for (i, t), e in zip(prose, library.encode_batch([t or "" for _, t in prose], add_special_tokens=False)):
        n = len(e.ids)
        assert tuple(got[i])[1:] == (len((t or "").encode()), n, n > 2048)


def test_token_files(spark, prose):
    import struct
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = rows_by_id(REGISTRY["op8_token_files"](spark, DATA))
    start = 0
    for i, t in sorted(prose):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(packed))
        start += len(ids)


def test_decontamination_finds_whole_passages(spark, prose):
    found = {(r["doc_id"], r["item_id"]) for r in REGISTRY["op3_decontaminate"](spark, DATA).collect()}
    items = [(r["item_id"], brute.low_words(r["text"])) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    texts = {i: " " + " ".join(brute.low_words(t)) + " " for i, t in prose}
    whole = {(i, k) for k, w in items for i, t in texts.items() if " " + " ".join(w) + " " in t}
    assert whole <= found
    windows = {(k, " ".join(w[a : a + 10])) for k, w in items for a in range(len(w) - 9)}
    stripped = {i: " ".join(x.strip(".,") for x in t.split()) for i, t in texts.items()}
    for i, k in found - whole:
        assert any(" ".join(x.strip(".,") for x in w.split()) in stripped[i] for item, w in windows if item == k)
