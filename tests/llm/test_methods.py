"""What each method promises beyond the digest of its query."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from llm_tables import documents, table  # noqa: F401
from pyspark.sql import functions as F

from riskfeat.llm import hmm_lm, minhash_dedup, pii_spans, quality_rules, token_counts, token_files
from riskfeat.llm.decontaminate import contaminations, decontaminated
from riskfeat.llm.text import shared_path


def test_cascade_asks_the_best_rule_first_and_keeps_the_verdict(spark, documents):
    found = quality_rules.estimate(documents, quality_rules.RULES, share=1.0)
    assert [e.worth for e in found] == sorted((e.worth for e in found), reverse=True)
    assert {e.rule.name for e in found} == {r.name for r in quality_rules.RULES}
    orders = [list(quality_rules.RULES), list(reversed(quality_rules.RULES))]
    kept = [{r["doc_id"] for r in documents.where(quality_rules.cascade(F.col("text"), o)).select("doc_id").collect()} for o in orders]
    assert kept[0] == kept[1]


def test_labelled_junk_goes_and_good_text_stays(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = quality_rules.quality_report(documents).join(labels, "doc_id").where("NOT base_failed").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    assert not any(r["kept"] for r in rows if r["quality"] == 0)


def prose_of(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_near_duplicates_of_a_large_group(spark):
    """Hundreds of edited copies of one text: every component as by brute force."""
    rng = random.Random(3)
    base = prose_of(rng, 120)
    docs = []
    for i in range(250):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(prose_of(rng, 60))) for i in range(50)]
    got = minhash_dedup.near_duplicates(table(spark, [(i, t, "s") for i, t in docs]), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near_duplicates(docs, 3, 85)


def test_classes_outside_a_large_component_meet_all(spark, monkeypatch):
    """Groups that share bands but are not similar enough, and stragglers, in small blocks."""
    rng = random.Random(11)
    base = prose_of(rng, 150)
    docs = []
    for i in range(160):
        w = list(base)
        # copies of the first half fall into the others' buckets now and then
        if i % 4 == 0:
            w[100:] = prose_of(rng, 50)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", 10_000)
    monkeypatch.setattr(minhash_dedup, "SMALL", 2)
    got = minhash_dedup.near_duplicates(table(spark, [(i, t, "s") for i, t in docs]), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near_duplicates(docs, 3, 85)


def test_only_outsiders_meet_everyone(spark):
    """One class outside a component of 300 is dealt with the component once, not the component with itself."""
    rng = random.Random(5)
    texts = [" ".join(prose_of(rng, 60)) for _ in range(301)]
    rows = minhash_dedup.band_rows(0.85)
    found = minhash_dedup.sketches(table(spark, [(i, t, "s") for i, t in enumerate(texts)]), 3)
    classes = found.selectExpr("doc_id AS node", "signature").cache()
    bucket = minhash_dedup.banded(classes.where("node = 300"), rows).head()["bucket"]
    large = classes.selectExpr(f"{bucket}L AS bucket", "node", "if(node = 300, 300L, 0L) AS label")
    sets = minhash_dedup.shingle_sets(spark.createDataFrame(list(enumerate(texts)), "node long, text string"), 3)
    blocks = minhash_dedup.dealt_blocks(large, classes, sets)
    assert sorted((r["i"], r["j"], r["count"]) for r in blocks.groupBy("i", "j").count().collect()) == [(0, 0, 1), (0, 1, 301)]


def test_sequential_test_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    steps = minhash_dedup.least_matches(0.85)
    assert [n for n, _ in steps] == [32, 64, 96, 128]
    hits = rng.random((20_000, 128)) < 0.85
    alive = np.ones(len(hits), dtype=bool)
    for n, least in steps:
        alive &= hits[:, :n].sum(axis=1) >= least
    assert alive.mean() > 0.999
    assert (1 - 0.85 ** minhash_dedup.band_rows(0.85)) ** (128 // minhash_dedup.band_rows(0.85)) <= 1e-6


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    one = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
    two = np.concatenate([one[:800], rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    same = (minhash_dedup.signature(one) == minhash_dedup.signature(two)).mean()
    assert abs(same - 0.8) < 0.12


ITEM = "If Maria buys 12 apples for 3 dollars each and 12 pears for 5 dollars then how much does Maria pay in total today"


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (ITEM, True),
        ("So they ask. " + ITEM.lower().replace("maria", "Maria") + " and go on", True),
        # other numbers and another name, used consistently
        (ITEM.replace("Maria", "Peter").replace("12", "40").replace("3", "7").replace("5", "9"), True),
        # equal slots of the item with different values
        (ITEM.replace("12 pears", "13 pears"), False),
        # different slots of the item with one value
        (ITEM.replace("12", "3"), False),
        (" ".join(ITEM.split()[:9]), False),
        ("nothing of the kind is written in this document at all", False),
    ],
)
def test_templates(spark, text, found):
    items = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    got = contaminations(table(spark, [(1, text, "s")]), items, width=12).collect()
    assert [r["item_id"] for r in got] == [9] * found


def items_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


@pytest.mark.parametrize(
    ("text", "n_windows", "n_changed"),
    [
        (ITEM, 15, 0),
        # one mistyped number: windows 4 to 10 hold it and are consistent in themselves
        (ITEM.replace("12 pears", "13 pears"), 12, 1),
        # two slots that differ in the item have one value
        (ITEM.replace("5", "3"), 12, 1),
        # no window of its own is consistent
        (" ".join(ITEM.replace("12 pears", "13 pears").split()[1:13]), 0, 0),
    ],
)
def test_a_consistent_window_counts_by_itself(spark, text, n_windows, n_changed):
    docs = table(spark, [(1, text, "s")])
    got = contaminations(docs, items_of(spark, ITEM), each_window=True).collect()
    assert [(r["n_windows"], r["n_changed"]) for r in got] == [(n_windows, n_changed)] * (n_windows > 0)
    assert decontaminated(docs, items_of(spark, ITEM)).count() == (n_windows == 0)


SHORT = ["What is the capital of France?", "Name the river that runs through the old town today", "Paris", "How much is 17 times 23?"]


def test_short_items_and_quoted_items_are_found_in_longer_documents(spark):
    texts = {
        "So he looked up from the map and asked: What is the capital of France? Nobody knew it then": {0},
        "they asked him what is the capital of Spain? and he did not know at all": {0},
        "we all knew that Paris is the capital of France and went there by train": {2},
        "the task on the sheet of paper said Name the river that runs through the old town today": {1},
        "they took the train to Rome and stayed there for a week or so": set(),
        "on the last page it says How much is 12 times 4? and there is a line": {3},
        "on the last page it says Guess much is 12 times 4? and there is a line": set(),
        "on the last page it says: how much is 12 times 4? and there is a line": {3},
        "what is the capital of": set(),
    }
    docs = table(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = contaminations(docs, items_of(spark, *SHORT), each_window=True).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, k) for i, ks in enumerate(texts.values()) for k in ks}


NAMES = "Anna met Bert in Rome while Carl and Dora saw Emil near Oslo. Then Fritz told Gerda that Hans left"


@pytest.mark.parametrize("copy", [str.lower, str.upper, str.title, lambda t: t.replace(".", ""), lambda t: t.lower().replace(".", "")])
def test_copies_with_other_case_and_marks_are_found(spark, copy):
    texts = [copy(NAMES), copy(ITEM), "so " + copy(NAMES) + " and so on", copy(NAMES.replace("Bert", "Ida").replace("Emil", "Ida")).lower()]
    got = contaminations(table(spark, [(i, t, "s") for i, t in enumerate(texts)]), items_of(spark, NAMES, ITEM), each_window=True).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(0, 0), (1, 1), (2, 0)}


def test_forward_recursion_is_exact():
    """Against the sum over all state paths."""
    from itertools import product

    rng = np.random.default_rng(4)
    model = hmm_lm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(6), 3).T)
    sequences = [np.array(s, dtype=np.int16) for s in ([0, 1, 5, 2], [3], [4, 4, 1], [2, 0, 0, 1, 3])]
    for s, got in zip(sequences, hmm_lm.log_likelihoods(sequences, model), strict=True):
        total = 0.0
        for path in product(range(3), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for a, b, c in zip(path, path[1:], s[1:]):
                p *= model.move[a, b] * model.emit[c, b]
            total += p
        assert got == pytest.approx(np.log10(total))


def test_expected_counts_add_up():
    """Every token is emitted once in expectation, every step moves once, and pieces are no longer than allowed."""
    rng = np.random.default_rng(5)
    model = hmm_lm.Model.initial(np.full(7, 1 / 7), 3)
    sequences = sorted((rng.integers(0, 7, n).astype(np.int16) for n in (50, 9, 9, 1)), key=len, reverse=True)
    start, moves, emitted = hmm_lm.Lattice(sequences, model).expected()
    assert start.sum() == pytest.approx(4) and moves.sum() == pytest.approx(49 + 8 + 8)
    assert emitted.sum(axis=1) == pytest.approx(np.bincount(np.concatenate(sequences), minlength=7))
    pieces, _ = hmm_lm.pieces_of([np.zeros(2500, dtype=np.int16), np.zeros(3, dtype=np.int16)], model)
    assert [len(p) for p in pieces] == [1024, 1024, 452, 3]


def test_pieces_add_up_to_whole_texts(monkeypatch):
    """Expected counts of texts cut into pieces are those of the whole texts."""
    rng = np.random.default_rng(4)
    model = hmm_lm.Model.initial(np.full(12, 1 / 12), 4)
    model.move[:] = rng.dirichlet(np.ones(4), 4)
    model.start[:] = rng.dirichlet(np.ones(4))
    texts = [rng.integers(0, 12, n).astype(np.int16) for n in (1, 6, 7, 8, 14, 30, 61, 700)]

    def counts():
        pieces, messages = hmm_lm.pieces_of(texts, model)
        parts = [hmm_lm.Lattice([pieces[i] for i in c], model, messages.of(c)).expected() for c in hmm_lm._chunks(pieces)]
        return len(pieces), [sum(p[k] for p in parts) for k in range(3)]

    n_whole, whole = counts()
    monkeypatch.setattr(hmm_lm, "PIECE", 7)
    n_cut, cut = counts()
    assert (n_whole, n_cut) == (8, 1 + 1 + 1 + 2 + 2 + 5 + 9 + 100)
    for a, b in zip(whole, cut, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)


def test_each_pass_raises_the_likelihood(spark, documents):
    rows = documents.select("doc_id", F.lit(False).alias("held_out"), "text")
    vocab = hmm_lm.vocabulary(hmm_lm.word_counts(rows))
    sequences = hmm_lm.encoded(rows, vocab).select("classes").cache()
    found = [np.frombuffer(r["classes"], dtype=np.int16) for r in sequences.collect()]
    model, scores = hmm_lm.Model.initial(vocab.unigram), []
    for _ in range(4):
        scores.append(hmm_lm.log_likelihoods(found, model).sum())
        model = hmm_lm.improved(sequences, model, vocab)
    assert scores == sorted(scores)
    assert len(hmm_lm.log_likelihoods([], model)) == 0


@pytest.mark.parametrize(
    ("text", "span"),
    [
        ("write to john dot smith at example dot com now", ("email", "john dot smith at example dot com")),
        ("write to john (at) example (dot) com now", ("email", "john (at) example (dot) com")),
        ("j.doe at mail.example.org", ("email", "j.doe at mail.example.org")),
        ("jоhn@exаmple.com", ("email", "jоhn@exаmple.com")),
        ("call plus one five five five one two three four five six please", ("phone", "plus one five five five one two three four five six")),
        ("card ４１１１ １１１１ １１１１ １１１１.", ("card", "４１１１ １１１１ １１１１ １１１１")),
        ("host 192[.]168[.]0[.]1 is up", ("ip", "192[.]168[.]0[.]1")),
        ("host 10 dot 0 dot 0 dot 7", ("ip", "10 dot 0 dot 0 dot 7")),
    ],
)
def test_disguised_identifiers_map_back(text, span):
    base, every = pii_spans.all_spans(text)
    assert base == [] and [(s.kind, text[s.start : s.end]) for s in every] == [span]


@pytest.mark.parametrize(
    ("text", "span"),
    [
        ("call +1 555 one 23 4567", "phone:5:23"),
        ("j.doe_at_example.com", "email:0:20"),
        ("j.doe-at-example.com", "email:0:20"),
        ("john at example . com", "email:0:21"),
        ("john@example . com", "email:0:18"),
        ("host 192 . 168 . 0 . 1", "ip:5:22"),
        ("john ( arroba ) example ( punto ) com", "email:0:37"),
    ],
)
def test_the_gate_lets_every_disguise_pass(text, span):
    assert span in [str(s) for s in pii_spans.all_spans(text)[1]]


def test_rows_of_numbers_match_only_themselves(spark):
    item = "continue the series 3 5 8 13 21 34 55 89 144 233 377 and give the sum"
    texts = [
        "yearly totals were 1 2 4 9 16 25 36 49 64 81 100 in the table",
        "a copy: 3 5 8 13 21 34 55 89 144 233 377 is the row",
        "please " + item.replace("8", "9").replace("377", "378"),
        "Anna Bert Carl Dora Emil Frida Gustav Hans Ida Jan met",
    ]
    names = "so Otto Paul Rita Sven Tina Udo Vera Willi Xaver Zoe met"
    got = contaminations(table(spark, [(i, t, "s") for i, t in enumerate(texts)]), items_of(spark, item, names), each_window=True)
    # the third is the question with other numbers: one of its windows has three words outside its slots
    assert {r["doc_id"] for r in got.collect()} == {1, 2}


def test_the_gate_is_never_wrong_on_the_side_of_no():
    rng = random.Random(7)
    parts = ["a", "j.doe", "1", "23", " ", " ", ".", " . ", "@", "_at_", "-at-", " at ", " dot ", "_dot_", "one", "oh", "plus ", "(", ")", "( punto )", "ſix", "+", "-", "о"]
    changed = 0
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        if pii_spans.normalised(text).text != text:
            changed += 1
            assert pii_spans.disguised(text), text
    assert changed > 1000


@pytest.mark.parametrize("text", ["meet me at the dot", "look at example.org", "one of the two, or three", "plus four more", "a @ b",
    "section 3 at example.org", "released v2.0 at github.com", "He paid 4 at shop.example.com", "see 1.2.3 at example.org"])
def test_prose_has_no_disguised_identifiers(text):
    assert pii_spans.all_spans(text) == ([], [])


def test_disguised_spans_overlap_nothing():
    rng = random.Random(8)
    parts = ["j.doe@a.org", "j.doe at a.org", "+1 555 one 23 4567", "4111 1111 1111 1111", "10 dot 0 dot 0 dot 7", "10.0.0.7", "jоhn@exаmple.com", " ", ", ", " + "]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        base, every = pii_spans.all_spans(text)
        added = [s for s in every if s not in base]
        assert set(base) <= set(every) and len(every) == len(base) + len(added)
        for s in added:
            assert all(s.end <= t.start or t.end <= s.start for t in every if t is not s)
        # nothing is left out that overlaps none of the others
        mapped = pii_spans.normalised(text)
        for s in pii_spans.plain_spans(mapped.text):
            a, b = min(mapped.starts[s.start : s.end]), max(mapped.ends[s.start : s.end])
            assert any(a < t.end and t.start < b for t in every)


def test_plain_spans_equal_the_patterns():
    rng = random.Random(6)
    for _ in range(4000):
        text = "".join(rng.choice("aB1 2.@+-_%()034 9.@.1") for _ in range(rng.randrange(40)))
        assert [str(s) for s in pii_spans.plain_spans(text)] == brute.plain_identifiers(text)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "1." * 100_000, "+1(" * 50_000, "one " * 50_000,
    "j.doe at mail.example.org " * 20_000, "a@b.co (at) " * 20_000, "+1 555 one 23 4567 " * 10_000, "jоhn@exаmple.com, " * 20_000])
def test_matching_takes_linear_time(text):
    import time

    begun = time.perf_counter()
    pii_spans.all_spans(text)
    assert time.perf_counter() - begun < 5


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_are_the_whole(name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(name))
    pieces = token_counts.PieceEncoder(public_tokenizers.path(name), list, cached=20)
    texts = [
        "a<|endoftext|>B. <|ENDOFTEXT|>", "..., a.b. É. é. İI.", "x\x1cy \x85 z　w", "", "It's don't. 3.5, 10.", "'S 's. 'll,",
        "é. ́a Å, ﬁ.", "<|startoftext|>. a, b", "Ab. ab. AB.", "word word. Word, word", "1. 2, a1. b2,",
    ]
    for _ in range(2):
        got = [sum(row, []) for row in pieces.encode([t.encode() for t in texts])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_batches_are_balanced_by_bytes():
    assert list(token_counts.by_bytes([b"x" * n for n in (3, 3, 3, 20, 1, 1)], 7)) == [(0, 2), (2, 3), (3, 4), (4, 6)]


def test_files_follow_the_bytes_of_the_table(spark, documents, monkeypatch):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    usual, small = shared_path(spark, "test"), shared_path(spark, "test")
    token_files.write_token_files(documents, usual, tokenizer)
    monkeypatch.setattr(token_files, "FILE_BYTES", 10_000)
    token_files.write_token_files(documents, small, tokenizer)
    names = [token_files.read_token_files(spark, p).select("file").distinct().count() for p in (usual, small)]
    assert names[1] > names[0] and names[1] >= 6
    one, two = (token_files.token_file_digest(spark, p) for p in (usual, small))
    assert one.count() == documents.count() and one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_rows_that_repeat_an_id_are_dealt_by_their_texts(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "FILE_BYTES", 500)
    docs = table(spark, [(None if i % 3 else i, f"{i * 7919 % 1000} text number", "s") for i in range(300)])
    path = shared_path(spark, "test")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    read = token_files.read_token_files(spark, path)
    assert read.where("doc_id IS NULL").select("file").distinct().count() > 3
    got = token_files.with_starts(read).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"]) for r in docs.collect())
    expected = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for _, _, t in rows]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in got] == expected


def test_files_are_plain_zstandard_and_notice_damage(spark, documents):
    import zstandard

    path = shared_path(spark, "test")
    token_files.write_token_files(documents.limit(30), path, public_tokenizers.path("word_bpe_49k.json"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    content = next(bytes(r["content"]) for r in files if r["length"])
    reader = token_files.FileReader(content)
    assert reader.ids == sorted(reader.ids)
    every = b"".join(reader.tokens(i) for i in range(len(reader.ids)))
    assert zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read() == every
    at = int(reader.offsets[1]) + 12
    broken = token_files.FileReader(content[:at] + bytes([content[at] ^ 0xFF]) + content[at + 1 :])
    broken.tokens(0)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken.tokens(1)
    with pytest.raises(ValueError):
        token_files.FileReader(content[:-3])
