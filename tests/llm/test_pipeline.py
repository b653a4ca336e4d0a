"""The pipeline against the stages' definitions in plain Python."""

import re

import brute
from compare import duck
from llm_tables import DATA, documents  # noqa: F401

import corpus_pipeline
from riskfeat.llm.mixing import ORACLE_AMOUNTS


def test_pipeline_equals_brute_force(spark, documents):
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    docs = documents
    # what the rules keep is tested with the rules; here their decision must take effect
    docs = stages["quality"](spark, docs, DATA)
    kept = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert not any(brute.base_measures(t)[5] for _, t in kept)

    single = brute.near_duplicates(kept, 5, 80)
    docs = stages["near_duplicates"](spark, docs, DATA)
    kept = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(i for i, _ in kept) == sorted(i for i, (_, c) in single.items() if i == c)

    items = [" ".join(brute.low_words(r["text"])) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = {i for i, t in kept if not any(item in " ".join(brute.low_words(t)) for item in items)}
    docs = stages["decontaminate"](spark, docs, DATA)
    assert {r["doc_id"] for r in docs.collect()} == clean

    rows = docs.toPandas()
    con = duck(DATA)
    con.execute("DROP VIEW documents")
    con.register("documents", rows)
    taken = {r[0]: r[4] for r in con.execute(ORACLE_AMOUNTS).fetchall()}
    texts = dict(zip(rows["doc_id"], rows["text"]))

    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in texts.items():
        pieces = re.findall(r"[ \t-\r]*[^ \t-\r]+", t)
        whole, rest = divmod(taken[i], len(pieces))
        for text in [t] * whole + ["".join(pieces[:rest])] * (rest > 0):
            want.append((i, len(library.encode(text, add_special_tokens=False).ids) + 1))
    got = corpus_pipeline.run(spark, DATA).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == sorted(want)
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted(i for i, _ in want)


def test_stages_keep_the_columns_of_documents(spark, documents):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, DATA).columns == documents.columns, name
