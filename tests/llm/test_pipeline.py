"""The pipeline's stages, each against a plain version on its own input."""

from collections import Counter

from marshlight.llm import toxicity
from tests.llm.frames import awkward, documents, empty
from tests.llm.test_jaccard import brute

import corpus_pipeline

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_one_by_one(spark):
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, SF).cache()
    lexicon = toxicity.fit_toxicity(docs, labels)
    assert set(rows(clean)) == {i for i, r in rows(docs).items() if lexicon.score(r["text"]) < 0.5} and clean.columns == COLUMNS

    lined = corpus_pipeline.drop_common_lines(spark, clean, SF).cache()
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    seen = Counter(k for r in rows(clean).values() for k in {key(x) for x in r["text"].split("\n")} if k)
    for i, r in rows(clean).items():
        assert rows(lined)[i]["text"] == "\n".join(x for x in r["text"].split("\n") if not key(x) or seen[key(x)] < 10)
    assert lined.columns == COLUMNS and lined.where("n_chars != length(text)").count() == 0

    single = corpus_pipeline.drop_near_copies(spark, lined, SF).cache()
    groups = brute([(i, r["text"]) for i, r in rows(lined).items()], 5, 80)
    assert set(rows(single)) == {i for i, (_, c) in groups.items() if c == i} and single.columns == COLUMNS

    free = corpus_pipeline.drop_benchmark(spark, single, SF).cache()
    norm = lambda t: " ".join(t.split())
    items = [norm(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(rows(single)) - set(rows(free)) == {i for i, r in rows(single).items() if any(x in norm(r["text"]) for x in items)}

    mixed = corpus_pipeline.mix(spark, free, SF)
    assert sorted(rows(mixed)) == sorted(rows(free))
    assert {tuple(r) for r in mixed.collect()} == {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}


def test_stages_take_awkward_tables(spark):
    for df in (awkward(spark), empty(spark)):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, df, SF)
            n = out.count()
            assert n <= df.count() and (name == "source_mixing" or out.columns == COLUMNS)
    kept = corpus_pipeline.drop_common_lines(spark, awkward(spark), SF)
    assert kept.count() == 13 and kept.where("text IS NULL").count() == 2


def test_rows_not_ids_are_kept_or_dropped(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    near = text + " end"
    df = documents(spark, [(7, text, "en", "a")] * 300 + [(None, near, "en", "b")] * 200 + [(9, near, "en", "b"), (7, other, "en", "a"), (None, None, None, None), (None, None, None, None), (3, "", "en", "a")])
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, df, SF).collect()]
    assert sorted(kept, key=str) == sorted([(7, text), (7, other), (None, None), (None, None), (3, "")], key=str)
    only_null = documents(spark, [(None, text, "en", "a"), (None, near, "en", "b")])
    assert corpus_pipeline.drop_near_copies(spark, only_null, SF).count() == 1

    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    df = documents(spark, [(7, item, "en", "a"), (7, text, "en", "a"), (None, other, "en", "b"), (None, f"see {item} here", "en", "b")])
    assert {r["text"] for r in corpus_pipeline.drop_benchmark(spark, df, SF).collect()} == {text, other}
