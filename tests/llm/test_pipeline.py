"""The pipeline against its operators' plain parts, one document at a time."""

import itertools

import pytest

import corpus_pipeline
from catalograph.llm import near_duplicates as N
from catalograph.llm import pii, quality, toxicity
from catalograph.llm.pii_queries import TRIAL_KEY
from catalograph.llm.tables import table
from catalograph.llm.token_count_queries import vocabulary
from catalograph.llm.token_counts import Automaton, ChunkCounts
from tests.llm.test_near_duplicates import plain_components, plain_fingerprint
from tests.llm.test_quality import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage, as the driver runs them."""
    docs, out = table(spark, SF, "documents"), []
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test")
        assert docs.columns == columns or number == len(corpus_pipeline.STAGES)
        out.append([r.asDict() for r in docs.collect()])
    return [[r.asDict() for r in table(spark, SF, "documents").collect()], *out]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "pii", "packing"]


def test_filters(spark, kept):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    net = toxicity.fit(docs, labels, "toxic")
    assert ids(kept[1]) == sorted(r["doc_id"] for r in kept[0] if net.scores([r["text"] or ""])[0] < 0.5)
    frame = spark.createDataFrame([tuple(r.values()) for r in kept[1]], docs.schema)
    classifier = quality.fit(frame, labels, "quality")
    rows = [(r["source"], r["lang"], float(classifier.evidence([r["text"] or ""])[0])) for r in kept[1]]
    good = []
    for r, (_, _, e), (_, share) in zip(kept[1], rows, plain(rows)):
        odds = e / (1 - e) / (classifier.prior / (1 - classifier.prior)) * share / (1 - share)
        if odds >= 1:
            good.append(r["doc_id"])
    assert ids(kept[2]) == sorted(good)


def test_one_of_each_group(kept):
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in kept[2]]
    assert ids(kept[3]) == sorted(set(plain_components(prints)))
    left = [N.fingerprint((r["text"] or "").encode()) for r in kept[3]]
    assert all(bin(a ^ b).count("1") > 3 for a, b in itertools.combinations(left, 2))


def test_pseudonyms_and_batches(kept):
    assert {(r["doc_id"], r["text"]) for r in kept[4]} == \
        {(r["doc_id"], pii.pseudonymise(r["text"], TRIAL_KEY)[0]) for r in kept[3]}
    counter = ChunkCounts(Automaton(vocabulary()))
    assert {(r["doc_id"], r["n_tokens"]) for r in kept[5]} == {(r["doc_id"], counter.of(r["text"])) for r in kept[4]}
    assert len(kept[5]) == len(kept[4]) and all(r["n_tokens"] <= r["bucket_length"] for r in kept[5])


def test_run(spark, kept):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").collect())
    assert got == sorted((r["doc_id"], r["n_tokens"]) for r in kept[5])


def test_stages_on_odd_tables(spark, documents, tmp_path):
    table(spark, SF, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    odd = [(None, None, None, None), (1, "", None, "en"), (1, "", None, "en"), (2, "word " * 30000, "s", None),
           (None, "some text here", "s", "en")]
    for rows in ([], odd):
        docs = documents(rows, extra=True)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), f"odd-{name}")
            assert docs.columns == columns or name == "packing"
        assert docs.count() <= len(rows)
