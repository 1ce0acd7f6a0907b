from __future__ import annotations

import pyarrow as pa
import pytest
from test_line_dedup import plain_dedup
from test_set_join import plain_components
from text_cases import documents, labels, no_documents, odd_documents

import corpus_pipeline
from clickloom.llm import quality, set_join, toxicity
from clickloom.llm.common import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before and after each stage, each written and read again."""
    docs, made = table(spark, FOLDER, "documents"), []
    for n, (name, function) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(n))
        function(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        made.append((name, docs, after))
        docs = after
    return made


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(steps):
    assert len(steps) == 5
    assert all(after.columns == before.columns for _, before, after in steps[:-1])


def test_filters_take_their_operators_verdict(spark, steps):
    marks = table(spark, FOLDER, "labels")
    (_, raw, good), (_, _, clean) = steps[:2]
    assert ids(good) == ids(quality.quality_rules(raw, marks).where("kept"))
    assert ids(clean) == ids(toxicity.score_toxicity(good, marks).where("predicted = 0"))


def test_line_dedup(steps):
    _, before, after = steps[2]
    want = [(i, text) for i, _, _, text in plain_dedup([(r.doc_id, r.text) for r in before.collect()])]
    rows = after.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_all_that_is_left_is_packed(spark, steps):
    _, before, after = steps[4]
    assert sorted(set(ids(after))) == ids(before)
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, after.collect()))


def test_odd_rows_and_no_rows_pass_all_stages(spark, tmp_path):
    folder = str(tmp_path)
    labels(spark, [(1, 1, 0), (5, 1, 0), (6, None, None), (None, 1, 1)]).write.parquet(f"{folder}/labels.parquet")
    for start in (odd_documents(spark), no_documents(spark)):
        docs, left = start, []
        for n, (_, function) in enumerate(corpus_pipeline.STAGES):
            path = f"{folder}/{start is docs}-{start.isEmpty()}-{n}"
            function(spark, docs, folder).write.parquet(path)
            docs = spark.read.parquet(path)
            left.append(docs.count())
            assert n == 4 or docs.columns == start.columns
        # Texts of under 20 words and of repeated windows go; of the rest, one of each group stays.
        assert left == [0] * 5 or left[0] >= left[1] == left[2] >= left[3] <= left[4]


def test_stages_alone_on_odd_rows(spark, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = odd_documents(spark)
    kept = {name: function(spark, docs, str(tmp_path)) for name, function in corpus_pipeline.STAGES}
    assert kept["toxicity"].count() == 10  # nothing to learn from, nothing rejected
    assert kept["line dedup"].count() == 10
    near = sorted(str(r.doc_id) for r in kept["n-gram Jaccard join"].collect())
    assert near == sorted(["1", "2", "3", "4", "5", "7", "7", "8", "None"])  # 6 is a copy of 5
    assert {r.doc_id for r in kept["best-fit packing"].collect()} == {1, 2, 3, 4, 5, 6, 7, 8, None}


def test_near_copies_are_five_words_and_eighty_per_cent(spark):
    words = [f"w{n}" for n in range(200)]
    edited = [w + "x" if n in (40, 80, 120, 160) else w for n, w in enumerate(words)]
    other = [f"v{n}" for n in range(200)]
    longer = other + [f"u{n}" for n in range(25)]
    less = [f"t{n}" for n in range(200)]
    unlike = [w + "x" if n in (30, 60, 90, 120, 150) else w for n, w in enumerate(less)]
    texts = [" ".join(t) for t in (words, edited, other, longer, less, unlike)]
    kept = corpus_pipeline.near_duplicates(spark, documents(spark, texts), FOLDER)
    assert ids(kept) == [0, 2, 4, 5]


def test_one_of_each_group_stays_at_five_words_and_eighty_per_cent(steps):
    _, before, after = steps[3]
    found = plain_components(sorted((r.doc_id, r.text) for r in before.collect()), 5, 80)
    assert ids(after) == sorted({c for _, _, c in found})


def test_rows_of_a_repeated_id_are_judged_by_their_texts(spark):
    a, b, c = (" ".join(f"{letter}{n}" for n in range(30)) for letter in "abc")
    data = [(3, a), (5, a), (5, b), (7, b), (7, c), (None, a)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([data[0], data[2], data[4], data[5]], key=str)


def test_line_dedup_keeps_columns_that_it_uses_itself(spark):
    line = "a line of more than forty characters in all of them"
    docs = spark.createDataFrame(
        [(n, f"{line}\nown {n}", 77, 88, "x", 500) for n in range(6)],
        "doc_id bigint, text string, n_lines int, n_dropped int, c2 string, n_chars int",
    )
    kept = corpus_pipeline.shared_lines(spark, docs, FOLDER)
    assert kept.schema == docs.schema
    found = sorted(map(tuple, kept.collect()))
    assert found == [(n, f"own {n}", 77, 88, "x", 5) for n in range(5)] + [(5, f"{line}\nown 5", 77, 88, "x", 500)]


def test_near_copies_meet_by_segments(spark, monkeypatch):
    """The join stage partitions the universe; it has no other signatures."""
    seen = []
    stage = set_join.stage

    def noted(df, purpose):
        made = stage(df, purpose)
        if purpose == "profiles":
            seen.extend(made.select("n_shingles", "signatures").collect())
        return made

    monkeypatch.setattr(set_join, "stage", noted)
    text = " ".join(f"w{n}" for n in range(64))
    assert ids(corpus_pipeline.near_duplicates(spark, documents(spark, [text, text + " more"]), FOLDER)) == [0]
    (_, shingles), *_ = set_join.shingle_sets(pa.array([text]), corpus_pipeline.NEAR_WORDS)
    want = set_join.signatures(shingles, corpus_pipeline.NEAR_SIMILARITY).tolist()
    assert [r.signatures for r in seen if r.n_shingles == 60] == [want]
