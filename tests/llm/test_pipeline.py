"""Each stage on what its predecessor kept, against brute force."""

import corpus_pipeline
import pytest

from caseweave.llm.queries import QUERIES


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    sf = "/root/testdata/sf0.001"
    docs, frames = spark.read.parquet(f"{sf}/documents.parquet"), []
    docs = docs.unionByName(
        spark.createDataFrame([(9000, None, None, "x", 0), (9001, "12 !", "en", "x", 4), (9002, "the and of to in", None, "x", 16)], docs.schema)
    )
    frames.append(docs.toPandas())
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        frames.append(docs.toPandas())
    return frames


def test_language_rejects_only_what_has_no_letters(staged):
    given, kept = staged[0], staged[1]
    assert set(given["doc_id"]) - set(kept["doc_id"]) == {9000, 9001}
    assert kept.set_index("doc_id").loc[9002, "lang"] in {"en", "de", "fr", "es"}


def test_wrong_labels_are_replaced_and_right_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang is not null").toPandas()
    swapped = docs[docs["text"].str.len().gt(300)].iloc[::10].index  # enough text to be clear
    given = docs.copy()
    given.loc[swapped, "lang"] = given.loc[swapped, "lang"].map({"en": "de", "de": "fr", "fr": "es", "es": "en"})
    unknown = docs["doc_id"].max() + 1
    given.loc[len(given)] = docs.iloc[swapped[0]].to_dict() | {"doc_id": unknown, "lang": "xx"}
    kept = corpus_pipeline.identify_language(spark, spark.createDataFrame(given), "").toPandas().set_index("doc_id")["lang"]
    want = docs.set_index("doc_id")["lang"]
    assert len(swapped) >= 5 and (kept[want.index] == want).mean() >= 0.99
    assert (kept[docs.loc[swapped, "doc_id"]] == want[docs.loc[swapped, "doc_id"]]).mean() >= 0.8  # none before
    assert kept[unknown] == "xx"


def test_exact_copies_leave_the_largest_id(staged):
    before, after = staged[1], staged[2]
    assert set(after["doc_id"]) == set(before.groupby("text")["doc_id"].max())


def test_near_copies_leave_one_of_each_class(staged):
    from test_near_join import expected

    before, after = staged[2], staged[3]
    want = {i for i, c, *_ in expected(list(zip(before["doc_id"], before["text"], strict=True))) if i == c}
    assert set(after["doc_id"]) == want


def test_mixing_keeps_all_and_repeats_within_the_limit(staged):
    before, after = staged[3], staged[4]
    uses = after.groupby("doc_id").size()
    assert set(uses.index) == set(before["doc_id"]) and uses.max() <= 2
    assert list(after.columns) == corpus_pipeline.COLUMNS
    same = after.drop_duplicates().set_index("doc_id").sort_index()
    assert same.equals(before.set_index("doc_id").sort_index())


def test_packing_places_every_token(staged):
    from test_tokens import sequences_of

    docs, pieces = staged[4], staged[5]
    assert set(pieces["doc_id"]) == set(docs["doc_id"])
    assert (pieces["piece"] == 0).sum() == len(docs)
    used = sequences_of(pieces.to_dict("records"))
    assert used <= -(-pieces["length"].sum() // 2048) + 1


def test_registered(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {*QUERIES, "pipeline"} <= names
    assert len([n for n in QUERIES if n.startswith("op")]) == 13
    assert set(__spark_entry__.oracle_sql()) <= names
