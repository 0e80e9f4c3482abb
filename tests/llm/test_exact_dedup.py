import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from caseweave.llm import exact_dedup
from caseweave.llm.exact_dedup import build_directory, build_index, directory_bits, drop_copies, exact_copies


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        same = groups[t or ""]
        ids = [x for x in same if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(same), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [64, 2])
def test_against_brute_force(table, rows, prose, oddities, bits):
    texts = prose(150) + oddities + ["hot"] * 80
    given = list(enumerate(texts)) + [(None, "one two three four"), (None, "only null"), (7, texts[7])]
    got = exact_copies(table(given), hash_bits=bits, bucket_entries=10)
    assert rows(got) == expected(given)


def test_empty_table_and_other_columns(table, clashing, rows):
    assert rows(exact_copies(table([]))) == []
    assert rows(exact_copies(clashing([(1, "a"), (2, "a")])), "doc_id", "kept") == [(1, False), (2, True)]


def test_one_row_of_each_text_stays(clashing, rows):
    given = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "z"), (5, "b")]
    assert rows(drop_copies(clashing(given)), "doc_id", "text") == sorted(
        [(2, "a"), (4, ""), (None, "z"), (5, "b")], key=str
    )


def test_directory_splits_only_what_is_full():
    directory = build_directory({0: 9, 1: 2, 6: 3, 7: 1}, 3, 5)
    owners = [directory.slots[p >> (3 - directory.depth)] for p in range(8)]
    assert directory.depth == 3
    assert owners[0] != owners[1] and owners[2] == owners[3] and owners[4] == owners[7]
    assert build_directory({0: 5}, 3, 5).depth == 0


def test_shuffles_no_copies(spark, table):
    plan = exact_copies(table([(i, "same") for i in range(500)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "SortAggregate" not in plan and "CartesianProduct" not in plan


def test_stage_keeps_columns_with_our_names(table, rows):
    wide = table([(5, "a"), (6, "a"), (7, None), (None, ""), (8, "b"), (8, "b")]).selectExpr(
        "*", "'x' AS _id", "1 AS own", "2 AS digest", "3 AS row", "4 AS text_sha256", "5 AS kept"
    )
    kept = exact_dedup.drop_copies(wide)
    assert kept.columns == wide.columns and rows(kept, "doc_id", "own", "_id") == [(6, 1, "x"), (7, 1, "x"), (8, 1, "x")]


def test_index_alone_answers_from_split_buckets(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    index, directory = build_index(docs)
    assert directory.depth > 0
    # Owners are key ranges, each in one file, in the order of its keys.
    placed = index.select("owner", F.shiftrightunsigned("key", 1).alias("key"), F.input_file_name().alias("file"))
    ranges = placed.groupBy("owner").agg(F.min("key"), F.max("key"), F.countDistinct("file")).orderBy("owner").collect()
    assert len(ranges) == len(set(directory.slots)) and all(r[3] == 1 for r in ranges)
    assert all(a[2] < b[1] for a, b in zip(ranges, ranges[1:]))
    groups = defaultdict(list)
    for i, text in docs.select("doc_id", "text").collect():
        groups[text or ""].append(i)
    want = [(max(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items()]
    assert rows(index, "keep_id", "group_size", "sha256") == sorted(want, key=str)


def test_texts_meet_in_their_owners_task_once(spark, table, monkeypatch):
    """One shuffle of texts, by owner; only frequent ones are counted before it."""
    plans = []
    real = exact_dedup.stage
    monkeypatch.setattr(
        exact_dedup, "stage",
        lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or real(df, name),
    )
    build_index(table([(i, f"text {i}") for i in range(3000)]))
    plan = dict(plans)["exact-index"]
    assert plan.count("Exchange hashpartitioning(owner") == 1 and "Python" not in plan and "SortAggregate" not in plan


def test_directory_grows_with_the_keys():
    assert directory_bits(0, 512) == directory_bits(512, 512) == 0
    assert directory_bits(513, 512) == 3 and directory_bits(5120, 512) == 6
    assert directory_bits(10**12, 512) == exact_dedup.DIRECTORY_BITS
    wide = build_directory({i: 9 for i in range(1 << 12)}, 12, 10)
    assert wide.depth == 12 and len(set(wide.slots)) == 1 << 12
