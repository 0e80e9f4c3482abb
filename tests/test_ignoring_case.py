from pyspark.sql import functions as F

from caseweave.functions.text import same_ignoring_case
from caseweave.operators import catalog

PAIRS = [
    ("Noise", "nOISE", True),
    ("ÄRGER", "ärger", True),
    ("\u212a", "k", True),  # Kelvin sign
    ("İstanbul", "i̇stanbul", True),
    ("İ", "i", False),
    ("I", "ı", False),
    ("ΣΑΣ", "σας", True),
    ("σασ", "σας", True),
    ("Straße", "STRASSE", False),
    ("straße", "STRAẞE", True),
    ("é", "e", False),
    ("a", "a ", False),
    ("", "", True),
    (None, "a", None),
    (None, None, None),
]


def test_letters_that_have_rules_of_their_own(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in PAIRS], "a string, b string")
    got = df.select("a", "b", same_ignoring_case(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == PAIRS
    collated = df.select("a", "b", F.collate("a", "UTF8_LCASE") == F.collate("b", "UTF8_LCASE")).collect()
    assert [tuple(r) for r in collated] == PAIRS


def test_theme_validation_follows_them_and_broadcasts_the_labels(spark):
    policies = spark.createDataFrame(
        [(f"{i:02d}", "t", a) for i, (a, _, _) in enumerate(PAIRS)], "policy_id string, title string, target_theme string"
    )
    taxonomy = spark.createDataFrame([("NOISE",), ("ΣΑΣ",), ("STRASSE",), ("K",), (None,)], "label_value string")
    checked = catalog.theme_validation(policies, taxonomy)
    known = [a in ("Noise", "ΣΑΣ", "σασ", "\u212a") for a, _, _ in PAIRS]
    got = [r.theme_status for r in checked.orderBy("policy_id").collect()]
    assert got == ["ok" if k else "missing_in_taxonomy" for k in known]
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
