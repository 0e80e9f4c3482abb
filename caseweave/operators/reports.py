"""Analysis pool, rates, shares and health counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.jsonfields import is_malformed, normal_severity, with_triage_fields
from caseweave.operators.topn import top_n


def proto_pool(summaries: DataFrame, triage: DataFrame, matches: DataFrame) -> DataFrame:
    """Every summarised case with its triage answer and match, if any.

    All three are keyed by case id, so each is shuffled once.
    """
    answers = triage.select("service_request_id", F.col("triage_result").alias("tri_obj"))
    found = matches.select(
        "service_request_id", "policy_title", "target_theme", "source_url", "cosine_distance",
        F.lit(True).alias("policy_matched"),
    )
    return (
        summaries.join(answers, "service_request_id", "left")
        .join(found, "service_request_id", "left")
        .withColumn("policy_matched", F.coalesce("policy_matched", F.lit(False)))
    )


def pool_of_matched(summaries: DataFrame, matched: DataFrame) -> DataFrame:
    """As ``proto_pool`` for triage rows that carry their match: one join."""
    answers = matched.select(
        "service_request_id", F.col("triage_result").alias("tri_obj"),
        "policy_title", "target_theme", "source_url", "cosine_distance", "policy_matched",
    )
    return summaries.join(answers, "service_request_id", "left").withColumn(
        "policy_matched", F.coalesce("policy_matched", F.lit(False))
    )


def parse_pool(pool: DataFrame) -> DataFrame:
    return with_triage_fields(pool, "tri_obj").select(
        "service_request_id", "summary", "summary_source", "theme",
        normal_severity(F.col("severity")).alias("severity"),
        F.col("action").alias("suggested_action"),
        "policy_matched", "policy_title", "target_theme", "source_url", "cosine_distance",
    )


def best_pool(parsed: DataFrame, size: int | None = fv.ANALYSIS_POOL) -> DataFrame:
    """Matched cases first, nearest first, then by id; all summarised cases for ``None``.

    A report of the best cases: rates are taken from the pool itself.
    """
    if size is None:
        return parsed.filter(F.col("summary").isNotNull())
    order = [
        F.desc("policy_matched"), F.asc_nulls_last("cosine_distance"), F.asc("service_request_id")
    ]
    return top_n(parsed.filter(F.col("summary").isNotNull()), size, order)


def full_cohort(pool: DataFrame) -> DataFrame:
    return pool.filter(F.col("summary_source").isin("text", "image"))


def cohort_match_rate(cohort: DataFrame) -> DataFrame:
    """Match rate of text-only cases and of all; the first are part of the second.

    One pass over the cohort yields both lines.
    """
    return _rates(match_counts(cohort))


#: Columns of a partial match count.  Counts of disjoint rows add up, rates do not.
MATCH_COUNTS = ("text_total", "text_matched", "all_total", "all_matched")


def match_counts(cohort: DataFrame) -> DataFrame:
    """What match rates are made of, as one row that can be kept and added to others."""
    text, hit = F.col("summary_source") == "text", F.col("policy_matched")
    return cohort.agg(
        F.count_if(text).alias("text_total"),
        F.count_if(text & hit).alias("text_matched"),
        F.count(F.lit(1)).alias("all_total"),
        F.count_if(hit).alias("all_matched"),
    )


def merged_match_rate(partials: DataFrame) -> DataFrame:
    """``cohort_match_rate`` of all rows, from the ``match_counts`` of disjoint parts of them."""
    return _rates(partials.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in MATCH_COUNTS)))


def _rates(counts: DataFrame) -> DataFrame:
    lines = F.array(
        *[
            F.struct(
                F.lit(label).alias("cohort"),
                F.col(f"{which}_total").alias("total"),
                F.col(f"{which}_matched").alias("matched"),
                F.try_divide(f"{which}_matched", f"{which}_total").alias("match_rate"),
            )
            for which, label in (("text", fv.TEXT_COHORT), ("all", fv.ALL_COHORT))
        ]
    )
    return counts.select(F.inline(lines))


def share_of_total(rows: DataFrame, by: str = "alignment") -> DataFrame:
    """Count and percentage per value of a label; the window sees only the counts."""
    return _shares(label_counts(rows, by), by)


def label_counts(rows: DataFrame, by: str = "alignment") -> DataFrame:
    """What shares are made of: rows per value of a label, nulls as a value of their own."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("ct"))


def merged_share(partials: DataFrame, by: str = "alignment") -> DataFrame:
    """``share_of_total`` of all rows, from the ``label_counts`` of disjoint parts of them."""
    return _shares(partials.groupBy(by).agg(F.sum("ct").alias("ct")), by)


def _shares(counts: DataFrame, by: str) -> DataFrame:
    total = F.sum("ct").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(100 * F.col("ct") / total, 1)).orderBy(
        F.desc("ct"), by
    )


def review_examples(refined: DataFrame) -> DataFrame:
    return (
        refined.filter(F.col("alignment") == "review")
        .select(
            "service_request_id", "theme", "severity", "policy_title", "source_url",
            F.col("original_action").alias("before_action"),
            F.col("refined_action").alias("after_action"),
            "alignment",
        )
        .orderBy("service_request_id")
    )


def row_count_audit(spark: SparkSession, datasets: Mapping[str, DataFrame | int]) -> DataFrame:
    """Row count of each named dataset, by name.

    A number is the count that was taken while the dataset was written; only
    DataFrames are read.
    """
    known = [(name, n) for name, n in datasets.items() if not isinstance(n, DataFrame)]
    lines = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in datasets.items()
        if isinstance(df, DataFrame)
    ]
    if known:
        lines.append(spark.createDataFrame(known, "name string, n bigint"))
    return reduce(DataFrame.unionByName, lines).orderBy("name")


def validate_json(triage: DataFrame) -> DataFrame:
    """Null answers, answers that do not parse, and all."""
    answer = F.col("triage_result")
    return triage.agg(
        F.count_if(answer.isNull()).alias("bad_json_rows"),
        F.count_if(is_malformed(answer)).alias("malformed_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )
