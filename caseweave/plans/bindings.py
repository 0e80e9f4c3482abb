"""The test tables bound to the inputs of the job.

The tables hold no photo links, weak texts or model answers, so deterministic
rules on the key put those branches in: every document is a case with its whole
text, and every page is a further case with a weak text and perhaps a photo.
``plans/oracle.py`` states the same definitions in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.functions.text import first_group
from caseweave.operators import (
    catalog,
    clean,
    cohort,
    embed,
    match,
    refine,
    reports,
    search,
    summaries,
    worklist,
)
from caseweave.operators.infer import with_keyword_theme
from caseweave.sources.requests import normalise_requests
from caseweave.sinks.staging import stage, stage_counted
from caseweave.sources.tables import read_table

# Themes of the synthetic texts by the words that occur in them, first hit wins.
THEME_RULES = (
    ("theme_que", ("que", "les", "des")),
    ("theme_der", ("der", "die", "ein")),
    ("theme_los", ("los", "para", "el")),
    ("theme_than", ("than", "from")),
    ("theme_with", ("with", "as")),
    ("theme_in", ("in", "the")),
)
TEXT_MAX_DISTANCE = 0.25
VECTOR_MAX_DISTANCE = 0.75
COHORT_SIZE = 200
# Session setting: deal each table out to so many tasks.  For tables of a single row group.
PIECES = "spark.caseweave.pieces"
# Pages are cases of their own, numbered from here on.
PAGE_CASES = 1_000_000_000
SEED = 42


SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


class Bindings:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        pieces = self.spark.conf.get(PIECES, None)
        return read_table(
            self.spark, f"{self.folder}/{name}.parquet", SCHEMAS[name], pieces and int(pieces)
        )

    # --- requests -----------------------------------------------------------

    @cached_property
    def raw(self) -> DataFrame:
        d, e, p = self.table("documents"), self.table("events"), self.table("pages")
        key, text, source = F.col("doc_id"), F.col("text"), F.col("source")
        branch = key % 10
        descriptor = (
            F.when(branch == 4, F.concat(text, F.lit(" Case is a  duplicate of "), source))
            .when(branch == 5, F.concat(text, F.lit(" customer may follow up later")))
            .otherwise(text)
        )
        page = F.col("page_id") % 3
        media = (
            F.when(page == 0, F.concat(F.substring_index("url", "?", 1), F.lit("#.jpg?x=1")))
            .when(page == 1, F.col("url"))
            .when(page == 2, F.lit(" "))
        )
        documents = (
            d.join(e, key == F.col("event_id"), "left")
            .join(p, key == F.col("page_id"), "left")
            .select(
                key.alias("unique_key"),
                F.col("ts").alias("created_date"),
                F.when(key % 17 != 0, F.col("event_type")).alias("complaint_type"),
                F.when(key % 34 != 0, source).alias("category"),
                descriptor.alias("descriptor"),
                F.when(key % 60 == 0, F.concat(F.lit("Case transferred to "), source)).alias(
                    "status_notes"
                ),
                source.alias("agency_name"),
                media.alias("media_url"),
            )
        )
        number = F.col("page_id")
        weak = (
            F.when(number % 4 == 1, F.lit("open"))
            .when(number % 4 == 2, F.lit("N/A"))
            .when(number % 4 == 3, F.lit("_-_"))
        )
        pages = p.select(
            (number + PAGE_CASES).alias("unique_key"),
            F.lit(None).cast("timestamp_ntz").alias("created_date"),
            F.when(number % 17 != 0, F.lit("web page")).alias("complaint_type"),
            F.when(number % 34 != 0, F.lit("site")).alias("category"),
            weak.alias("descriptor"),
            F.when(number % 60 == 0, F.lit("Case transferred to web")).alias("status_notes"),
            F.lit("web").alias("agency_name"),
            media.alias("media_url"),
        )
        return documents.unionByName(pages)

    @cached_property
    def cases(self) -> DataFrame:
        return normalise_requests(self.raw)

    @cached_property
    def prepared(self) -> DataFrame:
        return clean.prepare(self.cases)

    @cached_property
    def quality(self) -> DataFrame:
        return clean.quality_of(self.prepared)

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean.cleaned_of(self.prepared)

    @cached_property
    def cohort(self) -> DataFrame:
        """All eligible cases: what follows the cohort runs on the whole table."""
        return cohort.eligible(self.quality).select("service_request_id")

    @cached_property
    def fallback(self) -> DataFrame:
        return cohort.fallback_ids(self.quality, self.cohort)

    # --- photos -------------------------------------------------------------

    @cached_property
    def objects(self) -> DataFrame:
        return self.table("pages").select(
            F.concat(
                F.lit("img/"), (F.col("page_id") + PAGE_CASES).cast("string"), F.lit(".jpg")
            ).alias("uri")
        )

    @cached_property
    def photo_summaries(self) -> DataFrame:
        """Photos summarised so far: those of pages with an even number, by their title."""
        done = self.table("pages").filter(F.col("page_id") % 2 == 0)
        return done.select(
            (F.col("page_id") + PAGE_CASES).cast("string").alias("service_request_id"),
            page_title(F.col("html")).alias("summary_text"),
        )

    # --- summaries and triage -----------------------------------------------

    @cached_property
    def summaries(self) -> DataFrame:
        eligible = self.prepared.filter(cohort.stratum().isNotNull())
        texts = summaries.text_source_of_prepared(eligible)
        return summaries.case_summaries(texts, self.photo_summaries)

    @cached_property
    def triage(self) -> DataFrame:
        """Stand-in for model answers: padded values, unknown severities, and
        every eleventh answer cut off before its closing brace."""
        summary, source = F.col("summary"), F.col("summary_source")
        severity = (
            F.when(F.length(summary) > 150, F.lit(" HIGH "))
            .when(F.length(summary) > 60, F.lit("medium"))
            .otherwise(F.lit("urgent"))
        )
        cut = F.col("service_request_id").cast("long") % 11 == 0
        answer = F.concat(
            F.lit('{"theme":" '), F.col("theme"),
            F.lit('","severity":"'), severity,
            F.lit('","suggested_action":"Check '), source, F.lit(' case now."'),
            F.when(cut, F.lit("")).otherwise(F.lit("}")),
        )
        summarised = self.summaries.filter(summary.isNotNull())
        return with_keyword_theme(summarised, "summary", THEME_RULES).select(
            "service_request_id", "summary", "summary_source",
            answer.alias("triage_result"),
            F.when(cut, F.lit("truncated")).otherwise(F.lit("")).alias("status"),
        )

    # --- policies and matches -----------------------------------------------

    @cached_property
    def policies(self) -> DataFrame:
        text = F.col("text")
        themed = with_keyword_theme(
            self.table("benchmark"), "text", THEME_RULES, into="target_theme"
        )
        return themed.select(
            F.concat(F.lit("P"), F.col("item_id").cast("string")).alias("policy_id"),
            F.substring_index(text, " ", 2).alias("title"),
            text.alias("chunk_text"),
            F.concat(F.lit("doc://P"), F.col("item_id").cast("string")).alias("source_url"),
            "target_theme",
        )

    @cached_property
    def policy_vectors(self) -> DataFrame:
        return catalog.embed_chunks(self.policies)

    @cached_property
    def case_queries(self) -> DataFrame:
        # The stand-in pads the theme, so it is trimmed here.
        return embed.query_texts(self.triage, trim_theme=True)

    @cached_property
    def case_vectors(self) -> DataFrame:
        return embed.embed_cases(self.case_queries)

    @cached_property
    def embedded(self) -> DataFrame:
        """Triage rows with the theme and the vector that they are searched by."""
        return embed.embed_cases(embed.search_theme(self.triage, trim=True))

    @cached_property
    def matched(self) -> DataFrame:
        return match.matched_rows(self.embedded, self.policy_vectors, TEXT_MAX_DISTANCE)

    @cached_property
    def matches(self) -> DataFrame:
        return match.tiered_match(self.case_vectors, self.policy_vectors, TEXT_MAX_DISTANCE)

    # --- given vectors ------------------------------------------------------

    @cached_property
    def given_catalog(self) -> DataFrame:
        vectors = self.table("embeddings").select(
            F.concat(F.lit("P"), F.col("vec_id").cast("string")).alias("policy_id"),
            F.concat(F.lit("theme_"), F.col("label").cast("string")).alias("target_theme"),
            "embedding",
        )
        return vectors.join(self.policies.drop("target_theme"), "policy_id", "left")

    @cached_property
    def given_queries(self) -> DataFrame:
        texts = self.table("documents").select("doc_id", F.col("text").alias("summary"))
        return (
            self.table("embeddings")
            .join(texts, F.col("vec_id") == F.col("doc_id"), "left")
            .select(
                F.col("vec_id").cast("string").alias("service_request_id"),
                F.concat(F.lit("Theme_"), F.col("label").cast("string")).alias("theme"),
                "summary",
                "embedding",
            )
        )

    @cached_property
    def given_candidates(self) -> DataFrame:
        return search.vector_topk(self.given_queries, self.given_catalog)

    # --- refinement and analysis --------------------------------------------

    @cached_property
    def refined_before(self) -> DataFrame:
        """Cases refined in an earlier run: those with a quality label."""
        return self.table("labels").select(
            F.col("doc_id").cast("string").alias("service_request_id")
        )

    @cached_property
    def open_triage(self) -> DataFrame:
        return worklist.pending(self.triage, self.refined_before)

    @cached_property
    def refine_todo(self) -> DataFrame:
        """Done cases leave before the search, so only open ones are matched."""
        return refine.refine_matched(self.match(self.open_triage), batch_size=None)

    @cached_property
    def todo_of_matched(self) -> DataFrame:
        """The same rows as ``refine_todo`` from rows that are matched, for those who have them."""
        return refine.refine_matched(worklist.pending(self.matched, self.refined_before), batch_size=None)

    def match(self, triage: DataFrame) -> DataFrame:
        return match.matched_triage(
            triage, self.policy_vectors, TEXT_MAX_DISTANCE, trim_theme=True
        )

    def staged(self, *names: str) -> Bindings:
        """The same with these datasets written once; what builds on them reads the files."""
        for name in names:
            self.__dict__[name] = stage(getattr(self, name), name)
        return self

    def written(self, name: str, which: str = "rows", **counts: Column) -> int:
        """Writes this dataset as ``staged`` does; how many rows the writing tasks counted."""
        self.__dict__[name], counted = stage_counted(getattr(self, name), name, **counts)
        return counted[which]

    @cached_property
    def pool(self) -> DataFrame:
        return reports.parse_pool(reports.pool_of_matched(self.summaries, self.matched))

    @cached_property
    def refined(self) -> DataFrame:
        """Stand-in rewrite: urgent cases follow the policy, others keep their action."""
        follow = F.concat(
            F.lit("Follow "), F.col("policy_title"), F.lit(": "), F.col("original_action")
        )
        action = F.when(F.col("severity") == "high", follow).otherwise(F.col("original_action"))
        return refine.refined_rows(self.refine_todo, action)

    @cached_property
    def event_answers(self) -> DataFrame:
        """JSON answers built from events; the event type decides the defect."""
        kind, value = F.col("event_type"), F.col("value")
        theme = F.when(kind == "signup", F.lit('{"name":"signup"}')).otherwise(
            F.concat(F.lit('"  '), kind, F.lit(' "'))
        )
        severity = (
            F.when(value > 40, F.lit(" HIGH "))
            .when(value > 20, F.lit("Low"))
            .when(value > 5, F.lit("medium"))
            .otherwise(F.lit("urgent"))
        )
        body = F.concat(
            F.lit('{"theme":'), theme,
            F.when(kind == "view", F.lit("")).otherwise(
                F.concat(F.lit(',"severity":"'), severity, F.lit('"'))
            ),
            F.lit(',"suggested_action":"Handle '), kind, F.lit(' \\"now\\"."'),
            F.lit(',"props":'), F.col("props"),
        )
        text = (
            F.when(kind == "error", body)
            .when(kind == "purchase", F.concat(F.lit("```json "), body, F.lit("}```")))
            .otherwise(F.concat(body, F.lit("}")))
        )
        return self.table("events").select("event_id", text.alias("triage_result"))


def page_title(html: Column) -> Column:
    return first_group(html, r"<title>([^<]*)</title>")
