"""The assembled batch job: raw requests to refined actions and reports.

Stages hand over by table name, as snapshots, views or append-only state.  State
rows carry the hash of their prompt and a status: a rerun asks the models about
cases without an answer to the prompt they have now, so what failed or changed is
asked again and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.operators import (
    catalog,
    clean,
    cohort,
    embed,
    match,
    media,
    refine,
    reports,
    summaries,
)
from caseweave.operators.infer import (
    Model,
    answered,
    batch_infer,
    prompt_hash,
    refine_prompt,
    triage_prompt,
)
from caseweave.operators.worklist import current_answers, pending_prompts, work_batch
from caseweave.sinks import tables
from caseweave.sources import reference_rows
from caseweave.sources.requests import normalise_requests


@dataclass(frozen=True)
class Models:
    """Callables that answer a list of prompts with (result, status) pairs, and
    the embedder of texts.  With ``Settings.generation`` its items are passed as
    keywords."""

    photo: Model
    triage: Model
    refine: Model
    embed: embed.Embedder = embed.hashed_vector


@dataclass(frozen=True)
class Settings:
    per_stratum: int | None = fv.COHORT_PER_STRATUM  # None: every eligible case
    seed: int = 42
    neighbours: int = fv.NEIGHBOURS
    max_distance: float = fv.MAX_DISTANCE
    refine_batch: int | None = None
    analysis_pool: int | None = None  # rows of the table of best cases; None: all
    keep_null_text: bool = False
    generation: Mapping[str, Any] | None = None  # for instance fixed_values.GENERATION
    buckets: int | None = None  # of tables with a row per case: joins by case need no shuffle


@dataclass
class Job:
    spark: SparkSession
    raw: DataFrame
    models: Models
    objects: DataFrame | None = None
    policies: DataFrame | None = None
    labels: DataFrame | None = None
    database: str = "default"
    settings: Settings = field(default_factory=Settings)

    STATE = ("batch_image_summaries", "batch_triage_raw", "batch_triage_policy_refined")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def _replace(self, df: DataFrame, table: str) -> DataFrame:
        return tables.replace_table(df, self.name(table))

    def _replace_cases(self, df: DataFrame, table: str, **counts: Column) -> DataFrame:
        """A snapshot with a row per case, filed by case."""
        return tables.replace_table(df, self.name(table), self._by_case(), **counts)

    def _by_case(self) -> tuple[int, str] | None:
        return (self.settings.buckets, "service_request_id") if self.settings.buckets else None

    def _written(self, table: str, which: str = "rows") -> int:
        return tables.written_rows(self.spark, self.name(table), which)

    def _state(self, table: str, schema) -> DataFrame:
        """A state table with the answers that an earlier run could not append any more."""
        tables.ensure_table(
            self.spark, self.name(table), tables.with_outcome(schema), self._by_case()
        )
        tables.recover(self.spark, self.name(table))
        return self.table(table)

    def _model(self, model: Model) -> Model:
        return partial(model, **self.settings.generation) if self.settings.generation else model

    def _ask(self, keyed: DataFrame, prompt, model: Model, table: str, **options) -> DataFrame:
        """Answers for the rows of ``keyed`` that the state table has none for."""
        done = answered(self.table(table))
        todo = pending_prompts(keyed, done).drop("prompt_hash")
        return batch_infer(todo, prompt, self._model(model), **options)

    def _current(self, table: str, keyed: DataFrame) -> DataFrame:
        return current_answers(answered(self.table(table)), keyed)

    def run(self) -> None:
        for stage in (
            self.prepare_cases, self.draw_cohort, self.load_reference, self.summarise_photos,
            self.summarise_cases, self.triage, self.build_catalog, self.match,
            self.refine, self.report,
        ):
            stage()

    def prepare_cases(self) -> None:
        cases = tables.replace_view(normalise_requests(self.raw), "cases_norm")
        tables.replace_view(clean.clean_text(cases), "cases_for_classify")
        tables.replace_view(clean.text_quality(cases), "cases_text_quality")

    def draw_cohort(self) -> None:
        quality = self.spark.table("cases_text_quality")
        drawn = cohort.stratified_cohort(quality, self.settings.per_stratum, self.settings.seed)
        ids = self._replace(drawn.select("service_request_id"), "batch_ids")
        self._replace(cohort.fallback_ids(quality, ids), "batch_fallback_ids")

    def load_reference(self) -> None:
        policies, labels = self.policies, self.labels
        self._replace(
            reference_rows.policy_chunks(self.spark) if policies is None else policies,
            "policy_chunks",
        )
        self._replace(
            reference_rows.label_taxonomy(self.spark) if labels is None else labels,
            "label_taxonomy",
        )

    def summarise_photos(self) -> None:
        """From stored objects when they are given, otherwise from URLs."""
        name = self.name("batch_image_summaries")
        state = self._state("batch_image_summaries", tables.PHOTO_SUMMARIES)
        nothing, fallback = state.filter(F.lit(False)), self.table("batch_fallback_ids")
        if self.objects is None:
            wanted = media.todo_from_urls(self.spark.table("cases_norm"), fallback, nothing)
            place = F.col("url")
        else:
            wanted = media.todo_from_objects(self.objects, fallback, nothing)
            place = F.col("uri")
        prompt = F.concat(F.lit(fv.PHOTO_PROMPT + " "), place)
        keyed = wanted.withColumn("prompt_hash", prompt_hash(prompt))
        answers = self._ask(keyed, prompt, self.models.photo, "batch_image_summaries")
        tables.append(answers.withColumnRenamed("result", "summary_text"), name)
        tables.replace_view(self._current("batch_image_summaries", keyed), "photo_summaries")

    def _summaries(self, ids: DataFrame) -> DataFrame:
        texts = summaries.text_source_of_cases(
            self.spark.table("cases_norm"), ids, self.settings.keep_null_text
        )
        return summaries.case_summaries(texts, self.spark.table("photo_summaries"))

    def summarise_cases(self) -> None:
        """Written once: triage, the pool and the audit read it."""
        made = self._summaries(self.table("batch_ids"))
        tables.replace_view(self._replace_cases(made, "case_summaries"), "batch_case_summaries")

    def triage(self) -> None:
        name = self.name("batch_triage_raw")
        self._state("batch_triage_raw", tables.TRIAGE_RESULTS)
        summarised = self.spark.table("batch_case_summaries").filter(F.col("summary").isNotNull())
        keyed = self._replace_cases(
            summarised.withColumn("prompt_hash", prompt_hash(triage_prompt())), "triage_wanted"
        )
        answers = self._ask(
            keyed, triage_prompt(), self.models.triage, "batch_triage_raw",
            shared_prompts=False,  # the prompt holds the case id
        )
        tables.append(answers.withColumnRenamed("result", "triage_result"), name)
        tables.replace_view(self._current("batch_triage_raw", keyed), "current_triage")

    def build_catalog(self) -> None:
        policies = self.table("policy_chunks")
        embedder = self.models.embed
        self._replace(catalog.embed_chunks(policies, embedder), "policy_embeddings")
        normalised = catalog.embed_normalised(policies, embedder)
        self._replace(catalog.policy_catalog(policies, normalised), "policy_catalog")
        tables.replace_view(
            catalog.theme_validation(policies, self.table("label_taxonomy")),
            "policy_chunks_validation",
        )

    def match(self) -> None:
        """Current triage answers carry their summary; all else is in the row."""
        current = self.spark.table("current_triage").drop("prompt_hash")
        vectors = self._replace(
            embed.embed_cases(embed.search_theme(current), self.models.embed),
            "case_query_embeddings",
        )
        matched = self._replace_cases(
            match.matched_rows(
                vectors, self.table("policy_embeddings"),
                self.settings.max_distance, self.settings.neighbours,
            ),
            "triage_matched",
            hits=F.count_if("policy_matched"),
        )
        tables.replace_view(matched.filter("policy_matched"), "batch_policy_matches")

    def refine(self) -> None:
        name = self.name("batch_triage_policy_refined")
        state = self._state("batch_triage_policy_refined", tables.REFINED_ACTIONS)
        wanted = refine.refine_matched(self.table("triage_matched"), batch_size=None)
        keyed = wanted.withColumn("prompt_hash", prompt_hash(refine_prompt()))
        todo = pending_prompts(keyed, answered(state)).drop("prompt_hash")
        if self.settings.refine_batch is not None:
            todo = work_batch(todo, self.settings.refine_batch)
        model = self._model(self.models.refine)
        tables.append(refine.refine(self._replace(todo, "triage_todo"), model), name)
        tables.replace_view(
            self._current("batch_triage_policy_refined", keyed), "current_refined"
        )

    def report(self) -> None:
        triage, refined = self.spark.table("current_triage"), self.spark.table("current_refined")
        case_summaries = self.spark.table("batch_case_summaries")
        pool = reports.pool_of_matched(case_summaries, self.table("triage_matched"))
        parsed = self._replace(reports.parse_pool(pool), "parsed_pool")
        self._replace(reports.best_pool(parsed, self.settings.analysis_pool), "analysis_pool")
        # The rates are those of all summarised cases, never of the best ones only.
        analysed = self._replace(reports.full_cohort(parsed), "full_cohort_analysis")
        views = {
            "v_match_rates": reports.cohort_match_rate(analysed),
            "v_alignment_share": reports.share_of_total(refined),
            "v_review_examples": reports.review_examples(refined),
            "v_validate_json": reports.validate_json(triage),
            "v_validate_counts": reports.row_count_audit(
                self.spark,
                {
                    "01_cases_norm": self.spark.table("cases_norm"),
                    "02_cases_for_classify": self.spark.table("cases_for_classify"),
                    "03_cases_text_quality": self.spark.table("cases_text_quality"),
                    "04_batch_ids": self._written("batch_ids"),
                    "05_batch_case_summaries": self._written("case_summaries"),
                    "06_batch_triage_raw": triage,
                    "07_policy_chunks": self._written("policy_chunks"),
                    "08_policy_embeddings": self._written("policy_embeddings"),
                    "09_case_query_embeddings": self._written("case_query_embeddings"),
                    "10_batch_policy_matches": self._written("triage_matched", "hits"),
                    "11_batch_triage_policy_refined": refined,
                },
            ),
        }
        for view, df in views.items():
            tables.replace_view(df, view)

    def reset_summaries(self) -> None:
        """Forget photo summaries before a run with another photo source."""
        tables.reset(self.spark, [self.name("batch_image_summaries"), "batch_case_summaries", self.name("case_summaries")])

    def reset_state(self) -> None:
        tables.reset(self.spark, [self.name(table) for table in self.STATE])
