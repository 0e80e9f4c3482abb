"""The same queries as plain SQL for an independent engine.

Shared datasets are named common table expressions; each query pulls in the
ones it mentions, in order of definition.
"""

from __future__ import annotations

import re

from caseweave import fixed_values as fv
from caseweave.plans import bindings as b


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(text(v) for v in values)


# --- expressions ------------------------------------------------------------


def trimmed(x: str) -> str:
    return f"trim({x}, {text(fv.UNICODE_SPACES)})"


def flat(x: str) -> str:
    blanks = f"replace(replace({x}, '_', ' '), '-', ' ')"
    return trimmed(rf"regexp_replace({blanks}, '\s+', ' ', 'g')")


def unboiled(x: str) -> str:
    """The text up to the first boilerplate phrase of each line."""
    phrases = "|".join(
        r"\b" + phrase.replace(" ", r"\s+") if starts_word else phrase
        for phrase, starts_word in fv.BOILERPLATE_PHRASES
    )
    return f"regexp_replace({x}, '(?i)(?:{phrases}).*$', '', 'g')"


def weak(x: str) -> str:
    return (
        f"({x} IS NULL OR {x} = '' OR length({x}) < {fv.MIN_TEXT_LENGTH} "
        f"OR lower({x}) IN ({_list(fv.STOP_TEXTS)}))"
    )


def titled(x: str) -> str:
    """Upper-case the first character of each run between delimiters."""
    cls = re.sub(r"([\[\]\\^\-&])", r"\\\1", fv.TITLE_DELIMITERS)
    runs = f"regexp_extract_all(lower({x}), {text(f'[^{cls}]+|[{cls}]+')})"
    return (
        f"array_to_string(list_transform({runs}, lambda w: "
        f"(CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END) || w[2:]), '')"
    )


def present(x: str) -> str:
    return f"({x} IS NOT NULL AND {trimmed(x)} <> '')"


def image_url(x: str) -> str:
    return rf"regexp_matches(lower({x}), '\.({'|'.join(fv.IMAGE_EXTENSIONS)})(?:$|[?#])')"


def words(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def theme_of(x: str) -> str:
    cases = " ".join(
        f"WHEN list_has_any({words(x)}, [{_list(keys)}]) THEN {text(theme)}"
        for theme, keys in b.THEME_RULES
    )
    return f"(CASE {cases} ELSE '' END)"


def json_scalar(j: str, key: str) -> str:
    path = text(f"$.{key}")
    return (
        f"(CASE WHEN json_valid({j}) THEN CASE WHEN json_type({j}, {path}) IN ('OBJECT', 'ARRAY') "
        f"THEN NULL ELSE json_extract_string({j}, {path}) END END)"
    )


def theme_field(j: str) -> str:
    return trimmed(json_scalar(j, "theme"))


def severity_field(j: str) -> str:
    return f"lower({trimmed(json_scalar(j, 'severity'))})"


def action_field(j: str) -> str:
    return trimmed(json_scalar(j, "suggested_action"))


def severity_case(s: str) -> str:
    return f"(CASE WHEN {s} IN ({_list(fv.SEVERITIES)}) THEN {s} ELSE {text(fv.DEFAULT_SEVERITY)} END)"


def stated(template: str, **columns: str) -> str:
    """A ``{name}`` template as a concatenation."""
    out = text(template.replace("{{", "\x01").replace("}}", "\x02"))
    for name, column in columns.items():
        out = out.replace("{" + name + "}", f"' || {column} || '")
    return out.replace("\x01", "{").replace("\x02", "}")


def bucket_counts(source: str, key: str, content: str) -> str:
    """Token counts per md5 bucket."""
    return (
        f"SELECT {key}, bucket, count(*) AS n FROM (SELECT {key}, "
        f"('0x' || substr(md5(w), 1, 4))::INT % 64 AS bucket FROM "
        f"(SELECT {key}, unnest({words(content)}) AS w FROM {source})) GROUP BY {key}, bucket"
    )


def ranked_cosine(queries: str, base: str, qid: str, bid: str, on: str, k: int) -> str:
    """Exact cosine top k of two sparse count tables with columns (id, key, n)."""
    return f"""
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY {qid} ORDER BY distance, {bid}) AS rn FROM (
          SELECT x.{qid}, y.{bid}, round(1 - coalesce(d.dot, 0) / (x.norm * y.norm), 9) AS distance
          FROM (SELECT {qid}, sqrt(sum(n * n)) AS norm FROM {queries} GROUP BY {qid}) x
          CROSS JOIN (SELECT {bid}, sqrt(sum(n * n)) AS norm FROM {base} GROUP BY {bid}) y
          LEFT JOIN (SELECT q.{qid}, p.{bid}, sum(q.n * p.n)::DOUBLE AS dot
                     FROM {queries} q JOIN {base} p USING ({on}) GROUP BY ALL) d
            ON d.{qid} = x.{qid} AND d.{bid} = y.{bid})) WHERE rn <= {k}"""


def best(source: str, where: str, cutoff: float) -> str:
    return f"""
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
          PARTITION BY service_request_id ORDER BY cosine_distance, policy_id) AS rn
        FROM {source} WHERE {where}) WHERE rn = 1 AND cosine_distance <= {cutoff}"""


def tiers(candidates: str, prefix: str, cutoff: float) -> dict[str, str]:
    return {
        f"{prefix}_precise": best(
            candidates, "lower(case_theme) = lower(target_theme)", cutoff
        ),
        f"{prefix}_global": best(
            candidates,
            f"service_request_id NOT IN (SELECT service_request_id FROM {prefix}_precise)",
            cutoff,
        ),
        f"{prefix}_matches": (
            f"SELECT *, 'precise' AS tier FROM {prefix}_precise UNION ALL "
            f"SELECT *, 'global' AS tier FROM {prefix}_global"
        ),
    }


# --- datasets ---------------------------------------------------------------

_STRATUM = (
    f"CASE WHEN NOT is_bad_text THEN 'text' WHEN is_bad_text AND has_media "
    f"AND {image_url('media_url')} THEN 'image' END"
)

DATASETS: dict[str, str] = {
    "raw_requests": """
      SELECT d.doc_id AS unique_key, e.ts AS created_date,
        CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE e.event_type END AS complaint_type,
        CASE WHEN d.doc_id % 34 = 0 THEN NULL ELSE d.source END AS category,
        CASE d.doc_id % 10 WHEN 4 THEN d.text || ' Case is a  duplicate of ' || d.source
          WHEN 5 THEN d.text || ' customer may follow up later' ELSE d.text END AS descriptor,
        CASE WHEN d.doc_id % 60 = 0 THEN 'Case transferred to ' || d.source END AS status_notes,
        d.source AS agency_name,
        CASE p.page_id % 3 WHEN 0 THEN string_split(p.url, '?')[1] || '#.jpg?x=1'
          WHEN 1 THEN p.url WHEN 2 THEN ' ' END AS media_url
      FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id
        LEFT JOIN pages p ON p.page_id = d.doc_id
      UNION ALL
      SELECT page_id + {cases}, NULL, CASE WHEN page_id % 17 <> 0 THEN 'web page' END,
        CASE WHEN page_id % 34 <> 0 THEN 'site' END,
        CASE page_id % 4 WHEN 1 THEN 'open' WHEN 2 THEN 'N/A' WHEN 3 THEN '_-_' END,
        CASE WHEN page_id % 60 = 0 THEN 'Case transferred to web' END, 'web',
        CASE page_id % 3 WHEN 0 THEN string_split(url, '?')[1] || '#.jpg?x=1'
          WHEN 1 THEN url WHEN 2 THEN ' ' END
      FROM pages""".replace("{cases}", str(b.PAGE_CASES)),
    "norm_cases": """
      SELECT CAST(unique_key AS VARCHAR) AS service_request_id, created_date AS requested_datetime,
        coalesce(complaint_type, category) AS request_type,
        coalesce(descriptor, status_notes, complaint_type) AS request_details,
        agency_name AS agency_responsible, media_url FROM raw_requests""",
    "unboiled": f"""
      SELECT service_request_id, request_type,
        {unboiled('coalesce(request_details, request_type)')} AS txt
      FROM norm_cases WHERE coalesce(request_details, request_type) IS NOT NULL""",
    "flattened": f"SELECT service_request_id, request_type, {flat('txt')} AS t FROM unboiled",
    "cleaned": rf"""
      SELECT service_request_id,
        CASE WHEN {weak('t')} THEN
          '(' || {titled("coalesce(request_type, 'Issue')")} || ') {fv.NO_TEXT_NOTE}'
        WHEN regexp_matches({titled('t')}, '[.!?]\s*$') THEN {titled('t')}
        ELSE {titled('t')} || '.' END AS complaint_text FROM flattened""",
    "quality": f"""
      SELECT service_request_id, request_type, media_url, text_norm,
        {present('media_url')} AS has_media, {weak('text_norm')} AS is_bad_text
      FROM (SELECT service_request_id, request_type, media_url,
        {flat('coalesce(request_details, request_type)')} AS text_norm FROM norm_cases)""",
    "strata": f"""
      SELECT service_request_id, stratum FROM (
        SELECT service_request_id, {_STRATUM} AS stratum FROM quality) WHERE stratum IS NOT NULL""",
    "cohort": "SELECT service_request_id FROM strata",
    "fallback": """
      SELECT q.service_request_id FROM quality q JOIN cohort USING (service_request_id)
      WHERE q.is_bad_text AND q.has_media""",
    "candidates_media": f"""
      SELECT service_request_id, media_url FROM norm_cases
      WHERE {present('media_url')} AND {image_url('media_url')}""",
    "image_objects": f"SELECT 'img/' || (page_id + {b.PAGE_CASES}) || '.jpg' AS uri FROM pages",
    "photo_summaries": rf"""
      SELECT CAST(page_id + {b.PAGE_CASES} AS VARCHAR) AS service_request_id,
        nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS summary_text
      FROM pages WHERE page_id % 2 = 0""",
    "looked_up": r"""
      SELECT uri, service_request_id FROM (
        SELECT uri, nullif(regexp_extract(uri, '(\d+)\.jpg$', 1), '') AS service_request_id
        FROM image_objects) WHERE service_request_id IN (SELECT service_request_id FROM fallback)""",
    "texts": """
      SELECT service_request_id, c.complaint_text, q.is_bad_text
      FROM cohort JOIN cleaned c USING (service_request_id)
        JOIN quality q USING (service_request_id)""",
    "summarised": """
      SELECT t.service_request_id,
        CASE WHEN is_bad_text THEN summary_text ELSE complaint_text END AS summary,
        CASE WHEN NOT is_bad_text THEN 'text' WHEN summary_text IS NULL THEN 'none'
          ELSE 'image' END AS summary_source
      FROM texts t LEFT JOIN photo_summaries s USING (service_request_id)""",
    "triage": f"""
      SELECT service_request_id, summary, summary_source,
        '{{"theme":" ' || {theme_of('summary')} || '","severity":"' ||
        CASE WHEN length(summary) > 150 THEN ' HIGH ' WHEN length(summary) > 60 THEN 'medium'
          ELSE 'urgent' END || '","suggested_action":"Check ' || summary_source || ' case now."' ||
        CASE WHEN service_request_id::BIGINT % 11 = 0 THEN '' ELSE '}}' END AS triage_result,
        CASE WHEN service_request_id::BIGINT % 11 = 0 THEN 'truncated' ELSE '' END AS status
      FROM summarised WHERE summary IS NOT NULL""",
    "policies": f"""
      SELECT 'P' || item_id AS policy_id,
        array_to_string(string_split(text, ' ')[1:2], ' ') AS title, text AS chunk_text,
        'doc://P' || item_id AS source_url, {theme_of('text')} AS target_theme FROM benchmark""",
    "policy_buckets": bucket_counts("policies", "policy_id", "chunk_text"),
    "searched": f"""
      SELECT service_request_id, coalesce({theme_field('triage_result')}, '') AS theme, s.summary
      FROM triage JOIN summarised s USING (service_request_id) WHERE s.summary IS NOT NULL""",
    "case_buckets": bucket_counts(
        "searched", "service_request_id", "('Theme: ' || theme || '. Summary: ' || summary)"
    ),
    "ranked": ranked_cosine(
        "case_buckets", "policy_buckets", "service_request_id", "policy_id", "bucket", 5
    ),
    "text_candidates": """
      SELECT service_request_id, s.theme AS case_theme, s.summary, policy_id, title AS policy_title,
        chunk_text AS policy_snippet, target_theme, source_url, distance AS cosine_distance
      FROM ranked JOIN searched s USING (service_request_id) JOIN policies USING (policy_id)""",
    **tiers("text_candidates", "text", b.TEXT_MAX_DISTANCE),
    "given_ranked": """
      SELECT * FROM (
        SELECT *, row_number() OVER (
          PARTITION BY service_request_id ORDER BY cosine_distance, policy_id) AS rn
        FROM (
          SELECT q.vec_id::VARCHAR AS service_request_id, 'Theme_' || q.label AS case_theme,
            'P' || v.vec_id AS policy_id, 'theme_' || v.label AS target_theme,
            round(list_cosine_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9)
              AS cosine_distance
          FROM embeddings q CROSS JOIN embeddings v)) WHERE rn <= 5""",
    "given_candidates": """
      SELECT service_request_id, case_theme, d.text AS summary, policy_id, p.title AS policy_title,
        p.chunk_text AS policy_snippet, g.target_theme, p.source_url, cosine_distance
      FROM given_ranked g LEFT JOIN policies p USING (policy_id)
        LEFT JOIN documents d ON d.doc_id = service_request_id::BIGINT""",
    **tiers("given_candidates", "given", b.VECTOR_MAX_DISTANCE),
    "refined_before": "SELECT CAST(doc_id AS VARCHAR) AS service_request_id FROM labels",
    "to_refine": f"""
      SELECT r.service_request_id, s.summary, s.summary_source,
        {theme_field('triage_result')} AS theme, {severity_field('triage_result')} AS severity,
        {action_field('triage_result')} AS original_action,
        m.policy_title, m.policy_snippet, m.source_url
      FROM triage r JOIN summarised s USING (service_request_id)
        LEFT JOIN text_matches m USING (service_request_id)
        LEFT JOIN refined_before e USING (service_request_id)
      WHERE e.service_request_id IS NULL""",
    "refined": """
      SELECT *, CASE WHEN contains(lower(refined_action), lower(string_split(policy_title, ' ')[1]))
          THEN 'aligned' ELSE 'review' END AS alignment
      FROM (SELECT *, CASE WHEN severity = 'high'
          THEN 'Follow ' || policy_title || ': ' || original_action
          ELSE original_action END AS refined_action FROM to_refine)""",
    "event_answers": r"""
      SELECT event_id,
        CASE event_type WHEN 'error' THEN body WHEN 'purchase' THEN '```json ' || body || '}```'
          ELSE body || '}' END AS triage_result
      FROM (SELECT event_id, event_type, '{"theme":' ||
        CASE WHEN event_type = 'signup' THEN '{"name":"signup"}'
          ELSE '"  ' || event_type || ' "' END ||
        CASE WHEN event_type = 'view' THEN '' ELSE ',"severity":"' ||
          CASE WHEN value > 40 THEN ' HIGH ' WHEN value > 20 THEN 'Low' WHEN value > 5
            THEN 'medium' ELSE 'urgent' END || '"' END ||
        ',"suggested_action":"Handle ' || event_type || ' \"now\"."' ||
        ',"props":' || props AS body FROM events)""",
    "pool": """
      SELECT s.service_request_id, s.summary, s.summary_source, r.triage_result AS tri_obj,
        m.policy_title, m.target_theme, m.source_url, m.cosine_distance,
        m.service_request_id IS NOT NULL AS policy_matched
      FROM summarised s
        LEFT JOIN triage r ON r.service_request_id = s.service_request_id
        LEFT JOIN text_matches m ON m.service_request_id = s.service_request_id""",
    "parsed_pool": f"""
      SELECT service_request_id, summary, summary_source, {theme_field('tri_obj')} AS theme,
        {severity_case(severity_field('tri_obj'))} AS severity,
        {action_field('tri_obj')} AS suggested_action, policy_matched, policy_title, target_theme,
        source_url, cosine_distance FROM pool""",
    "literal_policies": "SELECT * FROM (VALUES "
    + ", ".join("(" + _list(row) + ")" for row in fv.POLICIES)
    + ") v(policy_id, title, chunk_text, source_url, target_theme)",
    "literal_labels": "SELECT * FROM (VALUES "
    + ", ".join(f"({text(label)})" for label in fv.LABELS)
    + ") v(label_value)",
    "literal_buckets": bucket_counts("literal_policies", "policy_id", "chunk_text"),
    "document_buckets": bucket_counts("documents", "doc_id", "text"),
    "nearest_literal": "SELECT policy_id, count(*) AS n_documents FROM ("
    + ranked_cosine("document_buckets", "literal_buckets", "doc_id", "policy_id", "bucket", 1)
    + ") GROUP BY policy_id",
    "titled": r"""
      SELECT doc_id, text, title FROM documents LEFT JOIN (SELECT page_id,
        nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages)
        ON doc_id = page_id""",
    "document_tokens": f"""
      SELECT doc_id, w, count(*) AS n FROM (
        SELECT doc_id, unnest({words('text')}) AS w FROM documents) GROUP BY ALL""",
    "item_tokens": f"""
      SELECT item_id, w, count(*) AS n FROM (
        SELECT item_id::VARCHAR AS item_id, unnest({words('text')}) AS w FROM benchmark)
      GROUP BY ALL""",
}

_MEASURED = (
    "length({0}) || ' characters' AS result, "
    "CASE WHEN length({0}) > 200 THEN 'long' ELSE 'short' END AS status"
)

# --- queries ----------------------------------------------------------------

SELECTS: dict[str, str] = {
    "cases_norm": "SELECT * FROM norm_cases",
    "clean_text": "SELECT * FROM cleaned",
    "text_quality": "SELECT * FROM quality",
    "image_candidates": "SELECT * FROM candidates_media",
    "stratified_cohort": f"""
      SELECT service_request_id, stratum FROM (
        SELECT *, row_number() OVER (PARTITION BY stratum
          ORDER BY md5('{b.SEED}:' || service_request_id), service_request_id) AS rn FROM strata)
      WHERE rn <= {b.COHORT_SIZE}""",
    "fallback_ids": "SELECT * FROM fallback",
    "text_source": "SELECT * FROM texts",
    "download_manifest": """
      SELECT service_request_id, media_url, 'images/' || service_request_id || '.jpg' AS object_key
      FROM candidates_media JOIN cohort USING (service_request_id)""",
    "media_object_lookup": "SELECT * FROM looked_up",
    "media_todo_url": """
      SELECT service_request_id, media_url AS url FROM candidates_media
        JOIN fallback USING (service_request_id)
      WHERE service_request_id NOT IN (SELECT service_request_id FROM photo_summaries)""",
    "media_todo_objects": """
      SELECT service_request_id, min(uri) AS uri FROM looked_up
      WHERE service_request_id NOT IN (SELECT service_request_id FROM photo_summaries)
      GROUP BY service_request_id""",
    "incremental_todo": """
      SELECT s.* FROM summarised s LEFT JOIN refined_before e USING (service_request_id)
      WHERE s.summary IS NOT NULL AND e.service_request_id IS NULL""",
    "case_summaries": "SELECT * FROM summarised",
    "build_prompt": f"""
      SELECT service_request_id,
        {stated(fv.TRIAGE_PROMPT, summary='summary', themes=text(' | '.join(fv.PROMPT_THEMES)),
                id='service_request_id')} AS triage_prompt,
        {stated(fv.EMBED_TEXT, theme='theme', summary='summary')} AS embed_content,
        {stated(fv.REFINE_PROMPT, title='policy_title', snippet='policy_snippet',
                summary='summary', action='original_action')} AS refine_prompt
      FROM to_refine WHERE summary IS NOT NULL""",
    "triage_rules": f"""
      SELECT service_request_id, summary, summary_source,
        '{{"theme":"' || {theme_of('summary')} || '","severity":"' ||
        CASE WHEN length(summary) > 150 THEN 'high' WHEN length(summary) > 60 THEN 'medium'
          ELSE 'low' END || '","suggested_action":"Check ' || summary_source || ' case now."}}'
        AS triage_result, '' AS status FROM summarised WHERE summary IS NOT NULL""",
    "prompt_dedup": f"""
      SELECT conv_id, turn, sha256(text) AS prompt_hash, {_MEASURED.format('text')}
      FROM conversations""",
    "prompt_dedup_hot": f"""
      SELECT event_id, event_type, sha256(p) AS prompt_hash, {_MEASURED.format('p')}
      FROM (SELECT *, 'Event: ' || event_type AS p FROM events)""",
    "outcome_counts": "SELECT status, count(*) AS n FROM triage GROUP BY status",
    "json_extract": f"""
      SELECT event_id, {theme_field('triage_result')} AS theme,
        {severity_field('triage_result')} AS severity, {action_field('triage_result')} AS action
      FROM event_answers""",
    "severity_normalise": f"""
      SELECT event_id, {severity_case(severity_field('triage_result'))} AS severity
      FROM event_answers""",
    "validate_json": """
      SELECT count_if(triage_result IS NULL)::BIGINT AS bad_json_rows,
        count_if(NOT json_valid(triage_result))::BIGINT AS malformed_rows,
        count(*) AS total_rows FROM event_answers""",
    "policy_chunks": """
      SELECT p.*, coalesce(n_documents, 0) AS n_documents
      FROM literal_policies p LEFT JOIN nearest_literal USING (policy_id)""",
    "label_taxonomy": """
      SELECT label_value, coalesce(n_documents, 0)::BIGINT AS n_documents FROM literal_labels
        LEFT JOIN (SELECT target_theme, sum(n_documents) AS n_documents FROM nearest_literal
          JOIN literal_policies USING (policy_id) GROUP BY target_theme)
        ON label_value = target_theme""",
    "theme_validation": """
      SELECT CAST(d.doc_id AS VARCHAR) AS policy_id, lang AS title, source AS target_theme,
        CASE WHEN label_value IS NULL THEN 'missing_in_taxonomy' ELSE 'ok' END AS theme_status
      FROM documents d LEFT JOIN (SELECT DISTINCT upper(source) AS label_value FROM documents
        JOIN labels USING (doc_id) WHERE quality = 0 AND toxic = 1)
        ON lower(source) = lower(label_value)""",
    "normalise_chunks": f"SELECT policy_id, {trimmed('lower(chunk_text)')} AS content FROM policies",
    "policy_catalog": f"""
      SELECT policy_id, title, source_url, target_theme, {trimmed('lower(chunk_text)')} AS content,
        (SELECT array_to_string(list(coalesce(n, 0) ORDER BY i), ',')
         FROM range(64) r(i) LEFT JOIN policy_buckets k
           ON k.bucket = i AND k.policy_id = p.policy_id) AS embedding FROM policies p""",
    "embed_hashed": "SELECT doc_id, bucket, n FROM document_buckets",
    "vector_topk": "SELECT * FROM given_candidates",
    "vector_topk_indexed": "SELECT * FROM given_candidates",
    "sparse_topk": "SELECT doc_id, item_id, distance FROM ("
    + ranked_cosine("document_tokens", "item_tokens", "doc_id", "item_id", "w", 5)
    + ")",
    "best_match_precise": "SELECT * FROM given_precise",
    "unmatched_cases": """
      SELECT service_request_id, policy_id, cosine_distance FROM given_candidates
      WHERE service_request_id NOT IN (SELECT service_request_id FROM given_precise)""",
    "best_match_global": "SELECT * FROM given_global",
    "tiered_match": "SELECT * FROM given_matches",
    "case_matches": "SELECT * FROM text_matches",
    "refine_prep": "SELECT * FROM to_refine",
    "refine_prep_fused": "SELECT * FROM to_refine",
    "work_batch": "SELECT * FROM to_refine ORDER BY service_request_id LIMIT 200",
    "alignment_flag": """
      SELECT doc_id, title,
        CASE WHEN contains(lower(text), lower(string_split(title, ' ')[1])) THEN 'aligned'
          ELSE 'review' END AS alignment
      FROM titled""",
    "alignment_regex": """
      SELECT doc_id, pattern AS title,
        CASE WHEN coalesce(
            TRY(regexp_matches(lower(text), lower(string_split(pattern, ' ')[1]))),
            TRY(regexp_matches(lower(text), regexp_replace(lower(string_split(pattern, ' ')[1]), '([*+?}])\\+', '\\1', 'g')))
          ) THEN 'aligned'
          ELSE 'review' END AS alignment
      FROM (SELECT *, CASE doc_id % 4 WHEN 0 THEN '(' || title
          WHEN 1 THEN regexp_replace(title, '[aeiou]', '.', 'g') ELSE title END AS pattern
        FROM titled)""",
    "review_examples": """
      SELECT service_request_id, theme, severity, policy_title, source_url,
        original_action AS before_action, refined_action AS after_action, alignment
      FROM refined WHERE alignment = 'review' ORDER BY service_request_id""",
    "share_of_total": """
      SELECT alignment, count(*) AS ct, round(100 * count(*) / sum(count(*)) OVER (), 1) AS pct
      FROM refined GROUP BY alignment ORDER BY ct DESC""",
    "proto_pool": "SELECT * FROM pool",
    "proto_pool_parsed": "SELECT * FROM parsed_pool",
    "best_pool_topk": """
      SELECT * FROM parsed_pool WHERE summary IS NOT NULL
      ORDER BY policy_matched DESC, cosine_distance ASC NULLS LAST, service_request_id LIMIT 1000""",
    "full_cohort": "SELECT * FROM parsed_pool WHERE summary_source IN ('text', 'image')",
    "cohort_match_rate": " UNION ALL ".join(
        f"SELECT {text(label)} AS cohort, count(*) AS total, "
        f"count_if(policy_matched)::BIGINT AS matched, "
        f"count_if(policy_matched) / nullif(count(*), 0) AS match_rate FROM pool WHERE {where}"
        for label, where in (
            (fv.TEXT_COHORT, "summary_source = 'text'"),
            (fv.ALL_COHORT, "summary_source IN ('text', 'image')"),
        )
    ),
    "row_count_audit": " UNION ALL ".join(
        f"SELECT {text(name)} AS name, count(*) AS n FROM {dataset}"
        for name, dataset in (
            ("01_cases_norm", "norm_cases"),
            ("02_cases_for_classify", "cleaned"),
            ("03_cases_text_quality", "quality"),
            ("04_batch_ids", "cohort"),
            ("05_batch_case_summaries", "summarised"),
            ("06_batch_triage_raw", "triage"),
            ("07_policy_chunks", "policies"),
            ("08_policy_embeddings", "policies"),
            ("09_case_query_embeddings", "searched"),
            ("10_batch_policy_matches", "text_matches"),
            ("11_batch_triage_policy_refined", "refined"),
        )
    ),
}


def _mentioned(sql: str) -> set[str]:
    return {name for name in DATASETS if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql)}


SELECTS["share_of_total_of_runs"] = SELECTS["share_of_total"]
SELECTS["match_rate_of_runs"] = SELECTS["cohort_match_rate"]


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, select in SELECTS.items():
        needed, frontier = set(), _mentioned(select)
        while frontier:
            needed |= frontier
            frontier = {d for n in frontier for d in _mentioned(DATASETS[n])} - needed
        ctes = ", ".join(f"{n} AS ({DATASETS[n]})" for n in DATASETS if n in needed)
        out[key] = f"WITH {ctes} {select}" if ctes else select
    return out
