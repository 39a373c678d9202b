"""Schemas of the tables; text at rest is string and blank means missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


DB = strings("paper_id title authors year venue doi url dblp_id")
ENRICHED = strings("paper_id arxiv_id s2_paper_id title authors year venue abstract source categories citation_count url doi published_date crawled_date keep notes")
SCORED = T.StructType([*ENRICHED.fields, T.StructField("relevance_score", T.LongType()), T.StructField("matched_keywords", T.StringType()), T.StructField("relevance", T.StringType())])
DRAFT = "file string, title string, authors string, year int, venue string, doi string, url string, abstract string, citation_count string, relevance_score string, relevance string, matched_keywords string, body_text string, text_length int, csv_matched boolean, extraction_status string"
STATUS = "stage string, job_name string, state string, pid int, started_at_unix double, finished_at_unix double, elapsed_sec double, timeout_sec int, returncode int, stdout_tail string, stderr_tail string, cwd string, command array<string>"
REVIEW = "review_target struct<analysis_json_path:string,paper_json_path:string,analysis_title:string,paper_title:string,resolved_paper_by:string>, overall_verdict string, ready_for_proposal_use boolean, confidence string, summary string, checks struct<schema:string,metadata:string,evidence_quotes:string,semantic_grounding:string,taxonomy_mapping:string,numeric_claims:string>, field_reviews array<struct<field:string,status:string,severity:string,reason:string,paper_evidence:string,suggested_fix:string>>, issues array<struct<severity:string,field:string,problem:string,paper_evidence:string,recommended_action:string>>"
DOSSIER = "title string, authors string, year int, venue string, doi string, research_purpose string, research_significance string, contributions array<struct<point:string,evidence:string>>, theme_primary string, theme_secondary string, workstream_fit string, is_close_baseline_to_cute boolean, key_technique string, key_results string, gap_identified array<struct<gap:string,evidence:string,relevance_to_cute:string>>, proposal_evidence struct<for_state_of_art:string,for_gap:string,for_feasibility:string>, url string"

UNAVAILABLE = "[abstract unavailable]"


def missing_abstract(abstract: Column) -> Column:
    """Null, blank, the placeholder or an error tag."""
    return abstract.isNull() | (abstract == "") | (abstract == UNAVAILABLE) | abstract.startswith("[error:")


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""
