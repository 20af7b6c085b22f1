"""Explicit schemas of the engine's tables, and the rules their rows obey. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINK = "struct<access:string,type:string,url:string>"
CANDIDATES = f"bibcode string, links_data array<{LINK}>, doi array<string>, abstract string, pdf_links array<string>, pdf_sha256 string"
ATTEMPTS = "seq long, timestamp timestamp, bibcode string, url string, final_url string, method string, status string, category string, error string"
MANUAL = "id string, target string, urls array<string>, category string, errors array<string>, updated_at timestamp"
PAGES = "paper string, page int, text string"
EVIDENCE = "struct<page:int,reason:string>"
CLASSIFICATION = f"struct<include:string,basis:array<string>,mission_mentioned:boolean,evidence:array<{EVIDENCE}>>"
RESPONSE = "struct<model:string,request_id:string,input_tokens:bigint,output_tokens:bigint>"
PROVENANCE = "struct<pipeline_version:string,prompt_version:string,prompt_sha256:string,model:string,reasoning_effort:string,request_id:string,input_tokens:bigint,output_tokens:bigint>"
RESULT = f"struct<schema_version:int,bibcode:string,pdf_sha256:string,status:string,classification:{CLASSIFICATION},provenance:{PROVENANCE},errors:array<string>>"
RESULTS = f"seq long, evaluation_key string, id string, bibcode string, pages_sent int, characters_sent long, result {RESULT}"
CASES = "id string, path string, pdf_sha256 string, bibcode string, title string, expected_include string, expected_basis array<string>, evidence_note string, pdf_links array<string>, doi array<string>, label_source string"
WORKS = "doi string, ids struct<pmcid:string>, locations array<struct<is_oa:boolean,pdf_url:string,landing_page_url:string>>"

# Decisions, their bases, and result states.
DECISIONS = ("YES", "NO", "UNCERTAIN")
BASES = ("OBSERVATIONAL_DATA", "SYNTHETIC_OBSERVABLE", "INSTRUMENT_OR_SOFTWARE", "COMPANION_PAPER", "REVIEW")
STATES = ("CLASSIFIED", "PROCESSING_FAILED")


def _found(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules that are broken; a rule that is null holds."""
    return F.filter(F.array(*(F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules)), lambda x: x.isNotNull())


def classification_violations(include: Column, basis: Column, evidence: Column) -> Column:
    """Broken rules of a classification. Evidence on a NO is allowed, as is one item for all tags."""
    other = F.size(F.filter(basis, lambda b: b != "REVIEW"))
    return _found([
        ("decision", ~include.isin(*DECISIONS)),
        ("tag", F.exists(basis, lambda b: ~b.isin(*BASES))),
        ("duplicate", F.size(F.array_distinct(basis)) < F.size(basis)),
        ("no_with_basis", (include == "NO") & (F.size(basis) > 0)),
        ("yes_without_basis", (include == "YES") & (other == 0)),
        ("uncertain_with_basis", (include == "UNCERTAIN") & (other > 0)),
        ("basis_without_evidence", (F.size(basis) > 0) & (F.size(evidence) == 0)),
        ("page", F.exists(evidence, lambda e: e["page"] < 1)),
        ("reason", F.exists(evidence, lambda e: e["reason"] == "")),
    ])


def result_violations(status: Column, has_classification: Column, errors: Column) -> Column:
    return _found([
        ("state", ~status.isin(*STATES)),
        ("classified_without", (status == "CLASSIFIED") & ~has_classification),
        ("failed_with", (status != "CLASSIFIED") & has_classification),
        ("failed_without_error", (status == "PROCESSING_FAILED") & (F.size(errors) == 0)),
        ("blank_error", F.exists(errors, lambda e: F.trim(e) == "")),
    ])
