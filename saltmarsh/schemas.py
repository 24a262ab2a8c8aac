"""Schemas of the relations that operators take and give, as DDL for readers and createDataFrame."""

from __future__ import annotations

_PAPER = "doi string, title string, abstract string, year int, keywords array<string>, authors array<string>, journal string, citation_count bigint, open_access boolean, pmid string"

SEARCH_INTENT = "id string, must_contain array<string>, any_of array<string>"
RAW_PAPER = f"seq bigint, {_PAPER}, source_api string"
UNIQUE_PAPER = f"{_PAPER}, source_apis array<string>"
SCORED_PAPER = f"{_PAPER}, source_apis array<string>, relevance_score int, relevance_reason string, score_confidence string"
LOCATION = "url string, format string, source string, pmcid string"
EXTRACTED = "format string, title string, abstract string, full_text string, sections array<struct<heading:string,text:string>>, pages int"
CHUNK = "chunk_id string, text string, char_start int, char_end int"
COMPOUND = "compound_name string, smiles string, formula string, structural_info string, role string, evidence string, chunk_id string"
MENTION = "seq bigint, paper_id string, doi string, title string, year string, source string, source_format string, source_filepath string, compound_name string, paper_smiles string, paper_formula string, paper_structural_info string"
RESOLUTION = "input_name string, normalized_name string, lookup_status string, strategy string, cid string, resolved_name string, pubchem_canonical_smiles string, pubchem_isomeric_smiles string, iupac_name string"
SMILES_ROW = "cid string, name string, smiles string, type string, heavy_atoms int"
CURATION_RULE = "ord int, candidate_id string, canonical_name string, scope string, subclass string, patterns array<string>, smiles string, identity_note string"
