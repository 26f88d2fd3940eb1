"""Schemas of the records that the operators exchange, as DDL. Read with these; nothing is inferred."""

from __future__ import annotations

#: A publication. `seq` is the order of arrival, the last tie-break everywhere.
PAPER = ("seq long, source string, title string, authors string, link string, abstract string, images array<string>, date timestamp, doi string")
#: A publication as candidate files hold it: the date is text, the DOI may be absent.
PAPER_JSON = ("source string, title string, authors string, link string, abstract string, images array<string>, date string, doi string")
TRAINING_DOC = ("title string, url string, section string, text string, weight double, source_file string")
TERM_ROW = ("doc_id string, term string, tf long")
FEEDBACK = ("papers array<struct<title:string,summary:string,source:string,link:string,upvotes:long,downvotes:long>>")
DECISION = (
    "run_date string, week string, label string, classifier_reason string, classifier_threshold long, classifier_score long, classifier_category string, classifier_explanation string, "
    "initial_classifier_score long, initial_classifier_category string, initial_classifier_explanation string, recall_classifier_score long, recall_classifier_category string, "
    "recall_classifier_explanation string, score_policy string, local_score double, source string, date string, title string, authors string, link string, doi string, abstract string, summary string"
)
FINAL_DECISION = ("run_date string, week string, label string, selected_section string, training_weight double, source string, title string, authors string, link string, doi string, abstract string")
SIDECAR = ("title string, link string, source string, date string")
EUROPEPMC = (
    "id string, source string, doi string, title string, authorString string, firstPublicationDate string, electronicPublicationDate string, abstractText string, "
    "pubTypeList struct<pubType:array<string>>, journalInfo struct<printPublicationDate:string>, authorList struct<author:array<struct<fullName:string>>>"
)
_PARTS = "struct<`date-parts`:array<array<int>>>"
CROSSREF = (
    "DOI string, URL string, title array<string>, abstract string, author array<struct<given:string,family:string,ORCID:string>>, "
    + ", ".join(f"`{k}` {_PARTS}" for k in ("published", "published-online", "published-print", "posted", "issued", "created", "deposited", "indexed"))
)
BIORXIV = ("doi string, title string, authors string, date string, version string, category string, abstract string")
