"""Domain operators: reports, admission, ingest, grading, postings, audits."""
