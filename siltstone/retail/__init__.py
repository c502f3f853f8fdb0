"""The retail orders model: schemas, tables, curation functions, jobs and reports."""
