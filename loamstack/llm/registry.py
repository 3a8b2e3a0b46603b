"""Queries of the training-data operators, by module."""

from __future__ import annotations

from loamstack.llm import q_documents, q_files

QUERIES = q_files.QUERIES | q_documents.QUERIES
ORACLE = q_files.ORACLE | q_documents.ORACLE
