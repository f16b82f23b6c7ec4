"""Registered queries over the given tables; the last module builds on the SQL of the others."""

from locuslens.plans import locus_queries, manifest_queries, signal_queries  # noqa: F401, I001
from locuslens.plans import file_queries  # noqa: F401
