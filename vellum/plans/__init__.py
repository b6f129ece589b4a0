"""All registered queries of the engine's own operators."""

from vellum.plans import documents, files, layouts, lines, registry_tables, relational, rules, services, texts
from vellum.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "documents", "files", "layouts", "lines", "registry_tables", "relational", "rules", "services", "texts"]
