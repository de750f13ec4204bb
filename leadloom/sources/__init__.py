"""Entity schemas and readers."""

from .provided import ENTITIES, Entities, view_sql
from .reader import conform, read_entity, write_entity, write_report
from .schemas import SCHEMAS

__all__ = ["ENTITIES", "SCHEMAS", "Entities", "conform", "read_entity", "view_sql", "write_entity", "write_report"]
