"""Sources: driver tables, the register views derived from them, dictionaries."""

from panelkit.sources.tables import read_table

__all__ = ["read_table"]
