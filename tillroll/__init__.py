"""tillroll — retail and e-commerce analytics expressed as Spark DataFrame jobs.

Every operator takes a :class:`tillroll.sources.bind.Tables` (the ten retail
tables bound to Parquet) and returns a lazy DataFrame; nothing is collected.
"""

from tillroll.sources.bind import AS_OF, Tables

__all__ = ["AS_OF", "Tables"]
