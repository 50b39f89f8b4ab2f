"""Spark jobs for the data work of an association-loci study.

Every public function takes and returns Spark DataFrames or Columns.  The
work stays inside Catalyst expressions, joins, aggregates and windows; see
``scale.py`` for the rules about sizes, skew and lineage.
"""

__version__ = "0.1.0"
