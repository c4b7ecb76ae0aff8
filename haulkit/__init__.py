"""haulkit: survey catch, CPUE, bycatch and data-quality products as Spark jobs.

Every public function takes and returns DataFrames (or Column expressions) and
leaves physical planning to Catalyst/AQE.  See README.md for the module map.
"""

__version__ = "0.1.0"
