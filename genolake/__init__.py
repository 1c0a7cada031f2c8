"""genolake: variant (VCF) analytics on Spark DataFrames.

Modules are grouped by role:

* ``sources``   - resolve and scan VCF text, header tables, fixture VCF.
* ``functions`` - column expressions (parse, region overlap, allele rules).
* ``operators`` - DataFrame -> DataFrame building blocks (flatten, split,
  joins, ordinals, aggregates, quality checks, comparisons).
* ``plans``     - whole jobs: summary, shard, table load, export, inventory.
* ``streaming`` - incremental pick-up of newly written shards.
"""

__version__ = "0.1.0"
