"""Operators for training-data pipelines: dedup, packing, scoring, search, tokenizers.

Nothing outside this subpackage imports it.  Shared conventions:

* texts may be null (treated as empty unless an operator says otherwise), ids may be null or repeated;
* an operator reads only the columns named in its arguments, so extra or clashing columns never matter;
* intermediate tables that cut lineage live under ``spark.checkpoint.dir`` (see ``scratch``).
"""
