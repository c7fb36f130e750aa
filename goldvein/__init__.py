"""goldvein: a Spark-native medallion pipeline for contact and event data.

Bronze union of contact sources, silver cleansing / scoring / golden-record
resolution with incremental merge, a gold star-schema fact with RFM features,
statistical and text enrichment, fuzzy-duplicate search, masking, row-level
filters, audit logging and data-quality rules. Everything is expressed with
DataFrames and built-in functions so Catalyst plans it.
"""

__version__ = "0.1.0"
