"""Relational operators of the pipeline, each a DataFrame -> DataFrame
function built from joins, aggregates and windows."""
