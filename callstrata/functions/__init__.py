"""Column expressions and the one Python UDF (payload redaction)."""
