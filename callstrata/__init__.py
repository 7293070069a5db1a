"""callstrata: an archive of third-party API call events, as Spark jobs.

Events land as JSON messages; a redacted copy goes to a hot columnar table and
the raw payloads to a cold dataset. Panels, alerts, rollups and lookups read
the hot table with DataFrames.
"""
