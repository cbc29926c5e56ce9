"""broadsheet: news and social text, from raw feed to scored and monitored tables, on Spark."""
