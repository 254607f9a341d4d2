"""The notice tables mapped onto the given test tables, the queries and their SQL."""
