"""Training-data pipeline operators (queries in ``parcelle.llm.queries``).

Nothing outside this folder imports it.
"""
