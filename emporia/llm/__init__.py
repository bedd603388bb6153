"""Training-data operators: thirteen corpus jobs and their registered queries (``llm/queries.py``)."""
