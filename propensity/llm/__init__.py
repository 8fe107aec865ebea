"""Training-data operators: ten corpus operations, their registered queries and SQL."""
