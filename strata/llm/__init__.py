"""Training-data operators: thirteen numbered operators and the queries that apply them.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries only
when it is present.
"""
