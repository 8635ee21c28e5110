"""Operators of a training-data pipeline over ``documents``.

Each module holds one operator with a general interface and its registered
query; ``queries.REGISTRY`` collects the queries.  Nothing outside this
package imports it, apart from the guarded hook in ``__spark_entry__.py``.
"""
