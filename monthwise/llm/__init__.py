"""Operations of a training-data pipeline, one module per operator.

Each module holds the operator with its own general interface and, at its
end, the thin ``opN_<name>`` query over the given tables.  ``entries.py``
collects the queries.  Nothing outside this folder imports it, but for
``corpus_pipeline.py`` and the guarded import in ``__spark_entry__.py``.
"""
