"""Training-data operators: dedup, tokenising, packing, extraction, sharding, filtering, mixing.

One module per operator; ``registry`` binds them to the test tables and
``oracle`` holds the DuckDB SQL of those that SQL can express. Nothing
outside this package imports it except ``__spark_entry__`` and
``corpus_pipeline``.
"""
