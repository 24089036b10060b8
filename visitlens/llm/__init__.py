"""Training-data operators: de-duplication, sharding, privacy, quality, tokenising, packing.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` queries over the ``documents`` table and
``oracle`` their SQL twins where SQL can express them. Nothing outside this
package imports it, except the guarded import in ``__spark_entry__.py`` and
``corpus_pipeline.py``.
"""
