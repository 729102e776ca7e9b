"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage. Modules: license_scan, chat_format, pii,
pieces, decontaminate, toxicity, simhash, secrets, url_filter, topk; queries registers one query
for each of them.
"""
