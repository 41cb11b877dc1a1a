"""Operators for training data: search, language, packing, language models, leaks, toxicity, shards, token files,
licences and near duplicates.  Nothing outside this folder imports it.
"""
