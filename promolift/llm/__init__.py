"""Operators of a training-data pipeline: tokenisation, mixing, quality rules, near
duplicates, language-model scores, secrets, HTML extraction, licences, toxicity, nearest
neighbours, conversation tries, importance resampling and token files.  Nothing outside this subpackage imports it."""
