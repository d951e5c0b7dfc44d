"""Operators for large training corpora: language, secrets, shards, repeats, neighbours, tokens, mixes, copies, leaks, urls."""
