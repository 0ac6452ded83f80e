"""Operators for training-data pipelines. Nothing outside this folder imports it, except the guarded entry module."""
