"""Operators of a training-data pipeline over documents and web pages.

Each module holds one operator; ``queries`` registers them. Nothing outside
this folder imports it.
"""
