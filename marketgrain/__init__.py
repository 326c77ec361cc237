"""Retail analytics as plain PySpark DataFrame operators.

``sources``    file drops, validated ingest, typed publication, sinks
``functions``  column expressions
``operators``  relation-to-relation building blocks
``plans``      complete analyses assembled from the operators
``parity``     the analyses wired to the test tables, with SQL oracles
"""
