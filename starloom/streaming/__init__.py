"""Incremental loading of arriving feed files.

There are no windowed or stateful stream operators here. A stream only decides which
files are new; every micro-batch runs the batch operators.
"""
