"""earshot: listening analytics as Spark jobs.

Raw play events come in through :mod:`earshot.sources` or
:mod:`earshot.streaming`, :mod:`earshot.operators` turns them into cleaned,
aggregated, ranked and scored tables, and :mod:`earshot.functions` holds the
column expressions those operators (and their users) are written with.
"""
