"""Site-expansion analytics as Spark DataFrame jobs.

Sub-packages
------------
``sources``    readers, key tables, loaders, sinks
``functions``  Column expressions (text, geography, arithmetic, model transforms)
``operators``  reusable DataFrame operators (spatial joins, ranks, selection, metrics, quality)
``plans``      the jobs built from them (supply, panel, models, scoring, portfolio, facts)
"""
