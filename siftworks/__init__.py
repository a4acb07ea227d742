"""siftworks: data-quality jobs on Spark DataFrames.

Messy text rows go in; a trustworthy table, a quarantine table whose rows say
why they failed, profiles, reports and KPI views come out.  Every step is a
``DataFrame -> DataFrame`` function made of built-in expressions.
"""
