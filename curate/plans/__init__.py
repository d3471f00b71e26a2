"""Flows built from the operators.

``silver``   dimensions, the single-pass fact curation, summaries, report
``bronze``   archive extraction with a manifest and report
``run``      end to end (also ``python -m curate.plans.run``)
``steplog``, ``report``, ``sinks``   step log, report fold, table/report sinks
``catalogue`` / ``catalogue_io``     the registered queries and their SQL oracles
``fixtures``, ``oracle``, ``verify``, ``explain``   test inputs, oracle SQL, checks, plan dumps
"""
