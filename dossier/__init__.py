"""Incremental, cited text profiles built from notes with PySpark DataFrames.

Every public function takes and returns DataFrames or Columns.  Values that belong to the
caller (rules, budgets, cut-off times, "now") are arguments, so a plan gives the same rows on
every run and every retry.
"""
