"""finwater: statement analytics jobs on Spark.

Jobs: ``plans.client_financials`` (cohort waterfall report),
``plans.rep_load`` (typed CSV drop load), ``operators.columns`` (column
finder), ``streaming.drop_loader`` (incremental drop folder load).
"""

__version__ = "0.1.0"
