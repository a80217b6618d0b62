"""Batch analytics jobs for a sell-in / sell-out retail data mart, written for Spark.

Every job is a plain function from DataFrames to a DataFrame:

* ``dispensa.plans.projection`` - panel-to-universe projection factors
* ``dispensa.plans.sellout``    - monthly sell-out mart and top-N reports
* ``dispensa.plans.calendar``   - date dimension, holidays, fiscal years, month periods
* ``dispensa.plans.gate``       - data-quality gate of a load against a comparable one
* ``dispensa.plans.feed``       - shredding of JSON feeds into a fact table
"""
