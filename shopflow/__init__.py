"""shopflow: retail sales analytics written as Spark DataFrame jobs.

Raw sales, customers, catalogue, reviews, activity log and stock are read
with fixed schemas, cleansed, integrated into one wide sales table and
summarised into business KPIs, data-quality reports, nested documents and
micro-batch stream summaries.  Every function takes and returns DataFrames;
nothing is collected to the driver.
"""

__version__ = "0.1.0"
