"""kessan: statement marts, accrual inputs and labelled sets from filing facts, on Spark.

Every operator is a plain function from DataFrame to DataFrame built on Spark's own
expressions; a corpus of filings is one ``facts`` table, not one file per step.
"""

__version__ = "0.1.0"
