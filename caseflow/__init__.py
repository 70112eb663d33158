"""caseflow: patient timelines to training and evaluation data sets, on Spark.

DataFrame in, DataFrame out.  Nothing here holds data; every function declares
a plan and leaves the physical strategy to Catalyst.
"""
