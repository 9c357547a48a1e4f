"""ledgerloom: multi-channel sales and royalty analytics as Spark jobs.

Everything is a function from DataFrames to a DataFrame.  ``functions`` holds
column expressions, ``sources`` reads and writes files, ``operators`` holds the
table transforms, ``plans`` composes them into channel jobs and registered
queries, ``streaming`` runs the same transforms over a landing folder.
"""
