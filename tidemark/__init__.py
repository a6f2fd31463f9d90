"""Sales analytics over change data, as Spark jobs.

Change events and CSV extracts of products, orders and order items become
current-state tables; one definition of the sales metrics serves the full batch
job, the incremental job and the streaming job.
"""
