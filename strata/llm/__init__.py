"""Training-data operators: deduplication, decontamination, toxicity,
tokenised output, packing and sharding.

Nothing else in the library imports this subpackage.  Every operator takes a
DataFrame and names of its id and text columns, returns a DataFrame, and
leaves all partitioning and shuffling to Spark; numpy only works inside tasks.
"""
