"""Named jobs. Every job is ``job(t, d) -> DataFrame``: ``t`` maps table names to DataFrames, ``d`` is the ISO run
date. Jobs never read, write or collect anything themselves, so they run unchanged in batch and in micro-batches."""
