"""DataFrame operators. None of them runs a job: each takes DataFrames and returns DataFrames."""
