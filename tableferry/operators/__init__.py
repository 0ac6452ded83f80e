"""Layout, load, verification and incremental operators on DataFrames."""
