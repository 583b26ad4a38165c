"""Building blocks shared by the reports: cumulative windows, top-k, membership, table merges, behaviour paths."""
