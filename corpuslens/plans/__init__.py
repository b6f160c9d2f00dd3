"""Sub-plans shared by several operators: ranks, histograms, report slices."""
