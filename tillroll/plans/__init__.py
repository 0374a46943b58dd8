"""Plans: the sales model over the benchmark tables, its SQL oracle, the
registered queries and the batch job."""
