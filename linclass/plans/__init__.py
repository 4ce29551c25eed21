"""Plans: the jobs (load -> check -> split -> fit -> score -> evaluate -> report), the
catalogue of named queries with their SQL oracles, and a thin command-line main."""
