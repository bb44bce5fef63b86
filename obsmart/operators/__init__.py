"""DataFrame operators: calendar, normalisation, rollup, norms, quality, versions."""
