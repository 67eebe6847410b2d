"""DataFrame operators: joins, aggregates, reshaping, panel windows, dense series."""
