"""Plans: the whole settlement job (`job`), and the registered queries with
their DuckDB oracle SQL (`queries`, `oracle`) used by the driver contract."""
