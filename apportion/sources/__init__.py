"""Sources: file and table readers with pushed columns and predicates, JDBC
scans (one SQL text, hash-predicate or numeric splits), and data set loading
(bound parameters, type normalisation, stored-row ids, uniqueness guard)."""
