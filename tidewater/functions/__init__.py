"""Column helpers that add semantics Spark built-ins lack."""
