"""Column-expression factories (JVM-side, codegen-friendly; no Python UDFs)."""
