"""Column expressions shared by the jobs; all stay inside the JVM."""
