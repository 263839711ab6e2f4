"""Column functions; all of them stay inside the JVM unless the text says otherwise."""
