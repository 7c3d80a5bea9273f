"""Column functions.  All of them stay on the JVM except `similarity`."""
