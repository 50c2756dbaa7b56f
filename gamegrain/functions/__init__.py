"""Column macros: plain functions from columns to columns, all inside the JVM except ``text.fold_ascii_udf``."""
