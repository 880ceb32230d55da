"""quayside: a Spark-native loader for headered CSV arriving in a raw zone.

Files are discovered (batch, file stream or arrival notifications), given
load time and source lineage, keyed (the file's ``id`` or a content hash),
checked for a key, deduplicated, mapped to string columns and written as one
batch of a keyed table, with an audit row whose counts add up.
"""

__version__ = "0.1.0"
