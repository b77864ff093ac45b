"""Fixed values that results must show, written out once more apart from the library's own tables, so that a wrong
entry there is found. Each is a condition or a CASE over an SQL expression."""

# Source type numbers.
TYPE_OF_NUMBER = """
    WHEN {0} = 16 THEN 'BOOL'
    WHEN {0} = 17 THEN 'BYTES'
    WHEN {0} IN (20, 21, 23) THEN 'INT64'
    WHEN {0} IN (25, 1042, 1043, 2950) THEN 'STRING'
    WHEN {0} IN (114, 3802) THEN 'JSON'
    WHEN {0} IN (700, 701) THEN 'FLOAT64'
    WHEN {0} = 1082 THEN 'DATE'
    WHEN {0} IN (1114, 1184) THEN 'TIMESTAMP'
    WHEN {0} = 1700 THEN 'NUMERIC'
"""
ITEM_OF_NUMBER = """
    WHEN {0} = 1000 THEN 'BOOL'
    WHEN {0} = 1001 THEN 'BYTES'
    WHEN {0} IN (1005, 1007, 1016) THEN 'INT64'
    WHEN {0} IN (1009, 1015, 2951) THEN 'STRING'
    WHEN {0} IN (199, 3807) THEN 'JSON'
    WHEN {0} IN (1021, 1022) THEN 'FLOAT64'
    WHEN {0} = 1182 THEN 'DATE'
    WHEN {0} IN (1115, 1185) THEN 'TIMESTAMP'
    WHEN {0} = 1231 THEN 'NUMERIC'
"""

# Source type names.
TYPE_OF_NAME = """
    WHEN {0} IN ('boolean', 'bool') THEN 'BOOL'
    WHEN {0} IN ('smallint', 'integer', 'int', 'bigint', 'bigserial') THEN 'INT64'
    WHEN {0} IN ('real', 'double precision') THEN 'FLOAT64'
    WHEN {0} IN ('numeric', 'decimal') THEN 'NUMERIC'
    WHEN {0} IN ('text', 'character varying', 'character', 'varchar', 'char', 'uuid') THEN 'STRING'
    WHEN {0} IN ('timestamp without time zone', 'timestamp with time zone') THEN 'TIMESTAMP'
    WHEN {0} = 'date' THEN 'DATE'
    WHEN {0} IN ('json', 'jsonb') THEN 'JSON'
    WHEN {0} = 'bytea' THEN 'BYTES'
"""

# Destination types; those not listed have the canonical name.
TO_DESTINATION = """
    WHEN {0} = 'INT64' THEN 'INTEGER'
    WHEN {0} = 'FLOAT64' THEN 'FLOAT'
    WHEN {0} = 'BOOL' THEN 'BOOLEAN'
    WHEN {0} IN ('STRING', 'NUMERIC', 'TIMESTAMP', 'DATE', 'JSON', 'BYTES') THEN {0}
"""
FROM_DESTINATION = """
    WHEN {0} = 'INTEGER' THEN 'INT64'
    WHEN {0} = 'FLOAT' THEN 'FLOAT64'
    WHEN {0} = 'BOOLEAN' THEN 'BOOL'
    WHEN {0} IN ('STRING', 'NUMERIC', 'TIMESTAMP', 'DATE', 'JSON', 'BYTES') THEN {0}
"""

# Safe widenings, from the destination's type to the source's.
WIDENINGS = """
    ('BOOL', 'STRING'), ('DATE', 'STRING'), ('DATE', 'TIMESTAMP'), ('FLOAT64', 'NUMERIC'), ('FLOAT64', 'STRING'),
    ('INT64', 'FLOAT64'), ('INT64', 'NUMERIC'), ('INT64', 'STRING'), ('NUMERIC', 'STRING'), ('TIMESTAMP', 'STRING')
"""

# Error classes, as patterns over a lower-case message.
FATAL = (
    "authentication|permission denied|access denied|invalid credentials|unauthorized|forbidden|"
    "incompatible schema|incompatible type"
)
RETRYABLE = (
    "connection refused|connection reset|timeout|deadline exceeded|temporary failure|too many requests|rate limit|"
    "quota exceeded|service unavailable|server busy|i/o timeout|broken pipe|eof"
)
