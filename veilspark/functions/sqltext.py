"""Which names a query text mentions (K12): a scanner as one regular expression.

Literals and comments are matched as wholes, so what looks like a name inside them is none,
and a quote or two dashes inside one of the others don't begin anything. A name is its
dotted parts, quoted or not; unquoted parts are upper-cased, quoted ones keep their case.
It finds names; it is no parser of statements.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PART = r'(?:"(?:[^"]|"")*"|[A-Za-z_][A-Za-z0-9_$]*)'
NAME = rf"{_PART}(?:\s*\.\s*(?:{_PART}|\*))*"
#: literals, comments, names, stars; in this order at every place
SIGNS = rf"'(?:[^']|'')*'|--[^\n]*|/\*[\s\S]*?\*/|{NAME}|\*"

# Words after which a table's name stands, and the event types of first words.
TABLE_WORDS = ("FROM", "JOIN", "INTO", "UPDATE", "TABLE", "EXISTS")
NO_TABLES = ("SELECT", "IF", "SET", "NOT", "*")
EVENT_TYPES = (
    ("INSERT", "DML_INSERT"), ("MERGE", "DML_UPDATE"), ("UPDATE", "DML_UPDATE"), ("DELETE", "DML_DELETE"),
    ("CREATE", "DDL_CREATE"), ("ALTER", "DDL_ALTER"), ("DROP", "DDL_DROP"), ("GRANT", "ROLE_GRANT"), ("REVOKE", "ROLE_REVOKE"),
)


def names(text: Column) -> Column:
    """array<array<string>>: the parts of every name of a text, in order (a star is a name or a last part)."""
    signs = F.regexp_extract_all(text, F.lit(SIGNS), F.lit(0))
    kept = F.filter(signs, lambda s: ~(s.startswith("'") | s.startswith("--") | s.startswith("/*")))

    def part(p: Column) -> Column:
        inner = F.replace(F.substring(p, F.lit(2), F.length(p) - 2), F.lit('""'), F.lit('"'))
        return F.when(p.startswith('"'), inner).otherwise(F.upper(p))

    split = lambda s: F.regexp_extract_all(s, F.lit(rf"{_PART}|\*"), F.lit(0))
    return F.transform(kept, lambda s: F.transform(split(s), part))


def event_type(found: Column) -> Column:
    """The audit event type by the first word of the names (null: a read, which is no audit event)."""
    first = F.get(F.get(found, F.lit(0)), F.lit(0))
    out = F.lit(None).cast("string")
    for word, kind in EVENT_TYPES:
        out = F.when(first == word, kind).otherwise(out)
    return out


def tables(found: Column, database: Column, schema: Column) -> Column:
    """array<struct(database, schema, table)>: names that follow a table word; missing parts are the session's."""
    word = lambda i: F.element_at(F.get(found, i - 1), 1)
    one = lambda i: F.size(F.get(found, i - 1)) == 1
    after = F.filter(F.transform(found, lambda n, i: F.when(
        (i > 0) & one(i) & word(i).isin(*TABLE_WORDS) & ~F.element_at(n, 1).isin(*NO_TABLES), n)), lambda n: n.isNotNull())

    def full(n: Column) -> Column:
        k = F.size(n)
        return F.struct(F.when(k >= 3, F.get(n, k - 3)).otherwise(database).alias("database_name"),
                        F.when(k >= 2, F.get(n, k - 2)).otherwise(schema).alias("schema_name"),
                        F.get(n, k - 1).alias("table_name"))

    return F.array_distinct(F.transform(after, full))


def columns_named(found: Column, columns: Column) -> Column:
    """Those of a table's (upper-case) columns that a text names: as the last part of a name, or all of them by a
    star after SELECT, DISTINCT or ALL or after a dot (COUNT(*) and products name none)."""
    lasts = F.transform(found, lambda n: F.upper(F.element_at(n, -1)))
    opens = lambda i: F.element_at(F.get(found, i - 1), 1).isin("SELECT", "DISTINCT", "ALL")
    stars = F.filter(F.transform(found, lambda n, i: (F.element_at(n, -1) == "*") & (
        (F.size(n) > 1) | F.coalesce(F.when(i > 0, opens(i)), F.lit(False)))), lambda x: x)
    return F.array_sort(F.when(F.size(stars) > 0, columns).otherwise(F.array_intersect(columns, lasts)))


def literals_of(text: Column, column: str) -> Column:
    """Text literals that a column is compared with by = or IN."""
    lists = F.regexp_extract_all(text, F.lit(rf"(?i)\b{column}\b\"?\s*(?:=|in\s*\()\s*('(?:[^']|'')*'(?:\s*,\s*'(?:[^']|'')*')*)"), F.lit(1))
    return F.array_distinct(F.transform(F.flatten(F.transform(
        lists, lambda x: F.regexp_extract_all(x, F.lit(r"'((?:[^']|'')*)'"), F.lit(1)))), lambda x: F.replace(x, F.lit("''"), F.lit("'"))))
