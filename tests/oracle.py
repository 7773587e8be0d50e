"""Compare a query with its oracle statement, column by column and row by row."""

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    if isinstance(value, float):
        value = repr(value + 0.0)
    return str(value)


TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def differences(frame, statement, folder):
    """What differs between a DataFrame and a statement, as text; empty when nothing does."""
    connection = connect(folder)
    result = connection.execute(statement)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = normalized(names, result.fetchall())
    problems = []
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    for field in frame.schema.fields:
        wanted = TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if wanted != types[field.name]:
            problems.append(f"type of {field.name}: {wanted} != {types[field.name]}")
    got = normalized(frame.columns, [tuple(r) for r in frame.collect()])
    if len(got) != len(expected):
        problems.append(f"{len(got)} rows != {len(expected)}")
    different = [(a, b) for a, b in zip(got, expected) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}")
    return "; ".join(problems)
