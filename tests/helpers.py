"""Small hand-made domain tables for unit tests."""

from decimal import Decimal

from registrar.schema import REQUEST_SCHEMAS, SCHEMAS


def df(spark, name, rows):
    schema = SCHEMAS.get(name) or REQUEST_SCHEMAS[name]
    return spark.createDataFrame(rows, schema)


def D(x):
    return None if x is None else Decimal(str(x))


def campus(spark, **tables):
    """Domain tables: the given ones plus empty versions of the rest."""
    out = {n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()}
    for name, rows in tables.items():
        out[name] = df(spark, name, rows)
    return out
