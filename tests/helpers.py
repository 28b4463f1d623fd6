"""Small hand-written inputs."""

from datetime import datetime

from spanwatch.model import TABLE_KEYS, table_schema


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(frame, *order):
    """Rows as tuples, sorted by the given columns."""
    if order:
        frame = frame.orderBy(*order)
    return [tuple(r) for r in frame.collect()]


def table(spark, key, records):
    """A weekly table from dicts; columns left out are null."""
    schema = table_schema(key)
    data = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(data, schema)


def tables(spark, **given):
    return {key: table(spark, key, given.get(key, [])) for key in TABLE_KEYS}


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")
