"""Nested documents to the rows of the weekly tables.

``parse_documents`` reads each line once into one typed row; the three families
are projections of that row. Write the parsed rows to a table when more than one
family is needed, and every line is parsed exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.functions import (
    document_float_sql,
    has_quoted_reading,
    iso_week,
    iso_year,
    parse_iso,
)
from spanwatch.model import (
    ACCELEROMETERS,
    HUB_SENSORS,
    HUBS,
    TABLE_KEYS,
    accel_columns,
    hub_of,
    sst_columns,
)
from spanwatch.sources.documents import emit_when, with_stamp


def is_object_sql(path: str) -> str:
    """True if the key holds an object; false for a missing key, null or a scalar."""
    return f"try_variant_get(doc, '{path}', 'map<string,variant>') IS NOT NULL"


def accel_sql() -> str:
    """All accelerometer values, one field per sensor and axis."""
    fields = []
    for column in accel_columns():
        path = "$." + column.replace("_", ".")
        fields.append(f"'{column}', {document_float_sql('doc', path, 'quoted')}")
    return f"named_struct({', '.join(fields)})"


def hub_sql(hub: str) -> str:
    """A hub's strain and temperature values; null if the document has none of its keys."""
    keys = {name: "s" for name in HUB_SENSORS[hub]["S"]}
    keys |= {name: "t" for name in HUB_SENSORS[hub]["T"]}
    present = " OR ".join(is_object_sql(f"$.{name}") for name in keys)
    fields = [
        f"'{name}', {document_float_sql('doc', f'$.{name}.{key}', 'quoted')}"
        for name, key in keys.items()
    ]
    return f"CASE WHEN {present} THEN named_struct({', '.join(fields)}) END"


# Spectra as numbers. A document this schema does not fit exactly leaves nulls and
# is read again element by element.
SPECTRA_SCHEMA = ", ".join(
    f"{a} struct<fft: struct<spectrum: array<struct<f: double, a: double>>>>"
    for a in ACCELEROMETERS
)


def spectrum_sql(sensor: str) -> str:
    """A sensor's spectrum; null if ``fft`` is missing or empty.

    A bad list element stays as null in its place, so both lists keep one length.
    """
    numbers = f"spectra.{sensor}.fft.spectrum"
    items = f"try_variant_get(doc, '$.{sensor}.fft.spectrum', 'array<variant>')"
    fft = f"try_variant_get(doc, '$.{sensor}.fft', 'map<string,variant>')"
    regular = (
        f"{numbers} IS NOT NULL AND forall({numbers}, p -> p.f IS NOT NULL AND p.a IS NOT NULL)"
    )

    def values(key: str) -> str:
        one_by_one = f"transform({items}, item -> {document_float_sql('item', f'$.{key}')})"
        return (
            f"CASE WHEN {regular} THEN cast({numbers}.{key} AS array<float>) "
            f"ELSE coalesce({one_by_one}, cast(array() AS array<float>)) END"
        )

    def main(key: str) -> str:
        return document_float_sql("doc", f"$.{sensor}.fft.main.{key}", "quoted")

    return (
        f"CASE WHEN {numbers} IS NOT NULL OR size({fft}) > 0 THEN named_struct("
        f"'hub', '{hub_of(sensor)}', 'sensor_id', '{sensor}', "
        f"'fft_main_f', {main('f')}, 'fft_main_a', {main('a')}, "
        f"'fft_freqs', {values('f')}, 'fft_amps', {values('a')}) END"
    )


def spectra_sql() -> str:
    return f"array_compact(array({', '.join(spectrum_sql(a) for a in ACCELEROMETERS)}))"


FAMILIES = ["accel", *HUBS, "fft"]


def _family_sql(family: str) -> str:
    if family == "accel":
        return accel_sql()
    return spectra_sql() if family == "fft" else hub_sql(family)


def _places() -> dict[str, Column]:
    written = F.substring("stamp", 1, 10).try_cast("date")
    return {"datetime": parse_iso("stamp"), "iso_year": iso_year(written), "iso_week": iso_week(written)}


def placed(rows: DataFrame) -> DataFrame:
    """Rows with a ``stamp`` with its time, and the week written in it, added."""
    return rows.withColumns(_places())


def parse_documents(documents: DataFrame, families: list[str] | None = None) -> DataFrame:
    """One typed row per document that states a time.

    Columns: ``datetime`` (null if its text cannot be read), ``stamp``, the ISO year
    and week of the date written in the text, ``accel``, one struct per hub and
    ``fft``, the list of spectra present. The week is the written one, so an offset
    never moves a document into another week. A line that is not JSON gives a row
    with null ``stamp`` and the line in ``broken``. ``families`` restricts the value
    columns to the ones needed.
    """
    families = FAMILIES if families is None else families
    broken = F.expr("doc IS NULL AND trim(value) <> ''")
    places = _places()
    row = F.struct(
        places.pop("datetime").alias("datetime"),
        F.col("stamp"),
        *[column.alias(name) for name, column in places.items()],
        *[F.expr(_family_sql(name)).alias(name) for name in families],
        F.when(broken, F.col("value")).alias("broken"),
    )
    stamped = with_stamp(documents).withColumn("quoted", has_quoted_reading(F.col("value")))
    if "fft" in families:
        stamped = stamped.withColumn("spectra", F.from_json("value", SPECTRA_SCHEMA))
    stated = F.expr("stamp IS NOT NULL AND stamp <> ''")
    typed = stamped.select((stated | broken).alias("keep"), row.alias("row"))
    return emit_when(typed, F.col("keep"), F.col("row")).select("row.*")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Documents that could not be placed in time, with the reason."""
    return parsed.where(F.col("datetime").isNull()).select(
        F.when(F.col("broken").isNotNull(), "not JSON").otherwise("unreadable datetime").alias("reason"),
        "stamp",
        F.col("broken").alias("line"),
    )


def _timed(parsed: DataFrame, keep: list[str]) -> DataFrame:
    return parsed.where(F.col("datetime").isNotNull()).select("datetime", *keep)


def accel_rows(parsed: DataFrame, keep: list[str] = []) -> DataFrame:
    """One row per document, also when it holds no accelerometer."""
    return _timed(parsed, [*keep, "accel.*"])


def sst_rows(parsed: DataFrame, hub: str, keep: list[str] = []) -> DataFrame:
    """Rows of one hub's strain/temperature table."""
    return _timed(parsed.where(F.col(hub).isNotNull()), [*keep, f"{hub}.*"])


def hub_rows(parsed: DataFrame, keep: list[str] = []) -> DataFrame:
    """Rows of all hubs' strain/temperature tables at once, with their ``hub``.

    Each document is read once and gives a row for every hub it has values of; the
    columns of the other hubs are null there.
    """
    names = [c for hub in HUBS for c in sst_columns(hub)]

    def row(hub: str):
        own = set(sst_columns(hub))
        fields = [(F.col(hub)[c] if c in own else F.lit(None).cast("float")).alias(c) for c in names]
        return F.when(F.col(hub).isNotNull(), F.struct(F.lit(hub).alias("hub"), *fields))

    present = F.array_compact(F.array(*[row(hub) for hub in HUBS]))
    return _timed(parsed, [*keep, *HUBS]).select("datetime", *keep, F.inline(present))


def fft_rows(parsed: DataFrame, keep: list[str] = []) -> DataFrame:
    """One row per document and sensor with a spectrum, with its hub."""
    return _timed(parsed, [*keep, "fft"]).select("datetime", *keep, F.inline("fft"))


def flatten(documents: DataFrame, keys: list[str] = TABLE_KEYS) -> dict[str, DataFrame]:
    """Weekly tables of a set of documents, by table key.

    Each table reads the lines by itself and extracts only its own columns; see
    ``spanwatch.plans.ingest`` for writing all of them after a single parse.
    """
    tables = {}
    if "accel_all" in keys:
        tables["accel_all"] = accel_rows(parse_documents(documents, ["accel"]))
    if any(key.startswith("fft_") for key in keys):
        spectra = fft_rows(parse_documents(documents, ["fft"]))
    for hub in HUBS:
        if f"fft_{hub}" in keys:
            tables[f"fft_{hub}"] = spectra.where(F.col("hub") == hub).drop("hub")
        if f"sst_{hub}" in keys:
            tables[f"sst_{hub}"] = sst_rows(parse_documents(documents, [hub]), hub)
    return {key: tables[key] for key in keys}
