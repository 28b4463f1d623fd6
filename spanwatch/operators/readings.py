"""Plain sensor documents read a batch at a time by Arrow's JSON reader.

A plain document states an ISO time and holds nothing but readings of the known sensors,
all of them numbers or null. All others (broken lines, quoted numbers, spectra, keys of
no sensor, keys twice) are handed on as lines, for
:func:`spanwatch.operators.flatten.parse_documents`, which reads plain ones to the same
values.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.json as pj
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from spanwatch.model import ACCELEROMETERS, AXES, GAUGES, HUBS, THERMOMETERS, accel_columns, sst_columns

# Travels to the executors as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ACCEL = accel_columns()
_COLUMNS = {hub: sst_columns(hub) for hub in HUBS}

# Lines that do not fit together are tried in pieces down to this many.
LEAST_LINES = 8
PIECES = 8

_STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9:.,]+(Z|[+-][0-9:]+)?$"
_NUMBER = pa.float64()
_FIELDS = pa.schema(
    [
        ("time", pa.struct([("datetime", pa.string())])),
        *[(a, pa.struct([(axis, _NUMBER) for axis in AXES])) for a in ACCELEROMETERS],
        *[(s, pa.struct([("s", _NUMBER)])) for s in GAUGES],
        *[(t, pa.struct([("t", _NUMBER)])) for t in THERMOMETERS],
    ]
)


def _floats(names: list[str]) -> str:
    return f"struct<{', '.join(f'{name}: float' for name in names)}>"


SCHEMA = ", ".join(["stamp string", f"accel {_floats(_ACCEL)}", *[f"{hub} {_floats(names)}" for hub, names in _COLUMNS.items()], "line string"])
_NAMES = ["stamp", "accel", *_COLUMNS, "line"]


def _candidates(lines: pa.Array) -> pa.Array:
    """Lines that may be plain documents: one object without a line break or spectrum."""
    odd = pc.or_(pc.match_substring_regex(lines, r"[\r\n]"), pc.match_substring(lines, '"fft"'))
    return pc.fill_null(pc.and_not(pc.and_(pc.starts_with(lines, "{"), pc.ends_with(lines, "}")), odd), False)


def _fitting(lines: pa.Array) -> pa.Table | None:
    """The fields of the lines, or None if one of them is not a plain document."""
    data = pc.binary_join_element_wise(lines, "\n", "").buffers()[2]
    try:
        table = pj.read_json(
            pa.BufferReader(data),
            pj.ReadOptions(use_threads=False, block_size=data.size + 1),
            pj.ParseOptions(explicit_schema=_FIELDS, unexpected_field_behavior="error"),
        )
    except pa.ArrowInvalid:
        return None
    # Every line holds one object at least, so a line of two makes a row too many.
    if table.num_rows != len(lines):
        return None
    table = table.combine_chunks()
    stamp = pc.struct_field(table.column("time"), "datetime")
    return table if pc.all(pc.fill_null(pc.match_substring_regex(stamp, _STAMP), False)).as_py() else None


def _structs(table: pa.Table, columns: dict[str, tuple[str, str]], mask: pa.Array | None = None) -> pa.Array:
    # A zero's sign is not kept, as decimals have none.
    parts = [pc.cast(pc.add(pc.struct_field(table.column(s), key), 0.0), pa.float32()).combine_chunks() for s, key in columns.values()]
    return pa.StructArray.from_arrays([p if isinstance(p, pa.Array) else p.chunk(0) for p in parts], list(columns), mask=mask)


def _typed(table: pa.Table) -> pa.RecordBatch:
    accel = _structs(table, {c: tuple(c.split("_")) for c in _ACCEL})
    hubs = []
    for names in _COLUMNS.values():
        absent = pc.is_null(table.column(names[0]))
        for name in names[1:]:
            absent = pc.and_(absent, pc.is_null(table.column(name)))
        hubs.append(_structs(table, {n: (n, "s" if n in GAUGES else "t") for n in names}, absent.combine_chunks()))
    stamp = pc.struct_field(table.column("time"), "datetime").combine_chunks()
    return pa.RecordBatch.from_arrays([stamp, accel, *hubs, pa.nulls(table.num_rows, pa.string())], _NAMES)


def _others(lines: pa.Array) -> pa.RecordBatch:
    n = len(lines)
    empty = [pa.nulls(n, pa.string()), pa.nulls(n, pa.struct([(c, pa.float32()) for c in _ACCEL]))]
    empty += [pa.nulls(n, pa.struct([(c, pa.float32()) for c in names])) for names in _COLUMNS.values()]
    return pa.RecordBatch.from_arrays([*empty, lines], _NAMES)


def _read(lines: pa.Array) -> Iterator[pa.RecordBatch]:
    if not len(lines):
        return
    table = _fitting(lines)
    if table is not None:
        yield _typed(table)
    elif len(lines) <= LEAST_LINES:
        yield _others(lines)
    else:
        size = -(-len(lines) // PIECES)
        for at in range(0, len(lines), size):
            yield from _read(lines[at : at + size])


def read_readings(documents: DataFrame) -> DataFrame:
    """Plain documents as typed rows (``stamp``, ``accel`` and one struct per hub, as
    ``parse_documents`` names them), all others as ``line``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = pc.cast(batch.column(0), pa.string())
            plain = _candidates(lines)
            yield from _read(lines.filter(plain))
            rest = lines.filter(pc.and_(pc.invert(plain), pc.is_valid(lines)))
            if len(rest):
                yield _others(rest)

    return documents.select("value").mapInArrow(run, SCHEMA)
