"""Sensor inventory and table schemas of the installation."""

from __future__ import annotations

from pyspark.sql import types as T

# Which sensors hang on which hub (A accelerometer, S strain gauge,
# T thermometer). The order inside a list is the column order of the tables.
HUB_SENSORS = {
    "hub1": {"A": ["A33", "A34", "A35"], "S": ["S27", "S28", "S29"], "T": ["T4", "T5", "T6"]},
    "hub2": {"A": ["A30"], "S": ["S7", "S8", "S9", "S10", "S11", "S12", "S13", "S14"], "T": ["T1"]},
    "hub3": {"A": ["A31"], "S": ["S15", "S16", "S17", "S18"], "T": ["T2"]},
    "hub4": {"A": ["A32"], "S": ["S19", "S20", "S21", "S22", "S23", "S24", "S25", "S26"], "T": ["T3"]},
}

# Where each sensor sits, as printed on the charts.
LOCATIONS = {
    "T1": "T1 (North)",
    "T2": "T2 (Middle)",
    "T3": "T3 (South)",
    "T4": "T4 (Bottom)",
    "T5": "T5 (Middle)",
    "T6": "T6 (Top)",
    "S7": "Arch, Section 1 – Top",
    "S8": "Arch, Section 1 – Diagonal",
    "S9": "Arch, Section 1 – Bottom Right",
    "S10": "Arch, Section 1 – Bottom Left",
    "S11": "Arch, Section 2 – Diagonal",
    "S12": "Arch, Section 2 – Bottom Right",
    "S13": "Arch, Section 2 – Top",
    "S14": "Arch, Section 2 – Bottom Left",
    "S15": "Arch, Section 3 – Diagonal",
    "S16": "Arch, Section 3 – Top",
    "S17": "Arch, Section 3 – Bottom Left",
    "S18": "Arch, Section 3 – Bottom Right",
    "S19": "Arch, Section 5 – Bottom Left",
    "S20": "Arch, Section 5 – Bottom Right",
    "S21": "Arch, Section 5 – Top",
    "S22": "Arch, Section 4 – Diagonal",
    "S23": "Arch, Section 4 – Bottom Right",
    "S24": "Arch, Section 5 – Diagonal",
    "S25": "Arch, Section 4 – Top",
    "S26": "Arch, Section 4 – Bottom Left",
    "S27": "Column – Bottom",
    "S28": "Column – Middle",
    "S29": "Column – Top",
    "A30": "Arch (North)",
    "A31": "Arch (Middle)",
    "A32": "Arch (South)",
    "A33": "Column (Bottom)",
    "A34": "Column (Middle)",
    "A35": "Column (Top)",
}

# Thermometer beside each gauge of the column; on the arch every
# gauge of a hub shares the hub's only thermometer.
COLUMN_PAIRS = {"S27": "T4", "S28": "T5", "S29": "T6"}

# Fixed value: raw gauge reading to strain; one more factor 1000 gives mm/m.
STRAIN_PER_COUNT = 3.11e-9

HUBS = list(HUB_SENSORS)
ACCELEROMETERS = [a for hub in HUBS for a in HUB_SENSORS[hub]["A"]]
GAUGES = [s for hub in HUBS for s in HUB_SENSORS[hub]["S"]]
THERMOMETERS = [t for hub in HUBS for t in HUB_SENSORS[hub]["T"]]
AXES = ["t", "x", "y", "z"]

TABLE_KEYS = ["accel_all", *[f"fft_{h}" for h in HUBS], *[f"sst_{h}" for h in HUBS]]


def thermometer_of(gauge: str) -> str:
    """Thermometer that goes with a strain gauge."""
    if gauge in COLUMN_PAIRS:
        return COLUMN_PAIRS[gauge]
    return HUB_SENSORS[hub_of(gauge)]["T"][0]


def hub_of(sensor: str) -> str:
    for hub, kinds in HUB_SENSORS.items():
        if any(sensor in names for names in kinds.values()):
            return hub
    raise ValueError(f"unknown sensor {sensor!r}")


def sst_columns(hub: str) -> list[str]:
    """Value columns of a hub's strain/temperature table, in table order."""
    return HUB_SENSORS[hub]["S"] + HUB_SENSORS[hub]["T"]


def accel_columns() -> list[str]:
    return [f"{a}_{axis}" for a in ACCELEROMETERS for axis in AXES]


def _schema(fields) -> T.StructType:
    return T.StructType([T.StructField("datetime", T.TimestampNTZType()), *fields])


ACCEL_SCHEMA = _schema([T.StructField(c, T.FloatType()) for c in accel_columns()])

FFT_SCHEMA = _schema(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("fft_main_f", T.FloatType()),
        T.StructField("fft_main_a", T.FloatType()),
        T.StructField("fft_freqs", T.ArrayType(T.FloatType())),
        T.StructField("fft_amps", T.ArrayType(T.FloatType())),
    ]
)


def sst_schema(hub: str) -> T.StructType:
    return _schema([T.StructField(c, T.FloatType()) for c in sst_columns(hub)])


def table_schema(key: str) -> T.StructType:
    """Schema of one of the nine weekly tables."""
    if key not in TABLE_KEYS:
        raise ValueError(f"unknown table {key!r}; expected one of {TABLE_KEYS}")
    if key == "accel_all":
        return ACCEL_SCHEMA
    family, hub = key.split("_")
    return FFT_SCHEMA if family == "fft" else sst_schema(hub)
