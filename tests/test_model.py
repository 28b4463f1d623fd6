"""The installation's fixed values, spelled out apart from the module that holds them."""

from spanwatch.model import LOCATIONS, TABLE_KEYS, hub_of, table_schema, thermometer_of

GAUGE_THERMOMETERS = {
    "T1": "S7 S8 S9 S10 S11 S12 S13 S14",
    "T2": "S15 S16 S17 S18",
    "T3": "S19 S20 S21 S22 S23 S24 S25 S26",
    "T4": "S27",
    "T5": "S28",
    "T6": "S29",
}
COLUMNS = {
    "sst_hub1": "datetime S27 S28 S29 T4 T5 T6",
    "sst_hub2": "datetime S7 S8 S9 S10 S11 S12 S13 S14 T1",
    "sst_hub3": "datetime S15 S16 S17 S18 T2",
    "sst_hub4": "datetime S19 S20 S21 S22 S23 S24 S25 S26 T3",
    "fft_hub1": "datetime sensor_id fft_main_f fft_main_a fft_freqs fft_amps",
    "accel_all": "datetime A33_t A33_x A33_y A33_z A34_t A34_x A34_y A34_z A35_t A35_x A35_y A35_z "
    "A30_t A30_x A30_y A30_z A31_t A31_x A31_y A31_z A32_t A32_x A32_y A32_z",
}


def test_pairs_hubs_and_labels():
    for thermometer, gauges in GAUGE_THERMOMETERS.items():
        assert [thermometer_of(g) for g in gauges.split()] == [thermometer] * len(gauges.split())
    assert [hub_of(s) for s in ("A30", "A31", "A32", "A33", "A34", "A35")] == ["hub2", "hub3", "hub4", "hub1", "hub1", "hub1"]
    assert len(LOCATIONS) == 35
    assert LOCATIONS["S7"] == "Arch, Section 1 – Top" and LOCATIONS["S26"] == "Arch, Section 4 – Bottom Left"
    assert LOCATIONS["A31"] == "Arch (Middle)" and LOCATIONS["T6"] == "T6 (Top)"


def test_schemas():
    assert TABLE_KEYS == "accel_all fft_hub1 fft_hub2 fft_hub3 fft_hub4 sst_hub1 sst_hub2 sst_hub3 sst_hub4".split()
    for key, names in COLUMNS.items():
        assert table_schema(key).names == names.split()
    kinds = {f.name: f.dataType.simpleString() for f in table_schema("fft_hub3").fields}
    assert kinds["datetime"] == "timestamp_ntz" and kinds["fft_freqs"] == "array<float>" and kinds["sensor_id"] == "string"
