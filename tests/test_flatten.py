import math

from helpers import at, lines, rows
from pyspark.sql import functions as F

from spanwatch.model import HUBS, TABLE_KEYS, table_schema
from spanwatch.operators.flatten import flatten, parse_documents, quarantine

T0 = '"time": {"datetime": "2025-12-01T00:00:01.250"}'


def test_a_whole_document(spark):
    doc = (
        f'{{{T0}, "A30": {{"t": 4.5, "x": 0.25, "y": 0.5, "z": 1, "fft": {{"main": {{"f": 2.5, "a": 0.125}},'
        '"spectrum": [{"f": 2.5, "a": 0.125}, {"f": 4.25, "a": 0.0625}]}}, "S7": {"s": 41234.0}, "T1": {"t": 4.5}}'
    )
    tables = flatten(lines(spark, doc))
    stamp = at("2025-12-01T00:00:01.250")
    accel = tables["accel_all"].first()
    assert (accel.datetime, accel.A30_t, accel.A30_x, accel.A30_y, accel.A30_z) == (stamp, 4.5, 0.25, 0.5, 1.0)
    assert accel.A33_x is None
    assert rows(tables["fft_hub2"]) == [(stamp, "A30", 2.5, 0.125, [2.5, 4.25], [0.125, 0.0625])]
    sst = tables["sst_hub2"].first()
    assert (sst.datetime, sst.S7, sst.S8, sst.T1) == (stamp, 41234.0, None, 4.5)
    for key in TABLE_KEYS:
        if key not in ("accel_all", "fft_hub2", "sst_hub2"):
            assert tables[key].count() == 0


def test_columns_and_types(spark):
    tables = flatten(lines(spark, "{}"))
    for key in TABLE_KEYS:
        assert tables[key].schema.simpleString() == table_schema(key).simpleString()


def test_documents_without_a_time_leave_no_row(spark):
    docs = lines(spark, '{"S7":{"s":1}}', '{"time":{},"S7":{"s":1}}', '{"time":{"datetime":""}}', '{"time":null}', "")
    for frame in flatten(docs).values():
        assert frame.count() == 0
    assert quarantine(parse_documents(docs)).count() == 0


def test_unreadable_documents_are_set_aside(spark):
    docs = lines(spark, "{broken", '{"time":{"datetime":"soon"},"S7":{"s":1}}', f"{{{T0}}}")
    parsed = parse_documents(docs)
    assert rows(quarantine(parsed), "reason") == [
        ("not JSON", None, "{broken"),
        ("unreadable datetime", "soon", None),
    ]
    assert flatten(docs)["sst_hub2"].count() == 0
    assert flatten(docs)["accel_all"].count() == 1


def test_offset_moves_the_time_but_not_the_week(spark):
    docs = lines(spark, '{"time":{"datetime":"2025-12-01T00:30:00+02:00"},"S7":{"s":1}}')
    row = parse_documents(docs).first()
    assert row.datetime == at("2025-11-30T22:30")
    assert (row.iso_year, row.iso_week) == (2025, 49)


def _sst(spark, body):
    return [tuple(r) for r in flatten(lines(spark, f"{{{T0}, {body}}}"), ["sst_hub2"])["sst_hub2"].select("S7", "T1").collect()]


def test_presence_of_a_key_makes_a_hub_row(spark):
    assert _sst(spark, '"S7": {"s": 2}') == [(2.0, None)]
    assert _sst(spark, '"S7": {}') == [(None, None)]
    assert _sst(spark, '"S7": {"s": null}') == [(None, None)]
    assert _sst(spark, '"S7": null') == []
    assert _sst(spark, '"S7": 5') == []
    assert _sst(spark, '"S15": {"s": 2}') == []
    assert _sst(spark, '"T1": {"t": 3}') == [(None, 3.0)]


def test_every_timed_document_has_an_acceleration_row(spark):
    row = flatten(lines(spark, f'{{{T0}, "S7": {{"s": 1}}}}'), ["accel_all"])["accel_all"].first()
    assert row.datetime is not None and all(v is None for v in row[1:])


def _fft(spark, fft):
    docs = lines(spark, f'{{{T0}, "A31": {{"fft": {fft}}}}}')
    return [tuple(r)[2:] for r in flatten(docs, ["fft_hub3"])["fft_hub3"].collect()]


def test_spectrum_rows(spark):
    assert _fft(spark, "{}") == []
    assert _fft(spark, "null") == []
    assert _fft(spark, '{"main": null}') == [(None, None, [], [])]
    assert _fft(spark, '{"spectrum": []}') == [(None, None, [], [])]
    assert _fft(spark, '{"main": {}, "spectrum": null}') == [(None, None, [], [])]
    assert _fft(spark, '{"main": {"f": "2.5"}, "spectrum": [{"f": 1, "a": 0.5}]}') == [(2.5, None, [1.0], [0.5])]


def test_bad_spectrum_elements_keep_their_place(spark):
    got = _fft(spark, '{"spectrum": [{"f":1,"a":"x"}, 3, {"f":2}, {"f":"4.5","a":true}, null, {"f":"1f","a":"1_0"}]}')
    assert got == [(None, None, [1.0, None, 2.0, 4.5, None, None], [None, None, None, 1.0, None, 10.0])]


def test_regular_and_irregular_spectra_agree_on_numbers(spark):
    points = ",".join(f'{{"f": {i / 7!r}, "a": {1 / (i + 3)!r}}}' for i in range(40))
    regular = _fft(spark, f'{{"spectrum": [{points}]}}')[0]
    irregular = _fft(spark, f'{{"spectrum": [{points}, 3]}}')[0]
    assert regular[2] == irregular[2][:-1] and regular[3] == irregular[3][:-1]


def test_bare_nan_keeps_the_document(spark):
    row = flatten(lines(spark, f'{{{T0}, "S7": {{"s": NaN}}, "S8": {{"s": 2}}}}'), ["sst_hub2"])["sst_hub2"].first()
    assert math.isnan(row.S7) and row.S8 == 2.0


def test_each_line_is_parsed_once(spark):
    plan = parse_documents(lines(spark, "{}"), ["hub2"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_hubs_do_not_mix(spark):
    docs = lines(spark, f'{{{T0}, "S27": {{"s": 1}}, "S7": {{"s": 2}}, "S15": {{"s": 3}}, "S19": {{"s": 4}}}}')
    tables = flatten(docs, [f"sst_{h}" for h in HUBS])
    firsts = {k: f.select(F.col(f.columns[1])).first()[0] for k, f in tables.items()}
    assert firsts == {"sst_hub1": 1.0, "sst_hub2": 2.0, "sst_hub3": 3.0, "sst_hub4": 4.0}
