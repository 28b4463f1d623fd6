from pyspark.sql import functions as F

from spanwatch.operators.flatten import parse_documents
from spanwatch.operators.readings import read_readings
from spanwatch.plans.ingest import stage

TIME = '{"time":{"datetime":"2024-01-02T03:04:05.000006"}'
PLAIN = [
    TIME + "}",
    *[TIME + f',"S7":{{"s":{value}}}}}' for value in ("1", "-2.5e3", "null", "0.1234567890123456789012345678901234567890123", "16777217.0000000001")],
    TIME + ',"S7":{}}',
    TIME + ',"T4":null,"A30":{"t":1,"x":2.5}}',
    '{"time":{"datetime":"2024-01-02T03:04:05+02:00"},"T4":{"t":3}}',
    '{"time":{"datetime":"2024-13-02T03:04:05.000000"},"T4":{"t":3}}',
    '{"time":{"datetime":"2024-01-02T25:04:05.000000"},"T4":{"t":3}}',
]
OTHER = [
    *[TIME + f',"S7":{{"s":{value}}}}}' for value in ("true", '"1.5"', '"NaN"', "NaN", "[1]", "01", ".5")],
    TIME + ',"S7":{"s":1},"S7":{"s":2}}',
    TIME + ',"S7":{"s":1,"s":2}}',
    TIME + ',"S7":{"s":1},"q":3}',
    TIME + ',"S7":5}',
    TIME + ',\n"S7":{"s":1}}',
    TIME + ',"A30":{"fft":{"main":{"f":1},"spectrum":[{"f":1,"a":2}]}}}',
    f" {TIME}}}",
    f"{TIME}}} x",
    f"{TIME}}}{TIME}}}",
    TIME,
    '{"time":{"datetime":20240102},"T4":{"t":3}}',
    '{"time":{"datetime":""}}',
    '{"time":{"datetime":null}}',
    *["{}", "null", "[]", "", " "],
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)


def test_staged_rows_are_those_of_the_parse(spark, tmp_path):
    many = [TIME + f',"S8":{{"s":{k * 0.37}}}}}' for k in range(300)]
    documents = lines(spark, [*many, *PLAIN, *OTHER, None, TIME + ',"S7":{"s":-0.0}}'])
    parsed = parse_documents(documents)
    staged = stage(documents, str(tmp_path / "staged")).select(parsed.columns)
    assert staged.dtypes == parsed.dtypes
    assert sorted(map(repr, staged.collect())) == sorted(map(repr, parsed.collect()))


def test_plain_documents_are_not_parsed_one_by_one(spark):
    found = {r.line for r in read_readings(lines(spark, PLAIN + OTHER)).where(F.col("line").isNotNull()).collect()}
    assert found >= set(OTHER)
    assert read_readings(lines(spark, PLAIN * 5)).where(F.col("line").isNotNull()).count() == 0
