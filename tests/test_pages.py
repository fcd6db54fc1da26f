from __future__ import annotations

import hashlib
import json
import math

import pyarrow as pa

from tidemark.sources import pages


def test_a_batch_of_pages_is_never_held_parsed():
    """Forty pages of 500 records in one Arrow batch: the first records come once they are parsed, some thousand at a time."""
    body = json.dumps({"data": [{"claim_id": str(i), "updated_at": "2024-01-01"} for i in range(500)]})
    bad = json.dumps({"data": 1})  # a last page that fails
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * 41), pa.array(range(41), pa.int64()), pa.array([body] * 40 + [bad])], names=["source_file", "page_number", "body"])
    whole = list(pages.record_batches(iter([batch.slice(0, 40)]), ["claim_id"]))
    assert sum(b.num_rows for b in whole) == 20_000 and max(b.num_rows for b in whole) <= pages.RECORDS_AT_ONCE
    rows = pa.Table.from_batches(whole).to_pylist()
    assert [(r["page_number"], r["record_index"], r["source_key"]) for r in rows] == [(p, i, str(i)) for p in range(40) for i in range(500)]
    assert next(pages.record_batches(iter([batch]), ["claim_id"])).num_rows == pages.RECORDS_AT_ONCE


def test_records_are_written_the_same_way_by_either_path():
    deep = 1
    for _ in range(3_000):
        deep = [deep]
    odd = [{"b": 1.0, "a": "é \"\\\x01", "1": [1e300, -0.0, 10**30, True, None, {}], "": {"z": [], "y": {"k": "v"}}}, "text", 5, None, [], {"n": math.nan, "m": [math.inf, {"x": -math.inf}]}, deep]
    for record in odd:
        assert pages._written(record) == pages.written(record)


def test_page_records_of_odd_pages():
    body = '{"data":["x",{"claim_id":null},{"claim_id":7,"updated_at":3,"v":NaN}]}'
    found = list(pages.page_records(body, ["claim_id"]))
    assert [f[:4] for f in found] == [(0, False, None, None), (1, True, None, None), (2, True, "7", None)]
    assert found[2][5:] == ('{"claim_id":7,"updated_at":3,"v":{"__non_finite_number__":"NaN"}}', [{"path": "$.v", "value": "NaN"}])
    assert found[0][4] == hashlib.sha256(b'"x"').hexdigest()


def test_drift_goes_over_the_records_twice(spark):
    from tidemark.sources.pages import schema_drift

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [(1, True, '{"a":1}'), (2, True, '{"a":"x"}'), (2, True, '{"a":2,"b":null}'), (3, False, '"s"')]
    records = spark.createDataFrame(rows, "page_number long, is_object boolean, payload string").mapInArrow(counted, "page_number long, is_object boolean, payload string")
    got = {tuple(r) for r in schema_drift(records).collect()}
    assert got == {(2, "new_shape", "a,b"), (3, "new_shape", "not an object"), (2, "new_type", "a string"), (2, "mixed_types", "a")}
    assert read.value == 2 * len(rows)
