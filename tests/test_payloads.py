from __future__ import annotations

import json


def _audit(spark, payloads):
    from tidemark.operators import profile

    return dict(map(tuple, profile.audit_raw_claims(spark.createDataFrame([(x,) for x in payloads], "payload string")).collect()))


def test_currencies_elsewhere_are_found_in_walked_payloads_only(spark, monkeypatch):
    from tidemark.operators import profile

    plain = [json.dumps({"claim_id": f"p{i}", "amount": {"value": "1", "currency": "USD"}}) for i in range(5)] + ['{"claim_id":"n","amount":{"value":"1"}}', "not json"]
    odd = [
        '{"claim_id":"a","Moneda":"ARS","amount":{"currency":"USD"}}', '{"claim_id":"b","amount":{"currency":{"x":"ABC"}}}', '{"claim_id":"c","\\u0063urrency":"ABC"}',
        '{"claim_id":"d","x":[{"subCURRENCY":"BRL"}]}', '{"claim_id":"e","currency":"lower case"}', '{"claim_id":"f","amount":{"currency":null},"currency":"ABC"}', '{"claim_id":"a","moneda":"ARS"}',
    ]
    walked, whole = [], profile.json_leaves
    monkeypatch.setattr(profile, "json_leaves", lambda df, *a: walked.append(df.count()) or whole(df, *a))
    found = _audit(spark, plain + odd)
    assert found["currency_elsewhere"] == 5 and walked == [7]
    assert found["repeated_ids"] == 1 and found["conflicting_ids"] == 1 and found["currency_nested"] == 1 and found["currency_absent"] == 7
    assert _audit(spark, [plain[0]] * 2)["conflicting_ids"] == 0


def test_batch_checks_shuffle_once_and_tell_nulls_apart(spark):
    from tidemark.operators.parse import batch_checks

    rows = [("a", "x", None), ("a", None, "x"), ("b", "x", "y"), ("b", "x", "y"), (None, "1", None), (None, "2", None), ("c", None, None)]
    df = spark.createDataFrame(rows, "k string, u string, v string")
    checked = batch_checks(df, ["k"], 7)
    assert tuple(checked.first()) == (7, 7, 2, 2)
    assert tuple(batch_checks(df.limit(0), ["k"], 0).first()) == (0, 0, 0, 0)
    assert checked._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_payloads_are_parsed_once_and_texts_before_dates(spark):
    from tidemark.operators.parse import parse_claims

    df = parse_claims(spark.createDataFrame([('{"claim_id":1.50,"status":true,"type":{"a":1},"occurred_at":"31/12/1999","reported_at":"1999-12-31T23:00:00-02:00","amount":{"value":12.5,"currency":"\\u0055SD"},"detail":null}',)], "payload string"))
    r = df.first()
    assert (r.claim_id, r.status, r.claim_type, str(r.occurred_on), str(r.reported_on), str(r.amount), r.currency, r.city) == ("1.5", "true", None, "1999-12-31", "2000-01-01", "12.500000000", "USD", None)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json") + plan.count("parseJson") == 1
