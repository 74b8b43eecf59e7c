"""Rules as data: one-pass evaluation, NL parsing and the implied checks."""

from kestrel.operators import rules as R


def test_business_rules_null_is_not_violation(spark):
    df = spark.createDataFrame([(10, "a@b", "0123456789"), (None, None, None), (95, "nope", "1")],
                               "age int, email string, phone string")
    got = {r["rule_name"]: r["violations"] for r in R.business_rules(df, "customers_silver",
                                                                      rules=[("customers_silver", "age_valid", "age < 18 OR age > 90"),
                                                                             ("customers_silver", "email_valid", "NOT contains(email, '@')"),
                                                                             ("customers_silver", "phone_valid", "length(phone) != 10")]).collect()}
    assert got == {"age_valid": 2, "email_valid": 1, "phone_valid": 1}


def test_parse_and_evaluate_reference_rule(spark):
    rules = spark.createDataFrame([("Flag transactions where amount > 500000 and merchant_id is missing",)],
                                  "rule_text string")
    parsed = R.parse_rules(rules, created_at="2024-02-01")
    p = parsed.first()
    assert p["column"] == "amount,merchant_id" and p["rule_type"] == "null_check"
    assert p["thresholds"]["max"] == 500000.0 and p["severity"] == "high" and p["action"] == "flag"
    assert p["rule_id"].startswith("rule_") and len(p["rule_id"]) == 11
    checks = R.rule_checks(parsed)
    got = sorted((r["check"], r["column_name"], r["threshold"]) for r in checks.collect())
    assert got == [("greater_than", "amount", 500000.0), ("is_null", "amount", None), ("is_null", "merchant_id", None)]
    tx = spark.createDataFrame([(600000.0,), (None,), (10.0,)], "amount double")
    res = {(r["check"], r["column_name"]): (r["violations"], r["error"]) for r in R.evaluate_rules(tx, checks).collect()}
    assert res[("is_null", "amount")] == (1, None)
    assert res[("greater_than", "amount")] == (1, None)
    assert res[("is_null", "merchant_id")] == (None, "unknown column: merchant_id")


def test_documented_rules(spark):
    df = spark.createDataFrame([(-1, "a@b.co"), (5, "no-at-sign.example.com"), (7, "x@y"), (9, None), (3, "@b.c")],
                               "age int, email string")
    got = {r["rule_name"]: r["violations"] for r in
           R.business_rules(df, "customers_silver", rules=R.DOCUMENTED_RULES).collect()}
    assert got == {"age_negative": 1, "invalid_email_format": 3}   # NULL email is not a violation


def test_rule_without_a_check_keeps_a_row(spark):
    texts = ["Flag rows where email is malformed", "Flag rows where status is not one of a, b", "Flag rows where amount > 5"]
    parsed = R.parse_rules(spark.createDataFrame([(t,) for t in texts], "rule_text string"), created_at="2024-02-01")
    checks = R.rule_checks(parsed)
    assert {r["description"] for r in checks.collect()} == set(texts)
    res = {r["description"]: r for r in R.evaluate_rules(spark.createDataFrame([(6.0,)], "amount double"), checks).collect()}
    for t in texts[:2]:
        assert (res[t]["check_no"], res[t]["check"], res[t]["violations"], res[t]["error"]) == (None, None, None, "not checkable")
    assert (res[texts[2]]["check"], res[texts[2]]["violations"], res[texts[2]]["error"]) == ("greater_than", 1, None)
