from decimal import Decimal

from tellerlake.operators import masking

SCHEMA = "transaction_id string, account_id string, amount decimal(18,2)"


def test_roles(spark):
    df = spark.createDataFrame([("T1", "ACCT-1", Decimal("5.00"))], SCHEMA)
    hidden = masking.apply_masks(df, "t_transaction", ["ANALYST"]).first()
    # The account id is protected in the account table only, so joins on it keep working here.
    assert (hidden.account_id, hidden.amount) == ("ACCT-1", Decimal("0.00"))
    for role in ("SYSADMIN", "accountadmin"):
        assert masking.apply_masks(df, "t_transaction", [role]).first().amount == Decimal("5.00")
    assert masking.apply_masks(df, "dim_date").first().amount == Decimal("5.00")


def test_assignments_cover_fifteen_columns():
    assert len(masking.ASSIGNMENTS) == 15
    assert len({(layer, table) for layer, table, _, _ in masking.ASSIGNMENTS}) == 6


def test_view_and_sample(spark):
    df = spark.createDataFrame([(f"ACCT-{n}", "CUST-1") for n in range(9)], "account_id string, customer_id string")
    masking.publish_masked_view(df, "t_account", "accounts_for_analysts", ["ANALYST"])
    assert {r.account_id for r in spark.sql("SELECT * FROM accounts_for_analysts").collect()} == {"ACCT-***"}
    assert masking.masked_sample(df, "t_account", "account_id").count() == 5


def test_coverage(spark):
    df = spark.createDataFrame([("T1", "A", Decimal("5.00")), ("T2", "A", Decimal("0.00")), ("T3", "A", None)], SCHEMA)
    row = masking.column_coverage({"t_transaction": df}).first()
    # A zero is not changed by its mask; a NULL becomes zero.
    assert (row.total_rows, row.present_values, row.masked_values) == (3, 2, 2)
