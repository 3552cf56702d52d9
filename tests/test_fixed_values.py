"""The lists that both the code and the check SQL use, written out once more.

The check SQL reads some of these lists from the code, so a wrong entry would
pass on both sides; here it does not.
"""

from dataclasses import astuple

from tellerlake.functions.text import EMAIL_PATTERN
from tellerlake.operators import cleanse, masking, quality
from tellerlake.plans import daily
from tellerlake.plans.bank_sql import _BAD_EMAIL
from tellerlake.schemas import ACCOUNT_FILE, CUSTOMER_FILE, TRACKED, TRANSACTION_FILE, is_required

# number, table, check, level, text if rows fail, text if none does
RULES = [
    (1, "BRONZE.T_Customer", "NULL_CHECK_Customer_ID", "ERROR", "records with NULL Customer_ID", "All records have Customer_ID"),
    (2, "BRONZE.T_Account", "NULL_CHECK_Account_ID", "ERROR", "records with NULL Account_ID", "All records have Account_ID"),
    (3, "BRONZE.T_Transaction", "NULL_CHECK_Transaction_ID", "ERROR", "records with NULL Transaction_ID", "All records have Transaction_ID"),
    (4, "BRONZE.T_Customer", "DUPLICATE_PK", "WARNING", "duplicate Customer_IDs found", "No duplicate Customer_IDs"),
    (5, "BRONZE.T_Customer", "EMAIL_FORMAT", "WARNING", "records with invalid email format", "All email addresses are valid"),
    (6, "BRONZE.T_Account", "FK_CUSTOMER_REF", "ERROR", "accounts reference non-existent customers", "All accounts reference valid customers"),
    (7, "BRONZE.T_Transaction", "FK_ACCOUNT_REF", "ERROR", "transactions reference non-existent accounts", "All transactions reference valid accounts"),
    (8, "SILVER.DimCustomer", "SCD2_SINGLE_ACTIVE", "ERROR", "customers with multiple active records", "SCD-2 integrity OK"),
]

# layer, table, column, policy
ASSIGNMENTS = [
    ("bronze", "t_customer", "first_name", "MASK_NAME"),
    ("bronze", "t_customer", "last_name", "MASK_NAME"),
    ("bronze", "t_customer", "email_address", "MASK_EMAIL"),
    ("bronze", "t_customer", "phone_number", "MASK_PHONE"),
    ("bronze", "t_customer", "city", "MASK_LOCATION"),
    ("bronze", "t_customer", "state_province", "MASK_LOCATION"),
    ("bronze", "t_account", "account_id", "MASK_FINANCIAL_ID"),
    ("bronze", "t_transaction", "amount", "MASK_AMOUNT"),
    ("silver", "dim_customer", "first_name", "MASK_NAME"),
    ("silver", "dim_customer", "last_name", "MASK_NAME"),
    ("silver", "dim_customer", "email_address", "MASK_EMAIL"),
    ("silver", "dim_customer", "city", "MASK_LOCATION"),
    ("silver", "dim_customer", "state_province", "MASK_LOCATION"),
    ("gold", "fact_daily_transaction", "amount", "MASK_AMOUNT"),
    ("gold", "fact_daily_agg", "total_amount", "MASK_AMOUNT"),
]

CATEGORIES = {
    "MASK_NAME": "PII - Identity",
    "MASK_EMAIL": "PII - Contact",
    "MASK_PHONE": "PII - Contact",
    "MASK_LOCATION": "PII - Location",
    "MASK_FINANCIAL_ID": "Financial - Identifier",
    "MASK_AMOUNT": "Financial - Amount",
}


def test_trimmed_columns():
    assert cleanse.TRIMMED == {
        "t_customer": [
            "customer_id", "first_name", "last_name", "email_address", "phone_number", "city", "state_province", "country",
        ],
        "t_account": ["account_id", "customer_id", "account_type", "status", "currency_code"],
        "t_transaction": ["transaction_id", "account_id", "transaction_type", "description"],
    }
    assert cleanse.KEYS == {"t_customer": "customer_id", "t_account": "account_id", "t_transaction": "transaction_id"}
    assert cleanse.DEFAULT_CURRENCY == "CAD"


def test_tracked_attributes():
    assert TRACKED == ["first_name", "last_name", "email_address", "city", "state_province", "country"]


def test_required_columns():
    required = [[f.name for f in schema.fields if is_required(f)] for schema in (CUSTOMER_FILE, ACCOUNT_FILE, TRANSACTION_FILE)]
    assert required == [["customer_id"], ["account_id", "customer_id"], ["transaction_id", "account_id", "transaction_date"]]


def test_loaded_and_built_tables():
    assert daily.LOADED == ["bronze/t_customer", "bronze/t_account", "bronze/t_transaction"]
    assert len(daily.BUILT) == 5


def test_email_pattern_of_code_and_check():
    assert EMAIL_PATTERN in _BAD_EMAIL


def test_rules():
    assert RULES == [astuple(rule) for rule in quality.RULES]


def test_assignments():
    assert ASSIGNMENTS == [tuple(a) for a in masking.ASSIGNMENTS]
    assert CATEGORIES == masking.CATEGORIES
